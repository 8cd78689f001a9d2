"""Byte-level BPE on padded matrices of distinct pre-tokens.

Pre-tokens of similar length are rows of one numpy matrix of token ids. In every round each row finds its leftmost pair of
minimum rank (a running matrix of pair ranks, looked up in an open-addressing hash table of packed pairs) and merges it;
every row loses exactly one column, so the matrix is compacted by one mask, and rows without a pair leave it.

Rows beyond ``LONG`` bytes merge all non-overlapping occurrences of their minimum-rank pair at once when that cannot change
the result (no new pair has a lower rank), else just the leftmost.

Null and empty texts have no ids. An output column replaces an input column of the same name; other columns pass through.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigstat.llm import pretokens
from sigstat.llm.batches import column, gather, pieces, ragged, release, texts

NONE = np.int32(2**31 - 1)
EMPTY = np.uint64(2**64 - 1)
#: Widths of the matrices; longer pre-tokens are merged alone.
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128)
LONG = WIDTHS[-1]
#: Rows of a matrix, and distinct pre-tokens that a worker remembers (then it starts anew).
ROWS, MEMO = 16384, 100_000
#: Id lists decoded at a time.
ID_LISTS = 200
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def rank_file(path: str | None = None) -> bytes:
    """The vocabulary (a file of fixed size), read by the driver and sent with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        return f.read()


class PairTable:
    """Pair of ids -> rank of the merged token, by open addressing."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(pairs), 1)))) + 2)
        self.keys, self.ranks = np.full(1 << self.bits, EMPTY), np.full(1 << self.bits, NONE)
        slot, left = self.slot(pairs), np.arange(len(pairs))
        while len(left):
            free = self.keys[slot] == EMPTY
            _, one = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.keys[slot[put]], self.ranks[slot[put]] = pairs[left[put]], ranks[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; NONE where there is no such merge or an id is padding (negative)."""
        pairs = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | (right.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF))
        shape, pairs = pairs.shape, pairs.ravel()
        slot = self.slot(pairs)
        got = self.keys[slot]
        out = np.where(got == pairs, self.ranks[slot], NONE)
        open_ = np.flatnonzero((got != pairs) & (got != EMPTY))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            got = self.keys[slot]
            same = got == pairs[open_]
            out[open_[same]] = self.ranks[slot[same]]
            on = ~same & (got != EMPTY)
            open_, slot = open_[on], slot[on]
        return out.reshape(shape)


class Codec:
    """Encoder and decoder of one rank file; ids are the ranks."""

    def __init__(self, raw: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.table = PairTable((np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64), np.array(merged, np.int32))
        size = max(ranks.values()) + 1
        self.width = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self.at = np.cumsum(self.width) - self.width
        self.bytes = np.zeros(int(self.width.sum()), np.uint8)
        for token, rank in ranks.items():
            self.bytes[self.at[rank] : self.at[rank] + len(token)] = np.frombuffer(token, np.uint8)
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # ---- encoding

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, and where in them each pre-token's ids start and how many they are."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int32, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum(size) - size
        start, length = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
        known = np.flatnonzero(whole >= 0)
        start[known] = np.arange(len(known))
        flat, used = [whole[known]], len(known)
        group = np.where(whole < 0, np.searchsorted(WIDTHS, size), -1)
        for g, width in enumerate(WIDTHS):
            members = np.flatnonzero(group == g)
            for begin in range(0, len(members), ROWS):
                part = members[begin : begin + ROWS]
                ids, length[part] = self.merge_rows(raw[gather(at[part], size[part])], size[part], width)
                start[part] = used + np.cumsum(length[part]) - length[part]
                flat.append(ids)
                used += len(ids)
        for k in np.flatnonzero(group == len(WIDTHS)):
            ids = self.merge_long(words[k])
            start[k], length[k] = used, len(ids)
            flat.append(ids)
            used += len(ids)
        return np.concatenate(flat), start, length

    def merge_rows(self, raw: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """All rows of a padded matrix at once, one merge for each row and round: flat ids and lengths."""
        inside = np.arange(width) < lengths[:, None]
        ids = np.full(inside.shape, -1, np.int32)
        ids[inside] = self.byte[raw]
        rank = self.table.find(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(lengths))
        result = np.full(inside.shape, -1, np.int32)
        while len(rows):
            wide = ids.shape[1]
            n = np.arange(len(rows))
            at = rank.argmin(1) if wide > 1 else np.zeros(len(rows), np.int64)
            best = rank[n, at] if wide > 1 else np.full(len(rows), NONE)
            if (done := best == NONE).any():
                result[rows[done], :wide] = ids[done]
                on = ~done
                ids, rank, rows, at, best = ids[on], rank[on], rows[on], at[on], best[on]
                n = n[: len(rows)]
                if not len(rows):
                    break
            ids[n, at] = best
            keep = np.ones(ids.shape, bool)
            keep[n, at + 1] = False
            ids = ids[keep].reshape(len(rows), wide - 1)
            keep = np.ones(rank.shape, bool)
            keep[n, at] = False
            rank = rank[keep].reshape(len(rows), wide - 2)
            before = np.flatnonzero(at > 0)
            after = np.flatnonzero(at < wide - 2)
            row, place = np.concatenate((before, after)), np.concatenate((at[before] - 1, at[after]))
            rank[row, place] = self.table.find(ids[row, place], ids[row, place + 1])
        full = result >= 0
        return result[full], full.sum(1)

    def merge_long(self, word: bytes) -> np.ndarray:
        ids = self.byte[np.frombuffer(word, np.uint8)]
        rank = self.table.find(ids[:-1], ids[1:])
        while len(ids) > 1 and (best := rank.min()) != NONE:
            at = np.flatnonzero(rank == best)
            run = np.concatenate(([True], np.diff(at) > 1))  # of overlapping pairs every second one merges
            order = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            many = at[order % 2 == 0]
            new, fresh = self.merged(ids, rank, many, best)
            if len(many) > 1 and (fresh < best).any():
                new, fresh = self.merged(ids, rank, at[:1], best)
                many = at[:1]
            ids = new
            keep = np.ones(len(rank), bool)
            keep[many] = False
            rank = rank[keep]
            now = many - np.arange(len(many))  # places of the merged tokens
            touched = np.concatenate((now[now > 0] - 1, now[now < len(rank)]))
            rank[touched] = fresh
        return ids

    def merged(self, ids: np.ndarray, rank: np.ndarray, at: np.ndarray, token: int) -> tuple[np.ndarray, np.ndarray]:
        new = ids.copy()
        new[at] = token
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        new = new[keep]
        now = at - np.arange(len(at))
        left, right = now[now > 0] - 1, now[now < len(new) - 1]
        touched = np.concatenate((left, right))
        return new, self.table.find(new[touched], new[touched + 1])

    def codes(self, words: list[str]) -> np.ndarray:
        """The number of each pre-token in this worker's memory, which learns those it has not."""
        memo = self.memo
        if new := set(words).difference(memo):
            if len(memo) + len(new) > MEMO:
                self.forget()
                memo, new = self.memo, set(words)
            new = list(new)
            add, start, length = self.encode_words([w.encode("utf-8", "surrogatepass") for w in new])
            memo.update(zip(new, range(len(memo), len(memo) + len(new))))
            if self.used + len(add) > len(self.flat):
                self.flat = np.concatenate((self.flat[: self.used], np.zeros(self.used + 2 * len(add), np.int32)))
            self.flat[self.used : self.used + len(add)] = add
            self.start = np.concatenate((self.start, self.used + start))
            self.length = np.concatenate((self.length, length))
            self.used += len(add)
        return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of each text's ids."""
        whole, starts, first = pretokens.split(texts)
        at = starts.tolist()
        words = [whole[a:b] for a, b in zip(at, at[1:])]
        codes = self.codes(words)
        count = self.length[codes]
        ids = self.flat[gather(self.start[codes], count)]
        total = np.concatenate(([0], np.cumsum(count)))
        return ids, np.diff(total[first])

    def counts(self, words: list[str]) -> np.ndarray:
        """Number of ids of each pre-token."""
        codes = self.codes(words)
        return self.length[codes]

    # ---- decoding

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat bytes of all id lists and the number of each list's bytes."""
        width = self.width[ids]
        total = np.concatenate(([0], np.cumsum(width)))
        return self.bytes[gather(self.at[ids], width)], np.diff(total[np.concatenate(([0], np.cumsum(lengths)))])


_codecs: dict[bytes, Codec] = {}


def codec(raw: bytes) -> Codec:
    """One codec for each worker process and vocabulary."""
    key = hashlib.sha256(raw).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(raw)
    return _codecs[key]


def _added(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, text: str = "text", out: str = "ids", ranks: str | None = None) -> DataFrame:
    """Add the list of token ids of ``text``; no special tokens."""
    raw, schema = rank_file(ranks), _added(docs, out, T.ArrayType(T.IntegerType()))
    names = [f.name for f in schema.fields[:-1]]

    def run(batches):
        own = codec(raw)
        for part in pieces(batches, text):
            ids, lengths = own.encode(texts(part, text))
            yield pa.RecordBatch.from_arrays([*(column(part, n) for n in names), ragged(ids, lengths, pa.int32())], [*names, out])
        own.forget()

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, ids: str = "ids", out: str = "decoded", ranks: str | None = None) -> DataFrame:
    """Add the bytes that the ids stand for (null ids: no bytes)."""
    raw, schema = rank_file(ranks), _added(docs, out, T.BinaryType())
    names = [f.name for f in schema.fields[:-1]]

    def run(batches):
        own = codec(raw)
        for batch in batches:
            for begin in range(0, batch.num_rows, ID_LISTS):
                part = batch.slice(begin, ID_LISTS)
                lists = column(part, ids)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                data, size = own.decode(flat, lengths)
                at = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
                raw_bytes = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*(column(part, n) for n in names), raw_bytes], [*names, out])
            batch = part = lists = flat = data = raw_bytes = None
        release()

    return docs.mapInArrow(run, schema)


def digests(ids: Column, decoded: Column) -> list[Column]:
    """What a digest row has of a list of ids and its decoded bytes."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    ]


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded: its token count and the digests of both results."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    coded = encode(docs).select("doc_id", "ids")
    return decode(coded).select("doc_id", *digests(F.col("ids"), F.col("decoded")))
