"""Edit-aware token counts: a segment tree of pre-tokens for each document.

The leaves of a tree are runs of about ``FAN`` pre-tokens with their lengths and token counts; inner nodes have the sums of
characters and tokens below them. An edit finds its leaf by the character sums. Pre-tokens are matched from left to right and
look at most one character past the one that ends them, so everything that ends two characters before the edit stays; from
there the text is split anew until a boundary behind the edit is one of the old boundaries, and only those pre-tokens are
encoded again. Then the sums on the way to the root follow.

A tree is kept as plain columns: pre-token lengths and counts, and the token sums in heap order. Null and empty texts have an
empty tree. Offsets are code points of the text as it is when the edit is applied, cut to its length; a null list of edits
is an empty one and a null replacement is empty. The columns of ``TREE`` replace input columns of these names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigstat.llm import pretokens
from sigstat.llm.batches import column, pieces, ragged, texts
from sigstat.llm.bpe import Codec, codec, rank_file

FAN = 64
TREE = {"lengths": "array<int>", "counts": "array<int>", "sums": "array<long>", "n_tokens": "long"}
EDIT = "struct<start: bigint, stop: bigint, new: string>"


class Tree:
    def __init__(self, text: str, lengths: np.ndarray, counts: np.ndarray):
        at = np.concatenate(([0], np.cumsum(lengths)))
        cuts = [*range(0, len(lengths), FAN), len(lengths)]
        self.build([(text[at[a] : at[b]], lengths[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:])] or [("", lengths, counts)])

    def build(self, parts: list) -> None:
        self.parts = parts
        self.size = 1
        while self.size < len(parts):
            self.size *= 2
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for k, (text, _, counts) in enumerate(parts):
            self.chars[self.size + k], self.tokens[self.size + k] = len(text), int(counts.sum())
        for k in range(self.size - 1, 0, -1):
            self.join(k)

    def join(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def put(self, k: int, part: tuple) -> None:
        """Replace a leaf and the sums above it."""
        self.parts[k] = part
        node = self.size + k
        self.chars[node], self.tokens[node] = len(part[0]), int(part[2].sum())
        while node > 1:
            node //= 2
            self.join(node)

    def find(self, offset: int) -> tuple[int, int]:
        """The leaf with the character at ``offset`` (the last one beyond the end) and where that leaf starts."""
        offset = max(min(offset, self.chars[1] - 1), 0)
        node, base = 1, 0
        while node < self.size:
            node *= 2
            if offset - base >= self.chars[node] and self.chars[node + 1]:
                base += self.chars[node]
                node += 1
        return node - self.size, base

    def edit(self, start: int, stop: int, new: str) -> tuple[list[str], Callable[[np.ndarray], None]]:
        """Replace characters: the pre-tokens to encode again, and what takes their counts and updates the tree."""
        total = self.chars[1]
        start = max(min(start, total), 0)
        stop = max(min(stop, total), start)
        first, base = self.find(start - 2)
        last, _ = self.find(stop)
        last = max(last, first)
        text, lengths, counts = self.parts[first]
        ends = base + np.cumsum(lengths)
        keep = int(np.searchsorted(ends, start - 2, "right"))  # what ends before start - 1 stays
        off = int(ends[keep - 1]) if keep else base
        old_text, old_lengths, old_counts = [text[off - base :]], [lengths[keep:]], [counts[keep:]]
        for k in range(first + 1, last + 1):
            for held, item in zip((old_text, old_lengths, old_counts), self.parts[k], strict=True):
                held.append(item)
        while True:
            old, sizes = "".join(old_text), np.concatenate(old_lengths)
            region = old[: start - off] + new + old[stop - off :]
            _, starts, _ = pretokens.split([region])
            at_end = last == len(self.parts) - 1
            begins = np.cumsum(sizes) - sizes + len(region) - len(old)  # old boundaries, where they are now
            behind = starts[(starts >= start - off + len(new)) & (starts > 0) & (starts + 2 <= len(region))]
            at = np.minimum(np.searchsorted(begins, behind), max(len(begins) - 1, 0))
            same = behind[begins[at] == behind] if len(begins) else behind[:0]
            if len(same) or at_end:
                break
            last += 1
            for held, item in zip((old_text, old_lengths, old_counts), self.parts[last], strict=True):
                held.append(item)
        until = int(same[0]) if len(same) else len(region)
        rest = int(np.searchsorted(begins, until)) if len(same) else len(sizes)
        bounds = starts[starts <= until]
        words = [region[a:b] for a, b in zip(bounds.tolist(), bounds.tolist()[1:])]

        def settle(made: np.ndarray) -> None:
            part = (
                text[: off - base] + region,
                np.concatenate((lengths[:keep], np.diff(bounds), sizes[rest:])),
                np.concatenate((counts[:keep], made, np.concatenate(old_counts)[rest:])),
            )
            for k in range(first + 1, last + 1):
                self.put(k, ("", part[1][:0], part[2][:0]))
            self.put(first, part)
            if len(part[1]) > 8 * FAN:
                self.build(Tree(self.text(), self.lengths(), self.counts()).parts)

        return words, settle

    def text(self) -> str:
        return "".join(p[0] for p in self.parts)

    def lengths(self) -> np.ndarray:
        return np.concatenate([p[1] for p in self.parts])

    def counts(self) -> np.ndarray:
        return np.concatenate([p[2] for p in self.parts])


def apply(trees: list[Tree], edits: list[list], own: Codec) -> list[int]:
    """Apply each tree's edits in order; the next edits of all trees are encoded together. Pre-tokens encoded for each."""
    encoded = [0] * len(trees)
    for step in range(max(map(len, edits), default=0)):
        plans = [(k, *trees[k].edit(*edits[k][step])) for k in range(len(trees)) if step < len(edits[k])]
        counts = own.counts([w for _, words, _ in plans for w in words])
        begin = 0
        for k, words, settle in plans:
            settle(counts[begin : begin + len(words)])
            begin += len(words)
            encoded[k] += len(words)
    return encoded


def heaps(counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token sums of many trees in heap order, one tree after the other, and the size of each heap."""
    total = np.concatenate(([0], np.cumsum(counts)))
    out, sizes = [], []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        leaves = np.diff(total[np.append(np.arange(a, b, FAN), b)]) if b > a else np.zeros(1, np.int64)
        size = 1 << (len(leaves) - 1).bit_length()
        level = np.zeros(size, np.int64)
        level[: len(leaves)] = leaves
        levels = [level]
        while len(level) > 1:
            level = level[::2] + level[1::2]
            levels.append(level)
        out += [np.zeros(1, np.int64), *levels[::-1]]
        sizes.append(2 * size)
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), np.array(sizes, np.int64)


def _schema(df: DataFrame, added: dict[str, str], drop: tuple[str, ...] = ()) -> tuple[list[str], T.StructType]:
    fields = [f for f in df.schema.fields if f.name not in added and f.name not in drop]
    extra = T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in added.items()))
    return [f.name for f in fields], T.StructType([*fields, *extra.fields])


def _columns(trees: list[Tree]) -> list[pa.Array]:
    def flat(get, kind):
        arrays = [np.asarray(get(t), np.int64) for t in trees]
        return ragged(np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind), np.array([len(a) for a in arrays], np.int64), pa.from_numpy_dtype(kind))

    return [flat(Tree.lengths, np.int32), flat(Tree.counts, np.int32), flat(lambda t: t.tokens, np.int64), pa.array([t.tokens[1] for t in trees], pa.int64())]


def token_trees(docs: DataFrame, text: str = "text", ranks: str | None = None) -> DataFrame:
    """Add the tree of every text: lengths and counts of its pre-tokens, token sums in heap order, n_tokens."""
    raw = rank_file(ranks)
    names, schema = _schema(docs, TREE)

    def run(batches):
        own = codec(raw)
        for part in pieces(batches, text):
            bodies = texts(part, text)
            whole, starts, first = pretokens.split(bodies)
            at = starts.tolist()
            counts = own.counts([whole[a:b] for a, b in zip(at, at[1:])])
            size = np.diff(first)
            sums, places = heaps(counts, first)
            total = np.concatenate(([0], np.cumsum(counts)))
            made = [
                ragged(np.diff(starts).astype(np.int32), size, pa.int32()), ragged(counts.astype(np.int32), size, pa.int32()),
                ragged(sums, places, pa.int64()), pa.array(np.diff(total[first])),
            ]
            yield pa.RecordBatch.from_arrays([*(column(part, n) for n in names), *made], [*names, *TREE])
        own.forget()

    return docs.mapInArrow(run, schema)


def edited(trees: DataFrame, edits: str = "edits", text: str = "text", ranks: str | None = None) -> DataFrame:
    """Apply each row's list of edits: the new text, its tree, and n_encoded, the pre-tokens that were encoded again.

    ``trees`` comes from ``token_trees`` (or from here) and has a column ``edits`` of structs (start, stop, new).
    """
    raw = rank_file(ranks)
    added = {text: "string"} | TREE | {"n_encoded": "long"}
    names, schema = _schema(trees, added, (edits,))

    def run(batches):
        own = codec(raw)
        for part in pieces(batches, text):
            lists = zip(*(column(part, n) for n in ("lengths", "counts")), strict=True)
            state = [[np.zeros(0, np.int64) if x.values is None else x.values.to_numpy().astype(np.int64) for x in pair] for pair in lists]
            made = [Tree(body, *own_) for body, own_ in zip(texts(part, text), state, strict=True)]
            todo = [[(e["start"] or 0, e["stop"] or 0, e["new"] or "") for e in row or [] if e] for row in column(part, edits).to_pylist()]
            encoded = apply(made, todo, own)
            yield pa.RecordBatch.from_arrays(
                [*(column(part, n) for n in names), pa.array([t.text() for t in made], pa.string()), *_columns(made), pa.array(encoded, pa.int64())],
                [*names, *added],
            )
        own.forget()

    return trees.mapInArrow(run, schema)


def with_edits(docs: DataFrame, edits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Add the list of edits from a table (doc_id, seq, start, stop, new), in the order of seq."""
    lists = edits.groupBy(doc_id).agg(F.sort_array(F.collect_list(F.struct("seq", "start", "stop", "new"))).alias("edits"))
    lists = lists.select(doc_id, F.transform("edits", lambda e: F.struct(e.start.cast("long").alias("start"), e.stop.cast("long").alias("stop"), e.new.alias("new"))).alias("edits"))
    return docs.join(lists, doc_id, "left")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document before and after three edits made from its own text.

    At a third of the text five characters give way to its first seven, "it's  " goes in at its half, the last four go.
    """
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    n = F.length("text").cast("long")
    third, half = F.floor(n / 3), F.floor(n / 2)
    edit = lambda a, b, new: F.struct(a.cast("long").alias("start"), b.cast("long").alias("stop"), new.alias("new"))
    edits = F.array(
        edit(third, third + 5, F.substring("text", 1, 7)), edit(half, half, F.lit("it's  ")), edit(F.greatest(n - 4, F.lit(0)), n, F.lit(""))
    )
    trees = token_trees(docs).withColumns({"edits": edits, "n_before": F.col("n_tokens"), "n_pretokens": F.size("lengths").cast("long")})
    return edited(trees).select("doc_id", "n_before", "n_pretokens", F.col("n_tokens").alias("n_after"), "n_encoded", F.sha2("text", 256).alias("text_sha256"))
