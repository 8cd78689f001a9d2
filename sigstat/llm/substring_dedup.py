"""Passages that repeat across documents: MinHash bands of paragraphs, verified Jaccard, removals by components.

A paragraph ends at a line end, and at those sentence ends whose last ``BEFORE`` characters have an odd CRC-32, about every
second one: the cut
depends on the text around it alone, so a passage falls into the same paragraphs wherever it stands. Paragraphs of fewer than
``LEAST`` words don't count. A paragraph is known by the XXH64 of its words (A-Z in lower case); its five-word shingles
have ``HASHES`` MinHash values in the bands that reach ``RECALL`` at the threshold. One pass over the texts writes units, band
keys and the words of new paragraphs; all later steps read that table.

A passage may also stand inside a paragraph, next to other text. So windows of ``PASSAGE`` words begin at anchors: in every
``STEP`` word pairs that follow each other, the last one with the smallest hash. Both depend on the words alone, so any
``PASSAGE + STEP - 1`` words that two documents share hold an equal window, wherever they stand. Windows match if they are
equal, and lie over paragraphs and each other; words of a passage before its first anchor and after its last window may
stay. Windows in a text that repeats itself follow each other without overlap.

Paragraphs and windows are units; equal units are one node. Bands of different nodes join on their keys; blocks of colliding nodes are compared by exact
Jaccard on their whole shingle sets, and linked nodes form components, of which those count that span two or more documents.
In a document, such units that follow each other within ``GAP`` characters are a passage; passages of ``PASSAGE`` words
or more count, shorter ones (a license line) stay. Of a component's occurrences that are left the first (by doc_id, then
place) stays, the others are to be removed; what is left in one document alone is no repeat. Bloom bitmaps of fixed
size keep paragraphs that can't matter out of the later shuffles.

Null and empty texts have no paragraphs. Rows without doc_id count as one document. Places are code points.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigstat.llm.batches import column, cut, pieces, ragged, texts, written
from sigstat.llm.components import blocks, components
from sigstat.llm.exact_dedup import filter_bits, present, probed
from sigstat.llm.fingerprints import LIKE, bands, factors, verified

LEAST, WORDS, HASHES = 6, 5, 10
PASSAGE, GAP = 20, 200
#: Word pairs of which one is an anchor.
STEP = 16
#: Line ends, and marks between a character of a sentence and white space; begins with a set, which ``re`` scans for fastest.
END = re.compile(r"[.!?\n](?:(?<=\n)|(?<=[^\s.!?][.!?])(?=\s))")
#: Characters before a sentence end that decide whether it is cut there.
BEFORE = 6
#: Paragraphs whose keys a task remembers to have sent.
SEEN = 1 << 19
#: Whether the documents from ``low`` to ``high``, and the one without doc_id if it is among them (``bare``), are two or more.
SEVERAL = "(low <> high OR bare AND low IS NOT NULL)"


def whole(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and words of each paragraph."""
    begin = 0
    for m in [*END.finditer(text), None]:
        if m is None:
            end = len(text)
        else:
            end = m.end()
            if text[end - 1] != "\n" and not zlib.crc32(text[max(end - BEFORE, 0) : end].lower().encode("utf-8", "surrogatepass")) & 1:
                continue
        part = text[begin:end]
        body = part.strip(" \t\n\x0b\x0c\r")
        words = body.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= LEAST:
            yield begin + part.find(body), len(body), b" ".join(words)
        begin = end


def anchors(words: list[bytes]) -> np.ndarray:
    """Numbers of the words where windows begin."""
    if len(words) < PASSAGE:
        return np.zeros(0, np.int64)
    own = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    pair = (own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]) * np.uint64(0xD1B54A32D192ED03)
    low = (pair & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(pair), dtype=np.uint64))
    size = 1
    while size < STEP:
        step = min(size, STEP - size)
        low, size = np.minimum(low[:-step], low[step:]), size + step
    at = np.unique((np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64))
    return at[at <= len(words) - PASSAGE]


def windows(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and words of each window; the words are one piece, so that only equal windows have a shingle in common."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    at = anchors(words)
    if not len(at):
        return
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.concatenate(([False], (points != 32) & ((points < 9) | (points > 13)), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2][at].tolist(), edges[1::2][at + PASSAGE - 1].tolist()
    last, free = b"", 0
    for k, start, end in zip(at.tolist(), starts, ends, strict=True):
        own = b"\xff".join(words[k : k + PASSAGE])  # no byte of UTF-8
        if own == last and k < free:
            continue
        last, free = own, k + PASSAGE
        yield start, end - start, own + b" " * (PASSAGE - 1)  # counts as PASSAGE words


def paragraphs(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and words of each unit: paragraphs, then windows."""
    yield from whole(text)
    yield from windows(text)


def node(words: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(words)


def shingle_hashes(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of all paragraphs, one after the other, and how many each has.

    A shingle is a polynomial over the XXH64 of its words, in numpy over all words at once. Each paragraph needs
    ``WORDS`` words or more.
    """
    import xxhash

    words = b" ".join(bodies).split()
    counts = np.fromiter((x.count(b" ") + 1 for x in bodies), np.int64, len(bodies))
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        out = out * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(out)]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD1B54A32D192ED03)
    out ^= out >> np.uint64(29)
    inside = np.ones(len(words), bool)  # a shingle that begins here ends in the same paragraph
    inside[(np.cumsum(counts)[:, None] - np.arange(1, WORDS)).ravel()] = False
    return out[inside[: len(out)]], counts - WORDS + 1


def band_keys(hashes: np.ndarray, counts: np.ndarray, threshold: float = LIKE) -> np.ndarray:
    """A key for each paragraph and band."""
    count, r = bands(threshold, n=HASHES)
    flat, begin = hashes & np.uint64(0xFFFFFFFF), np.cumsum(counts) - counts
    out = np.zeros((len(counts), count), np.uint64)
    for k, (a, b) in enumerate(zip(*factors(count * r, 3), strict=True)):
        low = np.minimum.reduceat(flat * a + b, begin) >> np.uint64(32)
        out[:, k // r] = out[:, k // r] * np.uint64(0x9E3779B97F4A7C15) + low + np.uint64(k + 1)
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = LIKE) -> DataFrame:
    """doc_id, start, length, words and id of every unit, in one pass over the texts.

    The first occurrence of a paragraph in a task, as far as the task remembers, also carries its band keys and its
    words (body), from which ``links`` works; elsewhere, and for windows, which match by their node alone, both are null.
    """
    count = bands(threshold, n=HASHES)[0]

    def run(batches):
        seen: set[int] = set()
        for part in pieces(batches, text):
            if len(seen) > SEEN:
                seen = set()
            rows, starts, lengths, sizes, ids, bodies = [], [], [], [], [], []
            for row, x in enumerate(texts(part, text)):
                for found, alone in ((whole(x), False), (windows(x), True)):
                    for start, length, words in found:
                        one = node(words)
                        rows.append(row), starts.append(start), lengths.append(length), sizes.append(words.count(b" ") + 1), ids.append(one)
                        if alone or one in seen:
                            bodies.append(None)
                        else:
                            seen.add(one), bodies.append(words)
            new = [x for x in bodies if x is not None]
            keys = band_keys(*shingle_hashes(new), threshold).ravel() if new else np.zeros(0, np.int64)
            numbers = [pa.array(x, pa.int64()) for x in (starts, lengths, sizes)]
            body = pa.array(bodies, pa.binary())
            filled = np.where(np.array(body.is_valid()), count, 0) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [column(part, doc_id).take(pa.array(rows, pa.int64())), *numbers, pa.array(np.array(ids, np.uint64).view(np.int64)), ragged(keys, filled, pa.int64()), body],
                ["doc_id", "start", "length", "words", "id", "keys", "body"],
            )

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, start long, length long, words long, id long, keys array<long>, body binary")


def _sets(near: DataFrame) -> DataFrame:
    """(id, hashes): the shingle set of each paragraph of (id, body)."""

    def hashed(batches):
        for part in pieces(batches, "body"):
            flat, counts = shingle_hashes(column(part, "body").to_pylist())
            sets = [np.unique(x).view(np.int64) for x in np.split(flat, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([column(part, "id"), ragged(np.concatenate(sets), np.array([len(x) for x in sets]), pa.int64())], ["id", "hashes"])

    return near.groupBy("id").agg(F.first("body").alias("body")).mapInArrow(hashed, "id long, hashes array<long>")


def links(units: DataFrame, threshold: float = LIKE) -> DataFrame:
    """(a, b): links that connect different paragraphs with a Jaccard of ``threshold`` or more.

    ``units`` is a written table of ``occurrences``; the texts are not read again.
    """
    first = units.filter("body IS NOT NULL")
    keyed = first.select(F.explode("keys").alias("key"), "id").repartition("key")
    shared = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high").select("key")
    colliding = cut(keyed.join(shared, "key").distinct())
    ids = colliding.select("id").distinct()
    bits = filter_bits(ids.count())
    near = probed(first.select("id", "body"), "id", cut(present(ids, "id", bits)), bits, "may").filter("may")
    return verified(blocks(colliding.join(_sets(near), "id"), ["key"], "id", ["hashes"]), threshold)


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = LIKE) -> DataFrame:
    """Every unit of a passage that two or more documents have.

    doc_id, start, length, words; class_doc_id and class_start of the first occurrence; copies; removed. Rows that repeat
    an id and its text give their units once.
    """
    units = written(occurrences(docs, doc_id, text, threshold), "zstd")
    label = components(links(units, threshold)).withColumnRenamed("node", "id")
    all_ = units.drop("keys", "body")
    doc = F.struct("doc_id")
    spread = all_.groupBy("id").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max(F.isnull("doc_id")).alias("bare"))
    # the only shuffle of all units; what may matter is a table, so that nothing below repeats it
    known = written(spread.join(label, "id", "left").filter(f"label IS NOT NULL OR {SEVERAL}"), "zstd")
    linked = known.filter("label IS NOT NULL")
    alone = known.filter("label IS NULL").select("id", F.col("id").alias("label"))
    across = linked.groupBy("label").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("bare").alias("bare")).filter(SEVERAL).select("label")
    named = cut(linked.select("id", "label").join(across, "label").select("id", "label").unionByName(alone))
    bits = filter_bits(named.count())
    near = probed(all_, "id", cut(present(named, "id", bits)), bits, "may").filter("may").drop("may")
    order = W.partitionBy("doc_id").orderBy("start", "length", "id")
    joined = F.col("start") - F.lag(F.col("start") + F.col("length")).over(order) <= GAP
    unit = F.struct("start", "length", "id")
    once = near.join(named, "id").withColumn("again", unit.eqNullSafe(F.lag(unit).over(order))).filter("NOT again")  # a repeated row has its units twice
    runs = once.withColumn("run", F.when(joined, 0).otherwise(1)).withColumn("run", F.sum("run").over(order))
    found = written(runs.withColumn("all", F.sum("words").over(W.partitionBy("doc_id", "run"))).filter(F.col("all") >= PASSAGE).drop("run", "all", "again", "id"))
    item = F.struct("doc_id", "start")
    firsts = found.groupBy("label").agg(F.min(item).alias("first"), F.max(doc).alias("last"), F.count("*").alias("copies"))
    firsts = firsts.filter(~F.struct("first.doc_id").eqNullSafe(F.col("last")))
    return found.join(firsts, "label").select(
        "doc_id", "start", "length", "words", F.col("first.doc_id").alias("class_doc_id"), F.col("first.start").alias("class_start"), "copies",
        (~item.eqNullSafe(F.col("first"))).alias("removed"),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = LIKE) -> DataFrame:
    """The documents without the passages to be removed; rows without doc_id stay as they are."""
    spans = repeated(docs, doc_id, text, threshold).filter("removed").groupBy("doc_id")
    spans = spans.agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("__spans")).withColumnRenamed("doc_id", "__doc")
    rows = docs.join(spans, docs[doc_id] == spans["__doc"], "left").drop("__doc")
    names = docs.columns

    def run(batches):
        for part in pieces(batches, text):
            out = []
            for x, own in zip(column(part, text).to_pylist(), column(part, "__spans").to_pylist(), strict=True):
                at, kept = 0, []
                for s in own or []:
                    kept.append(x[at : s["start"]])
                    at = max(at, s["start"] + s["length"])
                out.append(x if not own else "".join(kept) + x[at:])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == text else column(part, n) for n in names], names)

    return rows.mapInArrow(run, T.StructType(docs.schema.fields))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every occurrence of a passage that repeats across documents, and whether it is removed."""
    return repeated(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
