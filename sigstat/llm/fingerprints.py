"""MinHash fingerprints of documents, their likeness, and near-duplicates by signature bands with verified Jaccard.

A shingle is five words (all words of a shorter text); its XXH64 goes through ``PERMUTATIONS`` strongly universal functions
(multiply-add with 64-bit random factors, high bits kept), in numpy over all shingles of a batch; the minimum of each, cut to
16 bits, is a component. A fingerprint is written as four hexadecimal digits for each component. A text without words, null
included, has the fingerprint of all ones. Likeness is the share of equal components.

Documents follow each other by descending doc_id (nulls last, equal ids by descending text). They are dealt to ranges of
ids whose bounds are literals of the plan; a range streams through its task in order, and the pairs across range borders are
made from each range's first and last row. A copy of the text moves once.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigstat.llm.batches import column, cut, pieces, ragged, texts
from sigstat.llm.components import blocks, components, forest
from sigstat.llm.simhash import shingle_hashes

PERMUTATIONS, WORDS, LIKE, RECALL = 128, 5, 0.8, 0.99
ROWS, FEWEST, MOST = 4000, 1024, 20_000


@functools.cache
def factors(n: int = PERMUTATIONS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**64, n, np.uint64) | np.uint64(1), rng.integers(0, 2**64, n, np.uint64)


def flat_hashes(texts_: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """32-bit shingle hashes of all texts, and how many each has."""
    lists = [shingle_hashes(x, words) for x in texts_]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((h & 0xFFFFFFFF for x in lists for h in x), np.uint64, int(counts.sum())), counts


def signatures(hashes: np.ndarray, counts: np.ndarray, n: int = PERMUTATIONS) -> np.ndarray:
    """Texts x components, 16 bits each."""
    out = np.full((len(counts), n), 0xFFFF, np.uint16)
    full = np.flatnonzero(counts)
    if len(full):
        begin = (np.cumsum(counts) - counts)[full]
        for k, (a, b) in enumerate(zip(*factors(n), strict=True)):
            out[full, k] = (np.minimum.reduceat(hashes * a + b, begin) >> np.uint64(32)).astype(np.uint16)
    return out


def sign(texts_: list[str]) -> np.ndarray:
    return signatures(*flat_hashes(texts_))


def written_out(signature: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signature.astype(">u2")]


def edit(text: str, following: str) -> str:
    """The last third of the text gives way to the first characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def id_ranges(docs: DataFrame, doc_id: str, out: str) -> DataFrame:
    """Add the number of a document's range of ids; higher ids have higher numbers, nulls are in the lowest."""
    from pyspark.ml.feature import Bucketizer

    n = docs.count()
    count = min(max(n // ROWS, FEWEST), MOST)
    bounds = docs.filter(F.col(doc_id).isNotNull()).approxQuantile(doc_id, [k / count for k in range(1, count)], 1 / (4 * count)) if n else []
    bounds = [-math.inf, *sorted(set(bounds)), math.inf]
    if len(bounds) < 3:
        return docs.withColumn(out, F.lit(0))
    place = Bucketizer(splits=bounds, inputCol=f"{out}_of", outputCol=out, handleInvalid="keep")  # binary search; null comes last
    made = place.transform(docs.withColumn(f"{out}_of", F.col(doc_id).cast("double"))).drop(f"{out}_of")
    return made.withColumn(out, F.when(F.col(doc_id).isNull(), 0).otherwise(F.col(out).cast("int")))


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row."""
    import hashlib

    rows = id_ranges(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")), "doc_id", "range").select("range", "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def made(ids: pa.Array, bodies: list[str], following: list[str], own: np.ndarray, other: np.ndarray):
        edits = [edit(a, b) for a, b in zip(bodies, following, strict=True)]
        changed = sign(edits)
        return pa.RecordBatch.from_arrays(
            [
                ids, pa.array(list(map(len, bodies)), pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edits], pa.string()),
                pa.array(written_out(own), pa.string()), pa.array(written_out(changed), pa.string()),
                pa.array((own == changed).mean(1)), pa.array((own == other).mean(1)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def inside(batches):
        """All rows but the last of each range; the row before a piece waits for it."""
        last = None
        for part in pieces(batches, "text"):
            bodies, where, ids = texts(part), column(part, "range").to_pylist(), column(part, "doc_id")
            own = sign(bodies)
            if last:
                ids, bodies, where, own = pa.concat_arrays([last[0], ids]), [*last[1], *bodies], [*last[2], *where], np.concatenate((last[3], own))
            last = (ids[-1:], bodies[-1:], where[-1:], own[-1:])
            same = np.flatnonzero(np.diff(where) == 0)
            if len(same):
                yield made(ids.take(pa.array(same)), [bodies[k] for k in same], [bodies[k + 1] for k in same], own[same], own[same + 1])

    def across(batches):
        for part in pieces(batches, "text"):
            bodies, following = texts(part), texts(part, "following")
            yield made(column(part, "doc_id"), bodies, following, sign(bodies), sign(following))

    ordered = rows.repartition("range").sortWithinPartitions(F.desc("range"), F.desc("doc_id"), F.desc("text"))
    main = ordered.mapInArrow(inside, schema)
    item = F.struct("doc_id", "text")
    ends = rows.groupBy("range").agg(F.max(item).alias("first"), F.min(item).alias("last"))
    borders = rows.select("range").distinct()
    order = W.partitionBy(F.lit(0)).orderBy(F.desc("range"))  # a row for each range
    borders = borders.select("range", F.coalesce(F.lead("range").over(order), F.max("range").over(W.partitionBy(F.lit(0)))).alias("then"))
    pairs = ends.select("range", "last").join(borders, "range").join(ends.select(F.col("range").alias("then"), "first"), "then")
    border = pairs.select("last.doc_id", "last.text", F.col("first.text").alias("following")).mapInArrow(across, schema)
    return main.unionByName(border)


# ---- near-duplicates


def bands(threshold: float = LIKE, recall: float = RECALL, n: int = PERMUTATIONS) -> tuple[int, int]:
    """Number of bands and rows of a band: the longest bands that still find a pair at the threshold with ``recall``."""
    for r in range(n, 1, -1):
        if 1 - (1 - threshold**r) ** (n // r) >= recall:
            return n // r, r
    return n, 1


def jaccard_links(flat: np.ndarray, size: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Members of a block, given by their distinct hashes one after the other, whose links connect what Jaccard connects."""
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(size)), size)

    def linked(one: int, others: np.ndarray) -> np.ndarray:
        own = flat[end[one] - size[one] : end[one]]
        if len(others) == 1:
            k = others[0]
            both = np.intersect1d(own, flat[end[k] - size[k] : end[k]], assume_unique=True).size
        else:
            both = np.bincount(owner[np.isin(flat, own)], minlength=len(size))[others]
        return both >= threshold * (size[others] + size[one] - both) - 1e-9

    return forest(len(size), linked)


def verified(candidates: DataFrame, threshold: float = LIKE) -> DataFrame:
    """(a, b) of rows ``members``: lists of (id, hashes)."""

    def run(batches):
        for batch in batches:
            lists = column(batch, "members")
            members = lists.flatten()
            ids, sets = members.field(0).to_numpy(zero_copy_only=False), members.field(1)
            size = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = sets.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            place = np.concatenate(([0], np.cumsum(size)))
            a, b = [], []
            for begin, end in zip(at, at[1:]):
                for i, j in jaccard_links(flat[place[begin] : place[end]], size[begin:end], threshold):
                    a.append(ids[begin + i]), b.append(ids[begin + j])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b)], ["a", "b"])

    return candidates.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = LIKE) -> DataFrame:
    """doc_id and class_id of every row: the smallest doc_id reached by links of Jaccard ``threshold`` or more.

    Equal shingle sets are one node (the XXH64 of the sorted set); bands of distinct nodes join, blocks of colliding nodes
    are verified on their whole shingle sets.
    """
    count, r = bands(threshold)

    def run(batches):
        import xxhash

        for part in pieces(batches, text):
            hashes, counts = flat_hashes(texts(part, text))
            own = signatures(hashes, counts)
            sets = [np.unique(s) for s in np.split(hashes, np.cumsum(counts)[:-1])]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            keys = [[xxhash.xxh64_intdigest(row[k * r : k * r + r].tobytes(), k) for k in range(count)] for row in own]
            keys = np.array(keys, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, doc_id), pa.array(node),
                    ragged(np.concatenate(sets).astype(np.int64), np.array([len(s) for s in sets]), pa.int64()),
                    ragged(keys.ravel(), np.full(len(sets), count), pa.int64()),
                ],
                ["doc_id", "id", "hashes", "keys"],
            )

    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, id long, hashes array<long>, keys array<long>")
    nodes = rows.groupBy("id").agg(F.first("keys").alias("keys"))
    keyed = nodes.select("id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    colliding = cut(keyed.join(shared, "key"))
    sets = rows.join(colliding.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.first("hashes").alias("hashes"))
    links = verified(blocks(colliding.join(sets, "id"), ["key"], "id", ["hashes"]), threshold)
    label = components(links).withColumnRenamed("node", "id")
    ids = cut(rows.select("doc_id", "id"))
    named = ids.join(label, "id", "left").select("doc_id", F.coalesce("label", "id").alias("label"))
    return named.join(named.groupBy("label").agg(F.min("doc_id").alias("class_id")), "label").select("doc_id", "class_id")


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document."""
    return compared(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
