"""SimHash near-duplicates by covering locality-sensitive hashing.

Every fingerprint bit gets a vector of ``radius`` + 1 bits; for each of the 2^(radius + 1) - 1 nonzero vectors v a table
masks the bits whose vector has an odd product with v. Up to ``radius`` differing bits span at most ``radius`` dimensions,
so some v is orthogonal to all of them: its mask has none of those bits and the pair collides in that table, always.

Distinct fingerprints are compared, copies only counted. Buckets are cut into blocks, a task compares two blocks and returns
the links that connect them, never all pairs; components follow by stars. Null and empty texts have the fingerprint zero,
which links like any other. A null doc_id never is a component's id unless the component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigstat.llm.batches import column, cut, pieces, texts
from sigstat.llm.components import blocks, components, forest

#: Fixed by the contract.
WORDS, SEED, RADIUS, BITS = 4, 42, 4, 64


def shingle_hashes(text: str, words: int = WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle; A-Z in lower case, words parted by ASCII white space."""
    return word_hashes(text.encode("utf-8", "surrogatepass").lower().split(), words, seed)


def word_hashes(parts: list[bytes], words: int = WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of a list of words."""
    import xxhash

    if not parts:
        return []
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return [digest(b" ".join(parts), seed)]
    line = b" ".join(parts)
    at = [0]
    for p in parts:
        at.append(at[-1] + len(p) + 1)
    return [digest(line[a : b - 1], seed) for a, b in zip(at, at[words:])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text a fingerprint: the bits set in over half of its hashes (no hashes: zero)."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        begin = (np.cumsum(counts) - counts)[full]
        set_ = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        high = np.packbits(2 * set_ > counts[full, None], axis=1)
        out[full] = high.view(">u8").ravel().astype(np.uint64)
    return out


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", words: int = WORDS) -> DataFrame:
    """Add the fingerprint, as a signed 64-bit number; it replaces a column of that name."""
    fields = [f for f in docs.schema.fields if f.name != out]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]):
        for part in pieces(batches, text):
            lists = [shingle_hashes(x, words) for x in texts(part, text)]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((h for x in lists for h in x), np.uint64, int(counts.sum()))
            yield pa.RecordBatch.from_arrays([*(column(part, n) for n in names), pa.array(majority(flat, counts).view(np.int64))], [*names, out])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.LongType())]))


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The covering masks, as signed 64-bit numbers."""
    vectors = (1 << (radius + 1)) - 1
    made = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(bits) if bin((i % vectors + 1) & v).count("1") % 2)
        made.append(mask - (1 << 64) if mask >> 63 else mask)
    return made


def links(prints: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints within ``radius`` bits of each other."""
    keys = [F.struct(F.lit(t).alias("table"), F.col(fp).bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks(radius))]
    members = prints.select(fp, F.explode(F.array(*keys)).alias("at")).select("at.table", "at.key", fp)

    def run(batches):
        for batch in batches:
            lists = column(batch, "members")
            flat = lists.flatten().field(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            a, b = [], []
            for begin, end in zip(at, at[1:]):
                own = flat[begin:end]
                for i, j in forest(len(own), lambda k, others, own=own: np.bitwise_count(own[others] ^ own[k]) <= radius):
                    a.append(own[i]), b.append(own[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])

    return blocks(members, ["table", "key"], fp, []).mapInArrow(run, "a long, b long").distinct()


def classes(rows: DataFrame, doc_id: str, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """For each distinct fingerprint its component's label, smallest doc_id and number of rows that have that id.

    ``rows`` is read several times; it should be a cut or written table of ids and fingerprints.
    """
    ids = rows.groupBy(fp, doc_id).agg(F.count("*").alias("__same"))
    own = ids.groupBy(fp).agg(F.min(doc_id).alias("__id"), F.min_by("__same", doc_id).alias("__same"), F.max("__same").alias("__any"))
    own = cut(own)
    label = components(links(own.select(fp), fp, radius))
    named = own.join(label.select(F.col("node").alias(fp), "label"), fp, "left").withColumn("label", F.coalesce("label", fp))
    named = cut(named)
    groups = named.groupBy("label").agg(F.min("__id").alias("component_id"))
    counted = named.join(groups, "label").groupBy("label").agg(
        F.sum(F.when(F.col("__id").eqNullSafe(F.col("component_id")), F.coalesce("__same", "__any")).otherwise(0)).alias("first_rows")
    )
    return named.select(fp, "label").join(groups, "label").join(counted, "label").select(fp, "label", "component_id", "first_rows")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    rows = cut(fingerprints(docs.select(doc_id, text), text).select(doc_id, "fp"))
    return rows.join(classes(rows, doc_id, radius=radius).select("fp", "component_id"), "fp", "left")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Of each component the row with the smallest doc_id, with its columns (one row if rows repeat that id)."""
    rows = cut(fingerprints(docs.select(doc_id, text), text).select(doc_id, "fp"))
    own = [f"__{c}" for c in ("fp", "label", "component_id", "first_rows")]
    found = classes(rows, doc_id, radius=radius).toDF(*own)
    kept = fingerprints(docs, text, own[0]).join(found, own[0]).filter(F.col(doc_id).eqNullSafe(F.col("__component_id")))
    one = kept.filter("__first_rows = 1").select(*docs.columns)
    return one.unionByName(kept.filter("__first_rows > 1").dropDuplicates(["__label"]).select(*docs.columns))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id that it is linked to."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
