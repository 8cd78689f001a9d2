"""Exact duplicates by a two-pass Bloom filter, in DataFrame functions only.

Pass 1 hashes every text, counts the slots of a Bloom filter that the hashes fall on and keeps a bitmap of the slots that
more than one row hit. Pass 2 tests each row against that bitmap: a row whose slots are not all repeated is unique and goes
straight through; only the others shuffle, salted, after groups were aggregated on the map side.

Two texts are equal when their SHA-256 after deleting white space (``[\\x20\\x09-\\x0D]``) is equal; null counts as empty. Of
a group the row with the most code points stays, then the smallest doc_id (a null id only if no other has that length).
Rows that repeat the id that stays all report ``kept``; ``deduplicated`` returns one of them.

The bitmap is broadcast: it has 16 bits for each row, at most ``MOST_BITS`` (32 MB). Beyond 16 million rows it fills up and
more unique rows shuffle; results stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contract: characters that do not count.
BLANK = " \t\n\x0b\x0c\r"
LEAST_BITS, MOST_BITS = 1 << 18, 1 << 28
SALTS = 32
PREFIX = "__dedup_"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANK, "")


def filter_bits(rows: int) -> int:
    bits = LEAST_BITS
    while bits < min(16 * rows, MOST_BITS):
        bits *= 2
    return bits


def slots(key: Column, bits: int) -> list[Column]:
    """The two slots of a 64-bit key."""
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits)) for k in (1, 2)]


def repeated(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmap of the slots that more than one key hit: at most bits / 32768 rows of 4 KB."""
    return _bitmap(_hit(keys, key, bits).groupBy("slot").count().filter("count > 1"))


def present(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmap of the slots that any key hit, of the same size: a plain Bloom filter."""
    return _bitmap(_hit(keys, key, bits))


def _hit(keys: DataFrame, key: str, bits: int) -> DataFrame:
    return keys.select(F.explode(F.array(slots(F.col(key), bits))).alias("slot"))


def _bitmap(hit: DataFrame) -> DataFrame:
    return hit.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def probed(df: DataFrame, key: str, bitmap: DataFrame, bits: int, out: str) -> DataFrame:
    """Add whether every slot of the key is set; rows stay where they are."""
    names, hits = df.columns, []
    for k, slot in enumerate(slots(F.col(key), bits)):
        bucket, place, part = f"{PREFIX}b{k}", f"{PREFIX}p{k}", f"{PREFIX}m{k}"
        df = df.withColumns({bucket: F.bitmap_bucket_number(slot), place: F.bitmap_bit_position(slot)})
        df = df.join(F.broadcast(bitmap.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(part))), bucket, "left")
        byte = F.conv(F.hex(F.substring(F.col(part), (F.col(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hits.append(F.col(part).isNotNull() & (F.getbit(byte, (F.col(place) % 8).cast("int")) == 1))
    return df.select(*names, F.coalesce(hits[0] & hits[1], F.lit(False)).alias(out))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row with keep_id, group_size, kept and text_sha256, beside the columns of ``carry``."""
    carry = [doc_id] if carry is None else carry
    raw = f"{PREFIX}text"
    plain = docs.withColumn(raw, normalised(F.col(text)))
    bits = filter_bits(docs.count())
    key, maybe, chars, sha, salt, best = (PREFIX + x for x in ("key", "maybe", "chars", "sha", "salt", "best"))
    bitmap = repeated(plain.select(F.xxhash64(raw).alias(key)), key, bits)
    rows = plain.select(
        *carry,
        F.col(doc_id).alias(f"{PREFIX}id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias(chars),
        F.xxhash64(raw).alias(key),
        F.sha2(raw, 256).alias(sha),
    )
    rows = probed(rows, key, bitmap, bits, maybe)
    alone = rows.filter(~F.col(maybe)).select(
        *carry, F.col(f"{PREFIX}id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col(sha).alias("text_sha256")
    )
    shared = (
        rows.filter(maybe)
        .select(*carry, f"{PREFIX}id", chars, sha, F.pmod(F.xxhash64(f"{PREFIX}id", F.lit(7)), F.lit(SALTS)).cast("int").alias(salt))
        .repartition(sha, salt)
    )
    winners = (
        shared.groupBy(sha)
        .agg(F.max(F.struct(F.col(chars), F.bitwise_not(f"{PREFIX}id").alias("id"))).alias(best), F.count("*").alias("group_size"))
        .select(sha, F.bitwise_not(F.col(f"{best}.id")).alias("keep_id"), "group_size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt))
    )
    settled = shared.join(winners, [sha, salt]).select(
        *carry, "keep_id", "group_size", F.col(f"{PREFIX}id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col(sha).alias("text_sha256")
    )
    return alone.unionByName(settled)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their columns."""
    rows = docs.select(F.struct(*docs.columns).alias(f"{PREFIX}row"), F.col(doc_id).alias(f"{PREFIX}doc"), F.col(text).alias(f"{PREFIX}body"))
    found = groups(rows, f"{PREFIX}doc", f"{PREFIX}body", [f"{PREFIX}row", f"{PREFIX}doc"]).filter("kept")
    alone = found.filter("group_size = 1").select(f"{PREFIX}row.*")
    ties = found.filter("group_size > 1").dropDuplicates(["text_sha256"]).select(f"{PREFIX}row.*")
    return alone.unionByName(ties)


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one that stays for it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: The groups of ``documents``; the pipeline's twin builds on it too.
SQL = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS sha
  FROM documents
), g AS (
  SELECT sha, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM t GROUP BY sha
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.sha AS text_sha256 FROM t JOIN g USING (sha)
"""
