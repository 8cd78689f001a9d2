"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.api import latest_period, normalise_api_json
from ..sources.files import (
    entity_from_path, profile, read_csv, read_lines, read_parquet, union_relaxed, write_result,
)
from ..sources.streams import select_stream, stream_manifest, stream_samples
from .base import query, rounded, rsql, table


@query("read_csv", rsql(
    "SELECT c_mktsegment, c_nationkey, count(*) AS n, sum(c_acctbal) AS balance FROM customer GROUP BY ALL", "balance", 4))
def csv_roundtrip(spark, folder):
    path = shared_folder(spark) + "-csv"
    table(spark, folder, "customer").write.option("header", True).csv(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    df = read_csv(spark, path, schema)
    return rounded(df.groupBy("c_mktsegment", "c_nationkey").agg(F.count("c_custkey").alias("n"), F.sum("c_acctbal").alias("balance")), 4)


@query("read_csv_inferred", "SELECT 'l_shipdate' AS \"column\", count(*) AS n, count(l_shipdate) AS filled FROM lineitem "
       "UNION ALL SELECT 'l_quantity', count(*), count(l_quantity) FROM lineitem")
def csv_inferred(spark, folder):
    path = shared_folder(spark) + "-csv"
    table(spark, folder, "lineitem").select("l_quantity", "l_shipdate").write.option("header", True).csv(path)
    df = read_csv(spark, path)
    if dict(df.dtypes)["l_quantity"] != "double":
        raise ValueError(f"inferred {df.dtypes}")
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in df.columns])
    return one.unpivot("n", ["l_shipdate", "l_quantity"], "column", "filled")


@query("read_lines", """
WITH l AS (SELECT lang, doc_id // 100 AS part, unnest(string_split(text, chr(10))) AS line FROM documents),
f AS (SELECT lang, part, count(*) + 1 AS lines, sum(CASE WHEN line = '' THEN 1 ELSE 0 END) + 1 AS empty, sum(length(line)) AS chars FROM l GROUP BY ALL)
SELECT lang, sum(lines)::BIGINT AS lines, sum(empty)::BIGINT AS empty, sum(chars)::BIGINT AS chars, max(lines) - 1 AS last_line FROM f GROUP BY lang""")
def lines_roundtrip(spark, folder):
    """A file per language and hundred documents, each text ended by a line end; the empty line after the last one counts."""
    path = shared_folder(spark) + "-lines"
    docs = table(spark, folder, "documents").select("lang", F.floor(F.col("doc_id") / 100).alias("part"), "text")
    docs.repartition("lang", "part").write.partitionBy("lang", "part").text(path)
    df = read_lines(spark, path)
    lang = F.regexp_extract("doc_id", r"lang=([a-z]+)", 1)
    return df.groupBy(lang.alias("lang")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum((F.col("lines") == "").cast("long")).alias("empty"),
        F.sum(F.length("lines")).cast("long").alias("chars"), F.max("line_no").alias("last_line"),
    )


@query("read_lines_in_splits", """
SELECT lang, count(*) AS lines, sum(length(line))::BIGINT AS chars
FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY lang""")
def lines_in_splits(spark, folder):
    """Large files of many texts each, read without numbers."""
    path = shared_folder(spark) + "-texts"
    table(spark, folder, "documents").select("lang", "text").write.partitionBy("lang").text(path)
    df = read_lines(spark, path, numbered=False)
    lang = F.regexp_extract("doc_id", r"lang=([a-z]+)", 1)
    return df.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("lines")).cast("long").alias("chars"))


@query("read_parquet_recursive", """
SELECT event_type, count(*) AS n, count(value) AS filled, count(extra) AS extra FROM (
  SELECT event_type, value, CASE WHEN event_type = 'click' THEN user_id END AS extra FROM events
) GROUP BY event_type""")
def parquet_recursive(spark, folder):
    """Files of two schemas in nested folders; files that the pattern doesn't name don't count."""
    path = shared_folder(spark) + "-nested"
    e = table(spark, folder, "events")
    e.where("event_type = 'click'").select("event_type", "value", F.col("user_id").alias("extra")).write.parquet(f"{path}/a/click")
    e.where("event_type <> 'click'").select("event_type", "value").write.parquet(f"{path}/b/c/others")
    e.select("event_type", "value").write.json(f"{path}/b/copy")
    df = read_parquet(spark, path, pattern="part-*.parquet", recursive=True)
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("filled"), F.count("extra").alias("extra"))


@query("union_relaxed", rsql("""
SELECT kind, count(*) AS n, sum(amount) AS amount, count(segment) AS segments FROM (
  SELECT 'customer' AS kind, c_acctbal AS amount, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'nation', n_nationkey, NULL FROM nation) GROUP BY kind""", "amount", 4))
def union(spark, folder):
    a = table(spark, folder, "customer").select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, folder, "nation").select(F.lit("nation").alias("kind"), F.col("n_nationkey").alias("amount"))
    out = union_relaxed([a, b]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.count("segment").alias("segments"))
    return rounded(out, 4)


@query("entity_from_path", """
SELECT doc_id, split_part(source, '_', 1) || '_' || doc_id AS participant_id, lang AS modality,
       source || '_x' AS stem FROM (SELECT doc_id, lang, replace(source, '_', '-') AS source FROM documents)""")
def entity(spark, folder):
    docs = table(spark, folder, "documents").withColumn("source", F.replace("source", F.lit("_"), F.lit("-")))
    path = F.concat(F.lit("/data/"), "source", F.lit("_"), F.col("doc_id").cast("string"), F.lit("_"), "lang", F.lit("_eeg.parquet"))
    df = docs.select("doc_id", path.alias("path"), F.concat("source", F.lit("_x")).alias("stem"))
    return entity_from_path(df, "path").drop("path")


@query("normalise_api_json", rsql("""
SELECT user_id AS participant_id, 'landed' AS source, event_type AS indicator, upper(event_type) AS indicator_code,
       year, value, 'c' || (user_id % 7) AS country
FROM (SELECT user_id, event_type, value, CAST(epoch_us(ts) / 3600000000 AS BIGINT) % 50 + 1970 AS y,
             CASE WHEN event_id % 5 = 0 THEN 0 ELSE CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) % 50 + 1970 END AS year, event_id FROM events)
WHERE event_type <> 'view' AND event_id % 4 <> 0""", "value", 6))
def api_json(spark, folder):
    e = table(spark, folder, "events")
    year = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3600000000) % 50 + 1970
    rec = F.struct(
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 != 0, year.cast("string")).alias("date"),
    )
    land = e.groupBy("user_id", "event_type").agg(F.collect_list(rec).alias("recs"))
    body = F.concat(F.lit('[{"page": 1}, '), F.to_json("recs"), F.lit("]"))
    land = land.select(
        F.col("user_id").alias("participant_id"), F.lit("landed").alias("source"), F.col("event_type").alias("indicator"),
        F.when(F.col("event_type") != "view", F.upper("event_type")).alias("indicator_code"),
        F.concat(F.lit("c"), (F.col("user_id") % 7).cast("string")).alias("country"), body.alias("body"),
    )
    return rounded(normalise_api_json(land, meta=["country", "api"]))


@query("latest_period", """
SELECT user_id AS participant_id, CASE WHEN user_id % 3 = 0 THEN 2025 ELSE CAST(min(k) AS INTEGER) END AS period
FROM (SELECT user_id, 1900 + CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
WHERE rn = 1 GROUP BY user_id""")
def period(spark, folder):
    e = table(spark, folder, "events")
    k = (F.regexp_extract("props", r"(\d+)", 1).cast("int") + 1900).cast("string")
    recs = F.array(F.struct(k.alias("date"), F.col("value")))
    body = F.when(F.col("user_id") % 3 == 0, F.lit('[{"page": 1}]')).otherwise(F.concat(F.lit("[{}, "), F.to_json(recs), F.lit("]")))
    land = e.select(F.col("user_id").alias("participant_id"), F.col("event_id").alias("ordinal"), body.alias("body"))
    return latest_period(land)


@query("stream_manifest", """
SELECT l_returnflag AS file, CAST(l_suppkey % 5 AS INTEGER) AS stream_idx, CASE WHEN l_suppkey % 5 = 0 THEN 'Unknown' ELSE 'T' || (l_suppkey % 5) END AS type,
       'my-stream_' || (l_suppkey % 5) AS name, max(n) AS samples, count(*) AS n_channels, max(n) BETWEEN 1 AND 9 AS few_samples
FROM (SELECT l_returnflag, l_suppkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1, 2, l_suppkey % 5
""".replace("SELECT l_returnflag, l_suppkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL",
            "SELECT l_returnflag, l_suppkey % 5 AS l_suppkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL"))
def manifest(spark, folder):
    li = table(spark, folder, "lineitem")
    s = (F.col("l_suppkey") % 5).cast("int")
    rows = li.select(
        F.col("l_returnflag").alias("file"), s.alias("stream_idx"), F.when(s != 0, F.concat(F.lit("T"), s.cast("string"))).alias("type"),
        F.concat(F.lit("my-stream_ "), s.cast("string"), F.lit("!")).alias("name"), F.col("l_linestatus").alias("channel"),
    )
    return stream_manifest(rows)


def _nations(spark, folder):
    n = table(spark, folder, "nation")
    kind = F.when(F.col("n_nationkey") % 3 == 0, "EEG").otherwise("Markers")
    return n.select(F.col("n_regionkey").alias("file"), F.col("n_nationkey").alias("stream_idx"), kind.alias("type"), F.col("n_name").alias("name"))


_PICK = """SELECT file, stream_idx, type, name FROM (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY stream_idx) AS rn FROM (
    SELECT n_regionkey AS file, n_nationkey AS stream_idx, CASE WHEN n_nationkey % 3 = 0 THEN 'EEG' ELSE 'Markers' END AS type, n_name AS name FROM nation)
  WHERE {}) WHERE rn = 1"""


@query("select_stream_type", _PICK.format("lower(type) = 'eeg'"))
def by_type(spark, folder):
    return select_stream(_nations(spark, folder), "type:eeg")


@query("select_stream_name", _PICK.format("contains(lower(name), 'nation_1')"))
def by_name(spark, folder):
    return select_stream(_nations(spark, folder), "name:Nation_1")


@query("select_stream_glob", _PICK.format("regexp_full_match(name, 'NATION_.[0-4]')"))
def by_glob(spark, folder):
    return select_stream(_nations(spark, folder), "NATION_?[0-4]")


@query("stream_samples", """
SELECT c_nationkey AS stream_idx, count(*) AS n FROM customer WHERE c_nationkey IN (
  SELECT min(n_nationkey) FROM nation WHERE n_nationkey % 3 = 0 GROUP BY n_regionkey) GROUP BY c_nationkey""")
def samples(spark, folder):
    chosen = select_stream(_nations(spark, folder), "type:EEG")
    rows = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "stream_idx")
    return stream_samples(rows, chosen, ["stream_idx"]).groupBy("stream_idx").agg(F.count(F.lit(1)).alias("n"))


@query("write_result", rsql("SELECT l_linestatus, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL", "quantity", 4))
def written(spark, folder):
    path = shared_folder(spark) + "-result"
    write_result(table(spark, folder, "lineitem"), path, ["l_linestatus"])
    got = read_parquet(spark, path)
    return rounded(got.groupBy("l_linestatus", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")), 4)


@query("write_corrected_partition", rsql("""
SELECT c_mktsegment, count(*) AS n, sum(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2 ELSE c_acctbal END) AS balance FROM customer GROUP BY ALL""", "balance", 4))
def corrected_partition(spark, folder):
    path = shared_folder(spark) + "-partition"
    base = table(spark, folder, "customer")
    write_result(base, path, ["c_mktsegment"])
    fix = base.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    write_result(fix, path, ["c_mktsegment"], mode="overwrite", dynamic=True)
    got = read_parquet(spark, path)
    return rounded(got.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("balance")), 4)


@query("profile", rsql("""
SELECT 'o_orderkey' AS "column", 'bigint' AS type, count(*) AS rows, count(o_orderkey) AS non_null, min(o_orderkey)::DOUBLE AS min, max(o_orderkey)::DOUBLE AS max FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(*), count(o_totalprice), min(o_totalprice), max(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(*), count(o_orderpriority), NULL, NULL FROM orders""", "min, max", 4))
def profiled(spark, folder):
    return rounded(profile(table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")), 4)
