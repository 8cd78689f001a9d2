"""Queries over row and column selection and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.select import (
    apply_corrections, flatten_lists, infer_sfreq, match_channels, null_report, reject_samples, retention, row_filter,
    select_channels, select_columns, strict_guard,
)
from .base import LINE_CHANNELS, LINE_ORDER, LINE_SQL_ORDER, SIGNAL, lines, query, rounded, rsql, signal, table


@query("row_filter", "SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus FROM lineitem WHERE l_returnflag = 'R'")
def filtered(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_returnflag")
    return row_filter(df, "l_returnflag", "R", drop_col=True)


@query("select_columns", "SELECT l_orderkey, l_extendedprice, l_discount, l_tax FROM lineitem")
def columns(spark, folder):
    return select_columns(table(spark, folder, "lineitem"), ["2:-1 -KEY -line -ship -flag -STAT -quant"], keep=["l_orderkey"])


@query("infer_sfreq_median", rsql(f"""
WITH {SIGNAL}, d AS (SELECT participant_id, time - lag(time) OVER (PARTITION BY participant_id ORDER BY time, seq) AS step FROM signal)
SELECT participant_id, CASE WHEN quantile_cont(step, 0.5) > 0 THEN 1 / quantile_cont(step, 0.5) ELSE 1.0 END AS sfreq FROM d GROUP BY participant_id""", "sfreq", 9))
def sfreq_median(spark, folder):
    return rounded(infer_sfreq(signal(spark, folder), ["participant_id"]), 9)


@query("infer_sfreq_first", rsql(f"""
WITH {SIGNAL}, d AS (SELECT participant_id, time, row_number() OVER (PARTITION BY participant_id ORDER BY time, seq) AS rn FROM signal),
p AS (SELECT participant_id, max(CASE WHEN rn = 2 THEN time END) - max(CASE WHEN rn = 1 THEN time END) AS step FROM d GROUP BY participant_id)
SELECT participant_id, CASE WHEN step > 0 THEN 1 / step ELSE 128.0 END AS sfreq FROM p""", "sfreq", 9))
def sfreq_first(spark, folder):
    return rounded(infer_sfreq(signal(spark, folder), ["participant_id"], rule="first", order=["time", "seq"]), 9)


@query("infer_sfreq_distinct", rsql(f"""
WITH {SIGNAL}, d AS (SELECT participant_id, time, dense_rank() OVER (PARTITION BY participant_id ORDER BY time) AS rn FROM signal),
p AS (SELECT participant_id, max(CASE WHEN rn = 2 THEN time END) - max(CASE WHEN rn = 1 THEN time END) AS step FROM d GROUP BY participant_id)
SELECT participant_id, CASE WHEN step > 0 THEN 1 / step ELSE 1.0 END AS sfreq FROM p""", "sfreq", 9))
def sfreq_distinct(spark, folder):
    return rounded(infer_sfreq(signal(spark, folder), ["participant_id"], rule="distinct"), 9)


@query("select_channels", "SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem")
def channels(spark, folder):
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *LINE_CHANNELS)
    return select_channels(li, "l_(disc|tax)", keep=["l_orderkey", "l_linenumber", "l_partkey"])


@query("match_channels", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount FROM lineitem")
def matched(spark, folder):
    li = table(spark, folder, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", *match_channels(LINE_CHANNELS, "0::2"))


@query("reject_amplitude", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount FROM lineitem WHERE abs(l_quantity) < 25 AND abs(l_discount) < 25")
def amplitude(spark, folder):
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    return reject_samples(li, [], ["l_quantity", "l_discount"], "amplitude", 25)


@query("reject_gradient", f"""
WITH g AS (SELECT l_suppkey, {LINE_SQL_ORDER}, l_tax,
  coalesce((lead(l_quantity) OVER w - lag(l_quantity) OVER w) / 2, lead(l_quantity) OVER w - l_quantity, l_quantity - lag(l_quantity) OVER w) AS gq,
  coalesce((lead(l_tax) OVER w - lag(l_tax) OVER w) / 2, lead(l_tax) OVER w - l_tax, l_tax - lag(l_tax) OVER w) AS gt
  FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY {LINE_SQL_ORDER}, l_tax))
SELECT l_suppkey, {LINE_SQL_ORDER}, l_tax FROM g WHERE abs(gq) < 8 AND abs(gt) < 8""")
def gradient(spark, folder):
    li = lines(spark, folder).select("l_suppkey", *LINE_ORDER, "l_tax")
    return reject_samples(li, ["l_suppkey"], ["l_quantity", "l_tax"], "gradient", 8, order=[*LINE_ORDER, "l_tax"])


@query("reject_flatline", """
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (
  SELECT l_suppkey FROM lineitem GROUP BY l_suppkey HAVING stddev_pop(l_quantity) > 14.4 AND stddev_pop(l_tax) > 0.02) GROUP BY l_suppkey""")
def flatline(spark, folder):
    li = table(spark, folder, "lineitem").select("l_suppkey", "l_quantity", (F.col("l_tax") * 720).alias("l_tax"))
    return reject_samples(li, ["l_suppkey"], ["l_quantity", "l_tax"], "flatline", 14.4).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("reject_zscore", """
WITH s AS (SELECT l_suppkey, avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, count(*) AS n FROM lineitem JOIN s USING (l_suppkey) WHERE abs(l_extendedprice - m) / (s + 1e-10) < 1.7 GROUP BY l_suppkey""")
def zscore(spark, folder):
    li = table(spark, folder, "lineitem").select("l_suppkey", "l_extendedprice")
    return reject_samples(li, ["l_suppkey"], ["l_extendedprice"], "zscore", 1.7).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("retention", rsql("""
SELECT *, CASE WHEN rejected_pct > 80 THEN 'severe' WHEN rejected_pct > 50 THEN 'high' ELSE 'ok' END AS level FROM (
  SELECT l_suppkey, count(*) AS rows_before, count(*) FILTER (abs(l_quantity) < 25) AS rows_after,
         100.0 * (1 - (count(*) FILTER (abs(l_quantity) < 25))::DOUBLE / count(*)) AS rejected_pct FROM lineitem GROUP BY l_suppkey)""", "rejected_pct", 6))
def kept(spark, folder):
    li = table(spark, folder, "lineitem").select("l_suppkey", "l_quantity")
    return rounded(retention(li, reject_samples(li, ["l_suppkey"], ["l_quantity"], "amplitude", 25), ["l_suppkey"]))


@query("apply_corrections", rsql("""
SELECT c_custkey, c_mktsegment, CASE WHEN c_nationkey = 3 THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal, c_nationkey FROM customer
WHERE c_nationkey <> 3 OR c_acctbal > 0""", "c_acctbal", 4))
def corrected(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    fix = c.where("c_nationkey = 3 and c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    return rounded(apply_corrections(c, fix, ["c_nationkey"]), 4)


@query("flatten_lists", rsql("""
SELECT vec_id, label, CAST(i - 1 AS BIGINT) AS pos, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, (SELECT unnest(range(1, 65)) AS i)""", "value", 6))
def flat(spark, folder):
    e = table(spark, folder, "embeddings")
    pos = F.sequence(F.lit(0).cast("long"), (F.size("embedding") - 1).cast("long"))
    wide = e.select("vec_id", "label", pos.alias("pos"), F.transform("embedding", lambda x: x.cast("double")).alias("value"))
    return rounded(flatten_lists(wide))


@query("null_report", """
SELECT count(*) AS rows, count(*) - count(v) AS missing_value, count(*) - count(u) AS missing_user_id FROM (
  SELECT CASE WHEN event_type <> 'error' THEN value END AS v, user_id AS u FROM events)""")
def nulls(spark, folder):
    e = table(spark, folder, "events").withColumn("value", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    return null_report(e, ["value", "user_id"])


@query("strict_guard", rsql("SELECT event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY event_type", "total", 4))
def guarded(spark, folder):
    e = strict_guard(table(spark, folder, "events"), ["value", "user_id"])
    return rounded(e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), 4)
