"""Queries over operators that put rows next to statistics of their series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.windows import (
    baseline_correct, linear_transform, log_transform, outlier_summary, reference, short_channel_regression, standardise, tddr, zscore_flags,
)
from .base import LINE_CHANNELS, LINE_ORDER, LINE_SQL_ORDER, WAVES, lines, query, rounded, rsql, table, waves

_ID = "l_suppkey, l_orderkey, l_linenumber, l_partkey"


@query("standardise", rsql("""
SELECT c_custkey, c_mktsegment, CASE WHEN s > 1e-8 THEN (c_acctbal - m) / s ELSE 0.0 END AS c_acctbal, 0e0 AS flat FROM customer JOIN (
  SELECT c_mktsegment, avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer GROUP BY ALL) USING (c_mktsegment)""", "c_acctbal"))
def standard(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", F.lit(3.0).alias("flat"))
    return rounded(standardise(c, ["c_mktsegment"], ["c_acctbal", "flat"]))


@query("zscore_flags", rsql("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_quantity_z, abs(l_quantity_z) > 1.7 AS l_quantity_out FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN s > 0 THEN (l_quantity - m) / s ELSE 0.0 END AS l_quantity_z FROM lineitem JOIN (
    SELECT l_suppkey, avg(l_quantity) AS m, stddev_samp(l_quantity) AS s FROM lineitem GROUP BY ALL) USING (l_suppkey))""", "l_quantity, l_quantity_z"))
def flags(spark, folder):
    li = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rounded(zscore_flags(li, ["l_suppkey"], ["l_quantity"], 1.7).drop("l_suppkey"))


@query("outlier_summary", """
SELECT l_suppkey, count(*) AS rows, 'l_extendedprice' AS "column", count(*) FILTER (abs((l_extendedprice - m) / s) > 1.8) AS outliers FROM lineitem JOIN (
  SELECT l_suppkey, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem GROUP BY ALL) USING (l_suppkey) GROUP BY l_suppkey""")
def outliers(spark, folder):
    return outlier_summary(table(spark, folder, "lineitem").select("l_suppkey", "l_extendedprice"), ["l_suppkey"], ["l_extendedprice"], 1.8)


_BASE = f"""n AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_SQL_ORDER}) AS rn FROM lineitem),
b AS (SELECT l_suppkey, avg(l_extendedprice) AS bp, avg(l_discount) AS bd FROM n WHERE rn <= {{}} GROUP BY l_suppkey)"""


@query("baseline_correct", rsql(f"""WITH {_BASE.format(25)}
SELECT {_ID}, l_extendedprice - bp AS l_extendedprice, l_discount - bd AS l_discount FROM lineitem JOIN b USING (l_suppkey)""", "l_extendedprice, l_discount"))
def baseline(spark, folder):
    out = baseline_correct(lines(spark, folder), ["l_suppkey"], ["l_extendedprice", "l_discount"], 5.0, 5.0, LINE_ORDER)
    return rounded(out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount"))


@query("baseline_correct_epochs", rsql(f"""WITH {WAVES}, n AS (SELECT *, row_number() OVER (PARTITION BY participant_id, condition, epoch_id ORDER BY time) AS rn FROM waves),
b AS (SELECT participant_id, condition, epoch_id, avg(x) AS bx FROM n WHERE rn <= 8 GROUP BY ALL)
SELECT participant_id, condition, epoch_id, seq, x - bx AS x FROM waves JOIN b USING (participant_id, condition, epoch_id)""", "x"))
def baseline_epochs(spark, folder):
    w = waves(spark, folder).select("participant_id", "condition", "epoch_id", "seq", "time", "x")
    return rounded(baseline_correct(w, ["participant_id"], ["x"], 0.125, 64.0, ["time"], per_epoch=True).drop("time"))


@query("log_transform", rsql(f"""WITH {_BASE.format(25)}
SELECT {_ID}, -log10((CASE WHEN l_extendedprice <= 0 THEN 1e-10 ELSE l_extendedprice END) / (CASE WHEN bp <= 0 THEN 1e-10 ELSE bp END)) AS l_extendedprice,
  -log10((CASE WHEN l_discount <= 0 THEN 1e-10 ELSE l_discount END) / (CASE WHEN bd <= 0 THEN 1e-10 ELSE bd END)) AS l_discount FROM lineitem JOIN b USING (l_suppkey)""", "l_extendedprice, l_discount"))
def logged(spark, folder):
    out = log_transform(lines(spark, folder), ["l_suppkey"], ["l_extendedprice", "l_discount"], 5.0, 5.0, LINE_ORDER)
    return rounded(out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount"))


@query("tddr", rsql(f"""
WITH {WAVES}, d AS (SELECT epoch_id, seq, x, coalesce(x - lag(x) OVER (PARTITION BY epoch_id ORDER BY seq), 0) AS d, first_value(x) OVER (PARTITION BY epoch_id ORDER BY seq) AS x0 FROM waves),
m AS (SELECT epoch_id, quantile_cont(d, 0.5) AS med FROM d GROUP BY ALL),
s AS (SELECT epoch_id, quantile_cont(abs(d - med), 0.5) / 1.4826 AS s FROM d JOIN m USING (epoch_id) GROUP BY ALL)
SELECT epoch_id, seq, CASE WHEN s < 1e-10 THEN x ELSE x0 + sum(d / pow(1 + pow(d / (4.685 * s), 2), 2)) OVER (PARTITION BY epoch_id ORDER BY seq ROWS UNBOUNDED PRECEDING) END AS x
FROM d JOIN s USING (epoch_id)""", "x"))
def repaired(spark, folder):
    return rounded(tddr(waves(spark, folder).select("epoch_id", "seq", "x"), ["epoch_id"], "x", ["seq"]))


@query("reference_average", rsql(f"""SELECT {_ID}, l_quantity - r AS l_quantity, l_discount - r AS l_discount, l_tax - r AS l_tax FROM (
  SELECT *, (l_quantity + l_discount + l_tax) / 3 AS r FROM lineitem)""", "l_quantity, l_discount, l_tax"))
def referenced(spark, folder):
    li = lines(spark, folder).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    return rounded(reference(li, ["l_quantity", "l_discount", "l_tax"]))


@query("reference_named", rsql(f"SELECT {_ID}, l_quantity - l_tax AS l_quantity, l_discount - l_tax AS l_discount, 0e0 AS l_tax FROM lineitem", "l_quantity, l_discount, l_tax"))
def referenced_named(spark, folder):
    li = lines(spark, folder).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    return rounded(reference(li, ["l_quantity", "l_discount", "l_tax"], "l_tax"))


@query("short_channel_regression", rsql("""
WITH r AS (SELECT *, (l_discount + l_tax) / 2 AS r FROM lineitem), b AS (SELECT l_suppkey, sum(l_quantity * r) / (sum(r * r) + 1e-12) AS b FROM r GROUP BY l_suppkey)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity - b * r AS long_a, l_discount AS short_a, l_tax AS short_b FROM r JOIN b USING (l_suppkey)""", "long_a, short_a, short_b"))
def regressed(spark, folder):
    li = lines(spark, folder).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("long_a"), F.col("l_discount").alias("short_a"), F.col("l_tax").alias("short_b")
    )
    return rounded(short_channel_regression(li, ["l_suppkey"], ["long_a", "short_a", "short_b"]))


@query("linear_transform", rsql(f"""SELECT {_ID}, 0.5 * l_quantity - l_discount AS l_quantity, 2e0 * l_quantity + 3 * l_discount AS l_discount FROM lineitem""", "l_quantity, l_discount"))
def transformed(spark, folder):
    li = lines(spark, folder).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", *LINE_CHANNELS)
    out = linear_transform(li, LINE_CHANNELS, [[0.5, -1.0], [2.0, 3.0]], "0,2")
    return rounded(out)


_DET = 1.4866 * 1.7986 - 3.8437 * 2.5264
_MBLL = [[1.7986 / _DET / 6 * 1000, -3.8437 / _DET / 6 * 1000], [-2.5264 / _DET / 6 * 1000, 1.4866 / _DET / 6 * 1000]]


@query("beer_lambert", rsql(f"""SELECT {_ID}, {_MBLL[0][0]!r} * l_discount + {_MBLL[0][1]!r} * l_tax AS l_discount, {_MBLL[1][0]!r} * l_discount + {_MBLL[1][1]!r} * l_tax AS l_tax FROM lineitem""", "l_discount, l_tax", 5))
def beer_lambert(spark, folder):
    li = lines(spark, folder).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return rounded(linear_transform(li, ["l_discount", "l_tax"], "mbll"), 5)
