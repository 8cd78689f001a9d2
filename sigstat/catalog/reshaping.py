"""Queries over joins, bins, pivots and stacked rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.reshape import (
    bin_by_labels, files_to_participant_table, map_join, overlay_long, overlay_series, pivot_long_to_wide, relative_long,
    relative_to_baseline, stack_conditions, unpivot_wide_to_long,
)
from .base import query, rounded, rsql, table


@query("map_join", rsql("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, n_regionkey, n.n_name AS c_name_right
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""", "c_acctbal", 4))
def mapped(spark, folder):
    n = table(spark, folder, "nation").withColumnRenamed("n_name", "c_name")
    return rounded(map_join(table(spark, folder, "customer"), n, "c_nationkey", "n_nationkey"), 4)


def _labels(spark, folder):
    p = table(spark, folder, "part")
    return p.select(F.col("p_partkey").alias("trial_id"), F.when(F.col("p_size") % 10 != 0, F.col("p_size") / 5.0).alias("valence"), (F.col("p_retailprice") / 200.0).alias("arousal"))


_LABELS = "labels2 AS (SELECT CAST(p_partkey AS VARCHAR) AS trial_id, CASE WHEN p_size % 10 <> 0 THEN p_size / 5.0 END AS valence, p_retailprice / 200.0 AS arousal FROM part)"
_TWICE = """SELECT {values}, unnest([{val}, {aro}]) AS condition, trial_id AS epoch_id
FROM (SELECT CAST(l_partkey AS VARCHAR) AS trial_id, l_quantity, l_extendedprice FROM lineitem) JOIN labels2 USING (trial_id)"""


@query("bin_by_labels", rsql(f"WITH {_LABELS} " + _TWICE.format(
    values="l_quantity AS value", val="CASE WHEN valence >= 5 THEN 'valence_high' ELSE 'valence_low' END",
    aro="CASE WHEN arousal >= 5 THEN 'arousal_high' ELSE 'arousal_low' END"), "value", 4))
def two_way(spark, folder):
    phys = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("condition"), "l_quantity")
    return rounded(bin_by_labels(phys, _labels(spark, folder)), 4)


@query("bin_by_labels_neutral", rsql(f"WITH {_LABELS} " + _TWICE.format(
    values="l_quantity, l_extendedprice",
    val="CASE WHEN valence > 6 THEN 'valence_high' WHEN valence < 4 THEN 'valence_low' ELSE 'valence_neutral' END",
    aro="CASE WHEN arousal > 6 THEN 'arousal_high' WHEN arousal < 4 THEN 'arousal_low' ELSE 'arousal_neutral' END"), "l_quantity, l_extendedprice", 4))
def three_way(spark, folder):
    phys = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("trial_id"), "l_quantity", "l_extendedprice", F.col("l_linestatus").alias("signal"))
    return rounded(bin_by_labels(phys, _labels(spark, folder), value_col="auto_multi", neutral_band=1.0), 4)


@query("pivot_long_to_wide", rsql("""
SELECT l_suppkey, max(CASE WHEN l_returnflag = 'A' THEN v END) AS A, max(CASE WHEN l_returnflag = 'N' THEN v END) AS N, max(CASE WHEN l_returnflag = 'R' THEN v END) AS R
FROM (SELECT l_suppkey, l_returnflag, arg_min(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS v FROM lineitem GROUP BY ALL)
GROUP BY l_suppkey""", "A, N, R", 4))
def pivoted(spark, folder):
    li = table(spark, folder, "lineitem")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return rounded(pivot_long_to_wide(li, ["l_suppkey"], "l_returnflag", "l_extendedprice", order, ["A", "N", "R"]), 4)


@query("unpivot_wide_to_long", rsql("""
SELECT c_custkey, c_name, variable, value FROM (SELECT c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal FROM customer)
UNPIVOT (value FOR variable IN (c_nationkey, c_acctbal))""", "value", 4))
def unpivoted(spark, folder):
    return rounded(unpivot_wide_to_long(table(spark, folder, "customer"), ["c_custkey", "c_name"]), 4)


def _result_files(spark, folder):
    """One row per nation (file) and segment: P_{region}_ecg / _eda result files."""
    c = table(spark, folder, "customer")
    nat = F.col("c_nationkey")
    mod = F.when(nat % 2 == 0, "ecg").otherwise("eda")
    rows = c.groupBy("c_nationkey", F.col("c_mktsegment").alias("condition")).agg(F.max("c_acctbal").alias("top"), F.min("c_acctbal").alias("low"))
    return rows.select(
        F.format_string("f%03d", nat).alias("file"), F.concat(F.lit("P_"), F.floor(nat / 5).cast("string")).alias("participant_id"), mod.alias("modality"),
        "condition", F.array("top", "low").alias("y_data"),
    )


@query("files_to_participant_table", rsql("""
WITH f AS (SELECT c_nationkey AS k, c_mktsegment AS condition, max(c_acctbal) AS top FROM customer GROUP BY ALL),
c AS (SELECT 'P_' || (k // 5) AS participant_id, CASE WHEN k % 2 = 0 THEN 'ecg' ELSE 'eda' END || '_' || condition || '_y_data' AS col, arg_max(top, k) AS v FROM f
      WHERE condition IN ('BUILDING', 'MACHINERY') GROUP BY ALL)
SELECT participant_id, max(v) FILTER (col = 'ecg_BUILDING_y_data') AS ecg_BUILDING_y_data, max(v) FILTER (col = 'ecg_MACHINERY_y_data') AS ecg_MACHINERY_y_data,
  max(v) FILTER (col = 'eda_BUILDING_y_data') AS eda_BUILDING_y_data, max(v) FILTER (col = 'eda_MACHINERY_y_data') AS eda_MACHINERY_y_data FROM c GROUP BY participant_id""",
    "ecg_BUILDING_y_data, ecg_MACHINERY_y_data, eda_BUILDING_y_data, eda_MACHINERY_y_data", 4))
def participant_table(spark, folder):
    out = files_to_participant_table(_result_files(spark, folder), conditions=["BUILDING", "MACHINERY"], auto_prefix=True)
    return rounded(out, 4)


@query("files_to_participant_table_lists", rsql("""
WITH f AS (SELECT c_nationkey AS k, c_mktsegment AS condition, max(c_acctbal) AS top FROM customer GROUP BY ALL),
c AS (SELECT 'P_' || (k // 5) AS participant_id, condition, arg_max(top, k) AS v FROM f GROUP BY ALL)
SELECT participant_id, max(v) FILTER (condition = 'BUILDING') AS m_BUILDING_y_data, max(v) FILTER (condition = 'MACHINERY') AS m_MACHINERY_y_data FROM c GROUP BY participant_id""",
    "m_BUILDING_y_data, m_MACHINERY_y_data", 4))
def participant_table_lists(spark, folder):
    """Files without a condition column: the list in x_data names the conditions."""
    rows = _result_files(spark, folder)
    files = rows.groupBy("file", "participant_id", "modality").agg(F.sort_array(F.collect_list(F.struct("condition", F.col("y_data")[0].alias("v")))).alias("s"))
    files = files.select("file", "participant_id", "modality", F.col("s.condition").alias("x_data"), F.col("s.v").alias("y_data"))
    out = files_to_participant_table(files, prefix="m_", columns=["m_BUILDING_y_data", "m_MACHINERY_y_data"])
    return rounded(out, 4)


@query("overlay_series", """
WITH s AS (SELECT l_returnflag AS g, l_linestatus AS indicator, year(l_shipdate) AS x, round(avg(l_extendedprice), 4) AS y FROM lineitem GROUP BY ALL)
SELECT indicator, list(g ORDER BY g) AS labels, list(xs ORDER BY g) AS x_data, list(ys ORDER BY g) AS y_data FROM (
  SELECT indicator, g, list(CAST(x AS DOUBLE) ORDER BY x) AS xs, list(y ORDER BY x) AS ys FROM s GROUP BY ALL) GROUP BY indicator""")
def overlay(spark, folder):
    li = table(spark, folder, "lineitem")
    s = li.groupBy(F.col("l_returnflag").alias("g"), F.col("l_linestatus").alias("indicator"), F.year("l_shipdate").alias("year")).agg(F.round(F.avg("l_extendedprice"), 4).alias("value"))
    return overlay_series(s, "g")


@query("overlay_long", """
SELECT l_linestatus AS indicator, l_returnflag AS "group", 'flag ' || l_returnflag AS label, row_number() OVER (PARTITION BY l_linestatus, l_returnflag ORDER BY x, y) - 1 AS idx, x, y
FROM (SELECT l_linestatus, l_returnflag, date_diff('day', DATE '1990-01-01', l_shipdate::DATE)::DOUBLE AS x, l_extendedprice AS y FROM lineitem)""")
def overlaid_rows(spark, folder):
    """Every line as a point of its series."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))
    s = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", day.alias("x"), "l_extendedprice", F.concat(F.lit("flag "), "l_returnflag").alias("name"))
    return overlay_long(s, "l_returnflag", "x", "l_linestatus", "l_extendedprice", "name").withColumnRenamed("l_linestatus", "indicator")


_STACK = """s AS (SELECT l_returnflag AS pid, l_linestatus AS c, year(l_shipdate) AS x, round(avg(l_quantity), 4) AS y, round(stddev_samp(l_quantity), 4) AS e FROM lineitem GROUP BY ALL),
st AS (SELECT pid, c, list(y ORDER BY x) AS y, list(e ORDER BY x) AS e FROM s GROUP BY ALL)"""


def _stacked(spark, folder):
    li = table(spark, folder, "lineitem")
    s = li.groupBy(F.col("l_returnflag").alias("pid"), F.col("l_linestatus").alias("condition"), F.year("l_shipdate").alias("x")).agg(
        F.round(F.avg("l_quantity"), 4).alias("y"), F.round(F.stddev_samp("l_quantity"), 4).alias("e")
    )
    rows = s.groupBy("pid", "condition").agg(F.sort_array(F.collect_list(F.struct("x", "y", "e"))).alias("p"))
    return rows.select("pid", "condition", F.col("p.y").alias("y_data"), F.col("p.e").alias("y_var"))


@query("stack_conditions", f"WITH {_STACK} SELECT pid, list(c ORDER BY c) AS labels, list(y ORDER BY c) AS y_data, list(e ORDER BY c) AS y_var FROM st GROUP BY pid")
def stacked(spark, folder):
    return stack_conditions(_stacked(spark, folder), ["pid"])


@query("relative_to_baseline", f"""WITH {_STACK}, b AS (SELECT pid, y AS b FROM st WHERE c = 'F')
SELECT pid, ['O'] AS labels, [list_transform(range(1, len(y) + 1), lambda i: round(y[i] - CASE WHEN i <= len(b) THEN b[i] ELSE b[1] END, 4) + 0.0)] AS y_data, [e] AS y_var, 'Δ Quantity (rel. to F)' AS y_label
FROM st JOIN b USING (pid) WHERE c = 'O'""")
def relative(spark, folder):
    rows = stack_conditions(_stacked(spark, folder), ["pid"], constants={"y_label": "Quantity"})
    out = relative_to_baseline(rows, "F")
    tidy = F.transform("y_data", lambda s: F.transform(s, lambda v: F.round(v, 4) + F.lit(0.0)))
    return out.withColumn("y_data", tidy)


@query("relative_long", rsql("""
WITH s AS (SELECT l_returnflag AS pid, l_linestatus AS condition, year(l_shipdate) - CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 100 ELSE 0 END AS x,
  avg(l_quantity) AS value FROM lineitem GROUP BY ALL),
b AS (SELECT pid, x, value AS b FROM s WHERE condition = 'F'), f AS (SELECT pid, arg_min(value, x) AS b0 FROM s WHERE condition = 'F' GROUP BY pid)
SELECT s.pid, condition, s.x, value - coalesce(b, b0) AS value FROM s LEFT JOIN b ON s.pid = b.pid AND s.x = b.x JOIN f ON s.pid = f.pid WHERE condition <> 'F'""", "value"))
def relative_rows(spark, folder):
    gap = F.expr("case when l_linestatus = 'F' and l_returnflag = 'N' then 100 else 0 end")  # one key has no baseline at its positions
    x = (F.year("l_shipdate") - gap).cast("long").alias("x")
    s = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("pid"), F.col("l_linestatus").alias("condition"), x).agg(F.avg("l_quantity").alias("value"))
    return rounded(relative_long(s, ["pid"], "F"))
