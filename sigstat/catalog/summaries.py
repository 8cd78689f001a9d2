"""Queries over aggregations and features per epoch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.summary import (
    amplitude, asymmetry, auto_aggregate, descriptive, epoch_means, interval_metrics, participant_flow, peak_latency,
    quality_status, region_epoch_means, region_group_means, waveform_average,
)
from .base import EPOCHS, WAVES, epochs, means_sql, query, rounded, rsql, signal, table, trials, waves


@query("auto_aggregate", rsql("""
SELECT l_returnflag, l_linestatus, count(is_big) AS total_count, round(avg(CASE WHEN is_big THEN 1.0 ELSE 0.0 END), 4) AS mean_is_big,
  round(avg(l_quantity), 4) AS mean_l_quantity, count(DISTINCT part) + max(CASE WHEN part IS NULL THEN 1 ELSE 0 END) AS unique_part,
  arg_min(tag, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS tag
FROM (SELECT *, l_quantity > 25 AS is_big, CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END AS part, 'S' || l_suppkey AS tag FROM lineitem) GROUP BY ALL""",
    "mean_is_big, mean_l_quantity", 4))
def auto(spark, folder):
    li = table(spark, folder, "lineitem")
    df = li.select(
        "l_returnflag", "l_linestatus", (F.col("l_quantity") > 25).alias("is_big"), "l_quantity",
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey")).alias("part"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("tag"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("at"),
    )
    return rounded(auto_aggregate(df, ["l_returnflag", "l_linestatus"], order=["at"]), 4)


@query("epoch_means", rsql(f"WITH {EPOCHS} SELECT participant_id, condition, epoch_id, avg(value) AS value FROM epochs GROUP BY ALL", "value"))
def means(spark, folder):
    return rounded(epoch_means(epochs(spark, folder), ["participant_id"], ["value"]))


_DESC = """SELECT {by} channel, condition, round(avg(value), 4) AS mean, round(coalesce(stddev_samp(value), 0), 4) AS std,
  round(coalesce(stddev_samp(value), 0) / sqrt(count(value)), 4) AS sem, round(quantile_cont(value, 0.5), 4) AS median,
  round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 4) AS iqr, round(min(value), 4) AS min, round(max(value), 4) AS max,
  round(CASE WHEN count(value) > 2 THEN m3 / pow(m2, 1.5) END, 4) AS skewness, round(CASE WHEN count(value) > 2 THEN m4 / (m2 * m2) - 3 END, 4) AS kurtosis, count(value) AS n,
  round(avg(value) - 1.96 * coalesce(stddev_samp(value), 0) / sqrt(count(value)), 4) AS ci_95_low,
  round(avg(value) + 1.96 * coalesce(stddev_samp(value), 0) / sqrt(count(value)), 4) AS ci_95_high
FROM (SELECT *, avg(pow(value - mu, 2)) OVER w AS m2, avg(pow(value - mu, 3)) OVER w AS m3, avg(pow(value - mu, 4)) OVER w AS m4
  FROM (SELECT *, avg(value) OVER (PARTITION BY channel, condition) AS mu FROM obs) WINDOW w AS (PARTITION BY channel, condition))
GROUP BY {by} channel, condition, m2, m3, m4"""
_DESC_COLS = "mean, std, sem, median, iqr, min, max, skewness, kurtosis, ci_95_low, ci_95_high"


@query("descriptive", rsql(f"WITH {means_sql()} " + _DESC.format(by=""), _DESC_COLS, 3))
def described(spark, folder):
    return rounded(descriptive(trials(spark, folder)), 3)


@query("event_response", rsql(f"""
WITH {EPOCHS}, obs AS (SELECT participant_id, 'value' AS channel, condition, epoch_id, avg(value) AS value FROM epochs GROUP BY ALL),
d AS ({_DESC.format(by="")}), s AS (SELECT channel, max(m) FILTER (condition = 'A') AS ma, max(m) FILTER (condition = 'B') AS mb, max(v) FILTER (condition = 'A') AS va,
  max(v) FILTER (condition = 'B') AS vb, max(n) FILTER (condition = 'A') AS na, max(n) FILTER (condition = 'B') AS nb
  FROM (SELECT channel, condition, avg(value) AS m, var_samp(value) AS v, count(value)::DOUBLE AS n FROM obs GROUP BY ALL) GROUP BY channel)
SELECT d.channel, condition, mean, sem, n, (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)) AS t, (ma - mb) / sqrt((va + vb) / 2) AS cohens_d
FROM d JOIN s ON d.channel = s.channel""", "mean, sem, t, cohens_d", 3))
def event_response(spark, folder):
    """Mean and error of epoch means per condition, with the t-test between the conditions."""
    from ..operators.inference import ttest

    e = epochs(spark, folder).drop("seq")
    d = descriptive(e, ["value"], ["participant_id"]).select("channel", "condition", "mean", "sem", "n")
    t = ttest(e, ["participant_id"], ["value"], conditions=("A", "B"), digits=False).select("channel", "t", "cohens_d")
    return rounded(d.join(t, "channel"), 3)


@query("amplitude_mean", rsql(f"WITH {EPOCHS} SELECT participant_id, condition, epoch_id, 'value' AS signal, avg(value) AS amplitude FROM epochs GROUP BY ALL", "amplitude"))
def amp_mean(spark, folder):
    return rounded(amplitude(epochs(spark, folder), ["participant_id"], ["value"]))


@query("amplitude_peak_baseline", rsql(f"""
WITH {WAVES} SELECT participant_id, condition, epoch_id, signal, amplitude FROM (
  SELECT participant_id, condition, epoch_id, max(x) - avg(x) FILTER (time BETWEEN 0 AND 0.25) AS x, max(y) - avg(y) FILTER (time BETWEEN 0 AND 0.25) AS y FROM waves GROUP BY ALL)
UNPIVOT (amplitude FOR signal IN (x, y))""", "amplitude"))
def amp_peak(spark, folder):
    return rounded(amplitude(waves(spark, folder), ["participant_id"], ["x", "y"], "peak_baseline", (0.0, 0.25)))


@query("peak_latency", rsql(f"""
WITH {WAVES}, l AS (SELECT participant_id, condition, epoch_id, seq, time, signal, v FROM waves UNPIVOT (v FOR signal IN (x, y)) WHERE time BETWEEN 0.25 AND 0.75)
SELECT participant_id, condition, epoch_id, signal, v AS amplitude, time AS latency FROM (
  SELECT *, row_number() OVER (PARTITION BY participant_id, epoch_id, signal ORDER BY abs(v) DESC, seq) AS rn FROM l) WHERE rn = 1""", "amplitude, latency"))
def latency(spark, folder):
    return rounded(peak_latency(waves(spark, folder), ["participant_id"], ["x", "y"], "max_abs", (0.25, 0.75)))


_INTERVALS = """e AS (SELECT user_id AS participant_id, event_type, {x} AS x, event_id FROM events),
i AS (SELECT *, (x - lag(x) OVER (PARTITION BY participant_id, event_type ORDER BY {o})) * 1000.0 AS iv FROM e),
j AS (SELECT *, iv - lag(iv) OVER (PARTITION BY participant_id, event_type ORDER BY {o}) AS d FROM i),
m AS (SELECT participant_id, event_type, stddev_samp(iv) AS SDNN, sqrt(avg(d * d)) AS RMSSD, count(iv) AS n FROM j GROUP BY ALL)
SELECT participant_id, event_type, metric, value FROM (SELECT participant_id, event_type, SDNN, RMSSD FROM m WHERE n >= 2) UNPIVOT (value FOR metric IN (SDNN, RMSSD))"""


@query("interval_metrics", rsql("WITH " + _INTERVALS.format(x="epoch_us(ts) / 1e6", o="x"), "value", 2))
def rhythm(spark, folder):
    e = table(spark, folder, "events")
    s = signal(spark, folder).join(e.select(F.col("event_id").alias("seq"), "event_type"), "seq")
    return rounded(interval_metrics(s, ["participant_id", "event_type"], "time", "time"), 2)


@query("interval_metrics_samples", rsql("WITH " + _INTERVALS.format(x="value / 250.0", o="event_id"), "value", 4))
def rhythm_samples(spark, folder):
    e = table(spark, folder, "events").withColumnRenamed("user_id", "participant_id")
    return rounded(interval_metrics(e, ["participant_id", "event_type"], "value", sfreq=250.0, order=["event_id"]), 4)


_LAST = """l AS (SELECT l_returnflag AS condition, l_suppkey AS epoch_id, arg_max(l_extendedprice, k) FILTER (l_linestatus = 'F') AS f, arg_max(l_extendedprice, k) FILTER (l_linestatus = 'O') AS o
  FROM (SELECT *, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem) GROUP BY ALL)"""


@query("asymmetry_log", rsql(f"WITH {_LAST} SELECT condition, epoch_id, 'F-O' AS pair, ln(o) - ln(f) AS asymmetry FROM l WHERE f > 0 AND o > 0", "asymmetry"))
def asym_log(spark, folder):
    return rounded(asymmetry(_sides(spark, folder), ["condition", "epoch_id"], [("F", "O")], order=["at"]))


@query("asymmetry_subtraction", rsql(f"WITH {_LAST} SELECT condition, epoch_id, 'F-O' AS pair, f - o AS asymmetry FROM l WHERE f IS NOT NULL AND o IS NOT NULL", "asymmetry", 4))
def asym_sub(spark, folder):
    return rounded(asymmetry(_sides(spark, folder), ["condition", "epoch_id"], [("F", "O")], "subtraction", order=["at"]), 4)


def _sides(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("condition"), F.col("l_suppkey").alias("epoch_id"), F.col("l_linestatus").alias("channel"),
        F.col("l_extendedprice").alias("power"), F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("at"),
    )


_REGION = f"""{WAVES}, n AS (SELECT *, row_number() OVER (PARTITION BY participant_id, condition, epoch_id ORDER BY time) - 1 AS i FROM waves),
r AS (SELECT participant_id, condition, epoch_id, (avg(x) FILTER (i >= 16) - avg(x) FILTER (i < 16) + avg(y) FILTER (i >= 16) - avg(y) FILTER (i < 16)) / 2 AS "both",
  avg(y) FILTER (i >= 16) - avg(y) FILTER (i < 16) AS square FROM n GROUP BY ALL)"""


@query("region_epoch_means", rsql(f'WITH {_REGION} SELECT participant_id, condition, epoch_id, "both" AS pair, square FROM r', "pair, square"))
def region_epochs(spark, folder):
    out = region_epoch_means(waves(spark, folder), ["participant_id"], {"pair": ["x", "y"], "square": ["re:^y$"]}, 0.25, 64.0, ["x", "y"])
    return rounded(out)


@query("region_group_means", rsql(f"""WITH {_REGION} SELECT condition, "group", avg(v) AS mean, coalesce(stddev_samp(v) / sqrt(count(v)), 0) AS sem, count(v) AS n
FROM (SELECT condition, "both" AS pair, square FROM r) UNPIVOT (v FOR "group" IN (pair, square)) GROUP BY ALL""", "mean, sem"))
def region_groups(spark, folder):
    groups = {"pair": ["x", "y"], "square": ["y*"]}
    return rounded(region_group_means(waves(spark, folder), ["participant_id"], groups=groups, baseline_sec=0.25, sfreq=64.0, channels=["x", "y"]))


@query("waveform_average", rsql(f"""
WITH {WAVES}, p AS (SELECT condition, time AS relative_time, avg(x) AS mean_signal, stddev_samp(x) / sqrt(count(x)) AS sem_signal FROM waves GROUP BY ALL)
SELECT condition, relative_time, mean_signal, sem_signal FROM (SELECT *, row_number() OVER (PARTITION BY condition ORDER BY relative_time) - 1 AS i FROM p) WHERE i % 5 = 0""",
    "relative_time, mean_signal, sem_signal"))
def waveform(spark, folder):
    return rounded(waveform_average(waves(spark, folder), ["participant_id"], "x", 5))


def logs(spark, folder):
    e = table(spark, folder, "events")
    t = F.col("event_type")
    return e.select(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(F.col("event_id") % 11 == 0, " ").otherwise(F.col("user_id").cast("string")).alias("participant_id"),
        F.when(t != "view", t).alias("process_name"), F.lit("node_7").alias("node_id"), F.when(F.col("event_id") % 3 != 0, (t == "error").cast("int")).alias("exit_code"),
    )


LOGS = """logs AS (SELECT CASE WHEN event_id % 11 = 0 THEN ' ' ELSE CAST(user_id AS VARCHAR) END AS participant_id, CASE WHEN event_type <> 'view' THEN event_type END AS process_name,
  'node_7' AS node_id, CASE WHEN event_id % 3 <> 0 THEN CAST(event_type = 'error' AS INTEGER) END AS exit_code, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM events)"""
STATUS = f"""WITH {LOGS} SELECT coalesce(process_name, node_id) AS node, count(*) AS total, count(*) - count(*) FILTER (exit_code <> 0) AS success, count(*) FILTER (exit_code <> 0) AS fail,
  count(DISTINCT participant_id) FILTER (trim(participant_id) <> '') AS participant_count, CASE WHEN count(*) FILTER (exit_code <> 0) > 0 THEN 'fail' ELSE 'success' END AS status FROM logs GROUP BY 1"""


@query("quality_status", STATUS)
def status(spark, folder):
    return quality_status(logs(spark, folder))


@query("participant_flow", f"""WITH {LOGS} SELECT timestamp, coalesce(process_name, node_id) AS node, coalesce(exit_code, 0) AS exit_code,
  CASE WHEN coalesce(exit_code, 0) = 0 THEN 'success' ELSE 'fail' END AS status FROM logs WHERE participant_id = '8'""")
def flow(spark, folder):
    return participant_flow(logs(spark, folder), "8")
