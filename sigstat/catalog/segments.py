"""Queries over epochs, windows, segments and event alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.events import align_events, extract_event_pairs
from ..operators.segment import (
    epoch_by_events, epoch_fixed_length, explode_event_map, parent_join, segment_fixed, segment_windows_samples, sliding_epochs,
)
from .base import EPOCHS, FIRST, INTERVALS, SIGNAL, WAVES, epochs, intervals, query, rounded, rsql, signal, table, waves

K = ["participant_id"]


@query("epoch_by_events", rsql(f"WITH {EPOCHS} SELECT * FROM epochs", "time, value"))
def by_events(spark, folder):
    return rounded(epochs(spark, folder))


@query("epoch_by_events_auto_units", rsql(f"""
WITH {EPOCHS} SELECT participant_id, condition, epoch_id, time - {FIRST} + 1 AS time, seq, value FROM epochs""", "time, value", 4))
def auto_units(spark, folder):
    """Sample times in seconds, interval times in milliseconds: the guess finds the factor."""
    sig = signal(spark, folder).withColumn("time", F.col("time") - FIRST + 1)
    iv = intervals(spark, folder).withColumns({c: (F.col(c) - FIRST + 1) * 1000 for c in ("start", "stop")})
    return rounded(epoch_by_events(sig, iv, K, units="auto"), 4)


@query("explode_event_map", f"WITH {INTERVALS} SELECT participant_id, condition, ordinal, start, stop FROM intervals")
def event_map(spark, folder):
    iv = intervals(spark, folder)
    pairs = iv.groupBy("participant_id", "condition").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "start", "stop"))), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))).alias("pairs")
    )
    maps = pairs.groupBy("participant_id").agg(F.map_from_entries(F.collect_list(F.struct("condition", "pairs"))).alias("data"))
    return explode_event_map(maps, K)


@query("epoch_fixed_length", rsql(f"""
WITH {WAVES}, rec AS (SELECT epoch_id, unnest(range(8)) AS k FROM waves GROUP BY epoch_id),
ev AS (SELECT epoch_id, CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS condition, k // 2 AS ordinal, k * 0.12 AS start, k * 0.12 + 0.25 AS stop FROM rec),
ks AS (SELECT *, CAST(trunc(start * 64) AS BIGINT) AS s, CAST(trunc(0.25 * 64) AS BIGINT) AS len FROM ev),
kept AS (SELECT *, row_number() OVER (PARTITION BY epoch_id, condition ORDER BY s, ordinal) - 1 AS i FROM ks WHERE s >= 0 AND s + len < 64)
SELECT w.epoch_id AS recording, k.condition, k.condition || '_' || i AS epoch_id, (w.seq - s) / 64.0 AS time, x, y
FROM waves w JOIN kept k ON w.epoch_id = k.epoch_id AND w.seq BETWEEN s AND s + len""", "time, x, y"))
def fixed_length(spark, folder):
    w = waves(spark, folder).select(F.col("epoch_id").alias("recording"), "seq", "time", "x", "y")
    k = F.col("k")
    ev = w.select("recording").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(7)))).select(
        "recording", F.when(k % 2 == 0, "A").otherwise("B").alias("condition"), F.floor(k / 2).cast("int").alias("ordinal"),
        (k * 0.12).alias("start"), (k * 0.12 + 0.25).alias("stop"),
    )
    return rounded(epoch_fixed_length(w, ev, ["recording"], 64.0))


_SLIDE = f"""{EPOCHS}, lim AS (SELECT participant_id, condition, epoch_id, min(time) AS t0, max(time) AS t1 FROM epochs GROUP BY ALL),
win AS (SELECT *, unnest(range(CAST(ceil((t1 - 43200 + 0.001 - t0) / 21600) AS BIGINT))) AS k FROM lim WHERE t1 - t0 >= 43200),
sub AS (SELECT e.participant_id, e.condition, e.epoch_id || '_w' || k AS epoch_id, e.epoch_id AS parent_epoch_id, CAST(k AS INTEGER) AS window_idx, time, seq, value
  FROM epochs e JOIN win w ON e.participant_id = w.participant_id AND e.condition = w.condition AND e.epoch_id = w.epoch_id
   AND time >= t0 + k * 21600.0 AND time <= t0 + k * 21600.0 + 43200.0)"""


@query("sliding_epochs", rsql(f"WITH {_SLIDE} SELECT * FROM sub", "time, value"))
def sliding(spark, folder):
    return rounded(sliding_epochs(epochs(spark, folder), K, 43200.0, 21600.0))


@query("segment_fixed", rsql(f"""
WITH {WAVES} SELECT epoch_id, seq, x, CAST(s AS BIGINT) AS segment, seq - s * 8 AS seg_pos FROM waves, (SELECT unnest(range(7)) AS s)
WHERE seq >= s * 8 AND seq < s * 8 + 16""", "x"))
def fixed_segments(spark, folder):
    w = waves(spark, folder).select("epoch_id", "seq", "time", "x")
    return rounded(segment_fixed(w, ["epoch_id"], 64.0, 0.25, 0.125).drop("time"))


@query("segment_windows_samples", rsql(f"""
WITH {WAVES}, n AS (SELECT *, row_number() OVER (PARTITION BY participant_id, epoch_id ORDER BY time) - 1 AS i FROM waves)
SELECT participant_id, condition, epoch_id, CAST(k AS BIGINT) AS window_idx, i - k * 10 AS win_pos, x FROM n, (SELECT unnest(range(5)) AS k)
WHERE i >= k * 10 AND i < k * 10 + 24""", "x"))
def window_samples(spark, folder):
    w = waves(spark, folder).select("participant_id", "condition", "epoch_id", "time", "x")
    return rounded(segment_windows_samples(w, K, 64.0, 0.375, 0.15625).drop("time"))


@query("parent_join", rsql(f"""
WITH {_SLIDE}, s AS (SELECT participant_id, condition, epoch_id, parent_epoch_id, avg(value) AS hrv FROM sub GROUP BY ALL),
p AS (SELECT participant_id, condition, epoch_id AS parent_epoch_id, max(value) AS top, count(*) AS n FROM epochs GROUP BY ALL)
SELECT participant_id, condition, epoch_id, parent_epoch_id, hrv, top, n FROM s JOIN p USING (participant_id, condition, parent_epoch_id)""", "hrv, top"))
def with_parent(spark, folder):
    e = epochs(spark, folder)
    group = [*K, "condition", "epoch_id"]
    sub = sliding_epochs(e, K, 43200.0, 21600.0).groupBy(*group).agg(F.avg("value").alias("value"))
    par = e.groupBy(*group).agg(F.max("value").alias("top"), F.count(F.lit(1)).alias("n"))
    return rounded(parent_join(sub, par, K))


def _pairs(spark, folder):
    """Every fifth event of a user opens a pair that the next event closes; clocks differ by 1000 s."""
    e = signal(spark, folder)
    from ..plans.ordered import ordered_scan

    scan = ordered_scan(e, K, ["time", "seq"], index="i", lead={"stop": "time"})
    p = scan.where((F.col("i") % 5 == 0) & F.col("stop").isNotNull())
    return p.select(
        *K, (F.col("i") / 5).cast("int").alias("ordinal"), F.lit("C").alias("condition"), F.lit("1").alias("start_trigger"),
        (F.col("time") - FIRST + 1000).alias("start_onset"), F.lit("2").alias("stop_trigger"), (F.col("stop") - FIRST + 1000).alias("stop_onset"),
    )


def _triggers(spark, folder):
    from ..plans.ordered import ordered_scan

    scan = ordered_scan(signal(spark, folder), K, ["time", "seq"], index="i", lead={"nx": "time"})
    kept = scan.where((F.col("i") % 5 == 1) | ((F.col("i") % 5 == 0) & F.col("nx").isNotNull()))
    return kept.select(*K, (F.col("time") - FIRST).alias("time"), (F.col("i") % 5 + 1.0).alias("trigger"))


@query("align_events", rsql(f"""
WITH {SIGNAL}, n AS (SELECT *, row_number() OVER w - 1 AS i, lead(time) OVER w AS nx FROM signal WINDOW w AS (PARTITION BY participant_id ORDER BY time, seq))
SELECT participant_id, 'C' AS condition, CAST(i // 5 AS INTEGER) AS ordinal, time - {FIRST} AS start, nx - {FIRST} AS stop
FROM n WHERE i % 5 = 0 AND nx IS NOT NULL""", "start, stop", 4))
def aligned(spark, folder):
    return rounded(align_events(_pairs(spark, folder), _triggers(spark, folder), K), 4)


def _event_nodes(spark, folder):
    """conversations as node tables: each user turn names a condition, later siblings hold triggers."""
    c = table(spark, folder, "conversations")
    leaf = lambda o, e, v: F.struct(F.lit(o).alias("o"), F.lit(e).alias("entry"), v.alias("value"))
    n = F.length("text")
    top = c.select(F.col("conv_id").alias("doc_id"), "turn", F.explode(F.array(
        leaf(0, "Role", F.col("role")), leaf(1, "Start.Trigger", (n % 90).cast("string")), leaf(2, "Start.OnsetTime", (n * 10).cast("string")),
        leaf(3, None, F.lit(None).cast("string")),
    )).alias("c"))
    base = F.col("turn") * 10
    kids = top.select(
        "doc_id", (base + F.col("c.o")).alias("node_id"), (base + 9 - 10000).alias("parent_id"), F.lit(1).alias("level"),
        (base + F.col("c.o")).alias("seq"), F.col("c.o").alias("ordinal"), F.col("c.entry").alias("entry"), F.col("c.value").alias("value"),
        (F.col("c.o") == 3).alias("is_structural"),
    )
    inner = c.select(F.col("conv_id").alias("doc_id"), "turn", F.explode(F.array(
        leaf(0, "Stop.Ack.Onset", F.lit("1")), leaf(1, "Stop.Trigger", (n % 80).cast("string")), leaf(2, "Stop.FirstFrameTime", (n * 10 + 5).cast("string")),
    )).alias("c")).select(
        "doc_id", (base + 4 + F.col("c.o")).alias("node_id"), (base + 3).alias("parent_id"), F.lit(2).alias("level"), (base + 4 + F.col("c.o")).alias("seq"),
        F.col("c.o").alias("ordinal"), F.col("c.entry").alias("entry"), F.col("c.value").alias("value"), F.lit(False).alias("is_structural"),
    )
    return kids.unionByName(inner).withColumn("subtree_end", F.col("seq"))


@query("extract_event_pairs", """
SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS ordinal, upper(replace(replace(pat, '*', ''), '?', '?')) AS condition,
  CAST(length(text) % 90 AS VARCHAR) AS start_trigger, length(text) * 10e0 AS start_onset, CAST(length(text) % 80 AS VARCHAR) AS stop_trigger, length(text) * 10e0 + 5 AS stop_onset
FROM (SELECT *, CASE WHEN role LIKE 'us%' THEN 'us*' WHEN role LIKE 'assistan_' THEN 'assistan?' END AS pat FROM conversations) WHERE pat IS NOT NULL""")
def event_pairs(spark, folder):
    return extract_event_pairs(_event_nodes(spark, folder), ["us*", "assistan?"])
