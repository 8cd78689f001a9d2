"""Structured Streaming counterparts: results that follow arriving data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import operator


@operator("incremental_compare")
def incremental_compare(
    stream: DataFrame, group: str = "participant_id", indicator: str = "indicator", x: str = "year", value: str = "value"
) -> DataFrame:
    """Line fit per group and indicator over all rows so far (``update`` or ``complete`` mode).

    The state of a group is a handful of mergeable sums; fits appear from three points on.
    """
    y, t = F.col(value).cast("double"), F.col(x).cast("double")
    rows = stream.where(F.col(value).isNotNull())
    fit = rows.groupBy(group, indicator).agg(
        F.regr_slope(y, t).alias("slope"), F.regr_r2(y, t).alias("r_squared"), F.count(y).alias("n_observations"),
        F.avg(y).alias("value_mean"),
    )
    return fit.where("n_observations >= 3")


@operator("live_status")
def live_status(logs: DataFrame, timestamp: str = "timestamp", watermark: str | None = "1 hour", window: str | None = None) -> DataFrame:
    """Runs, failures and status per process as logs arrive (``update`` mode).

    ``window`` limits the counts, and with the watermark the state, to time windows.
    Participants are counted approximately, as an exact distinct count has no bounded state.
    """
    rows = logs.withColumn("__ts", F.to_timestamp(timestamp))
    if watermark:
        rows = rows.withWatermark("__ts", watermark)
    node = F.coalesce(F.nullif(F.col("process_name"), F.lit("")), F.col("node_id"))
    bad = F.count_if(F.coalesce("exit_code", F.lit(0)) != 0)
    pid = F.nullif(F.trim(F.col("participant_id").cast("string")), F.lit(""))
    by = [node.alias("node")] + ([F.window("__ts", window).alias("window")] if window else [])
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), (F.count(F.lit(1)) - bad).alias("success"), bad.alias("fail"),
        F.approx_count_distinct(pid).alias("participant_count"), F.max("__ts").alias("last_seen"),
        F.when(bad > 0, "fail").otherwise("success").alias("status"),
    )


@operator("live_epochs", inputs=("samples", "events"))
def live_epochs(
    samples: DataFrame, events: DataFrame, keys: Sequence[str], time: str = "ts", delay: str = "10 minutes", longest: str = "1 day"
) -> DataFrame:
    """Samples inside event intervals on two streams (append mode); both ends closed.

    Both sides carry watermarks.  Intervals are cut into pieces of at most ``longest``, half-open
    but for the last, so that old rows leave the state however long an interval is.
    """
    s = samples.withWatermark(time, delay).alias("s")
    pieces = F.explode(F.expr(f"sequence(start, greatest(start, stop), INTERVAL {longest})"))
    e = events.withColumn("__from", pieces).withWatermark("__from", delay).alias("e")
    cond = F.expr(f"s.{time} >= e.__from AND s.{time} <= e.stop AND s.{time} < e.__from + INTERVAL {longest}")
    for k in keys:
        cond = cond & (F.col(f"s.{k}") == F.col(f"e.{k}"))
    rest = [c for c in samples.columns if c not in keys]
    return s.join(e, cond, "inner").select(
        *[F.col(f"s.{k}").alias(k) for k in keys],
        F.col("e.condition").alias("condition"),
        F.concat_ws("_", F.col("e.condition"), F.col("e.ordinal").cast("string")).alias("epoch_id"),
        *[F.col(f"s.{c}").alias(c) for c in rest],
    )


@operator("live_windows")
def live_windows(samples: DataFrame, keys: Sequence[str], value: str, time: str = "ts", size: str = "30 seconds", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Mean and count per aligned time window of a stream; windows are half-open here."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return samples.withWatermark(time, delay).groupBy(*keys, w.alias("window")).agg(
        F.avg(value).alias("mean"), F.count(value).alias("n")
    )
