"""Queries over Structured Streaming operators: the tables' files arrive as a stream.

Each runs to the end of the available files and writes its result to the shared
folder, from where it is read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming.live import incremental_compare, live_epochs, live_status, live_windows
from .base import EPOCHS, intervals, query, rounded, rsql, table
from .summaries import STATUS


def _stream(spark, folder, name) -> DataFrame:
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def _run(df: DataFrame, mode: str) -> DataFrame:
    spark = df.sparkSession
    path = shared_folder(spark)
    writer = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", path + "-state")
    if mode == "append":
        q = writer.format("parquet").start(path)
    else:
        q = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).start()
    q.awaitTermination()
    return spark.read.parquet(path)


@query("incremental_compare", rsql("""
SELECT l_returnflag AS participant_id, l_linestatus AS indicator, regr_slope(l_extendedprice, year(l_shipdate)) AS slope, regr_r2(l_extendedprice, year(l_shipdate)) AS r_squared, count(*) AS n_observations,
  avg(l_extendedprice) AS value_mean FROM lineitem GROUP BY ALL""", "slope, r_squared, value_mean", 4))
def compare(spark, folder):
    s = _stream(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("participant_id"), F.col("l_linestatus").alias("indicator"), F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("value")
    )
    return rounded(_run(incremental_compare(s), "complete"), 4)


@query("live_status", f"SELECT node, total, success, fail, status FROM ({STATUS})")
def status(spark, folder):
    raw = _stream(spark, folder, "events")

    t = F.col("event_type")
    feed = raw.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("user_id").cast("string").alias("participant_id"), F.when(t != "view", t).alias("process_name"),
        F.lit("node_7").alias("node_id"), F.when(F.col("event_id") % 3 != 0, (t == "error").cast("int")).alias("exit_code"),
    )
    return _run(live_status(feed), "complete").select("node", "total", "success", "fail", "status")


@query("live_epochs", rsql(f"WITH {EPOCHS} SELECT participant_id, condition, epoch_id, value FROM epochs", "value"))
def epochs(spark, folder):
    """Samples and intervals both arrive as streams; the intervals come from a written table."""
    path = shared_folder(spark) + "-intervals"
    iv = intervals(spark, folder).select("participant_id", "condition", "ordinal", *[F.timestamp_micros((F.col(c) * 1e6).cast("long")).alias(c) for c in ("start", "stop")])
    iv.write.parquet(path)
    ev = spark.readStream.schema(iv.schema).parquet(path)
    s = _stream(spark, folder, "events").select(F.col("user_id").alias("participant_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    out = live_epochs(s, ev, ["participant_id"], delay="40 days", longest="4 days")
    return rounded(_run(out, "append").drop("ts"))


@query("live_windows", rsql("""
SELECT user_id AS participant_id, CAST(floor(epoch_us(ts) / 1e6 / 86400) AS BIGINT) AS day, avg(value) AS mean, count(*) AS n FROM events GROUP BY ALL""", "mean"))
def windows(spark, folder):
    s = _stream(spark, folder, "events").select(F.col("user_id").alias("participant_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    out = _run(live_windows(s, ["participant_id"], "value", size="1 day"), "complete")
    return rounded(out.select("participant_id", F.floor(F.unix_seconds("window.start") / 86400).alias("day"), "mean", "n"))
