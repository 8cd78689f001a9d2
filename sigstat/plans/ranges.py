"""Range joins as equi joins: keys plus a time bucket, then the exact bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_width(intervals: DataFrame, start: str, stop: str) -> float:
    """Bucket width = mean interval length.

    The intervals then fill at most three buckets each on average, whatever
    their spread: sum(length / width) is the number of intervals.
    """
    got = intervals.where(F.col(stop) >= F.col(start)).agg(F.avg(F.col(stop) - F.col(start))).first()[0]
    return float(got) if got and got > 0 else 1.0


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    stop: str,
    width: float | None = None,
) -> DataFrame:
    """Pairs with equal keys (null equals null) and ``start <= at <= stop`` (both ends closed).

    The bucket number is an extra equality key, so a long recording spreads over
    many tasks and no pair outside a shared bucket is compared.
    """
    keys = list(keys)
    b = F.lit(width if width else mean_width(intervals, start, stop))
    left = points.withColumn("__b", F.floor(F.col(at) / b))
    right = (
        intervals.where(F.col(stop) >= F.col(start))
        .withColumn("__b", F.explode(F.sequence(F.floor(F.col(start) / b), F.floor(F.col(stop) / b))))
    )
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in [*keys, "__b"]})
    cond = (F.col("__b") == F.col("__r___b")) & F.col(at).between(F.col(start), F.col(stop))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(right, cond, "inner").drop("__b", *[f"__r_{c}" for c in [*keys, "__b"]])
