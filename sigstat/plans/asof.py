"""As-of joins: union both sides, one ordered pass, no pair enumeration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import AUTO, ordered_scan


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_on: str,
    right_on: str,
    take: Sequence[str],
    before: str = "before",
    after: str | None = None,
    hot=AUTO,
    rows: int | None = None,
) -> DataFrame:
    """Add to each left row the last right row at or before it, and the next one after.

    Both come as structs of the ``take`` columns (null where there is none); the
    next row is only computed when ``after`` is named.  Right rows with equal
    times are taken in the order of the ``take`` columns.  ``rows`` is the size of blocks, as in ``ordered_scan``.
    """
    keys, take = list(keys), list(take)
    l = left.select(
        *keys,
        F.col(left_on).cast("double").alias("__t"),
        F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("__row"),
    )
    r = right.select(
        *keys,
        F.col(right_on).cast("double").alias("__t"),
        F.lit(0).alias("__side"),
        F.struct(*take).alias("__hit"),
    )
    both = l.unionByName(r, allowMissingColumns=True)
    scan = ordered_scan(
        both, keys, ["__t", "__side", "__hit"],
        ffill={"__before": "__hit"},
        bfill={"__after": "__hit"} if after else None,
        hot=hot,
        rows=rows,
    ).where("__side = 1")
    cols = [F.col("__row")[c].alias(c) for c in left.columns]
    cols.append(F.col("__before").alias(before))
    if after:
        cols.append(F.col("__after").alias(after))
    return scan.select(*cols)
