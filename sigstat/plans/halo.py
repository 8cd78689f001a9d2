"""Blocks with overlap: local computations on series of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLK, CORE = "__blk", "__core"


def halo_blocks(df: DataFrame, index: str, count: str, block: int, halo: int) -> DataFrame:
    """Cut a numbered series into blocks of ``block`` samples plus ``halo`` on both sides.

    Every sample is core in one block; samples near a border are repeated for the
    neighbours that need them.  A (key, block) group holds at most block + 2 halo rows.
    """
    i, last = F.col(index), F.floor((F.col(count) - 1) / block)
    lo = F.greatest(F.lit(0).cast("long"), F.floor((i - halo) / block))
    hi = F.least(last, F.floor((i + halo) / block))
    out = df.withColumn(BLK, F.explode(F.sequence(lo, hi)))
    return out.withColumn(CORE, F.floor(i / block) == F.col(BLK))
