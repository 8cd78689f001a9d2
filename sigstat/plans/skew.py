"""Hot keys: groups too large for one task, and how to cut them into blocks.

One pass over the key columns finds the largest group.  Where none has more than
``BLOCK_ROWS`` rows nothing else happens and callers use plain windows.  Else
each larger key is cut into blocks of about ``BLOCK_ROWS`` rows, as many as its
own rows need.  The cuts are values of the whole order tuple with a hash of the
row behind it, so they take any orderable type and go through ties; they come
from a sample chosen by that hash and are written once, so that every branch of
a plan, and every retry of a lost task, cuts at the same places.  The sample
decides where blocks end, never which rows count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

BLOCK, TIE = "__block", "__tie"
BLOCK_ROWS = 2_000_000
PER_CUT = 16  # sampled rows of a block
MOST_TASKS = 20_000


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join one row of statistics per key back to the rows; a null key is a key like any other.

    No broadcast hint: the table grows with the number of keys.  Adaptive
    execution broadcasts it where its measured size allows, and splits a skewed
    key of a sort-merge join.  Without keys the one row is a scalar subquery.
    """
    if keys:
        names = {k: f"__on{i}" for i, k in enumerate(keys)}
        right = stats.withColumnsRenamed(names)
        same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()]
        return df.join(right, reduce(and_, same), how).drop(*names.values())
    row = stats.select(F.struct(*stats.columns)).scalar()
    return df.select("*", *[row[c].alias(c) for c in stats.columns])


@dataclass(frozen=True)
class HotKeys:
    """One row per hot key: its sorted cuts, in runs of about the square root of their number."""

    keys: tuple[str, ...]
    table: DataFrame

    def dealt(self, blocked: DataFrame, pieces: Column) -> DataFrame:
        """The rows by key and block, in as many tasks as there are blocks of large keys: ``pieces`` sums to their number.

        Adaptive execution goes by bytes written, and rows that compress well would come millions to a task.
        """
        n = int(self.table.agg(F.sum(pieces)).first()[0] or 0)
        n = min(max(n, int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))), MOST_TASKS)
        return blocked.repartition(n, *[F.col(f"`{k}`") for k in self.keys], F.col(BLOCK))

    @property
    def rows(self) -> list[tuple]:
        return [tuple(r) for r in self.table.select(*self.keys).collect()]


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group: a scan of the key columns only."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0


def tasks(df: DataFrame, rows: int) -> int:
    """Tasks for a number of rows, a block to a task."""
    return min(max(-(-rows // BLOCK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), MOST_TASKS)


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, to go through ties."""

    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        return plain(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))

    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if plain(f.dataType)], F.lit(0))


def find_hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str, rows: int | None = None, counted: bool = False) -> HotKeys | None:
    """The keys that need cutting, or None where no group has more than ``rows`` rows.

    Where the caller has ``counted`` a large group, one more pass takes the sample of all keys; the number of sampled
    rows tells which are large.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    rows = rows or BLOCK_ROWS
    if not counted and largest_group(df, keys) <= rows:
        return None
    step = max(1, rows // PER_CUT)
    tied = df.select(*dict.fromkeys([*keys, *order]), row_hash(df).alias(TIE))
    few = tied.where(F.pmod(F.xxhash64(TIE), F.lit(step)) == 0)
    found = few.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, TIE))).alias("__all"))
    found = found.where(F.size("__all") > rows // step)
    every = F.transform(F.sequence(F.lit(PER_CUT), F.size("__all"), F.lit(PER_CUT)), lambda i: F.element_at("__all", i))
    cuts = found.select(*keys, every.alias("__cuts"))
    wide = F.greatest(F.lit(1), F.sqrt(F.size("__cuts").cast("double")).cast("int"))
    runs = F.transform(F.sequence(F.lit(1), F.size("__cuts"), wide), lambda i: F.slice("__cuts", i, wide))
    return HotKeys(tuple(keys), materialise(cuts.select(*keys, runs.alias("__runs")), "cuts"))


def large_keys(df: DataFrame, keys: Sequence[str], rows: int) -> HotKeys:
    """The keys of more than ``rows`` rows, for series whose own numbers say where blocks end."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__runs")).where(F.col("__runs") > rows)
    return HotKeys(tuple(keys), materialise(found, "large"))


def numbered_blocks(df: DataFrame, hot: HotKeys, at: str, rows: int) -> DataFrame:
    """Add the block number, as ``with_blocks`` does, from numbers that run along each key: no cuts, nothing to compare."""
    number = F.greatest(F.coalesce(F.floor(F.col(at) / rows), F.lit(0)), F.lit(0)).cast("int")
    return attach(df, hot.table, list(hot.keys)).withColumn(BLOCK, F.when(F.col("__runs").isNull(), -1).otherwise(number)).drop("__runs")


def with_blocks(df: DataFrame, hot: HotKeys, order: Sequence[str]) -> DataFrame:
    """Add the row hash and the block number: -1 for ordinary keys, the cut interval for hot ones."""
    place = F.struct(*order, TIE)
    tied = attach(df.withColumn(TIE, row_hash(df)), hot.table, list(hot.keys))
    # two-level search: about twice the square root of the cuts in comparisons
    run = F.size(F.filter("__runs", lambda r: r[0] <= place))
    within = F.size(F.filter(F.element_at("__runs", F.greatest(run, F.lit(1))), lambda b: b <= place))
    number = F.when(F.col("__runs").isNull(), -1).when(run == 0, 0).otherwise((run - 1) * F.size(F.col("__runs")[0]) + within)
    return tied.withColumn(BLOCK, number).drop("__runs")
