"""Ordered passes over a series per key, in two levels where a key is hot.

``ordered_scan`` gives row index, previous and next values and running sums in
the order of a series.  For ordinary keys this is one window.  For hot keys the
window runs inside blocks (see ``skew``) of a table written once, and one row per
block carries the last value, first value, row count and sum across the borders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import skew
from ..session import materialise
from .skew import BLOCK, TIE, HotKeys, attach, find_hot_keys, large_keys, largest_group, numbered_blocks, with_blocks

AUTO, STORED, LARGE = "auto", "stored", "large"  # STORED: a scan of stored tables gives the rows; LARGE: some group is known to be large


def resolve_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str, hot) -> HotKeys | None:
    return find_hot_keys(df, keys, order) if hot in (AUTO, STORED, LARGE) else hot


def stored(hot):
    """For rows that a scan of stored tables gives: large groups need no copy of them before their passes."""
    return STORED if hot == AUTO else hot


def once(df: DataFrame, keys: Sequence[str], hot, rows: int | None = None):
    """One check for operators of several passes: None where no group is large.

    Passes over rows derived from ``df``, by the same or finer keys, then need no
    check of their own; where a group is large each pass finds its own cuts.
    """
    if hot != AUTO:
        return hot
    return None if largest_group(df, keys) <= (rows or skew.BLOCK_ROWS) else AUTO


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    index: str | None = None,
    size: str | None = None,
    lag: Mapping[str, str | Column] | None = None,
    lead: Mapping[str, str | Column] | None = None,
    cumsum: Mapping[str, str | Column] | None = None,
    ffill: Mapping[str, str | Column] | None = None,
    bfill: Mapping[str, str | Column] | None = None,
    cummin_back: Mapping[str, str | Column] | None = None,
    prior: Mapping[str, str | Column] | None = None,
    cummin: Mapping[str, str | Column] | None = None,
    hot: HotKeys | None | str = AUTO,
    rows: int | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Add ordered columns: ``index`` is 0-based, ``size`` the rows of the key; the mappings are new name -> source.

    ``ffill`` is the last non-null value up to and including the row, ``bfill``
    the next non-null value after it (taken in reverse order, so that it too is
    one running pass).  ``cummin_back`` is the minimum from the row to the end, ``cummin`` that up to the row, ``prior``
    the last non-null value before the row.  ``rows`` is the size of blocks, for rows too wide for that of ``skew``;
    ``numbered`` says that the first column of the order numbers the rows of a key or of a series that they come from,
    so that a block is a range of numbers and needs no cuts.
    """
    keys, order = list(keys), list(order)
    lag, lead, cumsum = dict(lag or {}), dict(lead or {}), dict(cumsum or {})
    ffill, bfill, cummin_back = dict(ffill or {}), dict(bfill or {}), dict(cummin_back or {})
    prior, cummin = dict(prior or {}), dict(cummin or {})
    names = df.columns
    if numbered and hot == STORED:  # one pass counts and finds them
        hot = large_keys(df, keys, rows or skew.BLOCK_ROWS)
        hot = None if hot.table.isEmpty() else hot
    elif hot in (AUTO, STORED, LARGE):
        if hot != LARGE and largest_group(df, keys) <= (rows or skew.BLOCK_ROWS):
            hot = None
        else:
            # written once: cuts, windows and carry read it and don't repeat what made it
            df = df if hot == STORED else materialise(df, "rows")
            hot = large_keys(df, keys, rows or skew.BLOCK_ROWS) if numbered else find_hot_keys(df, keys, order, rows, counted=True)
    elif hot is not None:
        numbered = False
        df = materialise(df, "rows")

    def as_col(c):
        return F.col(c) if isinstance(c, str) else c

    if hot is None:
        w = W.partitionBy(*keys).orderBy(*order)
        added = {n: F.lag(as_col(c)).over(w) for n, c in lag.items()}
        added |= {n: F.lead(as_col(c)).over(w) for n, c in lead.items()}
        run = w.rowsBetween(W.unboundedPreceding, 0)
        added |= {n: F.sum(as_col(c)).over(run) for n, c in cumsum.items()}
        added |= {n: F.last(as_col(c), True).over(run) for n, c in ffill.items()}
        added |= {n: F.last(as_col(c), True).over(w.rowsBetween(W.unboundedPreceding, -1)) for n, c in prior.items()}
        added |= {n: F.min(as_col(c)).over(run) for n, c in cummin.items()}
        back = W.partitionBy(*keys).orderBy(*[F.desc(o) for o in order]).rowsBetween(W.unboundedPreceding, -1)
        added |= {n: F.last(as_col(c), True).over(back) for n, c in bfill.items()}
        tail = W.partitionBy(*keys).orderBy(*[F.desc(o) for o in order]).rowsBetween(W.unboundedPreceding, 0)
        added |= {n: F.min(as_col(c)).over(tail) for n, c in cummin_back.items()}
        if index:
            added[index] = (F.row_number().over(w) - 1).cast("long")
        if size:
            added[size] = F.count(F.lit(1)).over(W.partitionBy(*keys))
        return df.withColumns(added)

    if numbered:
        blocked = numbered_blocks(df, hot, order[0], rows or skew.BLOCK_ROWS)
    else:
        blocked, order = with_blocks(df, hot, order), [*order, TIE]
    group = [*keys, BLOCK]
    rowed = blocked
    if numbered:
        rowed = hot.dealt(blocked, F.ceil(F.col("__runs") / (rows or skew.BLOCK_ROWS)))
    elif rows:
        rowed = hot.dealt(blocked, F.size(F.flatten("__runs")) + 1)
    w = W.partitionBy(*group).orderBy(*order)
    run = w.rowsBetween(W.unboundedPreceding, 0)
    local = {"__rn": F.row_number().over(w).cast("long")}
    local |= {f"__lag_{n}": F.lag(as_col(c)).over(w) for n, c in lag.items()}
    local |= {f"__lead_{n}": F.lead(as_col(c)).over(w) for n, c in lead.items()}
    local |= {f"__sum_{n}": F.sum(as_col(c)).over(run) for n, c in cumsum.items()}
    local |= {f"__ff_{n}": F.last(as_col(c), True).over(run) for n, c in ffill.items()}
    local |= {f"__ff_{n}": F.last(as_col(c), True).over(w.rowsBetween(W.unboundedPreceding, -1)) for n, c in prior.items()}
    local |= {f"__mf_{n}": F.min(as_col(c)).over(run) for n, c in cummin.items()}
    back = W.partitionBy(*group).orderBy(*[F.desc(o) for o in order]).rowsBetween(W.unboundedPreceding, -1)
    local |= {f"__bf_{n}": F.last(as_col(c), True).over(back) for n, c in bfill.items()}
    tail = W.partitionBy(*group).orderBy(*[F.desc(o) for o in order]).rowsBetween(W.unboundedPreceding, 0)
    local |= {f"__mb_{n}": F.min(as_col(c)).over(tail) for n, c in cummin_back.items()}

    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    aggs = [F.count(F.lit(1)).alias("__cnt")]
    aggs += [F.max_by(F.struct(as_col(c).alias("v")), by).alias(f"__last_{n}") for n, c in lag.items()]
    aggs += [F.min_by(F.struct(as_col(c).alias("v")), by).alias(f"__first_{n}") for n, c in lead.items()]
    aggs += [F.sum(as_col(c)).alias(f"__tot_{n}") for n, c in cumsum.items()]
    aggs += [F.max_by(as_col(c), F.when(as_col(c).isNotNull(), by)).alias(f"__end_{n}") for n, c in [*ffill.items(), *prior.items()]]
    aggs += [F.min_by(as_col(c), F.when(as_col(c).isNotNull(), by)).alias(f"__beg_{n}") for n, c in bfill.items()]
    aggs += [F.min(as_col(c)).alias(f"__low_{n}") for n, c in [*cummin_back.items(), *cummin.items()]]
    wk = W.partitionBy(*keys).orderBy(BLOCK)
    after = W.partitionBy(*keys).orderBy(F.desc(BLOCK)).rowsBetween(W.unboundedPreceding, -1)
    before = wk.rowsBetween(W.unboundedPreceding, -1)
    # a row for each block of the hot keys; written, so that its size is known and a small one does not move the rows
    carry = blocked.where(F.col(BLOCK) >= 0).groupBy(*group).agg(*aggs).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(group)],
        "__cnt",
        F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"),
        F.sum("__cnt").over(W.partitionBy(*keys)).alias("__all"),
        *[F.lag(f"__last_{n}").over(wk)["v"].alias(f"__cl_{n}") for n in lag],
        *[F.lead(f"__first_{n}").over(wk)["v"].alias(f"__cf_{n}") for n in lead],
        *[F.sum(f"__tot_{n}").over(before).alias(f"__cs_{n}") for n in cumsum],
        *[F.last(f"__end_{n}", True).over(before).alias(f"__cff_{n}") for n in [*ffill, *prior]],
        *[F.last(f"__beg_{n}", True).over(after).alias(f"__cbf_{n}") for n in bfill],
        *[F.min(f"__low_{n}").over(after).alias(f"__cmb_{n}") for n in cummin_back],
        *[F.min(f"__low_{n}").over(before).alias(f"__cmf_{n}") for n in cummin],
    )
    carry = materialise(carry, "carry")
    if size:
        local["__own"] = F.count(F.lit(1)).over(W.partitionBy(*group))
    main = rowed.withColumns(local)
    cond = F.lit(True)
    for i, k in enumerate(group):
        cond = cond & main[k].eqNullSafe(carry[f"__k{i}"])
    out = main.join(carry, cond, "left")
    final = {n: F.when(F.col("__rn") == 1, F.col(f"__cl_{n}")).otherwise(F.col(f"__lag_{n}")) for n in lag}
    final |= {
        n: F.when(F.col("__rn") == F.col("__cnt"), F.col(f"__cf_{n}")).otherwise(F.col(f"__lead_{n}"))
        for n in lead
    }
    # a running sum is null only until the first non-null value, as in the one-level window
    final |= {
        n: F.when(
            F.col(f"__sum_{n}").isNotNull() | F.col(f"__cs_{n}").isNotNull(),
            F.coalesce(f"__cs_{n}", F.lit(0)) + F.coalesce(f"__sum_{n}", F.lit(0)),
        )
        for n in cumsum
    }
    final |= {n: F.coalesce(f"__ff_{n}", f"__cff_{n}") for n in [*ffill, *prior]}
    final |= {n: F.least(f"__mf_{n}", f"__cmf_{n}") for n in cummin}
    final |= {n: F.coalesce(f"__bf_{n}", f"__cbf_{n}") for n in bfill}
    final |= {n: F.least(f"__mb_{n}", f"__cmb_{n}") for n in cummin_back}
    if index:
        final[index] = F.col("__rn") - 1 + F.coalesce("__off", F.lit(0))
    if size:
        final[size] = F.coalesce("__all", "__own")
    return out.withColumns(final).select(*names, *final)


GROUP_LIMIT = 1000  # Spark prunes row_number() <= n before the shuffle up to this n


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, hot: HotKeys | None | str = AUTO
) -> DataFrame:
    """The first n rows per key.  Small n is pruned in the map tasks, so hot keys do no harm."""
    if n <= GROUP_LIMIT:
        w = W.partitionBy(*keys).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
    return ordered_scan(df, keys, order, index="__rn", hot=hot).where(F.col("__rn") < n).drop("__rn")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    hot: HotKeys | None | str = AUTO,
) -> DataFrame:
    """Exact linear-interpolation quantiles per key, one output column per name.

    Small groups (checked) use the built-in exact ``percentile``, which keeps a
    group's values in one task.  Otherwise values are compressed to counts, a
    two-level running count gives positions, and only the bracketing values remain.
    """
    keys = list(keys)
    data = df.select(*keys, F.col(value).cast("double").alias("__v")).where("__v is not null")
    hot = resolve_hot(data, keys, "__v", hot)
    if hot is None:
        names = list(probs)
        got = data.groupBy(*keys).agg(F.percentile("__v", [float(probs[n]) for n in names]).alias("__q"))
        return got.select(*keys, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])

    counts = data.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    pos = ordered_scan(counts, keys, ["__v"], cumsum={"__hi": "__n"}, hot=hot)
    totals = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("__total"))
    pos = attach(pos, totals, keys, "inner")
    aggs = []
    for n, p in probs.items():
        at = F.lit(float(p)) * (F.col("__total") - 1)
        for side, k in (("lo", F.floor(at)), ("up", F.ceil(at))):
            inside = (F.col("__hi") - F.col("__n") <= k) & (k < F.col("__hi"))
            aggs.append(F.max(F.when(inside, F.col("__v"))).alias(f"__{side}_{n}"))
    got = pos.groupBy(*keys).agg(F.max("__total").alias("__total"), *aggs)
    cols = []
    for n, p in probs.items():
        at = F.lit(float(p)) * (F.col("__total") - 1)
        lo, up = F.col(f"__lo_{n}"), F.col(f"__up_{n}")
        cols.append((lo + (up - lo) * (at - F.floor(at))).alias(n))
    return got.select(*keys, *cols)


def mid_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rank: str = "rank",
    ties: str = "ties",
    hot: HotKeys | None | str = AUTO,
) -> DataFrame:
    """Tie-averaged ranks per key: one row per distinct value with its count."""
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias(ties))
    scan = ordered_scan(counts, keys, [value], cumsum={"__hi": ties}, hot=hot)
    return scan.withColumn(rank, F.col("__hi") - F.col(ties) + (F.col(ties) + 1) / 2.0).drop("__hi")
