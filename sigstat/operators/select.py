"""Row and column selection, guards and cleaning."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import missing
from ..plans.ordered import AUTO, attach, exact_quantiles, once, ordered_scan
from ..registry import operator


@operator("row_filter")
def row_filter(df: DataFrame, col: str, value, drop_col: bool = False, strict: bool = False) -> DataFrame:
    """Rows whose column equals the value as text; ``strict`` raises on an empty result."""
    if col not in df.columns:
        raise ValueError(f"column {col!r} not found")
    same = F.col(col) == F.lit(value) if isinstance(df.schema[col].dataType, T.StringType) else (
        F.col(col).cast("string") == F.lit(str(value))
    )
    out = df.where(same)
    if strict and out.isEmpty():
        raise ValueError(f"no row has {col} = {value!r}")
    return out.drop(col) if drop_col else out


# one selector: a span of positions, one position or (part of) a name; then words to leave out
SELECTOR = re.compile(r"\s*(?:(?P<first>-?\d*):(?P<last>-?\d*)|(?P<at>-?\d+)|(?P<name>[^\s,]+))?(?=[\s,]|\Z)(?P<less>.*)", re.S)


@dataclass(frozen=True)
class Selector:
    """A parsed selector; ``a:b`` counts from 1 and includes b, ``-n`` counts from the end as Python slices do."""

    span: slice | None = None
    at: int | None = None
    name: str = ""
    without: tuple[str, ...] = ()

    @classmethod
    def parse(cls, text: str) -> Selector:
        part = SELECTOR.match(text)
        without = tuple(w[1:].lower() for w in part["less"].rstrip(" ,").split() if w[0] == "-")
        if part["first"] is not None:
            low, high = part["first"], part["last"]
            return cls(span=slice(int(low) - 1 if low else None, int(high) if high else None), without=without)
        if part["at"] is not None:
            at = int(part["at"])
            return cls(at=at - (at > 0), without=without)
        return cls(name=(part["name"] or "").lower(), without=without)

    def pick(self, columns: Sequence[str]) -> list[str]:
        """Positions first; a name takes equal names if there are any, else those that contain it."""
        if self.span is not None:
            found = list(columns[self.span])
        elif self.at is not None:
            found = [columns[self.at]]
        else:
            equal = {c: c.lower() == self.name for c in columns if self.name and self.name in c.lower()}
            found = [c for c, same in equal.items() if same or not any(equal.values())]
        return [c for c in found if not any(w in c.lower() for w in self.without)]


def resolve_selector(selector: str, columns: Sequence[str]) -> list[str]:
    """Columns named by one selector; ``main -X -Y`` leaves out names that contain X or Y."""
    return Selector.parse(selector).pick(list(columns))


@operator("select_columns")
def select_columns(df: DataFrame, selectors: Sequence[str] | str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns named by selectors (see ``resolve_selector``) next to the kept ones.

    Selectors are resolved on the column names alone, so the Parquet scan reads
    only what is selected.
    """
    if isinstance(selectors, str):
        selectors = [selectors]
    data = [c for c in df.columns if c not in keep]
    chosen: list[str] = []
    for s in selectors:
        chosen += [c for c in resolve_selector(s, data) if c not in chosen]
    return df.select(*keep, *chosen)


@operator("infer_sfreq")
def infer_sfreq(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "time",
    rule: str = "median",
    default: float | None = None,
    order: Sequence[str] | None = None,
    hot=AUTO,
) -> DataFrame:
    """Sampling rate per key.

    ``median``: 1 / median step (default 1.0); ``first``: 1 / first step
    (default 128.0, steps that do not increase give the default); ``distinct``:
    1 / gap of the first two distinct times (default 1.0).
    """
    keys = list(keys)
    if rule == "distinct":
        lo = df.groupBy(*keys).agg(F.min(time).alias("__a"))
        both = attach(df.select(*keys, time), lo, keys, "inner").groupBy(*keys).agg(
            F.min("__a").alias("__a"), F.min(F.when(F.col(time) > F.col("__a"), F.col(time))).alias("__b")
        )
        step, fallback = both.select(*keys, (F.col("__b") - F.col("__a")).alias("__step")), 1.0
    elif rule == "first":
        # the two smallest (time, tie-break) rows per key, by aggregates only
        seq = F.struct(time, *(c for c in (order or []) if c != time))
        lo = df.groupBy(*keys).agg(F.min(seq).alias("__a"))
        both = attach(df.withColumn("__s", seq), lo, keys, "inner").groupBy(*keys).agg(
            F.min("__a").alias("__a"), F.min(F.when(F.col("__s") > F.col("__a"), F.col("__s"))).alias("__b")
        )
        step = both.select(*keys, (F.col("__b")[time] - F.col("__a")[time]).alias("__step"))
        fallback = 128.0
    elif rule == "median":
        hot = once(df, keys, hot)
        scan = ordered_scan(df.select(*keys, time), keys, [time], lag={"__p": time}, hot=hot)
        diffs = scan.select(*keys, (F.col(time) - F.col("__p")).alias("__d"))
        med = exact_quantiles(diffs, keys, "__d", {"__step": 0.5}, hot=hot)
        step = attach(df.select(*keys).distinct(), med, keys) if keys else med
        fallback = 1.0
    else:
        raise ValueError(f"unknown rule {rule!r}")
    rate = F.when(F.col("__step") > 0, 1.0 / F.col("__step")).otherwise(
        F.lit(float(default if default is not None else fallback))
    )
    return step.select(*keys, rate.alias("sfreq"))


def resolve_channels(channels: Sequence[str], selector, mode: str) -> list[str]:
    """``regex`` (anchored at the start), ``indices`` (0-based) or ``names``."""
    channels = list(channels)
    if mode == "regex":
        return [c for c in channels if re.match(selector, c)]
    if mode == "indices":
        want = [int(i) for i in (selector.split(",") if isinstance(selector, str) else selector)]
        return [channels[i] for i in want]
    if mode == "names":
        names = {s.strip() for s in (selector.split(",") if isinstance(selector, str) else selector)}
        return [c for c in channels if c in names]
    raise ValueError(f"unknown mode {mode!r}")


@operator("select_channels")
def select_channels(
    df: DataFrame, selector, mode: str = "regex", keep: Sequence[str] = (), channels: Sequence[str] | None = None
) -> DataFrame:
    """Channels by regular expression, position or name; raises when none is left."""
    pool = list(channels) if channels is not None else [c for c in df.columns if c not in keep]
    chosen = resolve_channels(pool, selector, mode)
    if not chosen:
        raise ValueError(f"no channel matches {selector!r}")
    return df.select(*keep, *chosen)


def match_channels(channels: Sequence[str], selector) -> list[str]:
    """0-based ``start:stop:step``, comma list of positions, or a regular expression searched in the name.

    Nothing given or nothing matched means every channel.
    """
    channels = list(channels)
    if not selector or selector == "*":
        return channels
    if not isinstance(selector, str):
        names = set(selector)
        return [c for c in channels if c in names] or channels
    if re.fullmatch(r"\s*-?\d*\s*:\s*-?\d*\s*(:\s*-?\d*\s*)?", selector):
        return channels[slice(*[int(p) if p.strip() else None for p in selector.split(":")])] or channels
    if re.fullmatch(r"[\d,\s]+", selector):
        return [channels[int(p)] for p in selector.split(",") if p.strip() and int(p) < len(channels)] or channels
    return [c for c in channels if re.search(selector, c)] or channels


@operator("reject_samples")
def reject_samples(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    criterion: str = "amplitude",
    threshold: float = 1e-4,
    order: Sequence[str] = ("time",),
    hot=AUTO,
) -> DataFrame:
    """Rows where every column passes the criterion.

    ``amplitude``: |x| < threshold.  ``gradient``: |slope per sample| < threshold,
    central differences inside and one-sided at the ends.  ``flatline``: the
    column's population deviation > threshold, for the series as a whole.
    ``zscore``: |x - mean| / (population deviation + 1e-10) < threshold.
    """
    keys, columns = list(keys), list(columns)
    thr = F.lit(float(threshold))
    if criterion == "amplitude":
        return df.where(_all([F.abs(c) < thr for c in columns]))
    if criterion == "gradient":
        scan = ordered_scan(
            df, keys, order,
            lag={f"__p{i}": c for i, c in enumerate(columns)},
            lead={f"__n{i}": c for i, c in enumerate(columns)},
            hot=hot,
        )
        tests = []
        for i, c in enumerate(columns):
            prev, nxt, x = F.col(f"__p{i}"), F.col(f"__n{i}"), F.col(c)
            slope = F.coalesce((nxt - prev) / 2.0, nxt - x, x - prev)
            tests.append(F.abs(slope) < thr)
        return scan.where(_all(tests)).select(*df.columns)
    aggs = [F.stddev_pop(c).alias(f"__s{i}") for i, c in enumerate(columns)]
    if criterion == "zscore":
        aggs += [F.avg(c).alias(f"__m{i}") for i, c in enumerate(columns)]
    stats = df.groupBy(*keys).agg(*aggs)
    joined = attach(df, stats, keys, "inner")
    if criterion == "flatline":
        tests = [F.col(f"__s{i}") > thr for i in range(len(columns))]
    elif criterion == "zscore":
        tests = [
            F.abs(F.col(c) - F.col(f"__m{i}")) / (F.col(f"__s{i}") + 1e-10) < thr for i, c in enumerate(columns)
        ]
    else:
        raise ValueError(f"unknown criterion {criterion!r}")
    return joined.where(_all(tests)).select(*df.columns)


def _all(tests):
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


@operator("retention", inputs=("before", "after"))
def retention(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows kept per key, percent rejected and the level of concern (``ok``, ``high``, ``severe``)."""
    keys = list(keys)
    n0 = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_before"))
    n1 = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_after"))
    out = attach(n0, n1, keys).withColumn("rows_after", F.coalesce("rows_after", F.lit(0)))
    pct = 100.0 * (1 - F.col("rows_after") / F.col("rows_before"))
    return out.withColumn("rejected_pct", pct).withColumn(
        "level", F.when(pct > 80, "severe").when(pct > 50, "high").otherwise("ok")
    )


@operator("apply_corrections", inputs=("base", "corrections"))
def apply_corrections(base: DataFrame, corrections: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Corrected rows replace all rows of the same keys; other keys stay as they are."""
    keys = list(keys)
    named = corrections.select(*keys).distinct()
    return attach(base, named, keys, "left_anti").unionByName(corrections)


@operator("flatten_lists")
def flatten_lists(df: DataFrame) -> DataFrame:
    """Explode all array columns in lockstep; arrays of unequal length in a row raise."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not arrays:
        return df
    first = F.size(arrays[0])
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    if len(arrays) > 1:
        equal = _all([F.size(a).eqNullSafe(first) for a in arrays[1:]])
        zipped = F.when(equal, zipped).otherwise(
            F.raise_error(F.lit("array columns differ in length")).cast(_zip_type(df, arrays))
        )
    rest = [c for c in df.columns if c not in arrays]
    out = df.select(*rest, F.explode_outer(zipped).alias("__z"))
    return out.select(*[F.col("__z")[c].alias(c) if c in arrays else F.col(c) for c in df.columns])


def _zip_type(df: DataFrame, arrays: Sequence[str]) -> T.DataType:
    return T.ArrayType(T.StructType([T.StructField(a, df.schema[a].dataType.elementType) for a in arrays]))


@operator("null_report")
def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and null-or-NaN counts of the columns, in one pass."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    return df.agg(*aggs, *[F.count_if(missing(F.col(c))).alias(f"missing_{c}") for c in cols])


@operator("strict_guard")
def strict_guard(df: DataFrame, cols: Sequence[str], allow_empty: bool = False) -> DataFrame:
    """Raise on absent columns, no rows, nulls or NaN; otherwise return the table unchanged."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns {absent}; available: {df.columns}")
    got = null_report(df, cols).first()
    if got["rows"] == 0 and not allow_empty:
        raise ValueError("input has no rows")
    bad = {c: got[f"missing_{c}"] for c in cols if got[f"missing_{c}"]}
    if bad:
        raise ValueError(f"null or NaN values: {bad}")
    return df


def warn_rejection(report: DataFrame) -> None:
    """Warn about keys that lost more than half of their rows (counts only reach the driver)."""
    got = report.groupBy("level").count().collect()
    for level, n in ((r["level"], r["count"]) for r in got):
        if level != "ok":
            warnings.warn(f"{n} series with {level} rejection", stacklevel=2)
