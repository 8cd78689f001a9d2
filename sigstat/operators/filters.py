"""Filtering and peak detection along a series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.filters import butterworth, settling, zero_phase
from ..plans.halo import BLK, CORE, halo_blocks
from ..plans.ordered import AUTO, attach, largest_group, once, ordered_scan
from ..registry import operator
from ..session import materialise
from .segment import indexed

BLOCK = 65_536


def band_design(kind: str, lo: float | None, hi: float | None, fs: float, order: int):
    """The filter, or None for cut-offs that do not fit the rate (the signal then passes)."""
    if kind == "bandpass":
        ok = 0 < (lo or 0) < (hi or 0) < fs / 2
    elif kind == "lowpass":
        ok, lo = 0 < (hi or 0) < fs / 2, None
    elif kind == "highpass":
        ok, hi = 0 < (lo or 0) < fs / 2, None
    else:
        raise ValueError(f"unknown filter type {kind!r}")
    return butterworth(order, lo, hi, fs) if ok else None


def apply_zero_phase(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], zpk, pad: int, block: int = BLOCK, hot=AUTO) -> DataFrame:
    """Zero-phase filter of a series per key, in overlapping blocks.

    The overlap is as long as the filter needs to settle, so block borders do not
    show, and a group handed to a task holds block + 2 overlaps samples at most.
    """
    keys = list(keys)
    halo = settling(zpk[1]) + pad
    block = max(block, 2 * halo)
    rows = halo_blocks(indexed(df, keys, order, hot), "__i", "__n", block, halo)
    names = [c for c in df.columns if c not in keys]
    last = F.col("__i") == F.col("__n") - 1
    cells = F.sort_array(F.collect_list(F.struct("__i", CORE, *names)))
    arrays = rows.groupBy(*keys, BLK).agg(
        cells.alias("__cells"), F.bool_or(F.col("__i") == 0).alias("__first"), F.bool_or(last).alias("__last")
    )

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(x: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        out = []
        for s, a, b in zip(x, first, last):
            v = np.asarray(s, dtype=float)
            out.append(zero_phase(v, zpk, pad, bool(a), bool(b)) if len(v) > 1 else v)
        return pd.Series(out)

    done = run(F.transform("__cells", lambda s: s[value].cast("double")), "__first", "__last")
    flat = arrays.select(*keys, F.inline(F.arrays_zip(F.col("__cells").alias("c"), done.alias("y")))).where(F.col(f"c.{CORE}"))
    return flat.select(*[F.col("y").alias(c) if c == value else F.col(c) if c in keys else F.col("c")[c].alias(c) for c in df.columns])


@operator("filter_signal")
def filter_signal(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    lo: float | None = None,
    hi: float | None = None,
    sfreq: float = 1000.0,
    kind: str = "bandpass",
    order: Sequence[str] = ("time",),
    filter_order: int = 2,
    block: int = BLOCK,
    hot=AUTO,
) -> DataFrame:
    """Butterworth filter of order 2, forward and backward; output ``keys, order, value, sfreq``.

    Cut-offs that do not satisfy 0 < lo < hi < rate / 2 leave the signal unchanged.
    Series in long form carry their channel as one of the keys.
    """
    base = df.select(*dict.fromkeys([*keys, *order, value])).withColumn(value, F.col(value).cast("double"))
    zpk = band_design(kind, lo, hi, sfreq, filter_order)
    if zpk is not None:
        sections = (len(zpk[1]) + 1) // 2
        base = apply_zero_phase(base, keys, value, order, zpk, 3 * (2 * sections + 1), block, hot)
    return base.withColumn("sfreq", F.lit(float(sfreq)))


def _maxima(df: DataFrame, keys: Sequence[str], signal: str, order: Sequence[str], hot) -> DataFrame:
    """Local maxima with their position in the series; plateaus give floor of the middle."""
    keys = list(keys)
    rows = ordered_scan(
        df.select(*dict.fromkeys([*keys, *order, signal])), keys, order, index="__i", lag={"__prev": signal}, hot=hot
    )
    new_run = F.col("__prev").isNull() | (F.col(signal) != F.col("__prev"))
    runs = ordered_scan(
        rows.where(new_run & F.col(signal).isNotNull()).withColumn("__x", F.col(signal).cast("double")),
        keys, ["__i"], lag={"__before": "__x"}, lead={"__after": "__x", "__next": "__i"}, hot=hot,
    )
    top = (F.col("__x") > F.col("__before")) & (F.col("__x") > F.col("__after"))
    mid = F.floor((F.col("__i") + F.col("__next") - 1) / 2)
    return runs.where(top).select(*keys, mid.alias("peak_sample"), F.col("__x").alias("__height"))


def _keep_by_distance(pos: np.ndarray, height: np.ndarray, distance: int, open_left: bool, open_right: bool, fixed: np.ndarray | None = None):
    """Highest first, drop peaks nearer than ``distance`` to a kept one; ``fixed`` ones are kept already.

    The second result tells which decisions do not depend on peaks beyond an open
    border of the block.
    """
    n = len(pos)
    fixed = np.zeros(n, dtype=bool) if fixed is None else fixed
    state = fixed.astype(int)  # 0 open, 1 kept, -1 dropped
    sure = np.ones(n, dtype=bool)
    if open_left:
        sure &= pos - pos[0] >= distance
    if open_right:
        sure &= pos[-1] - pos >= distance
    sure |= fixed
    for i in np.lexsort((pos, height))[::-1]:
        if fixed[i]:
            continue
        a, b = np.searchsorted(pos, pos[i] - distance, "right"), np.searchsorted(pos, pos[i] + distance, "left")
        near = [j for j in range(a, b) if j != i and state[j] != 0]
        if any(state[j] == 1 and sure[j] for j in near):
            state[i], sure[i] = -1, True
        else:
            state[i] = -1 if any(state[j] == 1 for j in near) else 1
            if any(not sure[j] for j in near):
                sure[i] = False
    return state == 1, sure


def suppress_near(peaks: DataFrame, keys: Sequence[str], distance: int, halo: int | None = None, hot=AUTO, block: int | None = None) -> DataFrame:
    """Peaks at least ``distance`` samples apart, higher ones first.

    Runs in blocks of the peak list with a fixed overlap.  Decisions that could depend on peaks beyond it stay open:
    they alone, with the peaks kept beside them, are numbered and cut anew in a further round of a written table.
    The highest open peak of a series is settled in each round, and a whole block's dependencies at best.
    """
    keys = list(keys)
    halo = max(halo or 4096, distance)
    block = max(block or BLOCK, halo)
    names = [f.name for f in peaks.schema.fields]
    flags = ("__keep", "__sure", "__fixed")
    schema = T.StructType([*peaks.schema.fields, *(T.StructField(c, T.BooleanType()) for c in flags)])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__i", kind="stable")
        keep, sure = _keep_by_distance(
            pdf["peak_sample"].to_numpy(), pdf["__height"].to_numpy(), distance,
            pdf["__i"].iloc[0] > 0, pdf["__i"].iloc[-1] < pdf["__n"].iloc[0] - 1, pdf["__fixed"].to_numpy(bool),
        )
        out = pdf.assign(__keep=keep, __sure=sure)
        return out.loc[pdf[CORE].to_numpy() & ~pdf["__fixed"].to_numpy(bool) & (keep | ~sure), [*names, *flags]]

    def settled(rows: DataFrame) -> DataFrame:
        cut = halo_blocks(indexed(rows, keys, ["peak_sample"], hot), "__i", "__n", block, halo)
        return cut.groupBy(*keys, BLK).applyInPandas(run, schema)

    left, done = peaks.withColumn("__fixed", F.lit(False)), None
    if largest_group(peaks, keys) <= block:  # a series of one block has no open border
        return settled(left).select(*names)
    while True:
        got = materialise(settled(left), "peaks")
        new = got.where("__sure").select(*names)
        done = new if done is None else done.unionByName(new)
        if got.where("not __sure").isEmpty():
            return done
        left = got.select(*names, F.col("__sure").alias("__fixed"))


@operator("detect_peaks")
def detect_peaks(
    df: DataFrame,
    keys: Sequence[str],
    signal: str,
    sfreq: float = 1000.0,
    height: float | None = None,
    distance: float | None = None,
    time: str = "time",
    order: Sequence[str] | None = None,
    hot=AUTO,
) -> DataFrame:
    """Local maxima per key: ``channel, peak_sample, time, sfreq``.

    ``height`` is an inclusive minimum, ``distance`` a gap in seconds within which
    only the higher peak stays.  ``peak_sample`` counts inside the group.
    """
    keys, order = list(keys), list(order or [time])
    hot = once(df, keys, hot)
    peaks = _maxima(df, keys, signal, order, hot)
    if height is not None:
        peaks = peaks.where(F.col("__height") >= float(height))
    if distance is not None and int(distance * sfreq) > 1:
        peaks = suppress_near(peaks, keys, int(distance * sfreq), hot=hot)
    at = ordered_scan(df.select(*dict.fromkeys([*keys, *order, time])), keys, order, index="peak_sample", hot=hot)
    return attach(peaks, at.select(*keys, "peak_sample", F.col(time).cast("double").alias("time")), [*keys, "peak_sample"], "inner").select(
        *keys, F.lit(signal).alias("channel"), "peak_sample", "time", F.lit(float(sfreq)).alias("sfreq")
    )


@operator("detect_r_peaks")
def detect_r_peaks(
    df: DataFrame,
    keys: Sequence[str],
    signal: str,
    sfreq: float = 1000.0,
    time: str = "time",
    order: Sequence[str] | None = None,
    hot=AUTO,
) -> DataFrame:
    """R peaks of an ECG by the smoothed gradient: same output as ``detect_peaks``.

    The absolute gradient is smoothed over 0.1 s and over 0.75 s; stretches where the
    first exceeds 1.5 times the second hold a beat at their highest sample; shorter
    stretches than 0.4 of the mean length are left out and of beats within 0.3 s the
    higher stays.
    """
    keys, order = list(keys), list(order or [time])
    hot = once(df, keys, hot)
    short, long = max(1, int(round(0.1 * sfreq))), max(1, int(round(0.75 * sfreq)))
    rows = indexed(df.select(*dict.fromkeys([*keys, *order, time, signal])), keys, order, hot)
    # both means look at most ``reach`` samples to each side: blocks with that overlap are exact
    reach = long // 2 + short // 2 + 2
    rows = halo_blocks(rows, "__i", "__n", max(BLOCK, 4 * reach), reach)
    w = W.partitionBy(*keys, BLK).orderBy("__i")
    x = F.col(signal).cast("double")
    prev, nxt = F.lag(x).over(w), F.lead(x).over(w)
    rows = rows.withColumn("__g", F.abs(F.coalesce((nxt - prev) / 2.0, nxt - x, x - prev)))
    around = lambda k: w.rowsBetween(-(k // 2), (k - 1) // 2)
    rows = rows.withColumn("__s", F.avg("__g").over(around(short)))
    rows = rows.withColumn("__b", F.avg("__s").over(around(long))).where(CORE).withColumn(
        "__on", F.col("__s") > 1.5 * F.col("__b")
    )
    marked = ordered_scan(rows, keys, ["__i"], lag={"__was": F.col("__on").cast("int")}, hot=hot)
    start = (F.col("__on") & (F.coalesce("__was", F.lit(0)) == 0)).cast("long")
    marked = ordered_scan(marked.withColumn("__st", start), keys, ["__i"], cumsum={"__beat": "__st"}, hot=hot)
    beats = marked.where("__on").groupBy(*keys, "__beat").agg(
        F.count(F.lit(1)).alias("__len"),
        F.min(F.struct((-x).alias("h"), F.col("__i").alias("i"), F.col(time).alias("t"))).alias("__top"),
    )
    mean = beats.groupBy(*keys).agg((0.4 * F.avg("__len")).alias("__min"))
    beats = attach(beats, mean, keys, "inner").where(F.col("__len") >= F.col("__min"))
    peaks = beats.select(
        *keys, F.col("__top.i").alias("peak_sample"), (-F.col("__top.h")).alias("__height"), F.col("__top.t").cast("double").alias("time")
    )
    peaks = suppress_near(peaks, keys, max(1, int(0.3 * sfreq)), hot=hot)
    return peaks.select(*keys, F.lit(signal).alias("channel"), "peak_sample", "time", F.lit(float(sfreq)).alias("sfreq"))
