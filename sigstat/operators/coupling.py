"""Phase locking between streams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import EPOCH, ratio
from ..functions.filters import analytic_phase, butterworth, zero_phase
from ..plans.asof import asof_join
from ..plans.ordered import AUTO, attach, once, ordered_scan
from ..registry import operator
from .spectral import gather


@dataclass(frozen=True)
class Stream:
    """An input of ``plv_streams``: channels of a continuous signal, or events where ``event`` names them."""

    table: DataFrame
    channels: Sequence[str] = ()
    sfreq: float = 1.0
    band: tuple[float, float] | None = None
    time: str = "time"
    event: str | None = None


def phase_arrays(
    epochs: DataFrame, group: Sequence[str], channels: Sequence[str], band: tuple[float, float] | None, sfreq: float, time: str = "time"
) -> DataFrame:
    """Band-pass (order 4, zero phase) and Hilbert phase: ``group, channel, __time, __phase`` with an array per channel and epoch."""
    rows = epochs.select(*group, F.col(time), *channels)
    zpk = butterworth(4, band[0], band[1], sfreq) if band else None
    # fixed value: the usual padding of a forward-backward pass, three times the nine coefficients
    pad = 27

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def phase(samples: pd.Series) -> pd.Series:
        out = []
        for s in samples:
            x = np.asarray(s, dtype=float)
            out.append(analytic_phase(zero_phase(x, zpk, pad) if zpk is not None and len(x) > 1 else x))
        return pd.Series(out)

    arrays = gather(rows, group, time, channels, position="__time")
    return arrays.select(*group, "channel", "__time", phase("samples").alias("__phase"))


@operator("analytic_phases")
def analytic_phases(
    epochs: DataFrame,
    keys: Sequence[str],
    channels: Sequence[str],
    band: tuple[float, float] | None,
    sfreq: float,
    time: str = "time",
) -> DataFrame:
    """Phases of ``phase_arrays`` sample by sample: ``channel, idx, n, time, phase, next``.

    The Hilbert transform needs an epoch as a whole; groups are single channels of
    single epochs, whose length is the epoch's duration times the rate.
    """
    group = [*keys, *EPOCH]
    arrays = phase_arrays(epochs, group, channels, band, sfreq, time)
    n = F.size("__phase").cast("long")
    after = F.concat(F.slice("__phase", F.lit(2), F.greatest(F.size("__phase") - 1, F.lit(0))), F.slice("__phase", -1, 1))
    cells = F.arrays_zip(F.col("__time").alias("t"), F.col("__phase").alias("p"), after.alias("q"))
    return arrays.select(*group, "channel", n.alias("n"), F.posexplode(cells).alias("idx", "__c")).select(
        *group, F.col("__c.t").alias(time), "channel", F.col("idx").cast("long").alias("idx"), "n",
        F.col("__c.p").alias("phase"), F.col("__c.q").alias("next"),
    )


def _on_grid(phases: DataFrame, group: Sequence[str], length: DataFrame, tag: str) -> DataFrame:
    """Phases interpolated linearly to ``__N`` samples; a stream of that length passes as it is.

    Each sample covers the grid points from its own position up to the next one's, so
    nothing but the epoch's length is joined.
    """
    rows = attach(phases, length, group, "inner")
    i, m, n = F.col("idx"), F.col("n"), F.col("__N")
    stretch = ratio(n - 1, m - 1)
    lo = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.ceil(i * stretch - 1e-9))
    hi = F.when(i >= m - 1, n - 1).otherwise(F.ceil((i + 1) * stretch - 1e-9) - 1)
    same = (m == n) | (m == 1)
    lo, hi = F.when(same, i).otherwise(lo), F.when(m == n, i).when(m == 1, n - 1).otherwise(hi)
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("__j", F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)))
    frac = F.when(same, F.lit(0.0)).otherwise(F.col("__j") / stretch - i)
    phase = F.col("phase") + frac * (F.coalesce("next", "phase") - F.col("phase"))
    return rows.select(*group, F.col("channel").alias(f"channel_{tag}"), "__j", phase.alias(f"__p{tag}"))


@operator("plv_from_phases", inputs=("a", "b"))
def plv_from_phases(a: DataFrame, b: DataFrame, keys: Sequence[str], hot=AUTO) -> DataFrame:
    """|mean exp(i difference)| per epoch and pair of channels from two phase tables.

    Streams of different length meet on the longer one's samples, where the shorter
    phase is interpolated linearly.
    """
    group = [*keys, *EPOCH]

    def prepared(df):
        if "next" in df.columns:
            return df
        return ordered_scan(df, [*group, "channel"], ["idx"], lead={"next": "phase"}, hot=hot)

    first = [df.where("idx = 0").select(*group, "n") for df in (a, b)]
    length = first[0].unionByName(first[1]).groupBy(*group).agg(F.max("n").alias("__N"))
    left, right = _on_grid(prepared(a), group, length, "a"), _on_grid(prepared(b), group, length, "b")
    both = attach(left, right, [*group, "__j"], "inner").withColumn("__d", F.col("__pa") - F.col("__pb"))
    c, s = F.avg(F.cos("__d")), F.avg(F.sin("__d"))
    return both.groupBy(*group, F.concat_ws("-", "channel_a", "channel_b").alias("pair")).agg(
        F.sqrt(c * c + s * s).alias("value")
    )


def _stretched(phases: np.ndarray, n: int) -> np.ndarray:
    """Rows of phases interpolated linearly to n samples; a single sample stays constant."""
    m = phases.shape[1]
    if m == n:
        return phases
    at = np.arange(n) * ((m - 1) / (n - 1))
    left = np.minimum(at.astype(int), max(m - 2, 0))
    part, right = at - left, np.minimum(left + 1, m - 1)
    return phases[:, left] + part * (phases[:, right] - phases[:, left])


@operator("plv_streams")
def plv_streams(streams: Sequence[Stream], keys: Sequence[str], hot=AUTO) -> DataFrame:
    """Phase-locking value per epoch for every pair of streams: ``keys, condition, epoch_id, stream_a, stream_b, pair, value``.

    Each channel of a continuous stream meets those of every later continuous stream and every event stream;
    ``stream_a`` and ``stream_b`` are positions in ``streams``.  Phases are made once per stream and move once, as one
    array per epoch and channel; of different lengths the shorter is interpolated to the longer one's samples.  Only
    epochs that both streams have give rows; null keys are keys; a null sample makes its channel's values nan.
    A task holds the phases of one epoch.
    """
    group = [*keys, *EPOCH]
    waves = [(i, s) for i, s in enumerate(streams) if s.event is None]
    if not waves or len(streams) < 2:
        raise ValueError("two streams needed, one of them continuous")
    out = []
    if len(waves) > 1:
        tables = [
            phase_arrays(s.table, group, s.channels, s.band, s.sfreq, s.time).select(*group, F.lit(i).alias("stream"), "channel", "__phase")
            for i, s in waves
        ]
        table = reduce(DataFrame.unionByName, tables)
        fields = [table.schema[k] for k in group]
        more = [("stream_a", T.IntegerType()), ("stream_b", T.IntegerType()), ("pair", T.StringType()), ("value", T.DoubleType())]
        result = T.StructType([*fields, *[T.StructField(*m) for m in more]])

        def locked(key, pdf):
            have = {i: (rows["channel"].to_numpy(), np.stack(rows["__phase"].to_list())) for i, rows in pdf.groupby("stream")}
            rows = []
            for i, (names_a, a) in have.items():
                for j, (names_b, b) in have.items():
                    if i < j:
                        n = max(a.shape[1], b.shape[1])
                        value = np.abs(np.exp(1j * _stretched(a, n)) @ np.exp(-1j * _stretched(b, n)).T) / n
                        rows += [(*key, i, j, f"{x}-{y}", v) for x, line in zip(names_a, value) for y, v in zip(names_b, line)]
            return pd.DataFrame(rows, columns=result.names)

        out.append(table.groupBy(*group).applyInPandas(locked, result))
    for i, s in waves:
        phases = None
        for j, e in enumerate(streams):
            if e.event is not None:
                phases = analytic_phases(s.table, keys, s.channels, s.band, s.sfreq, s.time) if phases is None else phases
                hits = plv_events(phases, e.table, keys, e.time, e.event, s.time, hot)
                out.append(hits.select(*group, F.lit(i).alias("stream_a"), F.lit(j).alias("stream_b"), "pair", "value"))
    return reduce(DataFrame.unionByName, out)


@operator("plv", inputs=("a", "b"))
def plv(a, b, keys, channels_a, channels_b, band_a, band_b, sfreq_a: float, sfreq_b: float, time: str = "time", hot=AUTO) -> DataFrame:
    """Phase-locking value of the channels of two continuous streams per epoch."""
    both = [Stream(a, channels_a, sfreq_a, band_a, time), Stream(b, channels_b, sfreq_b, band_b, time)]
    return plv_streams(both, keys, hot).drop("stream_a", "stream_b")


@operator("plv_events", inputs=("phases", "events"))
def plv_events(
    phases: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    event_time: str = "time",
    event_name: str = "events",
    time: str = "time",
    hot=AUTO,
) -> DataFrame:
    """Phase locking of a continuous stream with the cycle between events.

    Between the n-th event and the next the event phase is 2 pi (n + part of the
    gap); before the first and from the last event on it is 0 and counts too.
    """
    group = [*keys, *EPOCH]
    if once(events, group, hot) is None and once(phases, group, hot) is None:
        hot = None
    base = events.select(*group, F.col(event_time).cast("double").alias("__et"))
    numbered = ordered_scan(base, group, ["__et"], index="__n0", hot=hot).withColumn("__no", F.col("__n0") + 1)
    # the last of equal times carries the count of events up to that time
    numbered = numbered.groupBy(*group, "__et").agg(F.max("__no").alias("__no"))
    hit = asof_join(phases, numbered, group, time, "__et", ["__et", "__no"], "__prev", "__next", hot)
    prev, nxt = F.col("__prev.__et"), F.col("__next.__et")
    cycle = 2 * np.pi * (F.col("__prev.__no") + (F.col(time) - prev) / (nxt - prev))
    phase = F.when(prev.isNotNull() & nxt.isNotNull(), cycle).otherwise(F.lit(0.0))
    d = F.col("phase") - phase
    c, s = F.avg(F.cos(d)), F.avg(F.sin(d))
    pair = F.concat(F.col("channel"), F.lit(f"-{event_name}"))
    # an epoch without events has phase 0 throughout, as one without a pair around a sample
    return hit.groupBy(*group, pair.alias("pair")).agg(F.sqrt(c * c + s * s).alias("value"))


@operator("plv_table")
def plv_table(values: DataFrame, keys: Sequence[str], pairs: Sequence[str] | None = None) -> DataFrame:
    """One row per epoch, one column per pair; ``trial_id`` repeats the condition."""
    wide = values.groupBy(*keys, *EPOCH).pivot("pair", list(pairs) if pairs else None).agg(F.avg("value"))
    return wide.withColumn("trial_id", F.col("condition").cast("string"))


@operator("plv_summary")
def plv_summary(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and standard error (0 for one epoch) per condition and pair."""
    sem = F.coalesce(F.stddev_samp("value") / F.sqrt(F.count(F.lit(1))), F.lit(0.0))
    return values.groupBy(*by, "condition", "pair").agg(
        F.avg("value").alias("plv_mean"), sem.alias("plv_sem"), F.count(F.lit(1)).alias("n")
    )
