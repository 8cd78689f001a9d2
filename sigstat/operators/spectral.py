"""Spectra: Welch, band power, periodogram, coherence, explained variance.

Segments are gathered as arrays of bounded length and transformed by an
Arrow-batched FFT; everything before and after is relational.  ``method='relational'``
takes the same sums with cosines and sines in SQL instead: it needs no group in one
task, and is the independent check of the FFT.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import EPOCH, field, ratio, total
from ..plans.ordered import AUTO, attach, once
from ..registry import operator
from .segment import indexed

SPECTRUM = T.ArrayType(T.DoubleType())
COMPLEX = T.StructType([T.StructField("re", SPECTRUM), T.StructField("im", SPECTRUM)])


def _by_length(arrays: pd.Series, func) -> list:
    """Apply ``func`` to stacked arrays of equal length."""
    out = [None] * len(arrays)
    sizes = arrays.map(len).to_numpy()
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        res = func(np.vstack([np.asarray(arrays.iloc[i], dtype=float) for i in at]))
        for i, r in zip(at, res):
            out[i] = r
    return out


@F.pandas_udf(SPECTRUM)
def _welch_power(x: pd.Series) -> pd.Series:
    """Detrended, Hann-weighted one-sided density of a segment at unit rate."""

    def density(m):
        n = m.shape[1]
        w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
        p = np.abs(np.fft.rfft((m - m.mean(axis=1, keepdims=True)) * w, axis=1)) ** 2 / np.sum(w * w)
        p[:, 1 : (n + 1) // 2] *= 2
        return p

    return pd.Series(_by_length(x, density))


@F.pandas_udf(SPECTRUM)
def _periodogram(x: pd.Series) -> pd.Series:
    """|FFT|^2 / n at unit rate; all bins but the first and the last doubled."""

    def density(m):
        p = np.abs(np.fft.rfft(m, axis=1)) ** 2 / m.shape[1]
        p[:, 1:-1] *= 2
        return p

    return pd.Series(_by_length(x, density))


@F.pandas_udf(COMPLEX)
def _transform(x: pd.Series) -> pd.DataFrame:
    """Hann-weighted, detrended FFT of a segment."""

    def fft(m):
        n = m.shape[1]
        w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
        return np.fft.rfft((m - m.mean(axis=1, keepdims=True)) * w, axis=1)

    got = _by_length(x, fft)
    return pd.DataFrame({"re": [g.real for g in got], "im": [g.imag for g in got]})


def gather(rows: DataFrame, group: Sequence[str], pos: str, channels: Sequence[str], position: str | None = None) -> DataFrame:
    """One row per (group, channel) with the samples as an array in order of position.

    ``position`` names a column for the array of positions.
    """
    cells = F.struct(F.col(pos).alias("p"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(channels)])
    arr = rows.groupBy(*group).agg(F.sort_array(F.collect_list(cells)).alias("__all"))
    per = [
        F.struct(F.lit(c).alias("channel"), field("__all", f"c{i}").alias("samples"))
        for i, c in enumerate(channels)
    ]
    extra = [field("__all", "p").alias(position)] if position else []
    return arr.select(*group, *extra, F.inline(F.array(*per)))


def _first_epoch(epochs: DataFrame, keys: Sequence[str], time: str, per_epoch: DataFrame) -> DataFrame:
    """Rate and length of the first epoch (by condition and id) of each recording."""
    info = per_epoch.select(
        *keys, F.struct(*EPOCH).alias("__o"), F.struct("__t0", "__t1", "__n").alias("__v")
    )
    got = info.groupBy(*keys).agg(F.min_by("__v", "__o").alias("__v"))
    return got.select(*keys, ratio(F.lit(1.0), F.col("__v.__t1") - F.col("__v.__t0")).alias("__fs"), F.col("__v.__n").alias("__n1"))


def _with_rate(rows: DataFrame, keys, group, time, sfreq, default_rate: float) -> DataFrame:
    """Attach ``__fs`` and ``__n1`` (length of the first epoch) to numbered samples."""
    per_epoch = rows.groupBy(*group).agg(
        F.min(F.when(F.col("__i") == 0, F.col(time))).alias("__t0"),
        F.min(F.when(F.col("__i") == 1, F.col(time))).alias("__t1"),
        F.count(F.lit(1)).alias("__n"),
    )
    info = _first_epoch(rows, keys, time, per_epoch)
    fs = F.lit(float(sfreq)) if sfreq is not None else F.coalesce("__fs", F.lit(default_rate))
    info = info.withColumn("__fs", fs)
    return attach(rows, info, list(keys), "inner")


def _segments(rows: DataFrame, nperseg: Column) -> DataFrame:
    """Half-overlapping full segments: adds ``__seg`` and ``__pos``."""
    rows = rows.withColumn("__np", nperseg.cast("long"))
    step = F.greatest(F.col("__np") - F.floor(F.col("__np") / 2), F.lit(1).cast("long"))
    last = F.floor((F.col("__n") - F.col("__np")) / step)
    lo = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("__i") - F.col("__np") + 1) / step))
    hi = F.least(last, F.floor(F.col("__i") / step))
    ok = (F.col("__n") >= F.col("__np")) & (F.col("__np") >= 2) & (lo <= hi)
    rows = rows.withColumn("__seg", F.explode(F.when(ok, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))))
    return rows.withColumn("__pos", F.col("__i") - F.col("__seg") * step)


def _relational_welch(segs: DataFrame, group: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """(group, channel, __seg, __k, __p): the sums of a discrete Fourier transform in SQL."""
    long = segs.unpivot([*group, "__seg", "__pos", "__np", "__fs"], list(channels), "channel", "__x")
    unit = [*group, "channel", "__seg"]
    mean = long.groupBy(*unit).agg(F.avg("__x").alias("__mean"))
    n = F.col("__np")
    w = 0.5 - 0.5 * F.cos(2 * np.pi * F.col("__pos") / n)
    rows = attach(long, mean, unit, "inner").select(
        *unit, "__pos", "__np", "__fs", ((F.col("__x") - F.col("__mean")) * w).alias("__y"), (w * w).alias("__ww"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(n / 2))).alias("__k"),
    )
    angle = 2 * np.pi * ((F.col("__k") * F.col("__pos")) % n) / n
    sums = rows.groupBy(*unit, "__k").agg(
        F.sum(F.col("__y") * F.cos(angle)).alias("__re"), F.sum(F.col("__y") * F.sin(angle)).alias("__im"),
        F.sum("__ww").alias("__w2"), F.max("__np").alias("__np"), F.max("__fs").alias("__fs"),
    )
    power = (F.col("__re") * F.col("__re") + F.col("__im") * F.col("__im")) / F.col("__w2")
    side = F.when((F.col("__k") == 0) | (F.col("__k") * 2 == n), 1.0).otherwise(2.0)
    return sums.withColumn("__p", power * side)


def _welch(epochs, keys, channels, sfreq, nperseg, time, method, default_rate, rule, hot) -> DataFrame:
    """(keys, condition, epoch_id, channel, frequency, power) for all bins."""
    group = [*keys, *EPOCH]
    rows = indexed(epochs.select(*group, time, *channels), group, [time], hot)
    rows = _with_rate(rows, keys, group, time, sfreq, default_rate)
    length = F.lit(int(nperseg)) if nperseg else rule(F.col("__fs"), F.col("__n1"))
    segs = _segments(rows, length)
    if method == "relational":
        per = _relational_welch(segs, group, channels)
    else:
        per = gather(segs, [*group, "__seg", "__np", "__fs"], "__pos", channels)
        per = per.select(*group, "channel", "__np", "__fs", F.posexplode(_welch_power("samples")).alias("__k", "__p"))
    freq = (F.col("__k") * F.col("__fs") / F.col("__np")).alias("frequency")
    return per.groupBy(*group, "channel", freq, "__fs").agg(F.avg("__p").alias("__p")).select(
        *group, "channel", "frequency", (F.col("__p") / F.col("__fs")).alias("power")
    )


@operator("welch_spectrum")
def welch_spectrum(
    epochs: DataFrame,
    keys: Sequence[str],
    channels: Sequence[str],
    max_freq: float = 45.0,
    sfreq: float | None = None,
    nperseg: int | None = None,
    time: str = "time",
    method: str = "fft",
    hot=AUTO,
) -> DataFrame:
    """Welch density per epoch and channel for 1 <= f <= max_freq.

    Rate and segment length min(int(rate), n // 2) come from a recording's first
    epoch unless given; Hann window, half overlap, constant detrend, mean.
    """

    def rule(fs, n):
        return F.least(F.floor(fs + 1e-9), F.floor(n / 2))

    out = _welch(epochs, keys, channels, sfreq, nperseg, time, method, 128.0, rule, hot)
    return out.where(F.col("frequency").between(1.0, float(max_freq)))


@operator("band_power")
def band_power(
    epochs: DataFrame,
    keys: Sequence[str],
    bands: Mapping[str, tuple[float, float]],
    channels: Sequence[str],
    regions: Mapping[str, Sequence[str]] | None = None,
    sfreq: float | None = None,
    nperseg: int | None = None,
    time: str = "time",
    method: str = "fft",
    wide: bool = False,
    hot=AUTO,
) -> DataFrame:
    """Mean density in closed bands per epoch and channel, or per region of channels.

    Segment length min(256, n) of the first epoch; a band without a bin gives 0.0;
    regions average the spectra of their available channels first.  ``wide`` gives
    one column per band.
    """
    if regions:
        channels = [c for c in channels if any(c in r for r in regions.values())]

    def rule(fs, n):
        return F.least(F.lit(256), n)

    spec = _welch(epochs, keys, channels, sfreq, nperseg, time, method, 128.0, rule, hot)
    unit = "channel"
    if regions:
        names = F.array_compact(F.array(*[F.when(F.col("channel").isin(list(r)), F.lit(n)) for n, r in regions.items()]))
        spec = spec.withColumn("region", F.explode(names)).groupBy(*keys, *EPOCH, "region", "frequency").agg(
            F.avg("power").alias("power")
        )
        unit = "region"
    f = F.col("frequency")
    means = spec.groupBy(*keys, *EPOCH, unit).agg(
        *[F.coalesce(F.avg(F.when(f.between(lo, hi), F.col("power"))), F.lit(0.0)).alias(b) for b, (lo, hi) in bands.items()]
    )
    return means if wide else means.unpivot([*keys, *EPOCH, unit], list(bands), "band", "power")


@operator("band_power_summary")
def band_power_summary(power: DataFrame, by: Sequence[str] = (), unit: str | None = None) -> DataFrame:
    """Mean and error (population deviation / sqrt n) over epochs per condition and band.

    Channels are averaged within an epoch first; with ``unit='region'`` regions stay apart.
    """
    rest = [unit] if unit else []
    keys = [c for c in power.columns if c not in {"channel", "region", "band", "power", *EPOCH}]
    epoch = power.groupBy(*keys, *EPOCH, *rest, "band").agg(F.avg("power").alias("v"))
    return epoch.groupBy(*by, "condition", *rest, "band").agg(
        F.avg("v").alias("mean"), ratio(F.stddev_pop("v"), F.sqrt(F.count("v"))).alias("sem"), F.count("v").alias("n")
    )


@operator("mean_spectrum")
def mean_spectrum(
    epochs: DataFrame,
    keys: Sequence[str],
    channels: Sequence[str],
    regions: Mapping[str, Sequence[str]] | None = None,
    max_freq: float = 45.0,
    by: Sequence[str] = (),
    sfreq: float | None = None,
    time: str = "time",
    method: str = "auto",
    hot=AUTO,
) -> DataFrame:
    """Mean and standard error over epochs of the periodogram of the mean channel.

    Channels (of a region) are averaged first, then |FFT|^2 / (n rate) with all bins
    but the first and last doubled, for 1 <= f <= max_freq; one epoch has error 0.
    Epochs are transformed as arrays; where one is too long for that (checked), or with
    ``method='relational'``, the sums are taken in SQL.
    """
    group = [*keys, *EPOCH]
    hot = once(epochs, group, hot)
    if method == "auto":
        method = "fft" if hot is None else "relational"
    parts = {n: [c for c in r if c in channels] for n, r in regions.items()} if regions else {"all": list(channels)}
    parts = {n: r for n, r in parts.items() if r}
    mixed = epochs.select(*group, time, *[(total([F.col(c) for c in r]) / len(r)).alias(f"__r{i}") for i, r in enumerate(parts.values())])
    names = [f"__r{i}" for i in range(len(parts))]
    rows = indexed(mixed, group, [time], hot)
    rows = _with_rate(rows, keys, group, time, sfreq, 256.0)
    n = F.col("__n")
    if method == "relational":
        long = rows.unpivot([*group, "__i", "__n", "__fs"], names, "channel", "__x")
        top = F.least(F.floor(n / 2), F.floor(float(max_freq) * n / F.col("__fs") + 1))
        long = long.withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), top)))
        angle = 2 * np.pi * ((F.col("__k") * F.col("__i")) % n) / n
        spec = long.groupBy(*group, "channel", "__n", "__fs", "__k").agg(
            F.sum(F.col("__x") * F.cos(angle)).alias("__re"), F.sum(F.col("__x") * F.sin(angle)).alias("__im")
        )
        inner = (F.col("__k") > 0) & (F.col("__k") < F.floor(n / 2))
        power = (F.col("__re") * F.col("__re") + F.col("__im") * F.col("__im")) / n
        spec = spec.withColumn("__p", F.when(inner, power * 2).otherwise(power))
    else:
        spec = gather(rows, [*group, "__n", "__fs"], "__i", names)
        spec = spec.select(*group, "channel", "__n", "__fs", F.posexplode(_periodogram("samples")).alias("__k", "__p"))
    spec = spec.withColumn("frequency", F.col("__k") * F.col("__fs") / n).where(F.col("frequency").between(1.0, float(max_freq)))
    label = F.array(*[F.lit(p) for p in parts])[F.substring("channel", 4, 9).cast("int")]
    v = F.col("__p") / F.col("__fs")
    sem = F.coalesce(F.stddev_samp(v) / F.sqrt(F.count(v)), F.lit(0.0))
    return spec.groupBy(*by, "condition", label.alias("region"), "frequency").agg(F.avg(v).alias("mean"), sem.alias("sem"))


@operator("coherence")
def coherence(
    signal: DataFrame,
    keys: Sequence[str],
    channels: Sequence[str],
    sfreq: float,
    duration: float = 30.0,
    overlap: float = 15.0,
    fmin: float = 0.01,
    fmax: float = 0.1,
    method: str = "coh",
    order: Sequence[str] = ("time",),
    hot=AUTO,
) -> DataFrame:
    """Spectral connectivity of channel pairs, averaged over fmin <= f <= fmax.

    Hann cross spectra over fixed segments; ``coh`` |Sxy| / sqrt(Sxx Syy), ``pli``
    |mean sign Im|, ``wpli`` |mean Im| / mean |Im|.  Pairs follow the channel order.
    """
    from .segment import segment_fixed

    segs = segment_fixed(signal.select(*dict.fromkeys([*keys, *order, *channels])), keys, sfreq, duration, overlap, order, hot)
    n = int(round(duration * sfreq))
    spec = gather(segs, [*keys, "segment"], "seg_pos", channels).select(*keys, "segment", "channel", _transform("samples").alias("__f"))
    bins = [k for k in range(n // 2 + 1) if fmin <= k * sfreq / n <= fmax]
    if not bins:
        raise ValueError("no frequency of the segment grid lies in the band")
    # all channels of a (segment, bin) are columns of one row; pairs are a fixed list
    wide = spec.groupBy(*keys, "segment").agg(
        *[F.max(F.when(F.col("channel") == c, F.col("__f"))).alias(f"__c{i}") for i, c in enumerate(channels)]
    ).withColumn("__k", F.explode(F.lit(bins)))
    re = [F.col(f"__c{i}.re")[F.col("__k")] for i in range(len(channels))]
    im = [F.col(f"__c{i}.im")[F.col("__k")] for i in range(len(channels))]
    cells = []
    for i in range(len(channels)):
        for j in range(i + 1, len(channels)):
            cells.append(F.struct(
                F.lit(f"{channels[i]}-{channels[j]}").alias("pair"),
                (re[i] * re[j] + im[i] * im[j]).alias("cr"),
                (im[i] * re[j] - re[i] * im[j]).alias("ci"),
                (re[i] * re[i] + im[i] * im[i]).alias("xx"),
                (re[j] * re[j] + im[j] * im[j]).alias("yy"),
            ))
    rows = wide.select(*keys, "__k", F.inline(F.array(*cells)))
    cr, ci = F.avg("cr"), F.avg("ci")
    value = {
        "coh": ratio(F.sqrt(cr * cr + ci * ci), F.sqrt(F.avg("xx") * F.avg("yy"))),
        "pli": F.abs(F.avg(F.signum("ci"))),
        "wpli": ratio(F.abs(ci), F.avg(F.abs("ci"))),
    }.get(method)
    if value is None:
        raise ValueError(f"unknown method {method!r}")
    per = rows.groupBy(*keys, "pair", "__k").agg(value.alias("v"))
    return per.groupBy(*keys, "pair").agg(F.avg("v").alias("value"))


@operator("channel_covariance")
def channel_covariance(df: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """Covariance of every channel pair per key, long and with both triangles.

    Each pair is one mergeable aggregate of a single pass; nothing is joined.
    """
    aggs = [
        F.covar_samp(a, b).alias(f"{i}_{j}")
        for i, a in enumerate(channels) for j, b in enumerate(channels) if i <= j
    ]
    one = df.groupBy(*keys).agg(*aggs)
    cells = [
        F.struct(F.lit(a).alias("channel_a"), F.lit(b).alias("channel_b"), F.col(f"{min(i, j)}_{max(i, j)}").alias("cov"))
        for i, a in enumerate(channels) for j, b in enumerate(channels)
    ]
    return one.select(*keys, F.inline(F.array(*cells)))


@operator("pca_variance")
def pca_variance(
    signal: DataFrame, keys: Sequence[str], channels: Sequence[str], n_components: float | int = 0.99, exclude: Sequence[str] = ()
) -> DataFrame:
    """Variance per principal component, down to the asked share (or number) of it.

    The covariance is one aggregate; only its channels x channels matrix per key is
    decomposed.
    """
    used = [c for c in channels if c not in exclude]
    p = len(used)
    aggs = [F.covar_samp(a, b) for i, a in enumerate(used) for j, b in enumerate(used) if i <= j]
    flat = signal.groupBy(*keys).agg(F.array(*aggs).alias("__cov"))

    @F.pandas_udf(SPECTRUM)
    def eigenvalues(cov: pd.Series) -> pd.Series:
        out = []
        upper = np.triu_indices(p)
        for row in cov:
            m = np.zeros((p, p))
            m[upper] = np.asarray(row, dtype=float)
            m = m + np.triu(m, 1).T
            out.append(np.clip(np.linalg.eigvalsh(m)[::-1], 0.0, None))
        return pd.Series(out)

    parts = flat.select(*keys, eigenvalues("__cov").alias("__e"))
    all_ = F.aggregate("__e", F.lit(0.0), lambda a, x: a + x)
    rows = parts.select(*keys, "__e", all_.alias("__all"), F.posexplode("__e").alias("component", "variance"))
    before = F.aggregate(F.slice("__e", F.lit(1), F.col("component")), F.lit(0.0), lambda a, x: a + x)
    kept = F.col("component") < int(n_components) if n_components >= 1 else ratio(before, F.col("__all")) < float(n_components)
    return rows.where(kept).select(*keys, "component", "variance", ratio(F.col("variance"), F.col("__all")).alias("share"))
