"""Operators that put each row next to statistics of its series."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio, total
from ..plans.ordered import AUTO, attach, exact_quantiles, first_rows, once, ordered_scan
from ..registry import operator
from .select import match_channels


def _moments(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"__m{i}"), F.stddev_samp(c).alias(f"__s{i}")]
    return df.groupBy(*group).agg(*aggs)


@operator("standardise")
def standardise(df: DataFrame, group: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(x - mean) / sample deviation per group; 0.0 where the deviation is at most 1e-8 or null.

    Statistics are aggregated and joined back: no group has to fit in one task.
    """
    rows = attach(df, _moments(df, group, features), list(group), "inner")
    new = {
        c: F.when(F.col(f"__s{i}") > 1e-8, (F.col(c) - F.col(f"__m{i}")) / F.col(f"__s{i}")).otherwise(F.lit(0.0))
        for i, c in enumerate(features)
    }
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


@operator("zscore_flags")
def zscore_flags(df: DataFrame, group: Sequence[str], cols: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Adds ``{c}_z`` (0 where the group does not vary) and ``{c}_out`` = |z| > threshold."""
    rows = attach(df, _moments(df, group, cols), list(group), "inner")
    out = []
    for i, c in enumerate(cols):
        s = F.col(f"__s{i}")
        z = F.when(s > 0, (F.col(c) - F.col(f"__m{i}")) / s).when(F.col(c).isNotNull(), F.lit(0.0))
        out += [z.alias(f"{c}_z"), (F.abs(z) > float(threshold)).alias(f"{c}_out")]
    return rows.select(*df.columns, *out)


@operator("outlier_summary")
def outlier_summary(df: DataFrame, group: Sequence[str], cols: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Rows and outliers per group and column."""
    flags = zscore_flags(df, group, cols, threshold)
    wide = flags.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"{c}_out")).alias(c) for c in cols]
    )
    return wide.unpivot([*group, "rows"], list(cols), "column", "outliers")


def _baseline(df: DataFrame, keys, cols, n: int, order, hot) -> DataFrame:
    head = first_rows(df.select(*dict.fromkeys([*keys, *order, *cols])), keys, order, n, hot)
    return head.groupBy(*keys).agg(*[F.avg(c).alias(f"__base{i}") for i, c in enumerate(cols)])


@operator("baseline_correct")
def baseline_correct(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    baseline_sec: float = 5.0,
    sfreq: float = 1.0,
    order: Sequence[str] = ("time",),
    per_epoch: bool = False,
    hot=AUTO,
) -> DataFrame:
    """Subtract the mean of the first ``int(baseline_sec * sfreq)`` samples of a series.

    The series is the recording, or with ``per_epoch`` each epoch of it.
    """
    group = [*keys, "condition", "epoch_id"] if per_epoch else list(keys)
    n = int(baseline_sec * sfreq)
    if n < 1:
        raise ValueError("the baseline holds no sample")
    rows = attach(df, _baseline(df, group, columns, n, order, hot), group, "inner")
    new = {c: F.col(c) - F.col(f"__base{i}") for i, c in enumerate(columns)}
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


@operator("log_transform")
def log_transform(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    baseline_sec: float = 5.0,
    sfreq: float = 1.0,
    order: Sequence[str] = ("time",),
    hot=AUTO,
) -> DataFrame:
    """-log10(x / baseline), with the baseline as above; values of 0 or less become 1e-10."""
    n = max(1, int(baseline_sec * sfreq))
    rows = attach(df, _baseline(df, keys, columns, n, order, hot), list(keys), "inner")

    def positive(c):
        return F.when(c <= 0, F.lit(1e-10)).otherwise(c)

    new = {c: -F.log10(positive(F.col(c)) / positive(F.col(f"__base{i}"))) for i, c in enumerate(columns)}
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


@operator("tddr")
def tddr(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    order: Sequence[str] = ("time",),
    hot=AUTO,
) -> DataFrame:
    """Temporal derivative distribution repair of a series per key (long form: add the channel to the keys).

    Steps get weights 1 / (1 + (d / (4.685 s))^2)^2 with s = MAD(d) / 1.4826 and are
    summed again from the first value; series with s below 1e-10 stay as they are.
    """
    keys = list(keys)
    hot = once(df, keys, hot)
    x = F.col(value)
    steps = ordered_scan(df, keys, order, lag={"__p": value}, hot=hot).withColumn(
        "__d", F.coalesce(x - F.col("__p"), F.lit(0.0))
    ).drop("__p")
    first = df.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias("__x0"))
    mid = attach(exact_quantiles(steps, keys, "__d", {"__med": 0.5}, hot=hot), first, keys, "inner")
    steps = attach(steps, mid, keys, "inner").withColumn("__a", F.abs(F.col("__d") - F.col("__med")))
    mad = exact_quantiles(steps, keys, "__a", {"__mad": 0.5}, hot=hot)
    rows = attach(steps, mad, keys, "inner").withColumn("__sigma", F.col("__mad") / 1.4826)
    scaled = ratio(F.col("__d"), 4.685 * F.col("__sigma"))
    rows = rows.withColumn("__w", F.col("__d") / F.pow(1.0 + scaled * scaled, 2))
    rows = ordered_scan(rows, keys, order, cumsum={"__c": "__w"}, hot=hot)
    new = F.when(F.col("__sigma") < 1e-10, x).otherwise(F.col("__c") + F.col("__x0"))
    return rows.select(*[new.alias(value) if c == value else F.col(c) for c in df.columns])


@operator("reference")
def reference(df: DataFrame, channels: Sequence[str], ref: str | Sequence[str] = "average") -> DataFrame:
    """Subtract the mean of all channels, or of the named ones, from every channel of a sample."""
    base = list(channels) if ref == "average" else [ref] if isinstance(ref, str) else list(ref)
    mean = total([F.col(c) for c in base]) / len(base)
    return df.select(*[(F.col(c) - mean).alias(c) if c in channels else F.col(c) for c in df.columns])


# fixed values: naming conventions of short-distance channels and of the wavelength suffix
SHORT_CHANNEL = re.compile(r"(^s\d+\b)|short|_sd|_short|-(?:8|9|1[0-5]):", re.I)
WAVELENGTH = re.compile(r":\d+-(\d+)$")


@operator("short_channel_regression")
def short_channel_regression(
    df: DataFrame, keys: Sequence[str], channels: Sequence[str], method: str = "short_channel", short: Sequence[str] | None = None
) -> DataFrame:
    """Remove the mean short-distance signal of the same wavelength by regression through zero.

    Channels whose wavelength has no short channel use the ungrouped ones, or stay;
    tables without short channels and ``method='none'`` pass unchanged.
    """
    if method == "none":
        return df
    if method != "short_channel":
        raise ValueError(f"unknown method {method!r}")
    is_short = (lambda c: c in short) if short is not None else SHORT_CHANNEL.search
    layout = pd.DataFrame({"channel": list(channels)})
    layout["band"] = layout["channel"].str.extract(WAVELENGTH, expand=False).fillna("all")
    layout["short"] = [bool(is_short(c)) for c in channels]
    mean = {band: total([F.col(f"`{c}`") for c in own]) / len(own) for band, own in layout[layout["short"]].groupby("band")["channel"]}
    own = layout[~layout["short"]]
    own = own[own["band"].isin(mean) | ("all" in mean)]
    pick = {c: mean[band if band in mean else "all"] for c, band in zip(own["channel"], own["band"], strict=True)}
    aggs = []
    for i, (c, r) in enumerate(pick.items()):
        aggs += [F.sum(F.col(f"`{c}`") * r).alias(f"__sr{i}"), F.sum(r * r).alias(f"__rr{i}")]
    if not aggs:
        return df
    rows = attach(df, df.groupBy(*keys).agg(*aggs), list(keys), "inner")
    new = {
        c: F.col(f"`{c}`") - F.col(f"__sr{i}") / (F.col(f"__rr{i}") + 1e-12) * r for i, (c, r) in enumerate(pick.items())
    }
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])


# fixed values: extinction coefficients per wavelength (nm) of the two chromophores
EXTINCTION = {760: (1.4866, 3.8437), 850: (2.5264, 1.7986)}


def beer_lambert_matrix(ppf: float = 6.0, wavelengths: Sequence[int] = (760, 850)) -> np.ndarray:
    """Intensity pair -> concentration pair, in µM."""
    return np.linalg.pinv(np.array([EXTINCTION[w] for w in wavelengths])) / ppf * 1000.0


@operator("linear_transform")
def linear_transform(
    df: DataFrame, channels: Sequence[str], matrix, selector: str = "", ppf: float = 6.0
) -> DataFrame:
    """y = A x over the selected channels of a sample; the other columns that are no channels stay.

    ``matrix`` is square, or ``mbll`` for the 2x2 Beer-Lambert matrix on consecutive
    channel pairs (an odd number of channels raises).
    """
    chosen = match_channels(channels, selector)
    n = len(chosen)
    if isinstance(matrix, str):
        if matrix != "mbll":
            raise ValueError(f"unknown preset {matrix!r}")
        if n % 2:
            raise ValueError(f"channel pairs need an even number of channels, got {n}")
        a = np.kron(np.eye(n // 2), beer_lambert_matrix(ppf))
    else:
        a = np.asarray(matrix, dtype=float)
    if a.shape != (n, n):
        raise ValueError(f"matrix of shape {a.shape} does not fit {n} channels")
    cols = [F.col(f"`{c}`") for c in chosen]
    new = {}
    for i, c in enumerate(chosen):
        terms = [F.lit(float(a[i, j])) * cols[j] for j in range(n) if a[i, j] != 0.0]
        new[c] = total(terms) if terms else F.lit(0.0)
    keep = [c for c in df.columns if c in chosen or c not in channels]
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in keep])
