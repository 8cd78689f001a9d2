"""Aggregations: type-driven summary, epoch means, descriptives, features per epoch, log status."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import EPOCH, infer_channels, ratio, total
from ..plans.ordered import AUTO, attach, exact_quantiles, once, ordered_scan
from ..registry import operator


@operator("auto_aggregate")
def auto_aggregate(df: DataFrame, group_by: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Summary chosen by column type.

    Boolean and whole ``is_*`` columns: non-null count and mean; float: mean; other
    whole numbers: distinct values, null counting as one; text: first row's value
    by ``order``; other types are left out; means have 4 digits; a table with
    nothing to summarise gives ``count``.
    """
    group_by = list(group_by)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    flags = [
        f.name for f in df.schema.fields
        if f.name not in group_by
        and (isinstance(f.dataType, T.BooleanType) or (isinstance(f.dataType, whole) and f.name.startswith("is_")))
    ]
    aggs = []
    for f in df.schema.fields:
        c = f.name
        if c in group_by:
            continue
        if c in flags:
            n = "total_count" if len(flags) == 1 else f"count_{c}"
            aggs += [F.count(c).alias(n), F.round(F.avg(F.col(c).cast("double")), 4).alias(f"mean_{c}")]
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            aggs.append(F.round(F.avg(c), 4).alias(f"mean_{c}"))
        elif isinstance(f.dataType, whole):
            null = F.max(F.col(c).isNull().cast("long"))
            aggs.append((F.count_distinct(c) + null).alias(f"unique_{c}"))
        elif isinstance(f.dataType, T.StringType):
            if not order:
                raise ValueError("text columns need order= to have a first value")
            aggs.append(F.min_by(F.struct(F.col(c).alias("v")), F.struct(*order))["v"].alias(c))
    return df.groupBy(*group_by).agg(*(aggs or [F.count(F.lit(1)).alias("count")]))


@operator("epoch_means")
def epoch_means(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Mean per epoch: the observation of every test and summary."""
    group = [*keys, *EPOCH]
    return df.groupBy(*group).agg(*[F.avg(c).alias(c) for c in value_cols])


def long_epoch_means(df: DataFrame, keys: Sequence[str], channels: Sequence[str] | None = None) -> DataFrame:
    """Epoch means as ``keys, condition, epoch_id, channel, value``."""
    cols = list(channels) if channels else infer_channels(df, keys)
    means = epoch_means(df, keys, cols)
    return means.unpivot([*keys, *EPOCH], cols, "channel", "value")


@operator("descriptive")
def descriptive(
    df: DataFrame, channels: Sequence[str] | None = None, keys: Sequence[str] = (), by: Sequence[str] = (), hot=AUTO
) -> DataFrame:
    """Descriptives of epoch means per channel and condition, 4 digits.

    ``keys`` tells epochs of different recordings apart; ``by`` (a subset) gives one
    result per recording instead of one over all.  Deviation and error are 0 for one
    epoch, skewness and excess kurtosis null below three, limits mean ± 1.96 error.
    """
    group = [*by, "channel", "condition"]
    obs = long_epoch_means(df, keys, channels).where(F.col("value").isNotNull())
    n, sd = F.count("value"), F.coalesce(F.stddev_samp("value"), F.lit(0.0))
    sem = sd / F.sqrt(n)
    mean = F.avg("value")
    stats = obs.groupBy(*group).agg(
        mean.alias("mean"),
        sd.alias("std"),
        sem.alias("sem"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.when(n > 2, F.skewness("value")).alias("skewness"),
        F.when(n > 2, F.kurtosis("value")).alias("kurtosis"),
        n.alias("n"),
        (mean - 1.96 * sem).alias("ci_95_low"),
        (mean + 1.96 * sem).alias("ci_95_high"),
    )
    quant = exact_quantiles(obs, group, "value", {"median": 0.5, "__q1": 0.25, "__q3": 0.75}, hot=hot)
    out = attach(stats, quant, group, "inner").withColumn("iqr", F.col("__q3") - F.col("__q1"))
    nums = ["mean", "std", "sem", "median", "iqr", "min", "max", "skewness", "kurtosis"]
    return out.select(
        *group, *[F.round(c, 4).alias(c) for c in nums], "n",
        F.round("ci_95_low", 4).alias("ci_95_low"), F.round("ci_95_high", 4).alias("ci_95_high"),
    )


@operator("amplitude")
def amplitude(
    df: DataFrame,
    keys: Sequence[str],
    signals: Sequence[str],
    method: str = "mean",
    baseline_window: tuple[float, float] | None = None,
    time: str = "time",
    strict: bool = False,
) -> DataFrame:
    """Amplitude per epoch and signal: ``mean``, ``peak`` or ``peak_baseline``.

    ``peak_baseline`` is the maximum less the mean over the closed baseline window;
    epochs without a baseline sample give null, or raise with ``strict``.
    """
    group = [*keys, *EPOCH]
    aggs = []
    for c in signals:
        if method == "mean":
            aggs.append(F.avg(c).alias(c))
        elif method == "peak":
            aggs.append(F.max(c).alias(c))
        elif method == "peak_baseline":
            lo, hi = baseline_window
            aggs.append((F.max(c) - F.avg(F.when(F.col(time).between(lo, hi), F.col(c)))).alias(c))
        else:
            raise ValueError(f"unknown method {method!r}")
    out = df.groupBy(*group).agg(*[a.cast("double") for a in aggs]).toDF(*group, *signals)
    out = out.unpivot(group, list(signals), "signal", "amplitude")
    if strict and not out.where("amplitude is null").isEmpty():
        raise ValueError("an epoch has no sample in the baseline window")
    return out


@operator("peak_latency")
def peak_latency(
    df: DataFrame,
    keys: Sequence[str],
    signals: Sequence[str],
    method: str = "max",
    window: tuple[float, float] | None = None,
    time: str = "time",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Signed amplitude and time of the extreme in a closed window; ties give the first sample."""
    group = [*keys, *EPOCH]
    rows = df.where(F.col(time).between(*window)) if window else df
    first = list(order or [time])
    aggs = []
    for c in signals:
        x = F.col(c).cast("double")
        score = {"max": x, "min": -x, "max_abs": F.abs(x)}.get(method)
        if score is None:
            raise ValueError(f"unknown method {method!r}")
        # smallest of (-score, order): one mergeable aggregate per signal
        best = F.min(F.when(x.isNotNull(), F.struct((-score).alias("s"), *first, x.alias("__x"), F.col(time).alias("__t"))))
        aggs.append(F.struct(best["__x"].alias("amplitude"), best["__t"].alias("latency")).alias(c))
    out = rows.groupBy(*group).agg(*aggs).unpivot(group, list(signals), "signal", "__p")
    return out.select(*group, "signal", "__p.amplitude", "__p.latency").where(F.col("amplitude").isNotNull())


@operator("interval_metrics")
def interval_metrics(
    df: DataFrame,
    keys: Sequence[str],
    event_col: str,
    time_col: str | None = None,
    sfreq: float | None = None,
    order: Sequence[str] | None = None,
    metrics: str = "ALL",
    hot=AUTO,
    strict: bool = False,
) -> DataFrame:
    """SDNN and RMSSD of the intervals between events, in ms.

    With ``time_col``: times in the order of ``event_col``.  Otherwise differences
    of the event samples in row order (``order``) over ``sfreq``.  Keys with fewer
    than two intervals give nothing, or raise with ``strict``.
    """
    keys = list(keys)
    along = [event_col] if time_col else list(order or [])
    if not along or (time_col is None and not sfreq):
        raise ValueError("give time_col, or sfreq with order")
    src, scale = (time_col, 1000.0) if time_col else (event_col, 1000.0 / float(sfreq))
    base = df.select(*dict.fromkeys([*keys, *along, src]))
    hot = once(base, keys, hot)
    one = ordered_scan(base, keys, along, lag={"__p": src}, hot=hot)
    one = one.withColumn("__iv", (F.col(src) - F.col("__p")) * scale)
    two = ordered_scan(one, keys, along, lag={"__q": "__iv"}, hot=hot)
    step = F.col("__iv") - F.col("__q")
    out = two.groupBy(*keys).agg(
        F.count("__iv").alias("__n"),
        F.stddev_samp("__iv").alias("SDNN"),
        F.sqrt(F.avg(step * step)).alias("RMSSD"),
    )
    if strict and not out.where("__n < 2").isEmpty():
        raise ValueError("a group has fewer than two intervals")
    names = ["SDNN", "RMSSD"] if metrics.upper() == "ALL" else [metrics.upper()]
    return out.where("__n >= 2").unpivot(keys, names, "metric", "value")


@operator("asymmetry")
def asymmetry(
    df: DataFrame,
    keys: Sequence[str],
    pairs: Sequence[tuple[str, str]],
    mode: str = "log",
    value_col: str = "power",
    channel_col: str = "channel",
    order: Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Left/right comparison per key: ``log`` is ln(right) - ln(left), ``subtraction`` left - right.

    The last row of a channel wins (by ``order``); pairs with an absent side are
    left out, and so are non-positive values in log mode unless ``strict``.
    """
    keys = list(keys)
    names = sorted({c for p in pairs for c in p})
    by = F.struct(*order) if order else F.lit(0)
    rows = df.where(F.col(channel_col).isin(names))
    wide = rows.groupBy(*keys).agg(
        *[F.max_by(value_col, F.when(F.col(channel_col) == c, by)).alias(f"__c{i}") for i, c in enumerate(names)]
    )
    at = {c: F.col(f"__c{i}") for i, c in enumerate(names)}
    entries = []
    for left, right in pairs:
        l, r = at[left], at[right]
        val = F.when((l > 0) & (r > 0), F.ln(r) - F.ln(l)) if mode == "log" else l - r
        if mode == "log" and strict:
            bad = (l <= 0) | (r <= 0)
            val = F.when(bad, F.raise_error(F.lit("non-positive value in log asymmetry")).cast("double")).otherwise(val)
        entries.append(F.struct(F.lit(f"{left}-{right}").alias("pair"), val.alias("asymmetry")))
    if mode not in ("log", "subtraction"):
        raise ValueError(f"unknown mode {mode!r}")
    return wide.select(*keys, F.inline(F.array(*entries))).where(F.col("asymmetry").isNotNull())


# fixed values: how channel names give the number of their source
SOURCE = re.compile(r"(\d+)-\d+|S(\d+)_D\d+")


def _readings(pattern: str) -> list[re.Pattern]:
    """A channel pattern as regular expressions, the preferred one first."""
    if pattern.startswith("re:"):
        return [re.compile(f".*?(?:{pattern[3:]})", re.S)]
    if set(pattern) & set("*?["):
        return [re.compile(fnmatch.translate(pattern))]
    plain = re.escape(pattern)
    return [re.compile(plain + r"\Z"), re.compile(plain)]


def resolve_groups(channels: Sequence[str], groups: Mapping[str, Sequence[str]] | None) -> dict[str, list[str]]:
    """Channel groups from patterns: a whole name, else a prefix; a shell glob; ``re:`` searched.

    Where no pattern matches, channels are grouped by the source in their name, or form ``All``.
    """
    made = {}
    for name, patterns in (groups or {}).items():
        chosen = (next(filter(None, ([c for c in channels if r.match(c)] for r in _readings(p))), []) for p in patterns)
        made[name] = list(dict.fromkeys(c for some in chosen for c in some))
    made = {name: some for name, some in made.items() if some}
    if not made:
        sources = [(m[m.lastindex], c) for c in channels if (m := SOURCE.match(c))]
        made = {f"Source{k}": [c for n, c in sources if n == k] for k, _ in sources}
    return made or {"All": list(channels)}


@operator("region_epoch_means")
def region_epoch_means(
    df: DataFrame,
    keys: Sequence[str],
    groups: Mapping[str, Sequence[str]] | None = None,
    baseline_sec: float = 2.0,
    sfreq: float | None = None,
    channels: Sequence[str] | None = None,
    time: str = "time",
    hot=AUTO,
) -> DataFrame:
    """One value per epoch and channel group, as wide columns.

    Epochs longer than the baseline: mean of the remaining samples less the mean of
    the first ``baseline_sec * sfreq`` samples per channel; shorter ones: plain mean.
    """
    cols = list(channels) if channels else infer_channels(df, keys)
    parts = resolve_groups(cols, groups)
    used = list(dict.fromkeys(c for g in parts.values() for c in g))
    group = [*keys, *EPOCH]
    n = int(baseline_sec * sfreq) if sfreq else 0
    if n > 0:
        rows = ordered_scan(df.select(*group, time, *used), group, [time], index="__i", hot=hot)
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, c in enumerate(used):
            aggs += [
                F.avg(F.when(F.col("__i") < n, F.col(c))).alias(f"__b{i}"),
                F.avg(F.when(F.col("__i") >= n, F.col(c))).alias(f"__p{i}"),
                F.avg(c).alias(f"__a{i}"),
            ]
        stat = rows.groupBy(*group).agg(*aggs)
        val = {
            c: F.when(F.col("__n") > n, F.col(f"__p{i}") - F.col(f"__b{i}")).otherwise(F.col(f"__a{i}"))
            for i, c in enumerate(used)
        }
    else:
        stat = df.groupBy(*group).agg(*[F.avg(c).alias(f"__a{i}") for i, c in enumerate(used)])
        val = {c: F.col(f"__a{i}") for i, c in enumerate(used)}
    return stat.select(*group, *[(total([val[c] for c in g]) / len(g)).alias(name) for name, g in parts.items()])


@operator("region_group_means")
def region_group_means(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), **options) -> DataFrame:
    """Mean and standard error over epochs per condition and channel group."""
    wide = region_epoch_means(df, keys, **options)
    names = [c for c in wide.columns if c not in {*keys, *EPOCH}]
    obs = wide.unpivot([*keys, *EPOCH], names, "group", "value")
    sem = F.coalesce(ratio(F.stddev_samp("value"), F.sqrt(F.count("value"))), F.lit(0.0))
    return obs.groupBy(*by, "condition", "group").agg(
        F.avg("value").alias("mean"), sem.alias("sem"), F.count("value").alias("n")
    )


@operator("waveform_average")
def waveform_average(
    epochs: DataFrame,
    keys: Sequence[str],
    signal: str,
    downsample: int = 50,
    by: Sequence[str] = (),
    time: str = "time",
    digits: int = 9,
    hot=AUTO,
) -> DataFrame:
    """Mean and standard error over epochs at each time since onset, every n-th point.

    Times are matched after rounding to ``digits`` places.
    """
    group = [*keys, *EPOCH]
    onset = epochs.groupBy(*group).agg(F.min(time).alias("__t0"))
    rel = attach(epochs.select(*group, time, signal), onset, group, "inner").withColumn(
        "relative_time", F.round(F.col(time) - F.col("__t0"), digits)
    )
    point = [*by, "condition"]
    mean = rel.groupBy(*point, "relative_time").agg(
        F.avg(signal).alias("mean_signal"),
        ratio(F.stddev_samp(signal), F.sqrt(F.count(signal))).alias("sem_signal"),
    )
    scan = ordered_scan(mean, point, ["relative_time"], index="__i", hot=hot)
    return scan.where(F.col("__i") % downsample == 0).drop("__i")


@operator("quality_status")
def quality_status(logs: DataFrame) -> DataFrame:
    """Runs, successes, failures and participants per process; any failure gives ``fail``.

    A process without a name goes by its node id; missing exit codes count as 0 and
    blank participants are not counted.
    """
    node = F.coalesce(F.nullif(F.col("process_name"), F.lit("")), F.col("node_id"))
    code = F.coalesce("exit_code", F.lit(0))
    pid = F.nullif(F.trim(F.col("participant_id").cast("string")), F.lit(""))
    # participants first, so that the distinct count needs no expansion of the rows
    part = logs.groupBy(node.alias("node"), pid.alias("__pid")).agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(code != 0).alias("__bad")
    )
    fail = F.sum("__bad")
    return part.groupBy("node").agg(
        F.sum("__n").alias("total"),
        (F.sum("__n") - fail).alias("success"),
        fail.alias("fail"),
        F.count("__pid").alias("participant_count"),
        F.when(fail > 0, "fail").otherwise("success").alias("status"),
    )


@operator("participant_flow")
def participant_flow(logs: DataFrame, participant_id) -> DataFrame:
    """The processes of one participant in time order."""
    node = F.coalesce(F.nullif(F.col("process_name"), F.lit("")), F.col("node_id"))
    code = F.coalesce("exit_code", F.lit(0))
    return (
        logs.where(F.col("participant_id") == participant_id)
        .select("timestamp", node.alias("node"), code.alias("exit_code"),
                F.when(code == 0, "success").otherwise("fail").alias("status"))
        .orderBy("timestamp")
    )
