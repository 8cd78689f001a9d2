"""Cutting recordings into epochs, sliding windows and fixed segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import EPOCH, ratio
from ..plans.ordered import AUTO, attach, ordered_scan
from ..plans.ranges import interval_join
from ..registry import operator


@operator("explode_event_map")
def explode_event_map(df: DataFrame, keys: Sequence[str], data: str = "data") -> DataFrame:
    """Map or struct of condition -> list of (start, stop) as one row per interval."""
    dtype = df.schema[data].dataType
    if isinstance(dtype, T.MapType):
        per = df.select(*keys, F.explode(data).alias("condition", "__pairs"))
    else:
        fields = dtype.fieldNames()
        entries = F.array(*[F.struct(F.lit(n).alias("condition"), F.col(data)[n].alias("__pairs")) for n in fields])
        per = df.select(*keys, F.inline(entries))
    pairs = per.select(*keys, "condition", F.posexplode("__pairs").alias("ordinal", "__p"))
    return pairs.select(
        *keys, "condition", "ordinal",
        F.col("__p.start").cast("double").alias("start"), F.col("__p.stop").cast("double").alias("stop"),
    )


def _scales(signal: DataFrame, events: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Unit guess per key: (1, 1000), (1000, 1) or (1, 1) for sample and event times."""
    s = signal.groupBy(*keys).agg(F.max(time).alias("__smax"))
    e = events.groupBy(*keys).agg(F.greatest(F.max("start"), F.max("stop")).alias("__emax"))
    both = attach(s, e, keys, "inner")
    hi, lo = F.col("__smax") * 10 < F.col("__emax"), F.col("__emax") * 10 < F.col("__smax")
    return both.select(
        *keys,
        F.when(lo, 1000.0).otherwise(1.0).alias("__se"),
        F.when(hi, 1000.0).otherwise(1.0).alias("__sd"),
    )


@operator("epoch_by_events", inputs=("signal", "events"))
def epoch_by_events(
    signal: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    time: str = "time",
    units: str | tuple[float, float] = "same",
    width: float | None = None,
) -> DataFrame:
    """Samples inside event intervals, both ends closed; overlaps duplicate samples.

    ``epoch_id`` is ``{condition}_{ordinal}``, where intervals without samples keep
    their number.  ``units`` is ``same``, ``auto`` (guessed per key from the largest
    times) or the pair of factors for sample and event times.
    """
    keys = list(keys)
    sig, ev = signal, events.select(*keys, "condition", "ordinal", "start", "stop")
    at = "__at"
    if units == "auto":
        # times are scaled where they are compared; the output keeps the sample time
        scales = _scales(signal, events, keys, time)
        sig = attach(signal, scales, keys, "inner").withColumn(at, F.col(time) * F.col("__sd")).drop("__sd", "__se")
        ev = attach(ev, scales, keys, "inner")
        ev = ev.withColumn("start", F.col("start") * F.col("__se")).withColumn("stop", F.col("stop") * F.col("__se"))
        ev = ev.drop("__sd", "__se")
    elif units == "same":
        sig = signal.withColumn(at, F.col(time))
    else:
        sd, se = units
        sig = signal.withColumn(at, F.col(time) * float(sd))
        ev = ev.withColumn("start", F.col("start") * float(se)).withColumn("stop", F.col("stop") * float(se))
    ev = ev.withColumnsRenamed({"start": "__start", "stop": "__stop"})
    out = interval_join(sig, ev, keys, at, "__start", "__stop", width)
    epoch = F.concat_ws("_", "condition", F.col("ordinal").cast("string"))
    rest = [c for c in signal.columns if c not in keys and c != time]
    return out.select(*keys, "condition", epoch.alias("epoch_id"), time, *rest)


@operator("epoch_fixed_length", inputs=("signal", "events"))
def epoch_fixed_length(
    signal: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    sfreq: float,
    seq: str = "seq",
    time: str = "time",
    rec_start: float = 0.0,
    event_sfreq: float | None = None,
    channels: Sequence[str] | None = None,
) -> DataFrame:
    """Epochs of one common length from event onsets, with relative time from 0.

    ``seq`` is the 0-based sample number.  Event units are guessed per key: sample
    numbers when the largest event time exceeds a tenth of the sample count (at the
    event rate, or with the recording start removed when they exceed the count),
    else milliseconds when it exceeds ten times the last time, else seconds.  All
    epochs take the length of the first pair of the first condition by name; starts
    outside the recording and epochs running past its end are dropped, and numbers
    run over the kept ones.
    """
    keys = list(keys)
    fs = F.lit(float(sfreq))
    size = signal.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("__n"), ((F.count(F.lit(1)) - 1) / fs).alias("__last")
    )
    lead_pair = F.min(F.struct("condition", "ordinal", "start", "stop"))
    top = events.groupBy(*keys).agg(
        F.greatest(F.max("start"), F.max("stop")).alias("__emax"), lead_pair.alias("__lead")
    )
    info = attach(size, top, keys, "inner")
    n, emax = F.col("__n"), F.col("__emax")
    rate = F.lit(float(event_sfreq)) if event_sfreq is not None else emax / (n / fs)

    def sample(t: Column) -> Column:
        in_samples = (
            F.when(F.abs(rate - fs) > 1.0, (t / rate - float(rec_start)) * fs)
            .when(emax > n, (t / fs - float(rec_start)) * fs)
            .otherwise(t)
        )
        unit = F.when(emax > n * 0.1, in_samples).when(ratio(emax, F.col("__last")) > 10, t * fs / 1000.0).otherwise(t * fs)
        return unit.cast("long")

    info = info.withColumn("__len", sample(F.col("__lead.stop")) - sample(F.col("__lead.start")))
    starts = attach(events.select(*keys, "condition", "ordinal", "start"), info, keys, "inner")
    starts = starts.withColumn("__s", sample(F.col("start")))
    kept = starts.where((F.col("__s") >= 0) & (F.col("__s") + F.col("__len") < n)).select(
        *keys, "condition", "ordinal", "__s", (F.col("__s") + F.col("__len")).alias("__e")
    )
    numbered = ordered_scan(kept, [*keys, "condition"], ["__s", "ordinal"], index="__i")
    joined = interval_join(signal, numbered, keys, seq, "__s", "__e")
    cols = list(channels) if channels else [c for c in signal.columns if c not in {*keys, seq, time, "sfreq"}]
    return joined.select(
        *keys,
        "condition",
        F.concat_ws("_", "condition", F.col("__i").cast("string")).alias("epoch_id"),
        ((F.col(seq) - F.col("__s")) / fs).alias("time"),
        *cols,
    )


@operator("sliding_epochs")
def sliding_epochs(
    epochs: DataFrame,
    keys: Sequence[str],
    window: float = 30.0,
    step: float = 10.0,
    crop_start: float = 0.0,
    crop_end: float = 0.0,
    time: str = "time",
) -> DataFrame:
    """Overlapping windows inside each epoch, both ends closed.

    Window starts are ``t0 + k*step`` below ``t1 - window + 0.001`` with the cropped
    epoch limits t0 and t1; epochs shorter than a window give none, windows without
    samples keep their number.  Each sample finds its own windows by arithmetic, so
    nothing is joined but one row of limits per epoch.
    """
    keys = list(keys)
    group = [*keys, *EPOCH]
    limits = epochs.groupBy(*group).agg(
        (F.min(time) + float(crop_start)).alias("__t0"), (F.max(time) - float(crop_end)).alias("__t1")
    )
    limits = limits.where(F.col("__t1") - F.col("__t0") >= float(window))
    t, t0, w, s = F.col(time), F.col("__t0"), F.lit(float(window)), F.lit(float(step))
    last = F.ceil((F.col("__t1") - w + 0.001 - t0) / s) - 1
    # one window more on each side, then the exact test: division may round across a border
    lo = F.greatest(F.lit(0).cast("long"), F.ceil((t - w - t0) / s) - 1)
    hi = F.least(last, F.floor((t - t0) / s) + 1)
    rows = attach(epochs, limits, group, "inner").withColumn(
        "window_idx", F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>")))
    )
    begin = t0 + F.col("window_idx") * s
    rows = rows.where((t >= begin) & (t <= begin + w))
    rest = [c for c in epochs.columns if c not in group and c != time]
    return rows.select(
        *keys,
        "condition",
        F.concat(F.col("epoch_id"), F.lit("_w"), F.col("window_idx").cast("string")).alias("epoch_id"),
        F.col("epoch_id").alias("parent_epoch_id"),
        F.col("window_idx").cast("int").alias("window_idx"),
        time,
        *rest,
    )


def full_segments(index: Column, count: Column, length: int, step: int) -> Column:
    """Numbers of the half-open full segments that hold a sample (array)."""
    last = F.floor((count - length) / step)
    lo = F.greatest(F.lit(0).cast("long"), F.ceil((index - length + 1) / step))
    hi = F.least(last, F.floor(index / step))
    ok = (count >= length) & (lo <= hi)
    return F.when(ok, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def indexed(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot=AUTO) -> DataFrame:
    """Sample number ``__i`` inside a series and its length ``__n``."""
    return ordered_scan(df, keys, order, index="__i", size="__n", hot=hot)


@operator("segment_fixed")
def segment_fixed(
    signal: DataFrame,
    keys: Sequence[str],
    sfreq: float,
    duration: float = 30.0,
    overlap: float = 15.0,
    order: Sequence[str] = ("time",),
    hot=AUTO,
) -> DataFrame:
    """Full segments of a recording, half-open; adds ``segment`` and ``seg_pos``."""
    length, step = int(round(duration * sfreq)), int(round((duration - overlap) * sfreq))
    if length < 1 or step < 1:
        raise ValueError("duration must exceed overlap and hold a sample")
    rows = indexed(signal, keys, order, hot)
    rows = rows.withColumn("segment", F.explode(full_segments(F.col("__i"), F.col("__n"), length, step)))
    return rows.withColumn("seg_pos", F.col("__i") - F.col("segment") * step).drop("__i", "__n")


@operator("segment_windows_samples")
def segment_windows_samples(
    epochs: DataFrame,
    keys: Sequence[str],
    sfreq: float,
    window_sec: float = 4.0,
    step_sec: float = 2.0,
    epoch: str = "epoch_id",
    time: str = "time",
    hot=AUTO,
) -> DataFrame:
    """Windows counted in samples inside each epoch; short epochs give none.

    The condition of a window is the one of the epoch's first row.
    """
    length, step = int(round(window_sec * sfreq)), int(round(step_sec * sfreq))
    group = [*keys, epoch]
    rows = indexed(epochs, group, [time], hot)
    first = epochs.groupBy(*group).agg(F.min_by("condition", time).alias("__cond"))
    rows = attach(rows, first, group, "inner").withColumn("condition", F.col("__cond"))
    rows = rows.withColumn("window_idx", F.explode(full_segments(F.col("__i"), F.col("__n"), length, step)))
    return rows.withColumn("win_pos", F.col("__i") - F.col("window_idx") * step).drop("__i", "__n", "__cond")


@operator("parent_join", inputs=("sub", "parent"))
def parent_join(
    sub: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    alias: str = "hrv",
    strict: bool = False,
) -> DataFrame:
    """Windows (``{epoch}_w{N}``) next to their parent trial's features.

    Inner join on keys, condition and parent epoch; parents with several rows (one
    per region) give several rows.
    """
    on = [*keys, "condition", "parent_epoch_id"]
    left = sub.withColumn("parent_epoch_id", F.regexp_replace("epoch_id", r"_w\d+$", "")).select(
        *on, "epoch_id", F.col(value).alias(alias)
    )
    right = parent.withColumnRenamed("epoch_id", "parent_epoch_id")
    features = [c for c in right.columns if c not in {*on, "time", "sfreq"}]
    out = left.join(right.select(*on, *features), on, "inner").select(
        *keys, "condition", "epoch_id", "parent_epoch_id", alias, *features
    )
    if strict and out.isEmpty():
        raise ValueError("no window matches a parent trial")
    return out
