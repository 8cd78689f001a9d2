"""Event pairs from node tables, and their alignment with a recorder's triggers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import glob_to_regex
from ..plans.asof import asof_join
from ..plans.ordered import AUTO, attach, once, ordered_scan
from ..registry import operator
from ..session import materialise


def _onset_leaf():
    low = F.lower("entry")
    hit = F.contains(low, F.lit("onset")) | F.contains(low, F.lit("firstframe"))
    return hit & ~F.contains(low, F.lit("ack")) & ~F.contains(low, F.lit("delay")) & F.col("value").isNotNull()


@operator("extract_event_pairs")
def extract_event_pairs(nodes: DataFrame, patterns: Sequence[str], hot=AUTO) -> DataFrame:
    """Start and stop triggers with onsets: ``doc_id, ordinal, condition, start_trigger, start_onset, stop_trigger, stop_onset``.

    A node whose value matches a glob starts a pair: its start trigger is the next
    sibling leaf with a trigger, its start onset the siblings' first onset, its stop the
    next structural sibling that holds a trigger.  The condition is the first matching
    pattern without ``*``, in capitals.
    """
    hot = once(nodes, ["doc_id", "parent_id"], hot)
    trig = F.contains(F.lower("entry"), F.lit("trigger")) & F.col("value").rlike(r"^\d+$")
    leaf = ~F.col("is_structural")
    sib = ["doc_id", "parent_id"]
    # first trigger and onset among the children of each structural node
    inner = nodes.where("parent_id is not null").groupBy(*sib).agg(
        F.min_by("value", F.when(trig, F.col("ordinal"))).alias("stop_trigger"),
        F.min_by(F.col("value"), F.when(_onset_leaf(), F.col("ordinal"))).try_cast("double").alias("stop_onset"),
        F.min_by(F.col("value"), F.when(_onset_leaf() & leaf, F.col("ordinal"))).try_cast("double").alias("start_onset"),
    )
    own = inner.select("doc_id", F.col("parent_id").alias("node_id"), "stop_trigger", "stop_onset")
    rows = nodes.where("parent_id is not null").join(own, ["doc_id", "node_id"], "left")
    stop = F.when(F.col("is_structural") & F.col("stop_trigger").isNotNull(), F.struct("stop_trigger", "stop_onset"))
    rows = ordered_scan(rows, sib, ["ordinal"], bfill={"__stop": stop}, hot=hot)
    start = F.when(leaf & trig, F.struct(F.col("value").alias("trigger"), F.col("__stop").alias("stop")))
    rows = ordered_scan(rows, sib, ["ordinal"], bfill={"__start": start}, hot=hot)
    cond = F.lit(None).cast("string")
    for p in reversed(patterns):
        cond = F.when(F.coalesce("value", F.lit("")).rlike(glob_to_regex(p)), F.lit(p.replace("*", "").upper())).otherwise(cond)
    hits = rows.withColumn("condition", cond).where(F.col("condition").isNotNull() & F.col("__start").isNotNull())
    hits = hits.join(inner.select(*sib, "start_onset"), sib)
    out = hits.select(
        "doc_id", "seq", "condition", F.col("__start.trigger").alias("start_trigger"), "start_onset",
        F.col("__start.stop.stop_trigger").alias("stop_trigger"), F.col("__start.stop.stop_onset").alias("stop_onset"),
    ).where("start_onset is not null and stop_trigger is not null and stop_onset is not null")
    return ordered_scan(out, ["doc_id"], ["seq"], index="ordinal", hot=hot).drop("seq")


def _take_nearest(want: np.ndarray, times: np.ndarray) -> np.ndarray:
    """In order, the nearest time not used yet (the earlier on ties); NaN when none is left."""
    left = list(range(-1, len(times) - 1))
    right = list(range(1, len(times) + 1))
    used = np.zeros(len(times) + 1, dtype=bool)

    def free_left(i):
        while i >= 0 and used[i]:
            left[i] = left[left[i]] if left[i] >= 0 and used[left[i]] else left[i]
            i = left[i]
        return i

    def free_right(i):
        while i < len(times) and used[i]:
            right[i] = right[right[i]] if right[i] < len(times) and used[right[i]] else right[i]
            i = right[i]
        return i

    out = np.full(len(want), np.nan)
    for k, w in enumerate(want):
        at = int(np.searchsorted(times, w, "right"))
        lo, hi = free_left(at - 1), free_right(at)
        pick = None
        if lo >= 0 and (hi >= len(times) or w - times[lo] <= times[hi] - w):
            pick = lo
        elif hi < len(times):
            pick = hi
        if pick is not None:
            # the first of equal times, as a scan in order would take
            while pick > 0 and times[pick - 1] == times[pick] and not used[pick - 1]:
                pick -= 1
            out[k], used[pick] = times[pick], True
    return out


@operator("align_events", inputs=("pairs", "triggers"))
def align_events(pairs: DataFrame, triggers: DataFrame, keys: Sequence[str], strict: bool = False, hot=AUTO) -> DataFrame:
    """Event intervals on the recorder's clock: ``keys, condition, ordinal, start, stop``.

    ``pairs`` has ``ordinal, condition, start_trigger, start_onset, stop_trigger,
    stop_onset`` per key, ``triggers`` has ``time, trigger``.  The offset between the clocks is the onset less the
    first recorded time of the first pair whose start trigger was recorded; recorder
    times are taken as seconds against milliseconds when a hundred times smaller.  Each
    onset takes the nearest unused time of its trigger, in order; onsets without one
    are placed by the local offset at the nearest trigger of any kind.

    Where no two onsets want the same time the as-of join is the answer.  Only triggers
    with a conflict are resolved in sequence, one (key, trigger) at a time.
    """
    keys = list(keys)
    if once(pairs, keys, hot) is None and once(triggers, keys, hot) is None:
        hot = None
    trig = F.col("trigger").cast("double").cast("long").cast("string")
    need = pairs.select(*keys, "ordinal", "condition", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("start_trigger").alias("trigger"), F.col("start_onset").alias("onset")),
        F.struct(F.lit(1).alias("side"), F.col("stop_trigger").alias("trigger"), F.col("stop_onset").alias("onset")),
    )).alias("__r")).select(*keys, "ordinal", "condition", "__r.*")
    lead = pairs.groupBy(*keys).agg(F.min_by("start_onset", "ordinal").alias("__ref"))
    wanted = need.select(*keys, "trigger").distinct()
    rec = triggers.select(*keys, F.col("time").cast("double").alias("time"), trig.alias("trigger"))
    rec = attach(rec, wanted, [*keys, "trigger"], "left_semi")
    per = rec.groupBy(*keys, "trigger").agg(F.max("time").alias("__max"), F.min("time").alias("__min"))
    scale = attach(per, lead, keys, "inner").select(
        *keys, "trigger", "__min", F.when(F.col("__ref") / F.greatest("__max", F.lit(1.0)) > 100, 1000.0).otherwise(1.0).alias("__scale")
    )
    rec = attach(rec, scale.drop("__min"), [*keys, "trigger"], "inner").select(*keys, "trigger", (F.col("time") * F.col("__scale")).alias("time"))
    starts = attach(need.where("side = 0"), scale, [*keys, "trigger"], "inner")
    offset = starts.groupBy(*keys).agg(F.min_by(F.col("onset") - F.col("__min") * F.col("__scale"), "ordinal").alias("__off"))
    need = attach(need, offset, keys).withColumn("__want", F.col("onset") - F.coalesce("__off", F.lit(0.0)))

    unit = [*keys, "trigger"]
    near = asof_join(need, rec, unit, "__want", "time", ["time"], "__lo", "__hi", hot)
    lo, hi, w = F.col("__lo.time"), F.col("__hi.time"), F.col("__want")
    best = F.when(lo.isNotNull() & (hi.isNull() | (w - lo <= hi - w)), lo).otherwise(hi)
    near = materialise(near.withColumn("__t", best).drop("__lo", "__hi"), "nearest")
    clash = near.where("__t is not null").groupBy(*unit, "__t").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*unit).distinct()
    found = near if clash.isEmpty() else _settle(near, rec, clash, unit)
    out = _place(found, need, rec, keys, hot)
    times = out.groupBy(*keys, "condition", "ordinal").agg(
        F.max(F.when(F.col("side") == 0, F.col("__t"))).alias("start"), F.max(F.when(F.col("side") == 1, F.col("__t"))).alias("stop")
    )
    if strict:
        if not times.where("start is null or stop is null or start = 0 or stop = 0").isEmpty():
            raise ValueError("an event could not be aligned")
        if not out.groupBy(*keys, "__t").count().where("count > 1").isEmpty():
            raise ValueError("two events share a recorder time")
    return times


def _settle(near: DataFrame, rec: DataFrame, clash: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Resolve the triggers whose onsets want the same time, in the order of the events."""
    clear = attach(near, clash, unit, "left_anti")
    tangled = attach(near, clash, unit, "left_semi").drop("__t")
    pool = attach(rec, clash, unit, "left_semi")
    names = [f for f in tangled.schema.fields]

    def settle(want: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        want = want.sort_values(["ordinal", "side"], kind="stable")
        return want.assign(__t=_take_nearest(want["__want"].to_numpy(), np.sort(have["time"].to_numpy())))

    solved = tangled.groupBy(*unit).cogroup(pool.groupBy(*unit)).applyInPandas(
        settle, T.StructType([*names, T.StructField("__t", T.DoubleType())])
    )
    solved = solved.withColumn("__t", F.nanvl("__t", F.lit(None).cast("double")))
    return clear.select(*solved.columns).unionByName(solved)


def _place(found: DataFrame, need: DataFrame, rec: DataFrame, keys: Sequence[str], hot) -> DataFrame:
    """Onsets without a time of their own: local offset at the nearest trigger of any kind."""
    lost = found.where("__t is null")
    if lost.isEmpty():
        return found
    unit, w = [*keys, "trigger"], F.col("__want")
    onsets = need.groupBy(*unit).agg(
        F.coalesce(
            F.min_by("onset", F.when(F.col("side") == 0, F.col("ordinal"))), F.min_by("onset", F.when(F.col("side") == 1, F.col("ordinal")))
        ).alias("__tree")
    )
    anchors = attach(rec, onsets, unit, "inner").select(*keys, "time", "trigger", "__tree")
    placed = asof_join(lost, anchors, keys, "__want", "time", ["time", "trigger", "__tree"], "__lo", "__hi", hot)
    lo, hi = F.col("__lo"), F.col("__hi")
    nearest = F.when(lo.isNotNull() & (hi.isNull() | (w - lo["time"] <= hi["time"] - w)), lo).otherwise(hi)
    placed = placed.withColumn("__n", nearest).withColumn("__t", F.col("onset") - (F.col("__n.__tree") - F.col("__n.time")))
    return found.where("__t is not null").unionByName(placed.select(*found.columns))
