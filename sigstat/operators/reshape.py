"""Joins, label bins, pivots and stacked rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import field, is_numeric
from ..plans.ordered import AUTO, attach, ordered_scan
from ..registry import operator


@operator("map_join", inputs=("a", "b"))
def map_join(a: DataFrame, b: DataFrame, key_a: str, key_b: str) -> DataFrame:
    """Inner equi join of differently named keys; the right key goes, right duplicates get ``_right``."""
    names = {c: (f"{c}_right" if c in a.columns else c) for c in b.columns if c != key_b}
    right = b.select(F.col(key_b).alias("__key"), *[F.col(c).alias(n) for c, n in names.items()])
    return a.join(right, a[key_a] == right["__key"], "inner").drop("__key")


def _bin(value: str, name: str, threshold: float, band: float):
    v = F.col(value)
    if band > 0:
        return (
            F.when(v > threshold + band, f"{name}_high")
            .when(v < threshold - band, f"{name}_low")
            .otherwise(f"{name}_neutral")
        )
    return F.when(v >= threshold, f"{name}_high").otherwise(f"{name}_low")


# fixed values: columns of a physiology table that are never values
_LABEL_META = ("trial_id", "epoch_id", "condition", "metric", "source", "signal", "folder_path",
               "conditions", "time", "sfreq", "region")


@operator("bin_by_labels", inputs=("phys", "labels"))
def bin_by_labels(
    phys: DataFrame,
    labels: DataFrame,
    keys: Sequence[str] = (),
    val_thr: float = 5.0,
    aro_thr: float = 5.0,
    value_col: str | None = None,
    neutral_band: float = 0.0,
    strict: bool = False,
) -> DataFrame:
    """Trials under their valence bin and again under their arousal bin.

    Two-way bins are ``>= threshold`` high, everything else (null too) low; with a
    neutral band they are strict on both sides.  ``value_col`` is a name, None for
    the first other column, or ``auto_multi`` for all int, long and float columns.
    """
    keys = list(keys)
    if "trial_id" not in phys.columns:
        phys = phys.withColumnRenamed("condition", "trial_id")
    pool = [f for f in phys.schema.fields if f.name not in {*_LABEL_META, *keys}]
    if value_col == "auto_multi":
        wanted = (T.FloatType, T.DoubleType, T.IntegerType, T.LongType)
        values = {f.name: f.name for f in pool if isinstance(f.dataType, wanted)}
    else:
        values = {value_col or pool[0].name: "value"}
    left = phys.select(
        *keys,
        F.col("trial_id").cast("string").alias("trial_id"),
        *[F.col(c).cast("double").alias(n) for c, n in values.items()],
    )
    bins = labels.select(
        *keys,
        F.col("trial_id").cast("string").alias("trial_id"),
        F.array(
            _bin("valence", "valence", val_thr, neutral_band), _bin("arousal", "arousal", aro_thr, neutral_band)
        ).alias("__bins"),
    )
    out = attach(left, bins, [*keys, "trial_id"], "inner").select(
        *keys, F.explode("__bins").alias("condition"), F.col("trial_id").alias("epoch_id"), *values.values()
    )
    if strict and out.isEmpty():
        raise ValueError("no trial of the signal table has labels")
    return out


@operator("pivot_long_to_wide")
def pivot_long_to_wide(
    df: DataFrame,
    index: Sequence[str],
    pivot_col: str,
    value_col: str,
    order: Sequence[str],
    values: Sequence | None = None,
) -> DataFrame:
    """Wide table of the first row (by ``order``) of each (index, pivot) pair.

    The first row is an aggregate with a map-side part, not a window.  Give
    ``values`` to spare the extra job that looks for them.
    """
    index = list(index)
    first = df.groupBy(*index, pivot_col).agg(
        F.min_by(F.struct(F.col(value_col).alias("v")), F.struct(*order)).alias("__first")
    )
    grouped = first.select(*index, pivot_col, F.col("__first.v").cast("double").alias("__v")).groupBy(*index)
    return grouped.pivot(pivot_col, list(values) if values is not None else None).agg(F.first("__v", True))


@operator("unpivot_wide_to_long")
def unpivot_wide_to_long(df: DataFrame, index: Sequence[str], value_cols: Sequence[str] | None = None) -> DataFrame:
    """Long table ``index, variable, value``; default values are all other numeric columns."""
    cols = list(value_cols) if value_cols else [
        f.name for f in df.schema.fields if f.name not in index and is_numeric(f.dataType)
    ]
    typed = df.select(*index, *[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot(list(index), cols, "variable", "value")


# fixed values: columns of a result file that never hold the summary value
_FILE_META = ("condition", "plot_type", "x_label", "y_label", "x_data", "y_ticks", "region",
              "participant_id", "modality", "file")


@operator("files_to_participant_table")
def files_to_participant_table(
    df: DataFrame,
    value_col: str = "y_data",
    conditions: Sequence[str] | None = None,
    prefix: str = "",
    auto_prefix: bool = False,
    file: str = "file",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per participant with a column ``[prefix]condition_value`` per condition.

    Input is the union of result files with ``file``, ``participant_id`` and
    ``modality``.  List values give their first element, except where rows carry
    no condition: there ``x_data`` names the conditions of the list elements.  Later
    files win; values that are null count as absent, and so do participants
    without any.
    """
    if value_col not in df.columns:
        numeric = [f.name for f in df.schema.fields if f.name not in _FILE_META and is_numeric(f.dataType)]
        if not numeric:
            raise ValueError("no usable value column")
        value_col = numeric[0]
    is_list = isinstance(df.schema[value_col].dataType, T.ArrayType)
    scalar = F.get(F.col(value_col), F.lit(0)) if is_list else F.col(value_col)
    if "condition" in df.columns:
        cond, base, pos = F.col("condition"), df, F.lit(0)
    else:
        base = df.select("*", F.posexplode(F.arrays_zip(F.col("x_data").alias("x"), F.col(value_col).alias("y"))).alias("__pos", "__z"))
        cond, scalar, pos = F.col("__z.x"), F.col("__z.y"), F.col("__pos")
    tag = F.concat(F.col("modality"), F.lit("_")) if auto_prefix else F.lit(prefix)
    cells = base.select(
        "participant_id", F.col(file).alias("__file"), pos.alias("__pos"),
        cond.cast("string").alias("__cond"), tag.alias("__tag"), scalar.try_cast("double").alias("__v"),
    ).where(F.col("__v").isNotNull())
    if conditions:
        cells = cells.where(F.col("__cond").isin(list(conditions)))
    name = F.concat(F.col("__tag"), F.coalesce("__cond", F.lit("")), F.lit(f"_{value_col}"))
    latest = cells.groupBy("participant_id", name.alias("__col")).agg(
        F.max_by("__v", F.struct("__file", "__pos")).alias("__v")
    )
    return latest.groupBy("participant_id").pivot("__col", list(columns) if columns else None).agg(F.first("__v"))


@operator("overlay_series")
def overlay_series(
    df: DataFrame, group: str, x: str = "year", indicator: str = "indicator", value: str = "value", label: str | None = None
) -> DataFrame:
    """One row per indicator with a list of series, one per group in text order.

    Nulls go, points are sorted by x, groups without a point keep an empty list.
    A series becomes one value of the result row, as the plot-ready format wants.
    """
    point = F.struct(F.col(x).cast("double").alias("x"), F.col(value).cast("double").alias("y"))
    keyed = df.withColumn("__g", F.col(group).cast("string"))
    groups = keyed.groupBy("__g").agg((F.min(F.col(label)) if label else F.min("__g")).cast("string").alias("__label"))
    series = keyed.groupBy(indicator, "__g").agg(
        F.sort_array(F.collect_list(F.when(F.col(x).isNotNull() & F.col(value).isNotNull(), point))).alias("__pts")
    )
    entry = F.struct("__g", "__pts")
    rows = series.groupBy(indicator).agg(F.collect_list(entry).alias("__have"))
    # the group list is as long as every row of the result
    all_groups = groups.agg(F.sort_array(F.collect_list(F.struct("__g", "__label"))).alias("__groups"))
    both = attach(rows, all_groups, [])
    have = F.map_from_entries("__have")
    empty = F.array().cast(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
    pts = F.transform("__groups", lambda g: F.coalesce(F.try_element_at(have, g["__g"]), empty))
    return both.select(
        indicator,
        F.transform("__groups", lambda g: g["__label"]).alias("labels"),
        F.transform(pts, lambda s: F.transform(s, lambda p: p["x"])).alias("x_data"),
        F.transform(pts, lambda s: F.transform(s, lambda p: p["y"])).alias("y_data"),
    )


@operator("overlay_long")
def overlay_long(
    df: DataFrame, group: str, x: str = "year", indicator: str = "indicator", value: str = "value", label: str | None = None, hot=AUTO
) -> DataFrame:
    """The series of ``overlay_series`` as rows: ``indicator, group, label, idx, x, y``, one per point, numbered by x and value.

    No list is made, so a series may have any length; groups without a point have no row, null groups and indicators
    are series of their own.
    """
    g = F.col(group).cast("string")
    keyed = df.select(F.col(indicator).alias(indicator), g.alias("__g"), (F.col(label).cast("string") if label else g).alias("__label"),
                      F.col(x).cast("double").alias("__x"), F.col(value).cast("double").alias("__y"))
    names = keyed.groupBy("__g").agg(F.min("__label").alias("__label"))
    points = ordered_scan(keyed.drop("__label").where("__x IS NOT NULL AND __y IS NOT NULL"), [indicator, "__g"], ["__x", "__y"], index="__idx", hot=hot)
    return attach(points, names, ["__g"]).select(
        indicator, F.col("__g").alias("group"), F.col("__label").alias("label"), F.col("__idx").alias("idx"), F.col("__x").alias("x"), F.col("__y").alias("y")
    )


@operator("relative_to_baseline")
def relative_to_baseline(df: DataFrame, baseline: str | None = None) -> DataFrame:
    """Stacked rows relative to one of their conditions, which then leaves.

    ``labels`` names the series of ``y_data`` and ``y_var`` (lists of lists).  The
    baseline is the named label, else the first.  Values beyond its end are
    compared with its first value; variances pass unchanged.
    """
    at = F.array_position("labels", F.lit(baseline)) if baseline is not None else F.lit(1)
    at = F.when(at > 0, at).otherwise(F.lit(1)).cast("int")
    rows = df.withColumn("__b", at).withColumn("__base", F.element_at("y_data", F.col("__b")))

    def without(name):
        return F.filter(name, lambda _, i: i + 1 != F.col("__b"))

    def minus(series):
        return F.transform(
            series, lambda v, i: v - F.when(i < F.size("__base"), F.get(F.col("__base"), i)).otherwise(F.get(F.col("__base"), F.lit(0)))
        )

    changed = {"labels": without("labels"), "y_data": F.transform(without("y_data"), minus)}
    for c in ("y_var", "x_data"):
        if c in df.columns and isinstance(df.schema[c].dataType, T.ArrayType):
            nested = isinstance(df.schema[c].dataType.elementType, T.ArrayType)
            if nested:
                changed[c] = without(c)
    if "y_label" in df.columns:
        changed["y_label"] = F.concat(
            F.lit("Δ "), F.col("y_label"), F.lit(" (rel. to "), F.element_at("labels", F.col("__b")), F.lit(")")
        )
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])


@operator("relative_long")
def relative_long(
    df: DataFrame, keys: Sequence[str], baseline: str, condition: str = "condition", x: str = "x", value: str = "value"
) -> DataFrame:
    """The same on long rows: each condition minus the baseline at the same position.

    The baseline of a (key, x) is one row, found by aggregation and joined back;
    positions it lacks use its first.  Of repeated baseline rows the smallest value counts.
    """
    keys = list(keys)
    base = df.where(F.col(condition) == baseline)
    at = base.groupBy(*keys, x).agg(F.min(value).alias("__b"))
    start = base.groupBy(*keys).agg(F.min_by(value, x).alias("__b0"))
    rows = attach(attach(df.where(F.col(condition) != baseline), at, [*keys, x]), start, keys, "inner")
    return rows.select(*keys, condition, x, (F.col(value) - F.coalesce("__b", "__b0")).alias(value))


@operator("stack_conditions")
def stack_conditions(
    df: DataFrame,
    keys: Sequence[str],
    condition: str = "condition",
    lists: Sequence[str] = ("y_data", "y_var"),
    constants: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per key: condition labels and lists of their lists, in condition order."""
    stacked = df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(condition).alias("c"), *lists))).alias("__all")
    )
    return stacked.select(
        *keys,
        F.transform("__all", lambda s: s["c"].cast("string")).alias("labels"),
        *[field("__all", c).alias(c) for c in lists],
        *[F.lit(v).alias(k) for k, v in (constants or {}).items()],
    )
