"""Linear models from sufficient statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EPOCH, infer_channels, is_numeric, missing, ratio, total
from ..functions.dist import p_student
from ..plans.ordered import attach
from ..registry import operator


@operator("ols_cell_means")
def ols_cell_means(
    epochs: DataFrame, keys: Sequence[str] = (), channels: Sequence[str] | None = None,
    dims: Sequence[str] | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Condition betas of the dummy design without intercept: ``channel, condition, beta, tvalue, pvalue, se``.

    Betas are condition means of epoch means with the pooled residual variance; text
    columns (``dims``) split the fit and prefix the channel name.
    """
    cols = list(channels) if channels else infer_channels(epochs, keys)
    if dims is None:
        skip = {*keys, *by, *EPOCH, *cols, "time", "sfreq", "seq", "participant_id"}
        dims = [f.name for f in epochs.schema.fields if f.name not in skip and not is_numeric(f.dataType)]
    unit = list(dict.fromkeys([*by, *keys, *dims, *EPOCH]))
    means = epochs.groupBy(*unit).agg(*[F.avg(c).alias(c) for c in cols])
    long = means.unpivot(unit, cols, "channel", "__v").where("__v is not null")
    name = F.concat_ws("_", *[F.col(d).cast("string") for d in dims], "channel") if dims else F.col("channel")
    cell = long.groupBy(*by, name.alias("channel"), "condition").agg(
        F.count(F.lit(1)).alias("__n"), F.avg("__v").alias("beta"), (F.var_pop("__v") * F.count(F.lit(1))).alias("__ss")
    )
    group = [*by, "channel"]
    fit = cell.groupBy(*group).agg(
        (F.sum("__n") - F.count(F.lit(1))).cast("double").alias("__df"), F.sum("__ss").alias("__ssr")
    )
    out = attach(cell, fit, group, "inner")
    out = out.withColumn("se", F.sqrt(ratio(F.col("__ssr"), F.col("__df") * F.col("__n")))).withColumn("tvalue", ratio(F.col("beta"), F.col("se")))
    return out.select(
        *group, "condition", "beta", "tvalue", p_student(F.col("tvalue"), F.col("__df")).alias("pvalue"), "se",
        F.col("__df").alias("df"),
    )


@operator("contrasts")
def contrasts(ols: DataFrame, weights: Mapping[str, Mapping[str, float]], by: Sequence[str] = ()) -> DataFrame:
    """Weighted sums of betas per channel: value, se (independent terms) and t (0 without error).

    Conditions a channel lacks count as 0; without contrasts the table passes through.
    """
    if not weights:
        return ols
    aggs = []
    for i, spec in enumerate(weights.values()):
        w = F.lit(0.0)
        for cond, x in spec.items():
            w = F.when(F.col("condition") == cond, F.lit(float(x))).otherwise(w)
        aggs += [F.sum(w * F.col("beta")).alias(f"v{i}"), F.sqrt(F.sum(w * w * F.col("se") * F.col("se"))).alias(f"s{i}")]
    wide = ols.groupBy(*by, "channel").agg(*aggs)
    rows = [
        F.struct(
            F.lit(n).alias("contrast"), F.col(f"v{i}").alias("value"), F.col(f"s{i}").alias("se"),
            F.when(F.col(f"s{i}") > 0, F.col(f"v{i}") / F.col(f"s{i}")).otherwise(F.lit(0.0)).alias("t"),
        )
        for i, n in enumerate(weights)
    ]
    return wide.select(*by, "channel", F.inline(F.array(*rows))).withColumn("plot_type", F.lit("bar"))


def _linreg(long: DataFrame, group: Sequence[str], x: str, y: str, order: Sequence[str], rounded: bool = True) -> DataFrame:
    """Straight-line fits per group with at least three points."""
    data = long.where(F.col(y).isNotNull()).withColumns({"__x": F.col(x).cast("double"), "__y": F.col(y).cast("double")})
    at = F.struct(*order)
    s = data.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_observations"),
        F.regr_slope("__y", "__x").alias("slope"), F.regr_r2("__y", "__x").alias("__r2"),
        F.regr_sxx("__y", "__x").alias("__sxx"), F.regr_syy("__y", "__x").alias("__syy"),
        F.min_by(F.struct("__x", "__y"), at).alias("__a"), F.max_by(F.struct("__x", "__y"), at).alias("__z"),
        F.avg("__y").alias("value_mean"),
    ).where("n_observations >= 3")
    dof = F.col("n_observations") - 2
    s = s.withColumn("slope_se", F.sqrt(ratio(F.greatest(1 - F.col("__r2"), F.lit(0.0)) * F.col("__syy"), F.col("__sxx") * dof)))
    s = s.withColumn("p_value", F.when(F.col("slope_se") == 0, F.lit(0.0)).otherwise(p_student(ratio(F.col("slope"), F.col("slope_se")), dof)))
    first, last = F.col("__a.__y"), F.col("__z.__y")
    r = F.round if rounded else (lambda c, n: F.col(c) if isinstance(c, str) else c)
    return s.select(
        *group, r("slope", 6).alias("slope"), r("slope_se", 6).alias("slope_se"), r("p_value", 5).alias("p_value"),
        r("__r2", 4).alias("r_squared"), (F.col("p_value") < 0.05).alias("significant"),
        r(first, 4).alias("value_first"), r(last, 4).alias("value_last"), r("value_mean", 4).alias("value_mean"),
        r((last - first) / (F.abs(first) + 1e-9) * 100, 2).alias("total_change_pct"),
        r(F.col("__a.__x"), 2).alias("x_start"), r(F.col("__z.__x"), 2).alias("x_end"), "n_observations",
    )


@operator("linreg_wide")
def linreg_wide(
    df: DataFrame, x: str = "year", ys: Sequence[str] | None = None, order: Sequence[str] | None = None,
    keys: Sequence[str] = (), rounded: bool = True,
) -> DataFrame:
    """Straight line of each y column against x, with first and last value in row order."""
    order = list(order or [x])
    cols = list(ys) if ys else [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in {x, *keys, *order}]
    keep = list(dict.fromkeys([*keys, x, *order]))
    long = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(keep, cols, "column", "__val")
    return _linreg(long, [*keys, "column"], x, "__val", order, rounded)


@operator("linreg_grouped")
def linreg_grouped(
    df: DataFrame, group: str, indicator: str = "indicator", x: str = "year", value: str = "value",
    label: str | None = None, rounded: bool = True,
) -> DataFrame:
    """Straight line per group and indicator over x; ``label`` names the groups."""
    out = _linreg(df, [group, indicator], x, value, [x], rounded)
    if label:
        names = df.groupBy(group).agg(F.min(label).alias("group_label"))
        out = attach(out, names, [group], "inner")
    return out.drop("value_mean", "x_start", "x_end")


# fixed values: numeric columns that are never regression features
NOT_FEATURES = ("id", "participant_id", "subject", "condition", "plot_type", "level", "level_tag")


@operator("ridge")
def ridge(
    df: DataFrame, target: str, alpha: float = 1.0, group: str | None = None, features: Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Ridge regression with a free intercept: fit figures, intercept and one coefficient per feature.

    Centred cross products are one aggregate; a features x features system is solved
    and a second pass takes the absolute errors.
    """
    skip = {target, group, *NOT_FEATURES}
    use = list(features) if features else [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]
    if not use:
        raise ValueError("no numeric feature columns")
    y = F.col(target).try_cast("double")
    data = df.select(y.alias("__y"), *[F.col(c).cast("double").alias(c) for c in use])
    if strict:
        got = data.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(missing(F.col(c))).alias(c) for c in ["__y", *use]]).first()
        if any(got[c] for c in ["__y", *use]):
            raise ValueError("null or NaN values in target or features")
        if got["n"] <= len(use):
            raise ValueError(f"{got['n']} rows do not determine {len(use)} features")
    cols, p = [*use, "__y"], len(use)
    n = F.count(F.lit(1))
    gram = data.agg(
        n.alias("n"), F.array(*[F.avg(c) for c in cols]).alias("mean"),
        F.array(*[F.covar_pop(cols[i], cols[j]) * n for i in range(p + 1) for j in range(i, p + 1)]).alias("cross"),
    )

    @F.pandas_udf("array<double>")
    def solve(mean: pd.Series, cross: pd.Series) -> pd.Series:
        out = []
        for m, c in zip(mean, cross):
            m = np.asarray(m, dtype=float)
            g = np.zeros((p + 1, p + 1))
            g[np.triu_indices(p + 1)] = np.asarray(c, dtype=float)
            g = g + np.triu(g, 1).T
            coef = np.linalg.solve(g[:p, :p] + alpha * np.eye(p), g[:p, p])
            out.append(np.r_[m[p] - m[:p] @ coef, coef])
        return pd.Series(out)

    fit = gram.select(solve("mean", "cross").alias("__b"), F.col("mean")[p].alias("__ym"))
    rows = attach(data, fit, [], "inner")
    err = F.col("__y") - (F.col("__b")[0] + total([F.col("__b")[i + 1] * F.col(c) for i, c in enumerate(use)]))
    dev = F.col("__y") - F.col("__ym")
    return rows.agg(
        F.count(F.lit(1)).alias("n_samples"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        (1 - ratio(F.sum(err * err), F.sum(dev * dev))).alias("r2"), F.first("__b").alias("__b"),
    ).select(
        F.lit(target).alias("target"), "n_samples", F.lit(p).alias("n_features"), "rmse", "mae", "r2",
        F.lit(",".join(use)).alias("features_used"), F.col("__b")[0].alias("intercept"),
        *[F.col("__b")[i + 1].alias(f"coef_{c}") for i, c in enumerate(use)],
    )


# how far a value may lie from a whole number
NEAR_WHOLE = 1e-8


@operator("is_ordinal")
def is_ordinal(df: DataFrame, col: str, most: int = 9) -> DataFrame:
    """One row: distinct values (counted up to ``most`` + 1), whether (nearly) whole, and ``is_ordinal`` (false for no values)."""
    c = F.col(col).cast("double")
    got = df.where(c.isNotNull()).agg(F.count_distinct(c).alias("n_distinct"), F.bool_and(F.abs(c - F.rint(c)) <= NEAR_WHOLE * F.greatest(F.abs(c), F.lit(1.0))).alias("whole"))
    return got.select("n_distinct", "whole", F.coalesce((F.col("n_distinct") <= most) & F.col("whole"), F.lit(False)).alias("is_ordinal"))
