"""Bootstrap resampling and confidence intervals.

A group of n units is resampled by n draws with replacement, whatever its size.  Units are dealt to blocks by the
leading bits of their hash; how many of a resample's draws fall on a block is settled by halving: at each prefix of
those bits a binomial number, seeded by group and prefix, goes to the lower half.  Every block walks from the whole
group down to itself and so agrees with all others without an exchange: block counts are multinomial and add up to n.
Inside a block, draws are numbers of a counter-based generator, so a repeated task draws the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import field, is_numeric
from ..functions.dist import normal_cdf, normal_quantile
from ..plans.ordered import attach
from ..registry import operator

BLOCK_UNITS = 4096
_CHUNK = 250_000  # draws at a time: about 2 MB an array, some seven arrays
# fixed values: increment and factors of the splitmix64 generator
GOLDEN, MIX = 0x9E3779B97F4A7C15, ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))


def numbers(seed: int, begin: int, end: int) -> np.ndarray:
    """64-bit numbers begin .. end - 1 of the stream of a seed."""
    z = np.arange(begin + 1, end + 1, dtype=np.uint64) * np.uint64(GOLDEN) + np.uint64(seed % (1 << 64))
    for shift, factor in MIX:
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return z ^ (z >> np.uint64(31))


def block_draws(n_boot: int, seed: int, leaf: int, sizes: Sequence[int]) -> np.ndarray:
    """Draws of each resample that fall on a block; ``sizes`` are the units below each prefix of its number."""
    depth = len(sizes) - 1
    draws = np.full(n_boot, sizes[0], dtype=np.int64)
    for k in range(depth):
        high = (leaf >> (depth - k - 1)) & 1
        low = sizes[k] - sizes[k + 1] if high else sizes[k + 1]
        rng = np.random.default_rng([seed, k, leaf >> (depth - k)])
        lower = rng.binomial(draws, low / sizes[k])
        draws = draws - lower if high else lower
    return draws


def block_sums(x: np.ndarray, draws: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of x and x^2 over each resample's draws of a block, whole resamples of about ``_CHUNK`` draws at a time."""
    n_boot, ends = len(draws), np.cumsum(draws)
    swx, swxx = np.zeros(n_boot), np.zeros(n_boot)
    a = 0
    while a < n_boot:
        begin = int(ends[a] - draws[a])
        b = max(a + 1, int(np.searchsorted(ends, begin + _CHUNK, "right")))
        picked = x[(numbers(seed, begin, int(ends[b - 1])) % np.uint64(len(x))).astype(np.int64)]
        some = a + np.flatnonzero(draws[a:b])
        if len(some):
            starts = ends[some] - draws[some] - begin
            swx[some], swxx[some] = np.add.reduceat(picked, starts), np.add.reduceat(picked * picked, starts)
        a = b
    return swx, swxx


def resample(
    obs: DataFrame,
    group: Sequence[str],
    unit: Sequence[str],
    value: str,
    n_boot: int,
    seed: int = 42,
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """Per group: ``n``, ``mean``, ``skew`` and arrays over the resamples of sum w, w x and w x^2.

    x is centred on the group mean.  ``obs`` has one row per unit.  Blocks have about ``block_units`` units.
    """
    group, unit = list(group), list(unit)
    data = obs.select(*group, *unit, F.xxhash64(*unit).alias("__u"), F.col(value).cast("double").alias("__x")).where("__x is not null")
    stats = data.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg("__x").alias("mean"), F.skewness("__x").alias("skew")
    )
    most = stats.agg(F.max("n")).first()[0] or 0
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(g).cast("string"), F.lit("")) for g in group], F.lit(str(seed))))
    stats = stats.withColumns({
        "__depth": F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / block_units))).cast("int"),
        "__seed": F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"),
    })
    rows = attach(data, stats, group, "inner")
    rows = rows.withColumn("__leaf", F.expr("case when __depth = 0 then 0 else shiftrightunsigned(__u, 64 - __depth) end").cast("long"))
    if most <= block_units:
        rows = rows.withColumn("__sizes", F.array("n"))
    else:
        leaves = rows.groupBy(*group, "__leaf", "__depth").agg(F.count(F.lit(1)).alias("__n"))
        # a row for each block and prefix: blocks times their logarithm
        up = leaves.withColumn("__k", F.explode(F.expr("sequence(0, __depth)"))).withColumn("__prefix", F.expr("shiftright(__leaf, __depth - __k)"))
        below = up.groupBy(*group, "__k", "__prefix").agg(F.sum("__n").alias("__below"))
        ways = attach(up, below, [*group, "__k", "__prefix"], "inner").groupBy(*group, "__leaf").agg(
            F.sort_array(F.collect_list(F.struct("__k", "__below"))).alias("__way")
        )
        rows = attach(rows, ways.select(*group, "__leaf", field("__way", "__below").alias("__sizes")), [*group, "__leaf"], "inner")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*unit, "__x"], kind="stable", na_position="first")
        first = pdf.iloc[0]
        x = pdf["__x"].to_numpy() - first["mean"]
        leaf, own = int(first["__leaf"]), int(first["__seed"])
        draws = block_draws(n_boot, own, leaf, [int(v) for v in first["__sizes"]])
        swx, swxx = block_sums(x, draws, own + leaf * MIX[0][1])
        out = {k: [first[k]] for k in [*group, "n", "mean", "skew", "__depth"]}
        return pd.DataFrame({**out, "sw": [draws.astype(float)], "swx": [swx], "swxx": [swxx]})

    fields = [rows.schema[g] for g in group]
    fields += [T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("skew", T.DoubleType()),
               T.StructField("__depth", T.IntegerType())]
    fields += [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("sw", "swx", "swxx")]
    drawn = rows.groupBy(*group, "__leaf").applyInPandas(draw, T.StructType(fields))

    keep = [*group, "n", "mean", "skew"]
    if most <= block_units:
        return drawn.select(*keep, "sw", "swx", "swxx")
    single = drawn.where("__depth = 0").select(*keep, "sw", "swx", "swxx")
    many = drawn.where("__depth > 0").select(
        *keep, F.posexplode(F.arrays_zip("sw", "swx", "swxx")).alias("__r", "__s")
    )
    many = many.groupBy(*group, "__r").agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"), F.first("skew").alias("skew"),
        F.sum("__s.sw").alias("sw"), F.sum("__s.swx").alias("swx"), F.sum("__s.swxx").alias("swxx"),
    )
    # n_boot rows per group, the length of the result
    many = many.groupBy(*group).agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"), F.first("skew").alias("skew"),
        F.sort_array(F.collect_list(F.struct("__r", "sw", "swx", "swxx"))).alias("__all"),
    ).select(*keep, *[field("__all", c).alias(c) for c in ("sw", "swx", "swxx")])
    return single.unionByName(many)


@operator("bootstrap_ci")
def bootstrap_ci(
    df: DataFrame,
    group: Sequence[str],
    sample: Sequence[str],
    values: Sequence[str] | None = None,
    n_boot: int = 10_000,
    method: str = "percentile",
    alpha: float = 0.05,
    seed: int = 42,
    unknown_as_normal: bool = False,
) -> DataFrame:
    """Bootstrap interval of the mean over sample units, per group and value column.

    Rows are averaged per unit first; groups with fewer than two units give nothing.
    ``method``: percentile, bca or normal.  ``error`` is the larger distance to a bound.
    """
    if method not in ("percentile", "bca", "normal"):
        if not unknown_as_normal:
            raise ValueError(f"unknown method {method!r}")
        method = "normal"
    group, sample = list(group), list(sample)
    if values is None:
        skip = {*group, *sample, "time", "sfreq", "source", "folder_path", "signal", "conditions"}
        values = [f.name for f in df.schema.fields if f.name not in skip and is_numeric(f.dataType)]
    units = df.groupBy(*group, *sample).agg(*[F.avg(v).alias(v) for v in values])
    long = units.unpivot([*group, *sample], list(values), "variable", "__v").where("__v is not null")
    draws = resample(long, [*group, "variable"], sample, "__v", n_boot, seed).where("n >= 2")
    zl, zu = normal_quantile(alpha / 2), normal_quantile(1 - alpha / 2)

    @F.pandas_udf("struct<lo double, hi double>")
    def interval(n: pd.Series, mean: pd.Series, skew: pd.Series, sw: pd.Series, swx: pd.Series) -> pd.DataFrame:
        lo, hi = [], []
        for k, m, g, w, x in zip(n, mean, skew, sw, swx):
            w, x = np.asarray(w, dtype=float), np.asarray(x, dtype=float)
            boots = m + x / np.where(w > 0, w, 1.0)
            if method == "normal":
                se = np.std(boots, ddof=1)
                pair = (m + zl * se, m + zu * se)
            else:
                probs = [alpha / 2, 1 - alpha / 2]
                if method == "bca":
                    z0 = normal_quantile(float(np.mean(boots < m)))
                    # jackknife acceleration of a mean in closed form
                    a = g / (6.0 * np.sqrt(k)) if g is not None and np.isfinite(g) else 0.0
                    for i, z in enumerate((zl, zu)):
                        shift = a * (z0 + z)
                        if abs(shift) < 1:
                            probs[i] = normal_cdf(z0 + (z0 + z) / (1 - shift))
                pair = tuple(np.percentile(boots, [100 * min(max(p, 0.0), 1.0) for p in probs]))
            lo.append(float(pair[0]))
            hi.append(float(pair[1]))
        return pd.DataFrame({"lo": lo, "hi": hi})

    out = draws.select(*group, "variable", "n", "mean", interval("n", "mean", "skew", "sw", "swx").alias("__ci"))
    lo, hi = F.col("__ci.lo"), F.col("__ci.hi")
    return out.select(
        *group, "variable", "n", "mean", lo.alias("ci_lower"), hi.alias("ci_upper"),
        F.greatest(F.abs(hi - F.col("mean")), F.abs(F.col("mean") - lo)).alias("error"),
    )
