"""Gaussian mixed model with random intercept or slopes, by REML.

Everything the criterion needs of a group is the matrix of cross products of
(1, predictors, outcome): one Spark aggregate.  A moderate number of groups
(checked) is optimised over on the driver; more stay in a table and each evaluation
is a Spark sum.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import is_numeric, total
from ..functions.dist import normal_two_sided
from ..plans.ordered import attach
from ..registry import operator
from ..session import materialise

LOCAL_GROUPS = 20_000


@dataclass
class MixedFit:
    """``summary``: one row per term; ``rows``: the table with fitted values and residuals."""

    summary: DataFrame
    rows: DataFrame
    random_slopes: bool


def _terms(df: DataFrame, formula: str):
    """Design columns of ``a + b``, ``a:b`` and ``a*b``; text columns are treatment-coded."""
    coded: dict[str, list] = {}

    def one(name: str):
        if name not in coded:
            if name not in df.columns:
                raise ValueError(f"predictor {name!r} not found")
            if is_numeric(df.schema[name].dataType):
                coded[name] = [(name, F.col(name).cast("double"))]
            else:
                levels = sorted(str(r[0]) for r in df.select(name).distinct().collect())  # a model column each
                text = F.col(name).cast("string")
                coded[name] = [(f"{name}[T.{v}]", F.when(text == v, 1.0).otherwise(0.0)) for v in levels[1:]]
        return coded[name]

    wanted: list[tuple[str, ...]] = []
    for part in re.split(r"[+,]", formula):
        names = [n.strip() for n in re.split(r"[*:]", part) if n.strip()]
        if "*" in part:
            for mask in range(1, 2 ** len(names)):
                wanted.append(tuple(n for i, n in enumerate(names) if mask >> i & 1))
        elif names:
            wanted.append(tuple(names))
    out = []
    for names in sorted(dict.fromkeys(wanted), key=len):
        cols = one(names[0])
        for n in names[1:]:
            cols = [(f"{a}:{b}", x * y) for a, x in cols for b, y in one(n)]
        out += cols
    if not out:
        raise ValueError("no predictors")
    return out


def _unpack(flat: np.ndarray, k: int) -> np.ndarray:
    """Upper triangles (groups x entries) to symmetric matrices."""
    g = np.zeros((len(flat), k, k))
    iu = np.triu_indices(k)
    g[:, iu[0], iu[1]] = flat
    g[:, iu[1], iu[0]] = flat
    return g


def _lower(theta: np.ndarray, q: int) -> np.ndarray:
    low = np.zeros((q, q))
    low[np.tril_indices(q)] = theta
    return low


def _parts(g: np.ndarray, low: np.ndarray, p: int, q: int):
    """Sums over groups: log |V|, and the weighted cross products of (X, y)."""
    zz, zv = g[:, :q, :q], g[:, :q, :]
    m = np.eye(q) + low.T @ zz @ low
    lz = low.T @ zv
    vv = g - np.swapaxes(lz, 1, 2) @ np.linalg.solve(m, lz)
    return float(np.sum(np.linalg.slogdet(m)[1])), vv.sum(axis=0)


def _criterion(logdet: float, w: np.ndarray, p: int, n: float):
    """REML criterion with scale and fixed effects profiled out."""
    xx, xy, yy = w[:p, :p], w[:p, p], w[p, p]
    beta = np.linalg.solve(xx, xy)
    rss = max(float(yy - xy @ beta), 1e-300)
    sign, ld = np.linalg.slogdet(xx)
    return logdet + ld + (n - p) * np.log(rss / (n - p)), beta, rss / (n - p), xx


def _minimise(values, start: np.ndarray, rounds: int = 200):
    """BFGS with central differences; ``values`` evaluates a list of points at once."""
    x, d = start.copy(), len(start)
    h = np.eye(d)

    def look(x):
        eps = 1e-5 * np.maximum(1.0, np.abs(x))
        pts = [x] + [x + s * eps[i] * np.eye(d)[i] for i in range(d) for s in (1, -1)]
        v = values(pts)
        return v[0], np.array([(v[1 + 2 * i] - v[2 + 2 * i]) / (2 * eps[i]) for i in range(d)])

    f, g = look(x)
    for _ in range(rounds):
        if np.max(np.abs(g)) < 1e-4 * max(1.0, abs(f) * 1e-3):
            return x, f, True
        step = -h @ g
        if step @ g >= 0:
            h, step = np.eye(d), -g
        size = min(1.0, 2.0 / max(np.max(np.abs(step)), 1e-12))
        scales = [size * 0.5**i for i in range(12)]
        v = values([x + s * step for s in scales])
        ok = [i for i in range(len(scales)) if np.isfinite(v[i]) and v[i] <= f + 1e-4 * scales[i] * (step @ g)]
        if not ok:
            return x, f, bool(np.max(np.abs(g)) < 1e-2 * max(1.0, abs(f) * 1e-3))
        best = min(ok, key=lambda i: v[i])
        new = x + scales[best] * step
        f2, g2 = look(new)
        s, y = new - x, g2 - g
        if s @ y > 1e-12:
            rho = 1.0 / (s @ y)
            left = np.eye(d) - rho * np.outer(s, y)
            h = left @ h @ left.T + rho * np.outer(s, s)
        done = abs(f - f2) < 1e-10 * max(1.0, abs(f))
        x, f, g = new, f2, g2
        if done:
            return x, f, True
    return x, f, False


@operator("mixed_model")
def mixed_model(df: DataFrame, dep: str, predictors: str, group: str, slopes: bool = True, local_groups: int = LOCAL_GROUPS) -> MixedFit:
    """Fit ``dep ~ predictors`` with random slopes per group, or a random intercept where that fails.

    ``predictors`` joins terms by ``+`` or ``,`` and may hold ``a:b`` and ``a*b``.  Needs
    at least 5 rows, 2 groups and no nulls.  The summary has coefficients with z-tests
    and, as ``Group Var`` terms, the random variances relative to the scale.
    """
    terms = _terms(df, predictors)
    p = len(terms) + 1
    base = df.withColumns({f"__x{i + 1}": c for i, (_, c) in enumerate(terms)} | {"__x0": F.lit(1.0), f"__x{p}": F.col(dep).cast("double")})
    cols = [f"__x{i}" for i in range(p + 1)]
    k = p + 1
    sums = [F.sum(F.col(cols[i]) * F.col(cols[j])) for i in range(k) for j in range(i, k)]
    null = [F.count_if(F.col(c).isNull()) for c in [*cols, group]]
    grams = base.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("gram"), total(null).alias("nulls"))
    grams = materialise(grams, "grams")
    n, m, bad = grams.agg(F.sum("n"), F.count(F.lit(1)), F.sum("nulls")).first()
    if bad:
        raise ValueError("model columns contain nulls")
    if (n or 0) < 5 or m < 2:
        raise ValueError(f"{n or 0} rows in {m} groups are too few")
    local = None
    if m <= local_groups:
        local = _unpack(np.array([r[0] for r in grams.select("gram").collect()], dtype=float), k)

    def evaluate(points: list[np.ndarray], q: int):
        lows = [_lower(t, q) for t in points]
        if local is not None:
            return [_parts(local, low, p, q) for low in lows]

        def part(it):
            acc = None
            for pdf in it:
                g = _unpack(np.array(pdf["gram"].tolist(), dtype=float), k)
                got = [np.r_[a, b.ravel()] for a, b in (_parts(g, low, p, q) for low in lows)]
                acc = got if acc is None else [x + y for x, y in zip(acc, got)]
            if acc is not None:
                yield pd.DataFrame({"i": range(len(acc)), "s": [list(a) for a in acc]})

        got = grams.select("gram").mapInPandas(part, "i int, s array<double>").select("i", F.posexplode("s").alias("j", "v"))
        out = np.zeros((len(points), 1 + k * k))
        for r in got.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            out[r["i"], r["j"]] = r["v"]
        return [(o[0], o[1:].reshape(k, k)) for o in out]

    def fit(q: int):
        start = np.zeros(q * (q + 1) // 2)
        start[np.cumsum(np.arange(1, q + 1)) - 1] = 1.0

        def values(points):
            res = []
            for logdet, w in evaluate(points, q):
                try:
                    res.append(_criterion(logdet, w, p, n)[0])
                except np.linalg.LinAlgError:
                    res.append(np.inf)
            return res

        theta, _, ok = _minimise(values, start)
        logdet, w = evaluate([theta], q)[0]
        _, beta, scale, xx = _criterion(logdet, w, p, n)
        return ok, _lower(theta, q), beta, np.sqrt(np.diag(np.linalg.inv(xx)) * scale), scale

    q = p if slopes else 1
    result = None
    try:
        result = fit(q)
    except np.linalg.LinAlgError:
        pass
    if (result is None or not result[0]) and q > 1:
        q = 1
        result = fit(1)
    if result is None or not result[0]:
        raise RuntimeError(f"the mixed model of {dep!r} did not converge")
    _, low, beta, se, scale = result
    cov = low @ low.T

    names = ["Intercept", *[t for t, _ in terms]]
    rows = []
    for t, b, s in zip(names, beta, se):
        z = b / s
        pv = float(normal_two_sided(z)[0])
        stars = "***" if pv < 0.001 else "**" if pv < 0.01 else "*" if pv < 0.05 else "ns"
        rows.append((t, *(round(float(v), 4) for v in (b, s, z, pv)), stars))
    tags = ["Group", *names[1:q]]
    for i in range(q):
        for j in range(i + 1):
            t = f"{tags[j]} Var" if i == j else f"{tags[j]} x {tags[i]} Cov"
            rows.append((t, round(float(cov[i, j]), 4), None, None, None, None))
    schema = "term string, coef double, std_err double, z_stat double, p_val double, sig string"
    summary = df.sparkSession.createDataFrame(rows, schema)

    def effects(it):
        for pdf in it:
            g = _unpack(np.array(pdf["gram"].tolist(), dtype=float), k)
            zz, zx, zy = g[:, :q, :q], g[:, :q, :p], g[:, :q, p]
            inner = np.eye(q) + low.T @ zz @ low
            u = np.linalg.solve(inner, (low.T @ (zy - zx @ beta)[..., None])) if len(g) else np.zeros((0, q, 1))
            yield pd.DataFrame({group: pdf[group], "__u": list((low @ u)[..., 0])})

    gtype = grams.schema[group]
    us = grams.select(group, "gram").mapInPandas(effects, T.StructType([gtype, T.StructField("__u", T.ArrayType(T.DoubleType()))]))
    joined = attach(base, us, [group], "inner")
    fixed = total([F.lit(float(b)) * F.col(f"__x{i}") for i, b in enumerate(beta)])
    rand = total([F.col("__u")[i] * F.col(f"__x{i}") for i in range(q)])
    out = joined.select(
        *df.columns, fixed.alias("lmm_fit_fixed"), (fixed + rand).alias("lmm_fit_group"),
        (F.col(f"__x{p}") - fixed - rand).alias("lmm_residual"),
    )
    return MixedFit(summary, out, q > 1)
