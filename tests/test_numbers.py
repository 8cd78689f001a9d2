"""Hand goldens, brute force on small fixtures, closed forms and invariants."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigstat.functions import dist
from sigstat.functions.filters import analytic_phase, butterworth, zero_phase
from sigstat.functions.patterns import glob_to_regex
from sigstat.operators.classify import logo_gaussian
from sigstat.operators.coupling import Stream, plv_streams
from sigstat.operators.filters import _keep_by_distance, detect_peaks, detect_r_peaks
from sigstat.operators.inference import _inversions, anova_oneway, correlation_matrix, effect_size, fdr_bh, kendall, mann_whitney, ttest, wilcoxon
from sigstat.operators.mixed import mixed_model
from sigstat.operators.models import contrasts, linreg_wide, ols_cell_means
from sigstat.operators.reshape import bin_by_labels, overlay_long, pivot_long_to_wide
from sigstat.operators.resample import block_draws, bootstrap_ci, resample
from sigstat.operators.segment import epoch_by_events, sliding_epochs
from sigstat.operators.select import flatten_lists, reject_samples, resolve_selector, row_filter, strict_guard
from sigstat.operators.summary import asymmetry, interval_metrics
from sigstat.operators.tree import build_tree
from sigstat.operators.windows import baseline_correct, tddr


def test_tail_probabilities():
    # published table values
    assert dist.student_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert dist.student_two_sided(12.706, 1) == pytest.approx(0.05, abs=1e-5)
    assert dist.f_upper(4.10, 2, 10) == pytest.approx(0.05, abs=2e-4)
    assert dist.chi2_upper(5.991, 2) == pytest.approx(0.05, abs=1e-4)
    assert dist.chi2_upper(18.307, 10) == pytest.approx(0.05, abs=1e-5)
    assert dist.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert dist.mann_whitney_exact(0, 3, 3) == pytest.approx(0.1)
    assert dist.signed_rank_exact(0, 5) == pytest.approx(0.0625)


def test_exact_rank_distributions_by_enumeration():
    n1, n2 = 3, 4
    us = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(range(1, 8), n1)]
    for u in range(n1 * n2 + 1):
        upper = max(u, n1 * n2 - u)
        want = min(1.0, 2 * sum(x >= upper for x in us) / len(us))
        assert dist.mann_whitney_exact(u, n1, n2) == pytest.approx(want)
    ws = [sum(r for r, s in zip(range(1, 6), signs) if s) for signs in itertools.product([0, 1], repeat=5)]
    for w in range(8):
        assert dist.signed_rank_exact(w, 5) == pytest.approx(min(1.0, 2 * sum(x <= w for x in ws) / 32))


def test_butterworth_by_its_definition():
    # squared gain of order n: 1 / (1 + (f / fc)^(2n)) in warped frequency; half power at the edges
    for order, lo, hi in ((2, 4.0, 12.0), (4, 8.0, 13.0)):
        z, p, k = butterworth(order, lo, hi, 64.0)

        def gain(f):
            e = np.exp(2j * np.pi * f / 64.0)
            return abs(k * np.prod(e - z) / np.prod(e - p))

        assert gain(lo) == pytest.approx(math.sqrt(0.5), rel=1e-9)
        assert gain(hi) == pytest.approx(math.sqrt(0.5), rel=1e-9)
        assert gain(0.0) < 1e-9 and gain(32.0) < 1e-9 and np.all(np.abs(p) < 1)
    z, p, k = butterworth(2, None, 10.0, 100.0)
    assert abs(k * np.prod(1 - z) / np.prod(1 - p)) == pytest.approx(1.0)


def _recursive(x, zpk):
    """The difference equation, started in the steady state of the first value."""
    z, p, k = zpk
    b, a = np.real(k * np.poly(z)), np.real(np.poly(p))
    n = len(a) - 1
    dc = b.sum() / a.sum()
    past_x, past_y = [x[0]] * n, [x[0] * dc] * n
    out = []
    for v in x:
        y = b[0] * v + sum(b[i] * past_x[-i] - a[i] * past_y[-i] for i in range(1, n + 1))
        past_x.append(v)
        past_y.append(y)
        out.append(y)
    return np.array(out)


@pytest.mark.parametrize("edges", [(None, 5.0), (5.0, None), (4.0, 12.0)])
def test_zero_phase_equals_the_recursion(edges):
    x = np.random.default_rng(3).normal(size=200)
    zpk, pad = butterworth(2, *edges, 64.0), 15
    ext = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]])
    want = _recursive(_recursive(ext, zpk)[::-1], zpk)[::-1][pad:-pad]
    assert np.allclose(zero_phase(x, zpk, pad), want, atol=1e-9)


def test_filter_passes_and_stops():
    t = np.arange(2000) / 200.0
    zpk = butterworth(2, 8.0, 13.0, 200.0)
    inside, outside = zero_phase(np.sin(2 * np.pi * 10 * t), zpk, 15), zero_phase(np.sin(2 * np.pi * 50 * t), zpk, 15)
    assert np.max(np.abs(inside[500:1500])) == pytest.approx(1.0, abs=0.02)
    assert np.max(np.abs(outside[500:1500])) < 0.01


def test_phase_of_a_cosine():
    n = 128
    ph = 2 * np.pi * 5 * np.arange(n) / n
    assert np.allclose(np.exp(1j * analytic_phase(np.cos(ph))), np.exp(1j * ph), atol=1e-9)


def test_peak_suppression_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(30):
        pos = np.sort(rng.choice(300, 60, replace=False))
        height = rng.integers(0, 20, 60).astype(float)
        kept = []
        for i in sorted(range(60), key=lambda i: (height[i], pos[i]), reverse=True):
            if all(abs(pos[i] - pos[j]) >= 7 for j in kept):
                kept.append(i)
        keep, sure = _keep_by_distance(pos, height, 7, False, False)
        assert sure.all() and sorted(kept) == list(np.flatnonzero(keep))
        # a block with open borders: decisions called sure are those of the whole series
        keep2, sure2 = _keep_by_distance(pos[10:50], height[10:50], 7, True, True)
        assert np.array_equal(keep2[sure2], keep[10:50][sure2])


def test_plateau_and_r_peaks(spark):
    df = spark.createDataFrame([(1, float(i), float(v)) for i, v in enumerate([0, 1, 1, 1, 0])], "k int, time double, x double")
    assert [r["peak_sample"] for r in detect_peaks(df, ["k"], "x").collect()] == [2]
    fs, beats = 100, [100, 190, 285, 370]
    t = np.arange(500)
    ecg = sum(np.exp(-0.5 * ((t - b) / 2.0) ** 2) for b in beats)
    df = spark.createDataFrame([(1, i / fs, float(v)) for i, v in enumerate(ecg)], "k int, time double, x double")
    assert sorted(r["peak_sample"] for r in detect_r_peaks(df, ["k"], "x", fs).collect()) == beats


def test_inversions_and_kendall_strips(spark):
    rng = np.random.default_rng(7)
    v = rng.integers(0, 30, 200)
    assert _inversions(v) == sum(v[i] > v[j] for i in range(200) for j in range(i + 1, 200))
    x, y = rng.integers(0, 25, 300).astype(float), rng.integers(0, 40, 300).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i in range(300) for j in range(i))
    n0 = 300 * 299 / 2
    tie = lambda c: sum(k * (k - 1) / 2 for k in np.unique(c, return_counts=True)[1])
    want = s / math.sqrt((n0 - tie(x)) * (n0 - tie(y)))
    assert kendall(df, "x", "y").first()["tau"] == pytest.approx(want)
    assert kendall(df, "x", "y", strip=40).first()["tau"] == pytest.approx(want)


def _ab(spark, a, b, name="v"):
    rows = [("A", f"a{i}", float(v)) for i, v in enumerate(a)] + [("B", f"b{i}", float(v)) for i, v in enumerate(b)]
    return spark.createDataFrame(rows, f"condition string, epoch_id string, {name} double")


def test_small_tests(spark):
    df = _ab(spark, [1, 2, 3], [4, 5, 6])
    t = ttest(df).first()
    assert t["t"] == pytest.approx(-3.6742) and t["p"] == pytest.approx(0.02131) and t["cohens_d"] == -3 and t["significant"]
    u = mann_whitney(df).first()
    assert u["statistic"] == 0 and u["p"] == pytest.approx(0.1)
    w = wilcoxon(df).first()
    assert w["statistic"] == 0
    a = anova_oneway(df.withColumnRenamed("condition", "g"), ["v"], "g").first()
    assert (a["F"], a["df1"], a["df2"]) == (pytest.approx(13.5), 1, 4) and a["eta_sq"] == pytest.approx(0.7714, abs=1e-4)
    assert a["p"] == pytest.approx(0.0213, abs=1e-4) and a["sig"] == "*"
    d = effect_size(df, n_boot=200).first()
    assert d["value"] == -3 and d["ci_low"] <= d["ci_high"]


def test_degenerate_tests_give_null_not_errors(spark):
    same = _ab(spark, [2, 2], [2, 2])
    assert ttest(same).first()["t"] is None
    assert mann_whitney(same).first()["p"] == 1.0
    assert ttest(_ab(spark, [1], [2]), kind="welch").first()["t"] is None


def test_cell_means_and_contrast(spark):
    ols = {r["condition"]: r for r in ols_cell_means(_ab(spark, [1, 3], [5, 7])).collect()}
    assert (ols["A"]["beta"], ols["B"]["beta"]) == (2, 6) and ols["A"]["se"] == pytest.approx(1) and ols["A"]["df"] == 2
    tab = spark.createDataFrame([("c", "A", 3.0, 0.3), ("c", "B", 1.0, 0.4)], "channel string, condition string, beta double, se double")
    r = contrasts(tab, {"d": {"A": 1, "B": -1}}).first()
    assert (r["value"], r["se"], r["t"]) == (pytest.approx(2), pytest.approx(0.5), pytest.approx(4))


def test_fdr_and_regression(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.03,), (0.5,)], "p double")
    got = sorted(round(r["p"], 4) for r in fdr_bh(df).collect())
    assert got == [0.04, 0.0533, 0.0533, 0.5]
    r = linreg_wide(spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 5.0)], "year int, y double")).first()
    assert (r["slope"], r["r_squared"], r["total_change_pct"], r["n_observations"]) == (2, 1, 400, 3) and r["p_value"] == 0


def test_mixed_model_of_a_balanced_layout(spark):
    # balanced one-way layout: REML variance components are those of the analysis of variance
    rng = np.random.default_rng(11)
    g, m = 30, 8
    y = rng.normal(size=(g, 1)) * 2 + rng.normal(size=(g, m))
    x = np.tile(np.arange(m) - (m - 1) / 2, (g, 1))
    y = y + 0.5 * x
    rows = [(i, float(x[i, j]), float(y[i, j])) for i in range(g) for j in range(m)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    fit = mixed_model(df, "y", "x", "g", slopes=False)
    got = {r["term"]: r for r in fit.summary.collect()}
    slope = float(np.sum(x * (y - y.mean(axis=1, keepdims=True))) / np.sum(x * x))
    res = y - y.mean(axis=1, keepdims=True) - slope * x
    s2 = float(np.sum(res**2) / (g * (m - 1) - 1))
    between = float(np.var(y.mean(axis=1), ddof=1)) - s2 / m
    assert got["x"]["coef"] == pytest.approx(slope, abs=1e-4)
    assert got["Intercept"]["coef"] == pytest.approx(float(y.mean()), abs=1e-4)
    assert got["x"]["std_err"] == pytest.approx(math.sqrt(s2 / np.sum(x * x)), abs=2e-4)
    assert got["Group Var"]["coef"] == pytest.approx(between / s2, rel=2e-3)
    far = mixed_model(df, "y", "x", "g", slopes=False, local_groups=1)
    assert {r["term"]: r["coef"] for r in far.summary.collect()}["x"] == pytest.approx(got["x"]["coef"], abs=1e-4)
    slopes = mixed_model(df, "y", "x", "g")
    assert {r["term"]: r["coef"] for r in slopes.summary.collect()}["x"] == pytest.approx(slope, abs=2e-2)


def test_bootstrap(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=300)
    df = spark.createDataFrame([("A", i, float(v)) for i, v in enumerate(x)], "condition string, epoch_id int, v double")
    obs = df.select("condition", "epoch_id", "v")
    small = resample(obs, ["condition"], ["epoch_id"], "v", 2000).first()
    large = resample(obs, ["condition"], ["epoch_id"], "v", 2000, block_units=64).first()
    se = float(np.std(x) / math.sqrt(300))
    for r in (small, large):
        means = np.array(r["swx"]) / np.array(r["sw"])
        assert abs(means.mean()) < 5 * se / math.sqrt(2000) + 1e-3 and means.std() == pytest.approx(se, rel=0.08)
    again = resample(obs.repartition(7), ["condition"], ["epoch_id"], "v", 2000, block_units=64).first()
    assert np.allclose(sorted(again["swx"]), sorted(large["swx"]))
    r = bootstrap_ci(df, ["condition"], ["epoch_id"], n_boot=2000).first()
    assert r["ci_lower"] < r["mean"] < r["ci_upper"] and r["ci_upper"] - r["ci_lower"] == pytest.approx(3.92 * se, rel=0.1)


def test_bootstrap_blocks(spark):
    """Blocks agree on their draws without an exchange: each resample has exactly n, and every unit its even share."""
    sizes = {0: 70, 1: 30, 2: 55, 3: 0, 4: 1, 5: 90, 6: 40, 7: 14}

    def path(leaf):
        return [sum(n for k, n in sizes.items() if k >> (3 - d) == leaf >> (3 - d)) for d in range(4)]

    draws = {leaf: block_draws(4000, 7, leaf, path(leaf)) for leaf, n in sizes.items() if n}
    assert (sum(draws.values()) == 300).all()
    for leaf, d in draws.items():
        p = sizes[leaf] / 300
        assert d.mean() == pytest.approx(300 * p, abs=5 * math.sqrt(300 * p * (1 - p) / 4000))
        assert d.var() == pytest.approx(300 * p * (1 - p), rel=0.15)
    rows = [(g, i, float(i % 7)) for g, n in (("A", 500), ("B", 20), (None, 130)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    for r in resample(df, ["g"], ["i"], "v", 50, block_units=32).collect():
        assert r["sw"] == [float(r["n"])] * 50 and len(r["swx"]) == 50
    assert resample(df, ["g"], ["i"], "v", 50, block_units=32).count() == 3


def test_sliding_windows(spark):
    def epoch(n):
        return spark.range(n + 1).select(F.lit("p").alias("k"), F.lit("c").alias("condition"), F.lit("c_0").alias("epoch_id"), F.col("id").cast("double").alias("time"))

    got = sliding_epochs(epoch(100), ["k"]).groupBy("epoch_id").count().collect()
    assert len(got) == 8 and {r["count"] for r in got} == {31}
    assert sliding_epochs(epoch(20), ["k"]).count() == 0


def test_epoch_overlap_and_gap(spark):
    sig = spark.range(10).select(F.lit("p").alias("k"), F.col("id").cast("double").alias("time"), F.lit(1.0).alias("x"))
    schema = "k string, condition string, ordinal int, start double, stop double"
    ev = spark.createDataFrame([("p", "c", 0, 2.0, 5.0), ("p", "c", 1, 5.0, 7.0)], schema)
    assert epoch_by_events(sig, ev, ["k"]).where("time = 5").count() == 2
    ev = spark.createDataFrame([("p", "c", 0, 0.0, 1.0), ("p", "c", 1, 100.0, 101.0), ("p", "c", 2, 2.0, 3.0)], schema)
    assert {r["epoch_id"] for r in epoch_by_events(sig, ev, ["k"]).select("epoch_id").distinct().collect()} == {"c_0", "c_2"}


def test_small_goldens(spark):
    df = spark.createDataFrame([("p", float(i), v) for i, v in enumerate([0.0, 1.0, 4.0, 9.0])], "k string, time double, x double")
    assert {r["x"] for r in reject_samples(df, ["k"], ["x"], "gradient", 3.0).collect()} == {0.0, 1.0}
    flat = df.withColumn("x", F.lit(5.0))
    assert {r["x"] for r in tddr(flat, ["k"], "x").collect()} == {5.0}
    ramp = df.withColumn("x", F.col("time") * 2)
    assert sorted(r["x"] for r in tddr(ramp, ["k"], "x").collect())[0] == 0.0
    b = spark.createDataFrame([("p", float(i), v) for i, v in enumerate([1.0, 3.0, 5.0, 7.0])], "k string, time double, x double")
    assert sorted(r["x"] for r in baseline_correct(b, ["k"], ["x"], 2.0, 1.0).collect()) == [-1, 1, 3, 5]
    e = spark.createDataFrame([("p", v) for v in (0.0, 1.0, 2.1, 3.0)], "k string, time double")
    m = {r["metric"]: r["value"] for r in interval_metrics(e, ["k"], "time", "time").collect()}
    assert m["SDNN"] == pytest.approx(100) and m["RMSSD"] == pytest.approx(158.11, abs=0.01)
    a = spark.createDataFrame([("p", "L", 1.0), ("p", "R", math.e)], "k string, channel string, power double")
    assert asymmetry(a, ["k"], [("L", "R")]).first()["asymmetry"] == pytest.approx(1)
    assert asymmetry(a, ["k"], [("L", "R")], "subtraction").first()["asymmetry"] == pytest.approx(1 - math.e)
    p = spark.createDataFrame([(1, "a", 2, 9.0), (1, "a", 1, 1.0)], "i int, p string, o int, v double")
    assert pivot_long_to_wide(p, ["i"], "p", "v", ["o"]).first()["a"] == 1.0
    phys = spark.createDataFrame([("t", 1.0), ("u", 1.0)], "trial_id string, v double")
    lab = spark.createDataFrame([("t", 5.0, 5.0), ("u", None, 4.0)], "trial_id string, valence double, arousal double")
    two = {(r["epoch_id"], r["condition"]) for r in bin_by_labels(phys, lab).collect()}
    assert two == {("t", "valence_high"), ("t", "arousal_high"), ("u", "valence_low"), ("u", "arousal_low")}
    three = {r["condition"] for r in bin_by_labels(phys, lab, neutral_band=1.0).where("epoch_id = 't'").collect()}
    assert three == {"valence_neutral", "arousal_neutral"}


def test_tree_with_a_jump(spark):
    rows = ["Title: x", "Level: 1", "a: 1", "Level: 3", "b: 2", "Level: 2", "c: 3"]
    data = [("d", i, 0, *[s.strip() for s in r.split(":")]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id string, line_no int, pos int, key string, value string")
    nodes = {r["node_id"]: r for r in build_tree(df, "Level").collect()}
    entries = {r["entry"]: r for r in nodes.values() if r["entry"] and r["entry"] != "Level"}
    # the level-3 node is detached, its entry stays with the level-1 node; level 2 then closes one node
    assert entries["a"]["parent_id"] == entries["b"]["parent_id"]
    assert nodes[entries["a"]["parent_id"]]["level"] == 1
    assert not any(r["entry"] == "Level" and r["value"] == "3" for r in nodes.values())
    assert entries["Title"]["parent_id"] == 0


def stacked(levels, leaves):
    """Nodes of one document by an explicit stack: (level, entry, ordinal, parent's number, last number below) by number."""
    root, first = {"kids": []}, {"kids": [], "level": 0}
    root["kids"].append(first)
    stack, was, lost = [root, first], None, set()
    for k, (level, own) in enumerate(zip(levels, leaves)):
        if level is not None:
            node = {"kids": [{"entry": f"L{level}"}]}
            if was is None or level == was + 1:
                stack[-1]["kids"].append(node)
                stack.append(node)
            elif level <= was:
                down = was - level
                while down and len(stack) > 2:
                    stack.pop()
                    down -= 1
                stack.pop()
                stack[-1]["kids"].append(node)
                stack.append(node)
            was = level
        stack[-1]["kids"] += [{"entry": x} for x in own]
    out, number = {}, 0
    if not any(k.get("entry", "").startswith("L") for k in first["kids"]):
        first["kids"].insert(0, {"entry": "L1"})
        shift = 0
    else:
        shift = 1

    def walk(node, depth, parent, ordinal):
        nonlocal number
        own = number
        number += 1
        if own == 0:
            number += shift
        for k, kid in enumerate(node.get("kids", [])):
            walk(kid, depth + 1, own, k)
        out[own] = (depth, node.get("entry"), ordinal, parent, number - 1)

    for k, top in enumerate(root["kids"]):
        walk(top, 0, None, k)
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_trees_by_a_stack(spark, hot, request):
    if hot:
        request.getfixturevalue("small_groups")
    draw, docs, rows = random.Random(5), {}, []
    for doc in [*range(12), None]:
        levels, leaves, at = [None] if draw.random() < 0.5 else [], [], 0
        for _ in range(draw.randint(0, 90)):
            at = max(0, at + draw.choice([1, 1, 1, 1, 0, -1, -2, -5, 2, 4]))
            levels.append(at)
        leaves = [[f"x{draw.randint(0, 9)}" for _ in range(draw.randint(0, 3))] for _ in levels]
        docs[doc], n = (levels, leaves), 0
        for level, own in zip(levels, leaves):
            for entry, value in ([("Level", str(level))] if level is not None else []) + [(x, "v") for x in own]:
                rows.append((doc, n, 0, entry, value))
                n += 1
    frame = spark.createDataFrame(rows, "doc_id int, line_no int, pos int, key string, value string").repartition(3)
    tree = build_tree(frame, "Level")
    plan = tree._jdf.queryExecution().toString()
    assert "InPandas" not in plan
    got = {}
    for r in tree.collect():
        entry = r["entry"] if r["entry"] != "Level" else f"L{r['value']}"
        got.setdefault(r["doc_id"], {})[r["seq"]] = (r["level"], entry, r["ordinal"], r["parent_id"], r["subtree_end"])
    for doc, (levels, leaves) in docs.items():
        if any(x is not None for x in levels) or any(leaves):
            assert got[doc] == stacked(levels, leaves), doc


def test_guards(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k int, x double")
    with pytest.raises(ValueError, match="null or NaN"):
        strict_guard(df, ["x"])
    with pytest.raises(ValueError, match="missing columns"):
        strict_guard(df, ["y"])
    with pytest.raises(ValueError):
        row_filter(df, "k", 7, strict=True)
    bad = spark.createDataFrame([([1, 2], [1])], "a array<int>, b array<int>")
    with pytest.raises(Exception, match="differ in length"):
        flatten_lists(bad).collect()


def test_selectors():
    cols = ["t", "Fp1", "Fp2", "EKG", "short_1"]
    assert resolve_selector("2:3", cols) == ["Fp1", "Fp2"]
    assert resolve_selector("2:-1 -EKG", cols) == ["Fp1", "Fp2"]
    assert resolve_selector("-1", cols) == ["short_1"]
    assert resolve_selector("fp", cols) == ["Fp1", "Fp2"]
    assert resolve_selector("FP1", cols) == ["Fp1"]
    assert resolve_selector("nothing", cols) == []


def test_globs():
    import re

    for glob, yes, no in (("a*c", "abbc", "abbd"), ("x?z", "xyz", "xz"), ("[ab]1", "b1", "c1"), ("[!a]1", "c1", "a1"), ("a.b", "a.b", "axb")):
        assert re.match(glob_to_regex(glob), yes) and not re.match(glob_to_regex(glob), no)


def test_correlation_needs_two(spark):
    with pytest.raises(ValueError):
        correlation_matrix(spark.range(3), ["id"])


def tau_b(x, y):
    dx, dy = np.sign(np.subtract.outer(x, x)), np.sign(np.subtract.outer(y, y))
    return (dx * dy).sum() / math.sqrt((dx != 0).sum() * (dy != 0).sum())


def test_kendall_with_heavy_values(spark):
    rng = np.random.default_rng(9)
    x = np.where(rng.random(900) < 0.6, 2.0, rng.integers(0, 6, 900).astype(float))
    y = np.round(rng.normal(size=900) + 0.2 * x, 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    for strip in (7, 40, 100_000):
        assert kendall(df, "x", "y", strip=strip).first()["tau"] == pytest.approx(tau_b(x, y))


def test_spearman_over_complete_pairs(spark):
    rng = np.random.default_rng(3)
    a, c = rng.integers(0, 20, 300).astype(float), rng.normal(size=300)
    b = [None if k % 3 == 0 else float(v) for k, v in enumerate(a + rng.normal(size=300))]
    df = spark.createDataFrame([(float(x), y, float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    got = {r["feature"]: r for r in correlation_matrix(df, ["a", "b", "c"], "spearman").collect()}
    t = pd.DataFrame({"a": a, "b": b, "c": c}, dtype=float)
    for p, q in (("a", "b"), ("a", "c"), ("b", "c")):
        both = t[[p, q]].dropna()
        assert got[p][q] == pytest.approx(both[p].rank().corr(both[q].rank()))


def test_spearman_of_millions_of_rows(spark):
    df = spark.range(2_400_000).selectExpr("cast(id % 3 AS double) AS a", "cast((id % 3) * (id % 3) AS double) AS b", "cast(-(id % 3) AS double) AS c")
    got = {r["feature"]: r for r in correlation_matrix(df, ["a", "b", "c"], "spearman").collect()}
    assert got["a"]["b"] == pytest.approx(1.0) and got["a"]["c"] == pytest.approx(-1.0)


def test_r_peaks_without_keys(spark):
    from sigstat.operators.filters import detect_r_peaks

    time = np.arange(4000) / 100
    beat = np.exp(-(((time % 0.83) - 0.4) ** 2) / 0.0004) + 0.15 * np.exp(-(((time % 0.83) - 0.6) ** 2) / 0.003)
    df = spark.createDataFrame([("k", float(t), float(v)) for t, v in zip(time, beat)], "k string, time double, x double")
    keyed, bare = detect_r_peaks(df, ["k"], "x", 100.0), detect_r_peaks(df.drop("k"), [], "x", 100.0)
    assert [r["peak_sample"] for r in bare.orderBy("peak_sample").collect()] == [r["peak_sample"] for r in keyed.orderBy("peak_sample").collect()]


def test_is_ordinal_edges(spark):
    from sigstat.operators.models import is_ordinal

    df = spark.createDataFrame([(None, 1.0), (None, 2.0 + 1e-12)], "a double, b double")
    assert is_ordinal(df, "a").first()["is_ordinal"] is False
    assert is_ordinal(df, "b").first()["is_ordinal"] is True


def test_tail_probabilities_of_batches(spark):
    """Whole batches against numeric integration; null, nan, zero and infinite statistics have a defined p."""
    rng = np.random.default_rng(3)
    f, d1, d2 = 10 ** rng.uniform(-2, 1.5, 40), rng.integers(1, 30, 40).astype(float), rng.integers(2, 4000, 40).astype(float)
    for p, x, a, b in zip(dist.f_upper(f, d1, d2), f, d1, d2):
        u = np.linspace(0, np.pi / 2, 400_001)[1:-1]
        logs = (b - 1) * np.log(np.cos(u)) + (a - 1) * np.log(np.sin(u))
        w = np.exp(logs - logs.max())
        assert p == pytest.approx(w[u > np.arctan(np.sqrt(a * x / b))].sum() / w.sum(), abs=2e-4)
    assert dist.student_two_sided([0.0, np.inf, -2.0], 7.0).tolist() == pytest.approx([1.0, 0.0, 0.0856194], abs=1e-6)
    assert dist.chi2_upper([0.0, np.inf], 3.0).tolist() == [1.0, 0.0]
    rows = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (float("nan"), 5.0), (1.0, None)], "t double, df double")
    got = [r.p for r in rows.select(dist.p_student(F.col("t"), F.col("df")).alias("p")).collect()]
    assert got[0] == pytest.approx(0.36321746) and got[1:] == [None, None, None]


def test_exact_rank_distribution_is_symmetric_and_whole():
    for n1, n2 in ((1, 1), (2, 5), (8, 40)):
        shares = dist.mann_whitney_shares(n1, n2)
        middle = 1.0 if n1 * n2 % 2 else 1.0 + shares[-1] - (shares[-2] if len(shares) > 1 else 0.0)
        assert 2 * shares[-1] == pytest.approx(middle)


def test_locking_of_many_streams(spark):
    """Three signals, two of one rate, and beats; a null key is a key, an epoch that one stream lacks has no pair with it."""
    n, rate = 40, 40.0
    t = np.arange(n) / rate

    def table(rows, *names):
        return spark.createDataFrame(rows, "pid string, condition string, epoch_id string, time double, " + ", ".join(f"{c} double" for c in names))

    phase = {None: 0.3, "p": 1.1}
    a = table([(p, "c", "c_0", float(x), float(np.cos(10 * np.pi * x)), float(np.sin(10 * np.pi * x))) for p in phase for x in t], "a", "b")
    c = table([("p", "c", "c_0", float(x), float(np.cos(10 * np.pi * x + phase["p"]))) for x in t], "c")
    slow = table([(None, "c", "c_0", 0.0, 1.0)], "s")
    beats = spark.createDataFrame([("p", "c", "c_0", 0.2 * k) for k in range(5)], "pid string, condition string, epoch_id string, time double")
    out = plv_streams([Stream(a, ["a", "b"], rate), Stream(c, ["c"], rate), Stream(slow, ["s"], 1.0), Stream(beats, event="beats")], ["pid"])
    got = {(r.pid, r.stream_a, r.stream_b, r.pair): r.value for r in out.collect()}
    assert {k[1:] for k in got if k[0] == "p" and k[2] < 3} == {(0, 1, "a-c"), (0, 1, "b-c")}
    assert got["p", 0, 1, "a-c"] == pytest.approx(1.0) and got["p", 0, 1, "b-c"] == pytest.approx(1.0)
    # a single sample is a constant phase: five whole turns against it cancel out
    assert got[None, 0, 2, "a-s"] == pytest.approx(0.0, abs=1e-9)
    assert {k for k in got if k[2] == 3} == {(p, i, 3, f"{ch}-beats") for p, i, ch in ((None, 0, "a"), (None, 0, "b"), ("p", 0, "a"), ("p", 0, "b"), ("p", 1, "c"), (None, 2, "s"))}
    with pytest.raises(ValueError):
        plv_streams([Stream(a, ["a"], rate)], ["pid"])


def test_gaussian_folds(spark):
    """Against a fit of every fold; null labels leave one target, a group with all rows of a target has no model."""
    rng = random.Random(5)
    rows = [(k, "abcd"[min(k % 7, 3)], rng.gauss(k % 2, 0.7), rng.gauss(5.0, 0.0) + 1e6, str(k % 2), None if k % 5 == 0 else "hi" if k % 3 else "lo", "all" if k % 7 == 1 else None) for k in range(80)]
    rows += [(100, None, 1.0, 1.0, "0", "hi", None), (101, "a", None, 1.0, "0", "hi", None)]
    df = spark.createDataFrame(rows, "id long, g string, f1 double, f2 double, t1 string, t2 string, t3 string")
    got = {(r.id, r.target): r for r in logo_gaussian(df, ["t1", "t2", "t3"], "g", ["f1", "f2"], ["id"]).collect()}
    used = [r for r in rows if r[1] is not None and r[2] is not None]
    low = max(np.var([r[2] for r in used]), np.var([r[3] for r in used])) * 1e-9
    for at, name in ((4, "t1"), (5, "t2"), (6, "t3")):
        own = [r for r in used if r[at] is not None]
        assert {k[0] for k in got if k[1] == name} == {r[0] for r in own}
        for r in own:
            best = None
            for y in sorted({o[at] for o in own if o[1] != r[1]}):
                fit = np.array([o[2:4] for o in own if o[1] != r[1] and o[at] == y])
                var = fit.var(axis=0) + low
                p = math.log(len(fit)) - ((np.log(var) + (np.array(r[2:4]) - fit.mean(axis=0)) ** 2 / var) / 2).sum()
                best = max(best, (p, y), key=lambda v: v[0]) if best else (p, y)
            assert got[r[0], name].pred == (best[1] if best else None)


def test_overlay_in_rows(spark):
    rows = [("i", "a", 2.0, 1.0), ("i", "a", 1.0, 3.0), ("i", None, 1.0, 5.0), (None, "a", 1.0, 7.0), ("i", "b", None, 1.0), ("i", "b", 1.0, None)]
    df = spark.createDataFrame(rows, "indicator string, g string, year double, value double")
    got = {tuple(r) for r in overlay_long(df, "g").collect()}
    assert got == {("i", "a", "a", 0, 1.0, 3.0), ("i", "a", "a", 1, 2.0, 1.0), ("i", None, None, 0, 1.0, 5.0), (None, "a", "a", 0, 1.0, 7.0)}
    assert overlay_long(df.limit(0), "g").count() == 0


def test_anova_adjusts_the_p_values_it_returns(spark):
    """Sums that differ in their last bits from one evaluation to the next leave no adjusted p null."""
    noisy = F.udf(lambda v: v + random.random() * 1e-6, "double").asNondeterministic()
    df = spark.createDataFrame([(f"g{k % 3}", float(k * 7 % 31), float(k * 5 % 23)) for k in range(120)], "g string, a double, b double")
    rows = anova_oneway(df.select("g", noisy("a").alias("a"), noisy("b").alias("b")), ["a", "b"], "g", apply_fdr=True).collect()
    plain = {r.dv: r.p for r in anova_oneway(df, ["a", "b"], "g").collect()}
    low, high = sorted(plain, key=plain.get)
    want = {low: min(2 * plain[low], plain[high]), high: plain[high]}
    assert len(rows) == 2 and all(r.p is not None and abs(r.p - want[r.dv]) < 1e-4 for r in rows), rows
