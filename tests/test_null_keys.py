"""A null key is a key like any other: its rows give what the same rows give under a name."""

import random

import pytest

from sigstat.operators.classify import permute_labels
from sigstat.operators.events import align_events
from sigstat.operators.filters import detect_peaks, detect_r_peaks, suppress_near
from sigstat.operators.inference import fdr_bh
from sigstat.operators.reshape import bin_by_labels
from sigstat.operators.segment import epoch_by_events
from sigstat.operators.select import apply_corrections


def both(rows):
    """The rows under the key ``a`` and under null."""
    return [("a", *r) for r in rows] + [(None, *r) for r in rows]


def sides(df):
    rows = [tuple(r) for r in df.collect()]
    named = sorted((r[1:] for r in rows if r[0] == "a"), key=repr)
    return named, sorted((r[1:] for r in rows if r[0] is None), key=repr)


def same(df):
    named, null = sides(df)
    assert named and named == null
    return named


def test_peaks(spark):
    wave = [(i, i / 10, float(v)) for i, v in enumerate([0, 2, 0, 3, 0, 1, 0, 5, 0, 4, 0, 1, 0, 2])]
    df = spark.createDataFrame(both(wave), "k string, seq int, time double, x double")
    assert len(same(detect_peaks(df, ["k"], "x", order=["seq"]))) == 6
    assert [r[1] for r in same(detect_peaks(df, ["k"], "x", 1.0, distance=4.0, order=["seq"]))] == [11, 3, 7]
    ecg = [(i, i / 20, 9.0 if i % 30 == 15 else 0.1 * (i % 3)) for i in range(200)]
    same(detect_r_peaks(spark.createDataFrame(both(ecg), "k string, seq int, time double, x double"), ["k"], "x", 20.0, order=["seq"]))


def test_adjusted_p(spark):
    df = spark.createDataFrame(both([(1, 0.01), (2, 0.04), (3, None), (4, 0.03)]), "k string, i int, p double")
    named = same(fdr_bh(df, "p", ["k"]))
    assert {r[0]: r[1] for r in named} == {1: pytest.approx(0.03), 2: pytest.approx(0.04), 3: None, 4: pytest.approx(0.04)}


def test_permuted_labels(spark):
    df = spark.createDataFrame([(g, i, f"c{i % 3}") for g in ("a", None) for i in range(9)], "g string, i int, y string")
    out = permute_labels(df, "y", "g", ["i"], 4)
    assert out.count() == 72
    per = {(r["g"], r["perm"], r["y"]): r["count"] for r in out.groupBy("g", "perm", "y").count().collect()}
    assert set(per.values()) == {3} and len(per) == 24


def test_epochs_of_guessed_units(spark):
    signal = spark.createDataFrame(both([(float(i), i) for i in range(20)]), "k string, time double, x int")
    events = spark.createDataFrame(both([("go", 0, 2000.0, 5000.0), ("go", 1, 9000.0, 190000.0)]), "k string, condition string, ordinal int, start double, stop double")
    assert len(same(epoch_by_events(signal, events, ["k"], units="auto"))) == 4 + 11


def test_aligned_events(spark):
    pairs = [(0, "go", "1", 10.0, "2", 20.0), (1, "go", "1", 30.0, "2", 40.0), (2, "go", "9", 50.0, "2", 41.0)]
    times = [(4.0, 1), (14.0, 2), (24.5, 1), (34.0, 2), (35.5, 2)]
    p = spark.createDataFrame(both(pairs), "k string, ordinal int, condition string, start_trigger string, start_onset double, stop_trigger string, stop_onset double")
    t = spark.createDataFrame(both(times), "k string, time double, trigger int")
    named = same(align_events(p, t, ["k"]))
    assert all(start is not None and stop is not None for _, _, start, stop in named)


def test_corrections(spark):
    base = spark.createDataFrame(both([(1,), (2,)]) + [("b", 3)], "k string, v int")
    fixed = spark.createDataFrame([("a", 7), (None, 7)], "k string, v int")
    assert same(apply_corrections(base, fixed, ["k"])) == [(7,)]


def test_binned_labels(spark):
    rows = spark.createDataFrame(both([("t", 1.0)]), "k string, trial_id string, v double")
    labels = spark.createDataFrame(both([("t", 6.0, 1.0)]), "k string, trial_id string, valence double, arousal double")
    assert len(same(bin_by_labels(rows, labels, keys=["k"]).select("k", "epoch_id", "condition", "value"))) == 2


@pytest.mark.parametrize("shape", ["ramp", "noise", "ties"])
def test_suppression_in_rounds(spark, shape):
    draw = random.Random(3)
    pos = sorted(draw.sample(range(0, 1200, 2), 300))
    height = {"ramp": lambda k: float(k), "noise": lambda k: draw.random(), "ties": lambda k: float(draw.randint(0, 2))}[shape]
    rows = [(p, height(k)) for k, p in enumerate(pos)]
    kept = []
    for p, _ in sorted(rows, key=lambda r: (r[1], r[0]), reverse=True):
        if all(abs(p - q) >= 9 for q in kept):
            kept.append(p)
    df = spark.createDataFrame(both(rows), "k string, peak_sample long, __height double")
    got = same(suppress_near(df, ["k"], 9, halo=9, block=30))
    assert sorted(r[0] for r in got) == sorted(kept)
