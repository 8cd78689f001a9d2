"""The two-level paths give what the one-level windows give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigstat.operators.events import align_events
from sigstat.operators.filters import detect_peaks, filter_signal
from sigstat.operators.inference import fdr_bh
from sigstat.operators.windows import baseline_correct, tddr
from sigstat.plans.asof import asof_join
from sigstat.plans.ordered import exact_quantiles, mid_ranks, ordered_scan
from sigstat.plans.skew import BLOCK, find_hot_keys, with_blocks


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    data = []
    for k, n in (("hot", 400), ("warm", 60), ("cold", 7), ("one", 1)):
        t = np.sort(rng.integers(0, max(3, n // 2), n))
        for i in range(n):
            x = None if rng.random() < 0.2 else float(np.round(rng.normal(), 3))
            data.append((k, float(t[i]), i, x))
    return spark.createDataFrame(data, "k string, t double, i int, x double").repartition(5).cache()


def collect(df, *by):
    def tidy(v):
        return round(v, 9) + 0.0 if isinstance(v, float) else v

    return sorted((tuple(tidy(v) for v in r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def close(a, b):
    assert len(a) == len(b)
    for r, s in zip(a, b):
        for u, v in zip(r, s):
            if isinstance(u, float) and isinstance(v, float):
                assert u == pytest.approx(v, abs=1e-9)
            else:
                assert u == v


@pytest.mark.parametrize("size", [20, 55])
def test_ordered_scan(rows, size):
    kw = dict(
        index="idx", size="n", lag={"lag": "x"}, lead={"lead": "x"}, cumsum={"cs": "x"}, ffill={"ff": "x"}, bfill={"bf": "x"},
        cummin_back={"mb": "x"},
    )
    hot = find_hot_keys(rows, ["k"], ["t", "i"], rows=size)
    assert hot is not None and ("hot",) in hot.rows
    close(
        collect(ordered_scan(rows, ["k"], ["t", "i"], hot=None, **kw)),
        collect(ordered_scan(rows, ["k"], ["t", "i"], hot=hot, **kw)),
    )


def test_no_hot_keys(rows):
    assert find_hot_keys(rows, ["k"], "t") is None


def test_without_keys(rows):
    hot = find_hot_keys(rows, [], ["t", "k", "i"], rows=20)
    kw = dict(index="idx", cumsum={"cs": "x"})
    close(collect(ordered_scan(rows, [], ["t", "k", "i"], hot=None, **kw)), collect(ordered_scan(rows, [], ["t", "k", "i"], hot=hot, **kw)))


def block_sizes(df, keys, order, size):
    hot = find_hot_keys(df, keys, order, rows=size)
    return hot, [r[0] for r in with_blocks(df, hot, order).groupBy(*keys, BLOCK).count().select("count").collect()]


def test_text_order(spark):
    df = spark.range(3000).selectExpr("'k' AS k", "concat('v', lpad(id, 5, '0')) AS epoch_id", "cast(id AS double) AS x")
    hot, sizes = block_sizes(df, ["k"], ["epoch_id"], 100)
    assert len(sizes) > 20 and max(sizes) <= 400 and sum(sizes) == 3000
    got = ordered_scan(df, ["k"], ["epoch_id"], index="i", hot=hot)
    assert got.where("i <> x").count() == 0


def test_constant_first_column(spark):
    df = spark.range(2000).selectExpr("'k' AS k", "0 AS a", "id AS b")
    hot, sizes = block_sizes(df, ["k"], ["a", "b"], 100)
    assert max(sizes) <= 400
    assert ordered_scan(df, ["k"], ["a", "b"], index="i", hot=hot).where("i <> b").count() == 0


def test_ties_are_cut(spark):
    df = spark.range(2000).selectExpr("'k' AS k", "0 AS a", "id AS payload")
    hot, sizes = block_sizes(df, ["k"], ["a"], 100)
    assert max(sizes) <= 400
    assert sorted(r.i for r in ordered_scan(df, ["k"], ["a"], index="i", hot=hot).collect()) == list(range(2000))


def test_blocks_do_not_grow_with_the_table(spark):
    df = spark.range(40 * 50).selectExpr("id % 40 AS k", "id AS t")
    hot, sizes = block_sizes(df, ["k"], ["t"], 20)
    assert len(hot.rows) == 40 and max(sizes) <= 50 and len(sizes) > 60


def test_null_keys_and_order(spark):
    data = [(k, t, float(t or 0)) for k in ("a", None) for t in [None, *range(120)]]
    df = spark.createDataFrame(data, "k string, t int, x double")
    kw = dict(index="i", size="n", cumsum={"c": "x"}, lag={"p": "x"})
    hot = find_hot_keys(df, ["k"], ["t"], rows=20)
    assert sorted(hot.rows, key=str) == [("a",), (None,)]
    close(collect(ordered_scan(df, ["k"], ["t"], hot=None, **kw)), collect(ordered_scan(df, ["k"], ["t"], hot=hot, **kw)))


def test_plan_does_not_multiply(spark, small_groups):
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr("l_suppkey AS k", "l_orderkey AS t", "l_linenumber AS i", "l_quantity AS x")

    def scans(df):
        return len(re.findall(r"FileScan", df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]))

    args = (rows, ["k"], "x", ["t", "i"])
    assert scans(tddr(*args)) <= 2 * scans(tddr(*args, hot=None))


def test_null_groups_stay(spark):
    from sigstat.operators.select import reject_samples
    from sigstat.operators.windows import standardise, zscore_flags

    df = spark.createDataFrame([(k, float(i), float(i % 3)) for k in ("a", None) for i in range(4)], "k string, time double, x double")
    assert standardise(df, ["k"], ["x"]).count() == zscore_flags(df, ["k"], ["x"]).count() == 8
    assert baseline_correct(df, ["k"], ["x"], 2.0, 1.0, ["time"]).count() == 8
    assert reject_samples(df, ["k"], ["x"], "zscore", 3.0).count() == 8


def test_quantiles_and_ranks(rows, small_groups):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    close(collect(exact_quantiles(rows, ["k"], "x", probs, hot=None)), collect(exact_quantiles(rows, ["k"], "x", probs)))
    close(collect(mid_ranks(rows, ["k"], "x", hot=None)), collect(mid_ranks(rows, ["k"], "x")))


def test_asof(rows, small_groups):
    right = rows.where("i % 3 = 0").select("k", F.col("t").alias("rt"), "i")
    left = rows.select("k", "t", F.col("i").alias("li"))
    args = (left, right, ["k"], "t", "rt", ["rt", "i"], "before", "after")
    close(collect(asof_join(*args, hot=None)), collect(asof_join(*args)))


def test_operators(rows, small_groups):
    full = rows.withColumn("x", F.coalesce("x", F.lit(0.5)))
    for run in (
        lambda hot: tddr(full, ["k"], "x", ["t", "i"], hot=hot),
        lambda hot: baseline_correct(full, ["k"], ["x"], 30.0, 1.0, ["t", "i"], hot=hot),
        lambda hot: fdr_bh(full.select("k", "i", (F.abs("x") / 5).alias("p")), "p", ["k"], hot=hot),
        lambda hot: detect_peaks(full, ["k"], "x", 1.0, distance=4.0, time="t", order=["t", "i"], hot=hot),
        lambda hot: filter_signal(full, ["k"], "x", 0.1, 0.3, 1.0, order=["t", "i"], hot=hot),
    ):
        close(collect(run(None)), collect(run("auto")))


def test_interval_join_has_an_equality(spark):
    from sigstat.plans.ranges import interval_join

    p = spark.range(100).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("t"))
    iv = spark.createDataFrame([(1, 3.0, 50.0), (1, 10.0, 12.0), (1, 99.0, 98.0)], "k int, a double, b double")
    out = interval_join(p, iv, ["k"], "t", "a", "b")
    assert out.count() == 48 + 3
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_align_conflict(spark, small_groups):
    pairs = spark.createDataFrame(
        [("p", 0, "C", "1", 100.0, "2", 110.0), ("p", 1, "C", "1", 100.2, "2", 110.2), ("p", 2, "D", "9", 130.0, "2", 140.0)],
        "k string, ordinal int, condition string, start_trigger string, start_onset double, stop_trigger string, stop_onset double",
    )
    trig = spark.createDataFrame(
        [("p", 5.0, 1.0), ("p", 5.6, 1.0), ("p", 15.0, 2.0), ("p", 15.6, 2.0), ("p", 44.0, 2.0)], "k string, time double, trigger double"
    )
    got = {r["ordinal"]: (r["start"], r["stop"]) for r in align_events(pairs, trig, ["k"], strict=False).collect()}
    # offset 95; the second pair must take what the first left
    assert got[0] == (5.0, 15.0) and got[1] == (5.6, 15.6)
    # trigger 9 was not recorded: the nearest trigger (44.0 of kind 2, tree onset 110) gives the local offset
    assert got[2] == (pytest.approx(130 - (110 - 44.0)), 44.0)
