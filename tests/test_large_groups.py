"""Operators over groups above the block size: the same rows as in one window, and few copies of them written."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigstat.operators import classify, tree
from sigstat.operators.classify import permute_labels
from sigstat.operators.tree import build_tree, node_onsets, node_property, reparent_by_onset
from sigstat.plans import ordered, skew


def entries(spark, seed, docs=3, n=260, wild=0.1):
    """Markers and leaves; levels climb, fall and sometimes jump, also as the first of a block."""
    rng = np.random.default_rng(seed)
    rows = []
    for doc in [None, *range(docs)]:
        level = 0
        for i in range(n if doc != 0 else 7):
            if rng.random() < 0.4:
                level = max(0, level + int(rng.choice([-2, -1, 0, 1]))) + (2 if rng.random() < wild else 0)
                rows.append((doc, i // 10, i % 10, "Level", str(level)))
            else:
                key = str(rng.choice(["OnsetTime", "Price", "x"]))
                rows.append((doc, i // 10, i % 10, key, str(int(rng.integers(0, 9)))))
    return spark.createDataFrame(rows, "doc_id long, line_no int, pos int, key string, value string").repartition(4)


def tidy(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def written(monkeypatch):
    """Rows of every table written on the way."""
    counts, write = [], ordered.materialise

    def count(df, name="stage"):
        out = write(df, name)
        counts.append(out.count())
        return out

    for module in (ordered, skew, tree, classify):
        monkeypatch.setattr(module, "materialise", count)
    return counts


@pytest.mark.parametrize("seed", range(2))
def test_tree_of_blocks(spark, monkeypatch, seed):
    rows = entries(spark, seed)
    small = tidy(build_tree(rows, "Level"))
    nodes = build_tree(rows, "Level")
    plain = [tidy(f(nodes)) for f in (node_onsets, lambda t: node_property(t, ["Price", "x"]), reparent_by_onset)]
    monkeypatch.setattr(skew, "BLOCK_ROWS", 20)
    cut = build_tree(rows, "Level")
    assert tidy(cut) == small
    assert [tidy(f(nodes)) for f in (node_onsets, lambda t: node_property(t, ["Price", "x"]), reparent_by_onset)] == plain


def test_block_without_marker(spark, monkeypatch):
    """Blocks of leaves alone, before the first marker and after a jump."""
    keys = ["x"] * 70 + ["Level"] + ["x"] * 90 + ["Level", "Level", "Level"] + ["x"] * 80
    levels = iter(["3", "9", "4", "2"])
    rows = [("d", i, 0, k, next(levels) if k == "Level" else "1") for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "doc_id string, line_no int, pos int, key string, value string")
    want = tidy(build_tree(df, "Level"))
    monkeypatch.setattr(skew, "BLOCK_ROWS", 20)
    assert tidy(build_tree(df, "Level")) == want


def test_tree_writes_its_entries_once(spark, small_groups, written):
    rows = entries(spark, 9, docs=1, n=2000, wild=0.0).where("doc_id is null")
    assert rows.count() == 2000
    build_tree(rows, "Level").count()
    assert sum(written) < 4 * 2000 and sum(c >= 2000 for c in written) < 4


def test_trees_cut_wide_rows_into_smaller_blocks(spark, monkeypatch):
    """Far below the block size of other series, and blocks of a node table are ranges of its numbers (F3 to F9)."""
    rows = entries(spark, 4, docs=2, n=400)
    plain = build_tree(rows, "Level")
    calls = (node_onsets, lambda t: node_property(t, ["Price", "x"]), lambda t: tree.select_branches(t, ["x: [1-4]"]), reparent_by_onset,
             lambda t: tree.questionnaire(t, "Price", x="x", selectors=["x: [1-4]"]).drop("mean", "sd"))
    want = [tidy(plain), *[tidy(f(plain)) for f in calls]]
    sizes, cut = [], ordered.numbered_blocks

    def count(*args):
        out = cut(*args)
        sizes.append(max(r["count"] for r in out.groupBy(*args[1].keys, skew.BLOCK).count().collect()))
        return out

    monkeypatch.setattr(ordered, "numbered_blocks", count)
    monkeypatch.setattr(tree, "BLOCK_ROWS", 30, raising=False)
    nodes = build_tree(rows, "Level").cache()
    assert [tidy(nodes), *[tidy(f(nodes)) for f in calls]] == want
    assert sizes and max(sizes) <= 60


def test_tree_takes_the_depth_before_from_its_one_pass(spark, monkeypatch, small_groups):
    """No pass and no copy of the nodes for the depth of the node before (F4 to F8)."""
    passes, scan = [], tree.ordered_scan

    def count(df, keys, *args, **kw):
        passes.append((tuple(keys), kw.get("hot")))
        return scan(df, keys, *args, **kw)

    monkeypatch.setattr(tree, "ordered_scan", count)
    rows = entries(spark, 9, docs=1, n=2000, wild=0.0).where("doc_id is null")
    build_tree(rows, "Level").count()
    assert [k for k, _ in passes] == [("doc_id", "__l"), ("doc_id", "parent_id")] and {h for _, h in passes} == {ordered.STORED}


def test_depth_before_each_node(spark, monkeypatch):
    """The depth that the entries' pass gives is that of the kept marker before, within and across blocks."""
    rows = entries(spark, 11, docs=2, n=300, wild=0.2)
    for size in (skew.BLOCK_ROWS, 20):
        monkeypatch.setattr(skew, "BLOCK_ROWS", size)
        hot = ordered.once(rows, ["doc_id"], ordered.AUTO, size)
        marks = tree._open_nodes(rows, "Level", ["line_no", "pos"], hot).where("__node is not null")
        got = sorted((tuple(r) for r in marks.select(F.coalesce("doc_id", F.lit(-1)), "__node", "__depth", "__last").collect()))
        assert len(got) > 200
        for was, now in zip([None, *got], got, strict=False):
            assert now[3] == (was[2] if was and was[0] == now[0] else None)


def test_leaves_move_with_their_value_only(spark, monkeypatch):
    """Of a leaf only what answers goes through the exchange (F4 to F8)."""
    nodes = build_tree(entries(spark, 5, docs=1, n=80), "Level").cache()
    seen, scan = [], tree.ordered_scan
    monkeypatch.setattr(tree, "ordered_scan", lambda df, *a, **kw: (seen.append(df), scan(df, *a, **kw))[1])
    out = node_property(nodes, ["Price"])
    assert out.columns == [*tree.NODE, "prop_Price"] and out.count() == nodes.where("is_structural").count()
    leaves = seen[0].where("not is_structural")
    assert leaves.where("entry = 'Price' and value is not null").count() == leaves.count() > 0
    assert leaves.where("coalesce(node_id, parent_id, level, ordinal, subtree_end) is not null").count() == 0


def test_permutations_write_no_copies(spark, small_groups, written):
    df = spark.range(600).selectExpr("id", "id % 2 AS g", "id % 5 AS y")
    out = permute_labels(df, "y", "g", ["id"], 4)
    assert out.count() == 2400 and max(written) <= 600
    want = {tuple(r) for r in permute_labels(df, "y", "g", ["id"], 4, hot=None).select("perm", "g", "id", "y").collect()}
    assert {tuple(r) for r in out.select("perm", "g", "id", "y").collect()} == want


@pytest.mark.parametrize("size", [2_000_000, 25])
def test_renumbering_orders_siblings_alone(spark, monkeypatch, size):
    """No pass over whole documents for numbers and ends, no parents beside levels that stay; numbers as a walk gives them (F2, F3)."""
    rows = entries(spark, 3, docs=2, n=150, wild=0.15).cache()
    nodes = build_tree(rows, "Level").cache()
    assert nodes.agg(F.max("level")).first()[0] > 3
    monkeypatch.setattr(skew, "BLOCK_ROWS", size)
    joined, asof = [], tree.asof_join

    def nested(*_args, **_kw):
        raise AssertionError("all nodes are ordered for their ends")

    monkeypatch.setattr(tree, "_nested", nested)
    monkeypatch.setattr(tree, "asof_join", lambda left, right, *a, **kw: (joined.append((left, right)), asof(left, right, *a, **kw))[1])
    out = reparent_by_onset(nodes).collect()
    (left, right), = joined
    levels = [{tuple(r) for r in side.select("doc_id", "level").distinct().collect()} for side in (left, right)]
    assert levels[1] <= levels[0]
    below = {}
    for r in out:
        below.setdefault((r["doc_id"], r["parent_id"]), []).append(r)

    def walk(doc, parent, at):
        for i, r in enumerate(sorted(below.get((doc, parent), []), key=lambda r: (r["is_structural"], r["ordinal"]))):
            assert (r["ordinal"], r["seq"]) == (i, at)
            at = walk(doc, r["node_id"], at + 1) if r["is_structural"] else at + 1
            assert r["subtree_end"] == at - 1
        return at

    docs = {r["doc_id"] for r in out}
    assert sum(walk(doc, None, 0) for doc in docs) == len(out) == nodes.count() and len(docs) == 3


@pytest.mark.parametrize("most", [20_000, 5])
def test_permuted_labels_search_no_cuts(spark, monkeypatch, small_groups, most):
    """Large groups beside small ones and a null one: the rows of one window, without a search for cuts (F1)."""
    rows = [(None if g == 2 else f"g{g}", i % 7 if i % 5 else None, f"i{i}", float(i), f"c{i * i % 4}") for g, n in enumerate((300, 9, 120, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, a int, b string, x double, y string").repartition(4)
    plain = tidy(permute_labels(df, "y", "g", ["a", "b"], 3, 7, ["x"], hot=None))

    def searched(*_args, **_kw):
        raise AssertionError("cuts are searched")

    for module in (ordered, skew):
        monkeypatch.setattr(module, "find_hot_keys", searched)
    monkeypatch.setattr(skew, "MOST_TASKS", most)
    out = permute_labels(df, "y", "g", ["a", "b"], 3, 7, ["x"])
    assert out.columns == ["a", "b", "g", "x", "perm", "y"]
    assert tidy(out) == plain and len(plain) == 3 * 430


def test_scan_of_stored_rows(spark, small_groups, written):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), "id", (F.col("id") * 7 % 11).alias("v"))
    kw = dict(index="i", size="n", cumsum={"s": "v"}, lag={"a": "v"}, lead={"b": "v"})
    got = ordered.ordered_scan(df, ["k"], ["id"], hot=ordered.STORED, **kw)
    assert tidy(got) == tidy(ordered.ordered_scan(df, ["k"], ["id"], hot=None, **kw))
    assert max(written) < 100


def test_memory_of_a_block_of_draws():
    """A block's draws in little memory, each resample summed as a whole."""
    import tracemalloc

    from sigstat.operators.resample import block_sums, numbers

    x, draws = np.random.default_rng(2).normal(size=4096), np.random.default_rng(3).integers(0, 8192, 3000)
    tracemalloc.start()
    swx, swxx = block_sums(x, draws, 77)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6
    ends = np.cumsum(draws)
    for i in (0, 1, 1500, 2999):
        picked = x[(numbers(77, int(ends[i] - draws[i]), int(ends[i])) % np.uint64(len(x))).astype(np.int64)]
        assert swx[i] == pytest.approx(picked.sum()) and swxx[i] == pytest.approx((picked * picked).sum())
