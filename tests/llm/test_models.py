"""Toxicity, quality, mixing and revisits."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigstat.llm import mixing, quality, toxicity, warc

# ---- toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton():
    terms = [("loser", False), ("moron", False), ("scum", False), ("trash", False), ("tras", True), ("lowei", True)]
    machine = toxicity.automaton(terms)
    words = ["".join(w) for n in (3, 4) for w in itertools.product("losertam", repeat=n)][::7]
    for term, _ in terms:
        for k in range(len(term) + 1):
            words += [term[:k] + term[k + 1 :], term[:k] + "x" + term[k:], term[:k] + "x" + term[k + 1 :], term[:k] + "xy" + term[k:], term + "xyz"]
    text = "\n".join(words)
    whole, start, end, _ = toxicity.words_of([text])
    hit, code = machine.run(toxicity.pretokens.points(whole), start, end)
    got = dict(zip(hit.tolist(), code.tolist()))
    found = [whole[a:b] for a, b in zip(start, end)]
    for k, word in enumerate(found):
        best = (9, 0)
        for n, (term, stem) in enumerate(terms):
            most = 1 if len(term) >= toxicity.FUZZY else 0
            ways = [word] if not stem else [word[:j] for j in range(len(word) + 1)]
            d = min(distance(term, w) for w in ways)
            if d <= most:
                best = min(best, (d, n))
        assert got.get(k, -1) == (2 * best[1] + best[0] if best[0] < 9 else -1), word


def test_quotation_counts_apart():
    machine = toxicity.automaton([("moron", False)])
    sizes, found = toxicity.hits(machine, ['you moron', 'they said "what a moron" again', "", "mor0n moron"])
    assert sizes.tolist() == [2, 6, 0, 2]
    assert found[0].tolist() == [0, 1, 3, 3] and found[3].tolist() == [False, True, False, False]
    x = toxicity.features(sizes, *found, np.array([3.0, 1.0]))
    assert x[:, 1].tolist() == [3.0, 0.0, 0.0, 4.0] and x[:, 4].tolist() == [0.0, 3.0, 0.0, 0.0]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = toxicity.op5_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_odd(spark, odd, odd_rows, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(k, 1, k % 2) for k in range(15)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        model = toxicity.fit(odd, labels)
        rows = toxicity.score(odd, model).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.accepted(odd, labels).columns == odd.columns
        assert toxicity.accepted(empty, labels).count() == 0


# ---- quality


def reference_model(texts):
    """Kneser-Ney by its formulas, over dictionaries."""
    order = quality.ORDER
    tables = {order: collections.Counter()}
    for t in texts:
        line = [0] * (order - 1) + [(ord(c) + 1 if ord(c) < quality.OWN else quality.OWN + 1 + ord(c) % quality.SHARED) for c in t]
        for i in range(order - 1, len(line)):
            tables[order][tuple(line[i - order + 1 : i + 1])] += 1
    for n in range(order - 1, 0, -1):
        tables[n] = collections.Counter(g[1:] for g in tables[n + 1])
    discount, context = {}, {}
    for n, table in tables.items():
        n1, n2, n3, n4 = (sum(c == k for c in table.values()) for k in (1, 2, 3, 4))
        if n1 and n2 and n3 and n4:
            y = n1 / (n1 + 2 * n2)
            d = [min(max(v, 0.05), k - 0.05) for v, k in zip((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), (1, 2, 3))]
        else:
            d = [0.5] * 3
        discount[n], context[n] = d, collections.defaultdict(lambda: [0, 0.0])
        for g, c in table.items():
            context[n][g[:-1]][0] += c
            context[n][g[:-1]][1] += d[min(c, 3) - 1]

    def p(g):
        n = len(g)
        c = tables[n].get(g, 0)
        less = discount[n][min(c, 3) - 1] if c else 0
        if n == 1:
            total, spare = context[1][()]
            return max(c - less, 0) / total + spare / total / (len(tables[1]) + 1)
        low = p(g[1:])
        if g[:-1] not in context[n]:
            return low
        total, spare = context[n][g[:-1]]
        return max(c - less, 0) / total + spare / total * low

    def mean(t):
        line = [0] * (order - 1) + [(ord(c) + 1 if ord(c) < quality.OWN else quality.OWN + 1 + ord(c) % quality.SHARED) for c in t]
        return sum(math.log(p(tuple(line[i - order + 1 : i + 1]))) for i in range(order - 1, len(line))) / len(t)

    return mean, p, tables


def test_kneser_ney(spark, docs, texts):
    ids = sorted(texts)
    train, test = [texts[k][:900] for k in ids[:40]], [texts[k][:300] for k in ids[40:60]] + ["世界 new", "q"]
    mean, p, tables = reference_model(train)
    seen = next(iter(tables[5]))[:-1]
    assert sum(p((*seen, s)) for (s,) in tables[1]) + p((*seen, 4000)) == pytest.approx(1)
    made = quality.Model(quality.counted(spark.createDataFrame([(t,) for t in train], "text string").repartition(3)))
    rows = spark.createDataFrame([(k, t, "en") for k, t in enumerate(test)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.mean_lp for r in quality.perplexities(rows, made).collect()}
    for k, t in enumerate(test):
        assert got[k] == pytest.approx(mean(t), abs=1e-5)


def test_quality_keeps_clean(spark):
    folder = "/root/testdata/sf0.01"
    rows = quality.op7_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.97
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.05


def test_quality_limits(spark):
    """Limit and decision of every row from its perplexity: the quantile of the language's held-out good rows, else of all."""
    texts = [f"the {w} {k} of the long {w} story" for k in range(40) for w in ("river", "house")]
    rows = [(k, t, "en" if k % 3 else "de") for k, t in enumerate(texts)] + [(900, "the house of the river", "fr"), (901, "zzqx", None), (902, "", "en"), (903, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 7 != 0)) for k, *_ in rows[:80]], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judged(docs, labels, upper=0.9).collect()}
    assert set(got) == {r[0] for r in rows}
    cost = {k: math.log(r.perplexity) for k, r in got.items() if r.n_symbols}
    base = [k for k in range(80) if k % 7 and zlib.crc32(str(k).encode()) % 3 == 1]

    def quantile(values):
        return sorted(values)[math.ceil(0.9 * len(values)) - 1]

    of = {lang: quantile([cost[k] for k in base if rows[k][2] == lang]) for lang in ("en", "de")}
    pooled = quantile([cost[k] for k in base])
    for k, text, lang in rows:
        limit = of.get(lang, pooled) + quality.SLACK / math.sqrt(max(len(text or ""), 1))
        assert got[k].limit == pytest.approx(math.exp(limit))
        assert got[k].kept == (k in cost and cost[k] <= limit)


def test_quality_chunks_by_bytes(spark, monkeypatch):
    """Chunks of few bytes give the same perplexities as one chunk."""
    docs = spark.createDataFrame([(k, "ab cd " * (k + 1), "en") for k in range(30)], "doc_id long, text string, lang string")
    model = quality.Model(quality.counted(docs))
    want = {r.doc_id: r.mean_lp for r in quality.perplexities(docs, model).collect()}
    monkeypatch.setattr(quality, "CHUNKS", 1)
    monkeypatch.setattr(quality, "BYTES", 64)
    assert {r.doc_id: r.mean_lp for r in quality.perplexities(docs, model).collect()} == pytest.approx(want)


def test_quality_odd(spark, odd, odd_rows, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(k, k % 2, 0) for k in range(15)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        rows = quality.judged(odd, labels).collect()
        assert len(rows) == len(odd_rows)
        assert all((r.perplexity is None) == (r.n_symbols == 0) and (r.n_symbols > 0 or not r.kept) for r in rows)
        assert quality.judged(empty, labels).count() == 0
    assert all(r.kept for r in quality.judged(odd, none).collect() if r.n_symbols)


# ---- mixing


def test_fit_reaches_margins():
    rng = np.random.default_rng(2)
    cells = rng.random((3, 4, 2)) + 0.1
    aims = [np.array([0.2, 0.5, 0.3]), np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.6, 0.4])]
    share = mixing.fit(cells, aims)
    for axis, aim in enumerate(aims):
        assert share.sum(axis=tuple(a for a in range(3) if a != axis)) == pytest.approx(aim, abs=1e-6)
    assert mixing.fit(np.zeros((2, 2, 2)), [np.array([0.5, 0.5])] * 3).sum() == 0


def test_expected_margins(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mixed(docs).selectExpr("mix_source", "mix_lang", "mix_tokens * mix_probability AS t").collect()
    total = sum(r.t for r in rows)
    for side, aims in (("mix_source", mixing.TARGETS["source"]), ("mix_lang", mixing.TARGETS["lang"])):
        for value, aim in aims.items():
            assert sum(r.t for r in rows if r[side] == value) / total == pytest.approx(aim, abs=1e-4)
    assert max(r.mix_probability for r in mixing.mixed(docs).collect()) == pytest.approx(1)


def test_mixing_odd(odd, odd_rows, empty):
    rows = mixing.mixed(odd).collect()
    assert len(rows) == len(odd_rows) and {r.mix_source for r in rows} <= {"src0", "*"}
    assert all(isinstance(r.mix_kept, bool) for r in rows)
    kept = mixing.sampled(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.mix_kept for r in rows)
    assert mixing.mixed(empty).count() == mixing.sampled(empty).count() == 0


def test_rest_without_target_is_kept(spark):
    """Null and unknown languages keep their share of the tokens; the named ones keep their proportions."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 5 == 1, "pl").otherwise(F.col("lang"))
    rows = mixing.mixed(docs.withColumn("lang", lang)).collect()
    rest = [r for r in rows if r.mix_lang == mixing.REST]
    assert all(r.mix_probability > 0 for r in rows) and sum(r.mix_kept for r in rest) > 0
    own = sum(r.mix_tokens for r in rest) / sum(r.mix_tokens for r in rows)
    total = sum(r.mix_tokens * r.mix_probability for r in rows)
    for value, aim in mixing.TARGETS["lang"].items():
        want = own if value == mixing.REST else aim * (1 - own)
        assert sum(r.mix_tokens * r.mix_probability for r in rows if r.mix_lang == value) / total == pytest.approx(want, abs=1e-4)


# ---- revisits


def records(spark, rows):
    return spark.createDataFrame(rows, "record_id long, url string, ts long, status int, headers map<string,string>, body string, site string")


def test_revisits(spark):
    day = warc.DAY
    tag = lambda t, **more: {"etag": t} | {k.replace("_", "-"): v for k, v in more.items()}
    rows = [
        (1, "http://www.A.org:80/x/?b=2&utm_source=f&a=1#top", 100, 200, tag('"1"', content_length="5", cache_control="a"), "body", "clash"),
        (2, "https://a.org/x?a=1&b=2", 100, 200, tag('"2"', last_modified="m"), "other", "clash"),
        (3, "a.org/x?a=1&b=2", 100 + 40 * day, 200, None, None, "clash"),
        (4, "http://a.org/x/?a=1&b=2", 100, 304, tag('"1"'), None, None),  # not strictly earlier
        (5, "http://a.org/x/?a=1&b=2", 101, 304, tag('W/"2"', cache_control="b", content_length="0"), None, None),
        (6, "http://a.org/x/?a=1&b=2", 100 + 39 * day, 304, tag('"1"'), None, None),
        (7, "http://a.org/x/?a=1&b=2", 100 + 90 * day, 304, None, None, None),
        (8, "http://b.org/", 101, 304, None, None, None),
        (9, None, 101, 304, None, None, None),
        (10, "http://a.org/x?a=1&b=2", None, 304, None, None, None),
        (11, "http://a.org/x?a=1&b=2", 200, 304, {"last-modified": "m"}, None, None),
        (11, "http://a.org/x?a=1&b=2", 200, 304, {"last-modified": "m"}, None, None),
    ]
    got = {r.record_id: r for r in warc.resolved(records(spark, rows)).collect()}
    said = {k: (r.verdict, r.target_id) for k, r in got.items()}
    none = ("no earlier response", None)
    assert said == {4: none, 5: ("same", 2), 6: ("changed", 2), 7: ("unvalidated", 3), 8: none, 9: none, 10: none, 11: ("same", 2)}
    assert got[5].headers == {"etag": 'W/"2"', "last-modified": "m", "cache-control": "b"}
    assert got[5].digest and got[6].digest is None and got[6].headers is None and got[7].headers == {}
    assert warc.resolved(records(spark, rows)).count() == 9
    assert warc.resolved(records(spark, [])).count() == 0


def test_as_of_brute_force(spark):
    rng = np.random.default_rng(6)
    full = {(f"s{rng.integers(3)}", int(rng.integers(40 * warc.DAY))) for _ in range(150)}
    asked = {(f"s{rng.integers(4)}", int(rng.integers(50 * warc.DAY))) for _ in range(200)} | set(list(full)[:20])
    responses = spark.createDataFrame([(s, t, t) for s, t in full], "site string, ts long, value long")
    got = warc.latest_before(responses, spark.createDataFrame(list(asked), "site string, ts long"), "value").collect()
    want = {(s, t): max((u for r, u in full if r == s and u < t), default=None) for s, t in asked}
    assert {(r.site, r.ts): r.value for r in got} == want


def test_canonical_null(spark):
    assert spark.range(1).select(warc.canonical(F.lit(None).cast("string")).alias("c")).first().c is None
