"""Exact, near and passage duplicates against brute force."""

import collections
import re

import numpy as np
import pytest
import xxhash

from sigstat.llm import components, exact_dedup, fingerprints, simhash, substring_dedup


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard_classes(sets, items, threshold, union):
    where, both = collections.defaultdict(list), collections.Counter()
    for k, s in items.items():
        for x in s:
            where[x].append(k)
    for ks in where.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                both[a, b] += 1
    for (a, b), n in both.items():
        if n >= threshold * (len(items[a]) + len(items[b]) - n):
            union.join(a, b)


# ---- exact


def expected_groups(rows):
    groups = collections.defaultdict(list)
    for doc, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, doc))
    return {key: (min(g)[3], len(g)) for key, g in groups.items()}


def test_exact_odd(odd, odd_rows, empty):
    want = expected_groups([r[:2] for r in odd_rows])
    rows = exact_dedup.groups(odd, carry=["doc_id", "text"]).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        keep, size = want[re.sub("[\x20\x09-\x0d]", "", r.text or "")]
        assert (r.keep_id, r.group_size, r.kept) == (keep, size, r.doc_id == keep)
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _ in want.values())
    assert exact_dedup.groups(empty).count() == exact_dedup.deduplicated(empty).count() == 0


def test_exact_small_filter(odd, odd_rows, monkeypatch):
    """A filter that says "maybe" for every row changes no result."""
    normal = sorted(map(str, exact_dedup.groups(odd).collect()))
    monkeypatch.setattr(exact_dedup, "filter_bits", lambda rows: 8)
    assert sorted(map(str, exact_dedup.groups(odd).collect())) == normal


def test_unique_rows_do_not_shuffle(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    plain = docs.selectExpr("doc_id", "text", "xxhash64(text) AS k")
    bits = exact_dedup.filter_bits(2000)
    maybe = exact_dedup.probed(plain, "k", exact_dedup.repeated(plain.select("k"), "k", bits), bits, "may")
    assert maybe.filter("may").count() < 40


def test_no_python(spark, folder):
    plan = exact_dedup.op4_exact_dedup(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- SimHash


def brute_prints(texts):
    out = []
    for text in texts:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        out.append(sum(1 << k for k in range(64) if sum(v >> k & 1 for v in h) * 2 > len(h)))
    return out


def test_covering():
    rng = np.random.default_rng(3)
    masks = np.array(simhash.masks(), np.int64).view(np.uint64)
    assert len(masks) == 31
    for _ in range(3000):
        flips = rng.choice(64, rng.integers(1, 5), replace=False)
        diff = np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        assert (masks & diff == 0).any()


def test_simhash(spark, folder, texts, sets):
    ids = sorted(texts)
    prints = np.array(brute_prints([texts[k] for k in ids]), np.uint64)
    union = sets(ids)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 4) + i + 1:
            union.join(ids[i], ids[int(j)])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op8_simhash(spark, folder).collect()}
    assert got == {k: (f"{p:016x}", union.find(k)) for k, p in zip(ids, prints.tolist())}


def test_simhash_hot_bucket(spark, sets, monkeypatch):
    """A dense ball of fingerprints over several blocks, and a chain."""
    monkeypatch.setattr(components, "BLOCK", 20)
    monkeypatch.setattr(components.blocks, "__defaults__", (20,))
    rng = np.random.default_rng(4)
    center = int(rng.integers(0, 2**62))
    made = {center ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(300)}
    chain = int(rng.integers(0, 2**62))
    for k in range(0, 60, 4):
        chain ^= 0b1111 << k
        made.add(chain)
    made = sorted(made)
    fps = np.array(made, np.uint64)
    union = sets(range(len(made)))
    for i in range(len(made)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            union.join(i, int(j))
    rows = spark.createDataFrame([(k, int(v)) for k, v in enumerate(fps.view(np.int64).tolist())], "doc_id long, fp long")
    got = rows.join(simhash.classes(rows, "doc_id"), "fp").select("doc_id", "component_id").collect()
    assert {tuple(r) for r in got} == {(k, union.find(k)) for k in range(len(made))}


def test_simhash_odd(odd, odd_rows, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    got = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert got[0] == got[1] == got[2] == 0 and got[5] == got[7] == 5 and got[8] == 8
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {r.component_id for r in rows}
    assert simhash.near_duplicates(empty).count() == simhash.deduplicated(empty).count() == 0


# ---- MinHash


def test_bands_reach_recall():
    for threshold in (0.5, 0.8, 0.9):
        b, r = fingerprints.bands(threshold)
        assert b * r <= fingerprints.PERMUTATIONS and 1 - (1 - threshold**r) ** b >= fingerprints.RECALL


def test_fingerprints(spark, folder, texts):
    import hashlib

    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in fingerprints.op6_fingerprints(spark, folder).collect()}
    assert sorted(got) == sorted(texts)
    errors = []
    for k, doc in enumerate(order):
        text, following = texts[doc] or "", texts[order[(k + 1) % len(order)]] or ""
        changed = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = (shingles(x, 5) for x in (text, changed, following))
        errors += [r.near_edited - len(a & b) / max(len(a | b), 1), r.near_next - len(a & c) / max(len(a | c), 1)]
    assert np.abs(errors).max() < 0.25 and np.abs(errors).mean() < 0.04
    equal = collections.defaultdict(set)
    for doc, r in got.items():
        equal[texts[doc]].add(r.fingerprint)
    assert all(len(v) == 1 for v in equal.values())


def test_fingerprints_over_ranges(spark, odd, odd_rows, empty, monkeypatch):
    monkeypatch.setattr(fingerprints, "FEWEST", 7)
    monkeypatch.setattr(fingerprints, "ROWS", 2)
    rows = fingerprints.compared(odd).collect()
    assert len(rows) == len(odd_rows)
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()), reverse=True)
    want = []
    for k, r in enumerate(order):
        text, following = r[1] or "", order[(k + 1) % len(order)][1] or ""
        own, other = fingerprints.sign([text])[0], fingerprints.sign([following])[0]
        want.append((r[0], len(text), fingerprints.written_out(own[None])[0], float((own == other).mean())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.fingerprint, r.near_next)) for r in rows)
    assert fingerprints.compared(empty).count() == 0
    one = spark.createDataFrame([(3, "only one")], "doc_id long, text string")
    assert fingerprints.compared(one).first().near_next == 1.0


def test_near_duplicates(docs, texts, sets, odd, odd_rows, empty):
    union = sets(texts)
    jaccard_classes(sets, {k: shingles(t, 5) for k, t in texts.items()}, 0.8, union)
    blank = [k for k, t in texts.items() if not shingles(t, 5)]
    for k in blank:
        union.join(blank[0], k)
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(docs).collect()}
    assert got == {k: union.find(k) for k in texts}
    assert fingerprints.near_duplicates(odd).count() == len(odd_rows)
    assert fingerprints.near_duplicates(empty).count() == 0


# ---- passages


def brute_passages(texts, sets):
    found = [(d, a, n, w) for d, x in texts.items() for a, n, w in substring_dedup.paragraphs(x or "")]
    words = sorted({f[3] for f in found})
    union = sets(range(len(words)))
    jaccard_classes(sets, {k: set(simhash.word_hashes(w.split(), 5)) for k, w in enumerate(words)}, 0.8, union)
    number = {w: k for k, w in enumerate(words)}
    classes = collections.defaultdict(list)
    for d, a, n, w in found:
        classes[union.find(number[w])].append((d, a, n, w.count(b" ") + 1))
    by_doc = collections.defaultdict(list)
    for key, own in classes.items():
        if len({x[0] for x in own}) > 1:
            for d, a, n, k in own:
                by_doc[d].append((a, n, k, key))
    left = collections.defaultdict(list)
    for d, own in by_doc.items():
        run = []
        for x in [*sorted(own), None]:
            if run and (x is None or x[0] - run[-1][0] - run[-1][1] > substring_dedup.GAP):
                if sum(y[2] for y in run) >= substring_dedup.PASSAGE:
                    for y in run:
                        left[y[3]].append((d, *y[:3]))
                run = []
            run.append(x)
    return sorted((*x, *min(own)[:2], len(own), x[:2] != min(own)[:2]) for own in left.values() if len({x[0] for x in own}) > 1 for x in own)


def test_passages(spark, folder, texts, sets):
    rows = substring_dedup.op3_substring_dedup(spark, folder).collect()
    assert sorted(map(tuple, rows)) == brute_passages(texts, sets)


def test_planted_passages(spark, sets):
    """A passage inside other text, with and without a changed word, is found wherever it stands."""
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))

    def prose(n):
        return " ".join(" ".join(word() for _ in range(rng.integers(5, 12))) + "." for _ in range(n))

    passage = prose(9)
    changed = passage.split(" ")
    changed[30] = "altered"
    texts = {1: f"{prose(20)} {passage} {prose(30)}", 2: f"{prose(3)}\n{passage}\n{prose(3)}", 3: f"{prose(11)} {' '.join(changed)} {prose(4)}", 4: prose(40), 5: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = substring_dedup.repeated(docs).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3}
    assert sorted(map(tuple, rows)) == brute_passages(texts, sets)
    out = {r.doc_id: r.text for r in substring_dedup.deduplicated(docs).collect()}
    assert out[1] == texts[1] and out[4] == texts[4] and out[5] is None and len(out[2]) < len(texts[2])


def test_passages_odd(odd, odd_rows, empty):
    rows = substring_dedup.repeated(odd).collect()
    assert {r.doc_id for r in rows} == {8, 9, 14}
    assert substring_dedup.deduplicated(odd).count() == len(odd_rows)
    assert substring_dedup.repeated(empty).count() == 0


# ---- components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, sets, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 5000 + k) for k in range(1, 60)]
    union = sets({x for e in edges for x in e})
    for a, b in edges:
        union.join(a, b)
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: union.find(x) for a, b in edges if a != b for x in (a, b)}


# ---- passages inside running text


def prose_of(rng, words):
    out = []
    while len(out) < words:
        n = int(rng.integers(5, 12))
        out += ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]
        out[-1] += "."
    return out[:words]


def shared_words(a, b, least):
    """The longest run of words that both lists have, if it is ``least`` or more."""
    where = collections.defaultdict(list)
    for i in range(len(a) - least + 1):
        where[tuple(a[i : i + least])].append(i)
    best = 0
    for j in range(len(b) - least + 1):
        for i in where.get(tuple(b[j : j + least]), ()):
            n = least
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            best = max(best, n)
    return best


@pytest.mark.parametrize("size", (50, 52, 60, 80))
def test_exact_passages_at_any_word(spark, size):
    """An exact passage put at any word of two documents is found in both, with 20 words or more of it."""
    rng = np.random.default_rng(size)
    lists, inside = {}, {}
    for k in range(60):
        passage = prose_of(rng, size + 7)[7:]  # begins anywhere in a sentence
        for d in (2 * k, 2 * k + 1):
            host = prose_of(rng, 150)
            at = int(rng.integers(0, 151))
            lists[d] = host[:at] + passage + host[at:]
            inside[d] = (at, at + size)
        assert shared_words(lists[2 * k], lists[2 * k + 1], 20) >= size
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in lists.items()], "doc_id long, text string")
    rows = collections.defaultdict(list)
    for r in substring_dedup.repeated(docs).collect():
        rows[r.doc_id].append(r)
    for d, words in lists.items():
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        found = set()
        for r in rows[d]:
            found |= {k for k in range(len(words)) if r.start <= starts[k] and starts[k] + len(words[k]) <= r.start + r.length}
        assert len(found & set(range(*inside[d]))) >= 20, d
        assert all(r.class_doc_id == d - d % 2 and r.removed == (d % 2 == 1) for r in rows[d])


def test_planted_passage_of_seventy_words(spark, sets):
    """Nine sentences, with and without a changed word, inside other text."""
    rng = np.random.default_rng(7)
    passage = prose_of(rng, 72)
    changed = [*passage[:30], "altered", *passage[31:]]
    put = lambda a, p, b: " ".join([*prose_of(rng, a), *p, *prose_of(rng, b)])
    texts = {1: put(163, passage, 240), 2: put(25, passage, 25), 3: put(88, changed, 31), 4: put(100, [], 220), 5: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = substring_dedup.repeated(docs).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3}
    assert sorted(map(tuple, rows)) == brute_passages(texts, sets)


def test_windows_of_repeating_text():
    """Windows of a text that repeats itself don't overlap."""
    for unit in ("a ", "a b ", "one two three four five six seven "):
        found = list(substring_dedup.windows(unit * 2000))
        assert 0 < len(found) <= len((unit * 2000).split()) / substring_dedup.PASSAGE + 1
    text = "世界 \U0001f600 " + " \t\n".join(f"W\xc9{k}" for k in range(90)) + "\x1c\x85 odd"
    for start, size, words in substring_dedup.windows(text):
        assert text[start : start + size].encode().lower().split() == words.rstrip().split(b"\xff") and words.count(b" ") == 19


def test_units_are_shuffled_once_by_id(spark, monkeypatch):
    """Spans of all units come from one read of their table, however many steps use them."""
    reads = []

    def spied(step):
        def run(df, *rest):
            reads.append(len(re.findall(r"Relation \[[^\]]*\bkeys#", df._jdf.queryExecution().optimizedPlan().toString())))
            return step(df, *rest)

        return run

    monkeypatch.setattr(substring_dedup, "written", spied(substring_dedup.written))
    monkeypatch.setattr(substring_dedup, "cut", spied(substring_dedup.cut))
    passage = " ".join(prose_of(np.random.default_rng(1), 60))
    docs = spark.createDataFrame([(k, f"{passage}\n" + " ".join(prose_of(np.random.default_rng(k), 60))) for k in (2, 3)], "doc_id long, text string")
    rows = substring_dedup.repeated(docs)
    assert {r.doc_id for r in rows.collect()} == {2, 3}
    # band keys (one exchange, used twice), then spans and kept occurrences
    assert max(reads) == 2 and sum(reads) == 4, reads


def test_passages_of_rows_without_id(spark):
    """Rows without doc_id are one document: what they alone have is no repeat, what another document has too is one, equal or near."""
    rng = np.random.default_rng(5)
    own, both, near, far = (" ".join(prose_of(rng, n)).replace(".", "") for n in (50, 60, 70, 80))
    changed = near.split(" ")
    changed[-1] = "altered"
    far_changed = far.split(" ")
    far_changed[-1] = "altered"
    rows = [(None, f"{own}\n{far}"), (None, f"{own}\n{both}\n{' '.join(far_changed)}"), (4, f"{both}\n{near}"), (None, " ".join(changed))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.defaultdict(set)
    for r in substring_dedup.repeated(docs).collect():
        got[r.doc_id].add((r.start, r.length, r.removed))
    assert set(got) == {None, 4}
    assert {(0, len(both), True), (len(both) + 1, len(near), True)} <= got[4]
    assert {(len(own) + 1, len(both), False), (0, len(" ".join(changed)), False)} <= got[None]
    # nothing of the passages that only rows without doc_id have
    assert not any(size in (len(own), len(far), len(" ".join(far_changed))) for _, size, _ in got[None])


def test_sentence_ends():
    """The pattern that scans fast ends sentences where the plain one does."""
    plain = re.compile(r"[^\s.!?][.!?](?=\s)|\n")
    rng = np.random.default_rng(3)
    for _ in range(3000):
        text = "".join(rng.choice(list("ab.!?\n \t\x85\x1c\xe9\r"), rng.integers(0, 14)))
        assert [m.end() for m in substring_dedup.END.finditer(text)] == [m.end() for m in plain.finditer(text)], text
