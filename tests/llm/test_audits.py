"""Language identification, source divergence and conversation repair against brute force and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import oracle
import pytest

from sigstat.llm import conversations, divergence, langid


def con_of(name, rows, names):
    import pandas as pd

    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=names).astype(object).where(lambda x: x.notna(), None))
    return con


# --- language identification


def plain_codes(text):
    out = [0]
    for c in text.lower():
        if c.isalpha():
            out.append(ord(c))
        elif out[-1]:
            out.append(0)
    return [*out, 0] if out[-1] else out


def plain_grams(text, size):
    codes = plain_codes(text)
    for n in range(1, langid.ORDERS + 1):
        for k in range(len(codes) - n + 1):
            h = n
            for c in codes[k : k + n]:
                h = ((h ^ c) * 0x9E3779B97F4A7C15) % 2**64
                h ^= h >> 29
            if n > 1 or codes[k]:
                yield (h * 0xBF58476D1CE4E5B9 % 2**64) >> (64 - size.bit_length() + 1)


def plain_bayes(train, texts, size):
    names = sorted({lang for _, lang in train if lang is not None}, key=str.encode)
    rows = Counter(lang for _, lang in train if lang is not None)
    counts = {v: Counter() for v in names}
    for text, lang in train:
        if lang is not None:
            counts[lang].update(plain_grams(text or "", size))
    out = []
    for text in texts:
        if text is None or not any(c.isalpha() for c in text) or not names:
            out.append(("und", 0.0))
            continue
        logs = []
        for v in names:
            total = sum(counts[v].values()) + langid.ALPHA * size
            own = Counter(plain_grams(text, size))
            one = sum(n * math.log((counts[v][b] + langid.ALPHA) / total) for b, n in own.items())
            logs.append(one / langid.ORDERS + math.log((rows[v] + 1) / (sum(rows.values()) + len(names))))
        best = max(logs)
        out.append((names[logs.index(best)], 1 / sum(math.exp(x - best) for x in logs)))
    return out


def short(rows):
    return [(r[0], (r[1] or "")[:300] if r[1] else r[1], *r[2:]) for r in rows]


@pytest.mark.parametrize("shard", [1, 64])
def test_langid_is_naive_bayes(spark, odd_rows, odd, shard):
    rows = short(odd_rows) + [(100, "der die und das", "de", None, 1, *odd_rows[0][5:]), (101, "le la les des", "fr", None, 1, *odd_rows[0][5:])]
    docs = spark.createDataFrame(rows, odd.schema).repartition(3)
    model = langid.fit(docs.filter(~langid.held_out(docs.doc_id)), size=1 << 10, shard=shard)
    found = langid.predicted(docs.withColumns({"score": docs.doc_id, "lang_pred": docs.doc_id}), model)
    assert set(found.columns) == {*docs.columns, "lang_pred"} and found.columns.count("score") == 1
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in found.collect()}
    train = [(r[1], r[2]) for r in rows if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 4 != 2]
    want = plain_bayes(train, [r[1] for r in rows], 1 << 10)
    for r, (lang, score) in zip(rows, want):
        assert got[r[0], r[1]][0] == lang
        assert got[r[0], r[1]][1] == pytest.approx(score, abs=1e-4)
    assert found.count() == len(rows)


def test_langid_spans(monkeypatch):
    texts = ["Ab, c" * 50, "", None, "x", "Straße İstanbul " * 9, "--"]
    whole = sorted((int(d), int(b)) for own, hashed in langid.grams(texts) for d, b in zip(own, hashed))
    for span in (1, 2, 3, 7, 64):
        monkeypatch.setattr(langid, "SPAN", span)
        assert sorted((int(d), int(b)) for own, hashed in langid.grams(texts) for d, b in zip(own, hashed)) == whole
    assert whole == sorted((k, b) for k, t in enumerate(texts) for b in plain_grams(t or "", langid.BUCKETS))


def test_langid_empty(spark, empty, odd):
    assert langid.predicted(empty, langid.fit(empty)).count() == 0
    assert {(r.lang_pred, r.score) for r in langid.predicted(odd, langid.fit(empty)).collect()} == {("und", 0.0)}


def test_langid_held_out(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = langid.op11_langid(spark, folder).join(docs, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


# --- source divergence


def plain_audit(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]  # text, lang, source
    own = [Counter(t.encode().lower().decode() if t.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x)) for x, _, _ in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        at = [k for k, r in enumerate(rows) if r[1] == lang]
        docs = Counter(t for k in at for t in own[k])
        kept = [t for t, n in docs.items() if n >= least]
        groups = sorted({rows[k][2] for k in at})

        def shares(group, at=at, kept=kept):
            n = Counter()
            for k in at:
                if group is None or rows[k][2] == group:
                    n.update({t: own[k][t] for t in kept if t in own[k]})
            total = sum(n.values())
            return n, {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(None)[1]
        p = {g: shares(g) for g in groups}
        for g in groups:
            pairs = sorted(((-sum(abs(p[g][1][t] - p[h][1][t]) for t in kept), h.encode(), h) for h in groups if h != g))
            terms = sorted((q[t] - p[g][1][t], t.encode(), t) for t in kept if p[g][0][t] and p[g][1][t] > q[t])[:top]
            out |= {(lang, g, "pair", h, -v, k) for k, (v, _, h) in enumerate(pairs, 1)}
            out |= {(lang, g, "term", t, -v, k) for k, (v, _, t) in enumerate(terms, 1)}
    return out


def prose(seed, rows=400):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeéßÀ世") for _ in range(draw.randint(1, 3))) for _ in range(60)]
    made = []
    for _ in range(rows):
        some = draw.choices(words, [1 / (k + 1) for k in range(60)], k=draw.randint(0, 12))
        text = draw.choice([" ", "1", "_", "\n", "-"]).join(w.upper() if draw.random() < 0.2 else w for w in some)
        made.append((None if draw.random() < 0.05 else text, draw.choice(["x", "y", None, ""]), draw.choice(["s1", "s2", "S", "é", None])))
    return made + made[:5] + [("Only Here", "lone", "one"), (None, "lone", "two"), ("", "none", "")]


@pytest.mark.parametrize(("bits", "slots", "tile", "block"), [(64, 1 << 26, 64, 4096), (4, 1 << 4, 2, 3), (1, 2, 1, 1 << 20)])
def test_divergence(spark, monkeypatch, bits, slots, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = prose(bits)
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "text string, lang string, source string, rank int, term string").repartition(3)
    got = [tuple(r) for r in divergence.audit(docs, least=8, top=10, slots=slots, bits=bits).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_audit(rows, 8, 10)


def test_divergence_odd(spark, odd, odd_rows, empty):
    assert divergence.audit(empty).count() == 0
    got = {tuple(r) for r in divergence.audit(odd, least=2).collect()}
    assert got == plain_audit([(r[1], r[2], r[3]) for r in odd_rows], 2, 50)


def test_divergence_sql(spark, odd, odd_rows):
    con = con_of("given", [r[:4] for r in odd_rows], ["doc_id", "text", "lang", "source"])
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text, lang, source FROM given")
    assert oracle.compare(divergence.audit(odd), con, divergence.SQL) is None


def test_term_spans(monkeypatch):
    body = ("Ab éX-" * 40 + "y" * 100).lower().encode()
    whole = divergence.TERM.findall(body)
    for span in (1, 5, 64):
        monkeypatch.setattr(divergence, "SPAN", span)
        assert [w for part in divergence.spans(body) for w in divergence.TERM.findall(part)] == whole
    start, end, digest = divergence.terms_of(np.frombuffer(body, np.uint8))
    assert [body[a:b] for a, b in zip(start, end)] == whole
    assert len(set(digest.tolist())) == len(set(whole)) == len(set(zip(whole, digest.tolist())))


@pytest.mark.parametrize("bits", [64, 3])
def test_tallies(monkeypatch, bits):
    import pyarrow as pa

    rows = prose(7)
    batch = pa.RecordBatch.from_pylist([{"text": x, "lang": a, "source": b} for x, a, b in rows])
    lists = [((a, b), re.findall(rb"[a-z\x80-\xff]+", (x or "").encode().lower())) for x, a, b in rows]
    own = {}
    for _, words in lists:
        if words:
            digest = divergence.terms_of(np.frombuffer(b" ".join(words), np.uint8))[2]
            own |= dict(zip(words, (digest >> np.uint64(64 - bits)).view(np.int64).tolist()))
    for held, span in ((1 << 20, 1 << 20), (5, 1 << 20), (1 << 20, 4), (1, 1)):
        monkeypatch.setattr(divergence, "HELD", held)
        monkeypatch.setattr(divergence, "SPAN", span)
        monkeypatch.setattr(divergence, "pieces", lambda b, c, span=span: (x.slice(k, 1) for x in b for k in range(x.num_rows)) if span < 9 else iter(b))
        docs, counts, wrong = Counter(), Counter(), set()

        def seen(found, wrong=wrong):
            wrong |= set(found.digest[found.clashes()].tolist())

        for groups, group, digest, d, n in divergence.tallies([batch], ["lang", "source"], bits, seen=seen):
            for g, t, x, k in zip(group, digest.tolist(), d, n):
                docs[groups[g], t] += x
                counts[groups[g], t] += k
        assert counts == Counter((g, own[t]) for g, w in lists for t in w)
        assert docs == Counter((g, t) for g, w in lists for t in {own[x] for x in w})
        if held > 5 and span > 9:
            assert wrong == {d for d, k in Counter(own.values()).items() if k > 1}


# --- conversation repair


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def plain_repair(rows):
    """All numbers of one conversation, by shortest paths over (row, state) with whole letter strings."""
    seen, faults, initials = set(), [], [r[2][:1] for r in rows]
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    best = {"": (0, "", ())}  # by the initials so far, folded to the automaton's state

    def state(s):
        return "" if not s else s[-1]

    def opened(found):
        for _ in range(2):
            for s, (c, letters, lines) in list(found.items()):
                new = "a" if s == "u" else "u"
                one = (c + 5, letters + "I", (*lines, ("user" if new == "u" else "assistant") + ":"))
                if new not in found or one[:2] < found[new][:2]:
                    found[new] = one
        return found

    for (_, _, role, text), fault, initial in zip(rows, faults, initials):
        ahead = {}

        def put(s, one, ahead=ahead):
            if s not in ahead or one[:2] < ahead[s][:2]:
                ahead[s] = one

        for s, (c, letters, lines) in opened(dict(best)).items():
            put(s, (c + 2, letters + "D", lines))
            if fault in (1, 2):
                continue
            more = 5 if fault == 3 else 0
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[s]
            if initial and initial in legal:
                put(initial, (c + more, letters + "K", (*lines, f"{role}:{text}")))
            new = "a" if s == "u" else "u"
            put(new, (c + 1 + more, letters + "R", (*lines, f"{'user' if new == 'u' else 'assistant'}:{text}")))
        best = ahead
    found = opened(dict(best))
    cost, audit, lines = min(found[s] for s in ("", "a") if s in found)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, digest)


def talks(seed, n=60, most=14):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(draw.randint(1, most)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "under", None])
            text = draw.choice(["Hi.", "Why?", "no end", "", " \t", "Go!\n", "x" * draw.randint(1, 50) + ".", None, "a" + str(turn) + ".", "é" + str(turn)])
            rows.append((conv, draw.choice([turn, turn, turn, 2 * turn, None]), role, text))
    return rows + rows[:7]


@pytest.mark.parametrize(("seed", "chunk"), [(1, 1024), (2, 1), (3, 3)])
def test_conversations(spark, seed, chunk):
    rows = talks(seed)
    given = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, cost int").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in conversations.repaired(given, chunk).collect()}
    live = plain_damage(rows)
    assert set(got) == {r[0] for r in rows}
    for conv, found in got.items():
        assert found == plain_repair([r for r in live if r[0] == conv])
    con = con_of("given", rows, ["conv_id", "turn", "role", "text"])
    con.execute("CREATE VIEW conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM given")
    assert oracle.compare(conversations.repaired(given, chunk), con, conversations.SQL) is None


def test_hot_conversation(spark, small_groups):
    draw = random.Random(9)
    rows = [(1, k // 2, draw.choice(["user", "assistant", "system", "tool"]), draw.choice(["Yes.", "no", "", f"t{k}.", f"u{k}?"])) for k in range(300)]
    rows += talks(4, 5)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in conversations.repaired(given, 16).collect()}
    live = plain_damage(rows)
    for conv, found in got.items():
        assert found == plain_repair([r for r in live if r[0] == conv])


def test_blocks_equal_single_steps():
    t = conversations.tables()
    draw = random.Random(0)
    for _ in range(300):
        own = [draw.randrange(conversations.SYMBOLS) for _ in range(conversations.LENGTH)]
        v, cost = draw.randrange(len(t.vectors)), 0
        code = sum(s * conversations.SYMBOLS ** (conversations.LENGTH - 1 - k) for k, s in enumerate(own))
        w = v
        for s in reversed(own):
            cost += t.one_cost[w, s]
            w = t.one[w, s]
        assert (t.block[v, code], t.cost[v, code]) == (w, cost)


def test_conversations_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repaired(empty).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.")], empty.schema)
    assert [tuple(r) for r in conversations.repaired(one).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


# --- odd input of older operators


def test_null_header_values(spark):
    from sigstat.llm import warc

    kind = "record_id long, url string, ts long, status int, headers map<string,string>, body string"
    rows = [
        (1, "http://a/x", 10, 200, {"etag": "t", "last-modified": "d", "server": None}, "body"),
        (2, "http://a/x", 20, 304, {"etag": None, "last-modified": "d", "server": "s"}, None),
        (3, "http://a/x", 30, 304, {"etag": "t", "server": None}, None),
    ]
    got = {r["record_id"]: r for r in warc.resolved(spark.createDataFrame(rows, kind)).collect()}
    assert got[2]["verdict"] == "same" and got[2]["headers"] == {"etag": "t", "last-modified": "d", "server": "s"}
    assert got[3]["verdict"] == "same" and got[3]["headers"] == {"etag": "t", "last-modified": "d"}


def test_mixing_without_ids(spark):
    from sigstat.llm import mixing

    rows = [(None if k % 3 else k, f"some words {k} of a text\n" if k % 2 else f"other words {k}", [None, "en", "de", "xx"][k % 4], f"src{k % 2}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    made = mixing.mixed(docs)
    none = made.filter("doc_id IS NULL").collect()
    share = np.mean([r.mix_kept for r in none])
    assert share == pytest.approx(np.mean([r.mix_probability for r in none]), abs=0.08)
    con = con_of("given", rows, ["doc_id", "text", "lang", "source"])
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text, lang, source FROM given")
    import pyspark.sql.functions as F

    shown = made.select("doc_id", "mix_source", "mix_lang", "mix_topic", "mix_tokens", F.round("mix_weight", 6).alias("mix_weight"), F.round("mix_probability", 6).alias("mix_probability"), "mix_kept")
    assert oracle.compare(shown, con, mixing.SQL) is None


def test_substrings_of_repeated_rows(spark):
    from sigstat.llm import substring_dedup

    draw = random.Random(8)
    prose = lambda n: " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n)) + "."
    line, long = "licensed under the terms that stand in the file beside this one", prose(90)
    texts = [f"{prose(40)}\n{line}\n{prose(30)}", f"{prose(35)}\n{line}\n{prose(20)}", f"{prose(30)}\n{long}\n{prose(9)}", f"{prose(25)}\n{long}\n{prose(8)}"]
    rows = list(enumerate(texts))

    def found(some):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
        return sorted(tuple(r) for r in substring_dedup.repeated(docs).collect())

    assert found(rows[:2] * 2) == []
    once = found(rows)
    assert {r[0] for r in once} == {2, 3} and found(rows * 2) == once
