"""BPE and edit-aware counts against the tokenizer library."""

import hashlib
import random

import numpy as np
import pytest

from sigstat.llm import bpe, pretokens, token_counts


@pytest.fixture(scope="module")
def own():
    return bpe.codec(bpe.rank_file())


def cases():
    r = random.Random(1)
    alpha = "ab cd's 're'll \n\t'd't12٣é世!?..''   　\x1c\x85ſ"
    out = ["".join(r.choice(alpha) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    out += ["".join(chr(r.choice([r.randint(0, 300), r.randint(0, 0xD7FF), r.randint(0x10000, 0x1FFFF)])) for _ in range(r.randint(0, 40))) for _ in range(2000)]
    return [*out, "a" * 5000, "ab" * 3000, "é" * 999, " " * 3000 + "x", "".join(r.choice("aeinst") for _ in range(4000)), "!" * 700]


def test_codec(own, encoding):
    many = cases()
    ids, lengths = own.encode(many)
    data, size = own.decode(ids, lengths)
    at, byte = np.concatenate(([0], np.cumsum(lengths))), np.concatenate(([0], np.cumsum(size)))
    for k, x in enumerate(many):
        assert ids[at[k] : at[k + 1]].tolist() == encoding.encode_ordinary(x), x[:50]
        assert data[byte[k] : byte[k + 1]].tobytes() == x.encode()


def test_forgetting(encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    own = bpe.Codec(bpe.rank_file())
    for x in cases()[:300]:
        assert own.encode([x])[0].tolist() == encoding.encode_ordinary(x)


def test_query_rows(spark, folder, texts, encoding):
    rows = bpe.op2_byte_bpe(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_odd_rows(odd, empty, odd_rows, encoding):
    rows = bpe.decode(bpe.encode(odd)).select("doc_id", "text", "ids", "decoded", "score").collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.ids == encoding.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    assert bpe.decode(bpe.encode(empty)).count() == 0


def test_tree(own, encoding):
    r = random.Random(5)
    alpha = "ab cd's 're'll  \n\t12é世!?' "
    make = lambda n: "".join(r.choice(alpha) for _ in range(n))
    for _ in range(400):
        text = make(r.choice([0, 1, 5, 40, 400, 2000]))
        whole, starts, _ = pretokens.split([text])
        tree = token_counts.Tree(text, np.diff(starts), own.counts([whole[a:b] for a, b in zip(starts, starts[1:])]))
        for _ in range(6):
            a = r.randint(0, len(text) + 1)
            b = a + r.choice([0, 0, 1, 3, 200])
            new = make(r.choice([0, 1, 2, 10]))
            token_counts.apply([tree], [[(a, b, new)]], own)
            text = text[: min(a, len(text))] + new + text[max(a, b) :]
            assert tree.text() == text and tree.tokens[1] == len(encoding.encode_ordinary(text))
            assert tree.lengths().tolist() == np.diff(pretokens.split([text])[1]).tolist()


def test_heaps_are_the_trees(own):
    texts = ["", "one", "some words here. " * 700, "x"]
    whole, starts, first = pretokens.split(texts)
    counts = own.counts([whole[a:b] for a, b in zip(starts, starts[1:])])
    sums, sizes = token_counts.heaps(counts, first)
    trees = [token_counts.Tree(t, np.diff(starts)[a:b], counts[a:b]) for t, a, b in zip(texts, first, first[1:])]
    assert sums.tolist() == [x for t in trees for x in t.tokens] and sizes.tolist() == [len(t.tokens) for t in trees]


def test_edits_touch_little(own):
    text = "some words that go on and on. " * 3000
    whole, starts, _ = pretokens.split([text])
    tree = token_counts.Tree(text, np.diff(starts), own.counts([whole[a:b] for a, b in zip(starts, starts[1:])]))
    assert token_counts.apply([tree], [[(50_000, 50_003, "xyz")]], own)[0] < 8


def test_edit_table(spark, odd, empty, odd_rows, encoding):
    edits = spark.createDataFrame(
        [(3, 2, 0, 1, "On"), (3, 1, 3, 9, "!"), (8, 1, -5, 2, None), (10, 1, 999, 1000, " end"), (0, 1, 0, 0, "new"), (99, 1, 0, 0, "lost")],
        "doc_id long, seq int, start long, stop long, new string",
    )
    rows = token_counts.edited(token_counts.token_trees(token_counts.with_edits(odd, edits))).collect()
    assert len(rows) == len(odd_rows)
    after = {0: "new", 3: "Onne!", 10: odd_rows[10][1] + " end", 8: odd_rows[8][1][2:]}
    for r in rows:
        assert r.n_tokens == len(encoding.encode_ordinary(r.text)) == sum(r.counts)
        if r.doc_id in after:
            assert r.text == after[r.doc_id]
        elif r.doc_id is not None:
            assert r.text == (odd_rows[r.doc_id][1] or "") and r.n_encoded == 0
    assert token_counts.edited(token_counts.token_trees(token_counts.with_edits(empty, edits))).count() == 0
