"""The pipeline's stages against what they are made of."""

import corpus_pipeline
import numpy as np

from sigstat.llm import mixing, toxicity
from sigstat.llm.batches import written


def test_stages(spark, sets, encoding):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = before = written(stage(spark, before, folder))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    for name in list(steps)[:-1]:
        assert steps[name].columns == docs.columns
    rows = {n: {r.doc_id: r for r in d.collect()} for n, d in steps.items()}
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    all_ = {r.doc_id: r.text for r in docs.collect()}
    scores = dict(zip(all_, model.scores(list(all_.values()))))
    assert set(rows["toxicity"]) == {k for k, s in scores.items() if s < toxicity.THRESHOLD}
    bare = lambda t: "".join((t or "").split())
    best = {}
    for k in sorted(rows["toxicity"]):
        text = all_[k]
        if bare(text) not in best or len(all_[best[bare(text)]]) < len(text):
            best[bare(text)] = k
    assert set(rows["exact_dedup"]) == set(best.values())
    from test_copies import brute_prints

    ids = sorted(rows["exact_dedup"])
    prints = np.array(brute_prints([all_[k] for k in ids]), np.uint64)
    union = sets(ids)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4):
            union.join(ids[i], ids[int(j)])
    assert set(rows["near_dedup"]) == {k for k in ids if union.find(k) == k}
    assert set(rows["mixing"]) == {r.doc_id for r in mixing.mixed(steps["near_dedup"]).collect() if r.mix_kept}
    assert {k: r.ids for k, r in rows["byte_bpe"].items()} == {k: encoding.encode_ordinary(all_[k]) for k in rows["mixing"]}


def test_odd_stages(spark, odd, empty, folder):
    columns = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (columns, columns.limit(0)):
        before = docs
        for _, stage in corpus_pipeline.STAGES:
            before = written(stage(spark, before, folder))
        assert before.count() <= docs.count()
