"""Queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from sigstat.llm import (
    bpe, conversations, divergence, exact_dedup, fingerprints, langid, mixing, quality, simhash, substring_dedup, token_counts, toxicity, warc,
)

_ALL = (
    bpe.op2_byte_bpe, exact_dedup.op4_exact_dedup, simhash.op8_simhash, mixing.op10_mixing, toxicity.op5_toxicity, token_counts.op1_token_counts,
    fingerprints.op6_fingerprints, substring_dedup.op3_substring_dedup, quality.op7_quality, warc.op9_warc_revisits, langid.op11_langid,
    divergence.op12_divergence, conversations.op13_conversations,
)
QUERIES = {f.__name__: f for f in _ALL}

SQL = {
    "op4_exact_dedup": exact_dedup.SQL, "op10_mixing": mixing.SQL, "op9_warc_revisits": warc.SQL, "op12_divergence": divergence.SQL,
    "op13_conversations": conversations.SQL,
}
