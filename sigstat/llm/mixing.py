"""Mixing sources to target weights: iterative proportional fitting of token weights, then calibrated sampling.

Every row falls in a cell (source, language, topic). A value without a target of its own, null included, counts as ``REST``,
so there are at most (named values + 1) cells along each side whatever the corpus: only that table of cells comes to the
driver and goes back by broadcast. Fitting rakes the cells' token sums to the three lists of targets in turn, ``rounds``
times; targets of values without tokens are shared out among the others. A rest that has tokens but no positive target keeps
its measured share, the named targets share what is left: no row is lost for an unknown or null value. A cell's weight is its fitted share over its own
share; a row is kept with probability weight / largest weight, by a number drawn from its doc_id, so that the expected tokens
of the sample have the fitted margins. Repeated rows share one draw, rows without an id draw by their source, language
and text; a row without tokens goes by its cell's probability, or
1 if no row of the cell has tokens. ``ROUNDS`` is fixed so that every engine makes the same steps.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REST = "*"
ROUNDS = 60
SIDES = ("source", "lang", "topic")
#: Shares of the mix that the query and the pipeline aim at.
TARGETS: Mapping[str, Mapping[str, float]] = {
    "source": {"src0": 0.25, REST: 0.75},
    "lang": {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11, REST: 0.0},
    "topic": {"figures": 0.15, "lines": 0.25, "prose": 0.6},
}
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Tokens as words; a column of another tokenizer's counts can be given instead."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def surface_topic(text: Column) -> Column:
    """A topic by the look of a text: figures (any digit), lines (a line break in 250 characters), prose."""
    body = F.coalesce(text, F.lit(""))
    size = F.length(body)
    breaks = size - F.length(F.replace(body, F.lit("\n"), F.lit("")))
    return F.when(body.rlike("[0-9]"), "figures").when(breaks * 250 > size, "lines").otherwise("prose")


def fit(cells: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Rake an array of token sums to the targets of each axis; shares that add up to 1 (zeros where there is nothing)."""
    share = cells / max(cells.sum(), 1e-300)
    present = [share.sum(axis=tuple(a for a in range(share.ndim) if a != axis)) > 0 for axis in range(share.ndim)]
    aims = [np.where(p, t, 0) for t, p in zip(targets, present, strict=True)]
    aims = [t / t.sum() if t.sum() > 0 else p / max(p.sum(), 1) for t, p in zip(aims, present, strict=True)]
    for _ in range(rounds):
        for axis, aim in enumerate(aims):
            margin = share.sum(axis=tuple(a for a in range(share.ndim) if a != axis), keepdims=True)
            shape = [-1 if a == axis else 1 for a in range(share.ndim)]
            share = np.where(margin > 0, share * aim.reshape(shape) / np.where(margin > 0, margin, 1), 0.0)
    return share


def aims(found: np.ndarray, targets: Mapping[str, Mapping[str, float]], names: Mapping[str, list[str]]) -> list[np.ndarray]:
    """Targets of each axis; the last value, the rest, gets its measured share if it has tokens and no positive target."""
    out = []
    for axis, side in enumerate(SIDES):
        aim = np.array([targets[side].get(v, 0.0) for v in names[side]])
        margin = found.sum(axis=tuple(a for a in range(found.ndim) if a != axis))
        named = np.where(margin > 0, aim, 0)[:-1].sum()
        if aim[-1] <= 0 < margin[-1] and named > 0:
            aim[-1] = named * margin[-1] / margin[:-1].sum()
        out.append(aim)
    return out


def draw(doc_id: Column, seed: int = 0, other: Column | None = None) -> Column:
    """A number from 0 to 1 that depends on the id and the seed alone; for a null id, on ``other``."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("") if other is None else other), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def mixed(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] = TARGETS,
    columns: Mapping[str, Column] | None = None,
    tokens: Column | None = None,
    doc_id: str = "doc_id",
    seed: int = 0,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Add mix_source, mix_lang, mix_topic, mix_tokens, mix_weight, mix_probability and mix_kept to every row."""
    spark = docs.sparkSession
    columns = columns or {"source": F.col("source"), "lang": F.col("lang"), "topic": surface_topic(F.col("text"))}
    tokens = token_count(F.col("text")) if tokens is None else tokens
    names = {side: [*(v for v in targets[side] if v != REST), REST] for side in SIDES}
    cell = {f"mix_{side}": F.when(columns[side].isin(names[side][:-1]), columns[side]).otherwise(REST) for side in SIDES}
    added = [*cell, "mix_tokens", "mix_weight", "mix_probability", "mix_kept"]
    rows = docs.select(*(c for c in docs.columns if c not in added), *(c.alias(n) for n, c in cell.items()), tokens.alias("mix_tokens"))
    sums = rows.groupBy(*cell).agg(F.sum("mix_tokens").cast("double").alias("t")).collect()  # bounded by the targets
    found = np.zeros([len(names[s]) for s in SIDES])
    for r in sums:
        found[tuple(names[s].index(r[f"mix_{s}"]) for s in SIDES)] += r["t"] or 0.0
    fitted = fit(found, aims(found, targets, names), rounds)
    own = found / max(found.sum(), 1e-300)
    weight = np.where(own > 0, fitted / np.where(own > 0, own, 1), 1.0)
    top = weight[own > 0].max() if (own > 0).any() else 1.0
    rate = np.where(own > 0, weight / (top if top > 0 else 1.0), 1.0)
    table = [(*(names[s][k] for s, k in zip(SIDES, at, strict=True)), float(weight[at]), float(rate[at])) for at in np.ndindex(*found.shape)]
    rates = spark.createDataFrame(table, ", ".join(f"{c} string" for c in cell) + ", mix_weight double, mix_probability double")
    words = F.concat_ws("\x1f", *(F.coalesce(F.col(c), F.lit("")) for c in ("source", "lang", "text") if c in docs.columns))
    return (
        rows.join(F.broadcast(rates), list(cell), "left")
        .withColumn("mix_kept", draw(F.col(doc_id), seed, F.concat(F.lit("~"), F.md5(words.cast("binary")))) < F.col("mix_probability"))
        .select(*(c for c in docs.columns if c not in added), *added)
    )


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The rows of the sample, with their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), "source", "lang", "text")
    return mixed(rows, **options).filter("mix_kept").select("row.*")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its cell, calibrated weight and probability, and whether it is sampled."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mixed(docs).select(
        "doc_id", "mix_source", "mix_lang", "mix_topic", "mix_tokens", F.round("mix_weight", 6).alias("mix_weight"), F.round("mix_probability", 6).alias("mix_probability"), "mix_kept"
    )


def _listed(side: str) -> str:
    return ", ".join(f"'{v}'" for v in TARGETS[side] if v != REST)


def _aims() -> str:
    rows = [f"('{side}', '{v}', {float(t)!r})" for side in SIDES for v, t in ({REST: 0.0} | dict(TARGETS[side])).items()]
    return f"(VALUES {', '.join(rows)}) AS aim(side, value, t)"


def _rake(source: str, side: str) -> str:
    others = ", ".join(s for s in SIDES if s != side)
    return f"(SELECT {others}, {side}, own, k, w * a_{side} / sum(w) OVER (PARTITION BY {side}) AS w, a_source, a_lang, a_topic FROM {source})"


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN source IN ({_listed('source')}) THEN source ELSE '*' END AS source,
    CASE WHEN lang IN ({_listed('lang')}) THEN lang ELSE '*' END AS lang,
    CASE WHEN length(regexp_replace(body, '[^0-9]', '', 'g')) > 0 THEN 'figures'
      WHEN length(regexp_replace(body, '[^\\n]', '', 'g')) * 250 > length(body) THEN 'lines' ELSE 'prose' END AS topic,
    len(regexp_extract_all(body, '{WORD}')) AS tokens, source AS raw_source, lang AS raw_lang, body
  FROM (SELECT *, coalesce(text, '') AS body FROM documents)
), c AS (
  SELECT source, lang, topic, sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM d) AS own FROM d GROUP BY ALL HAVING sum(tokens) > 0
), margin AS (
  {" UNION ALL ".join(f"SELECT '{s}' AS side, {s} AS value, sum(own) AS m FROM c GROUP BY {s}" for s in SIDES)}
), given AS (
  SELECT side, value, t, m, sum(t) FILTER (value <> '*') OVER w AS named, sum(m) FILTER (value <> '*') OVER w AS others FROM {_aims()} JOIN margin USING (side, value) WINDOW w AS (PARTITION BY side)
), rest AS (
  SELECT side, value, CASE WHEN value = '*' AND t <= 0 AND named > 0 THEN named * m / others ELSE t END AS t FROM given
), seen AS (
  SELECT side, value, CASE WHEN sum(t) OVER w > 0 THEN t / sum(t) OVER w ELSE 1.0 / count(*) OVER w END AS t FROM rest WINDOW w AS (PARTITION BY side)
), r AS (
  SELECT c.source, c.lang, c.topic, own, 0 AS k, own AS w, x.t AS a_source, y.t AS a_lang, z.t AS a_topic FROM c
  JOIN seen x ON x.side = 'source' AND x.value = c.source JOIN seen y ON y.side = 'lang' AND y.value = c.lang
  JOIN seen z ON z.side = 'topic' AND z.value = c.topic
  UNION ALL
  SELECT source, lang, topic, own, k + 1, w, a_source, a_lang, a_topic FROM {_rake(_rake(_rake(f"(SELECT * FROM r WHERE k < {ROUNDS})", 'source'), 'lang'), 'topic')}
), f AS (
  SELECT source, lang, topic, w / own AS weight, (w / own) / max(w / own) OVER () AS rate FROM r WHERE k = {ROUNDS}
)
SELECT doc_id, source AS mix_source, lang AS mix_lang, topic AS mix_topic, tokens AS mix_tokens, round(coalesce(weight, 1.0), 6) AS mix_weight,
  round(coalesce(rate, 1.0), 6) AS mix_probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '~' || md5(coalesce(raw_source, '') || chr(31) || coalesce(raw_lang, '') || chr(31) || body)) || ':0'), 1, 13))::BIGINT / 4503599627370496.0 < coalesce(rate, 1.0) AS mix_kept
FROM d LEFT JOIN f USING (source, lang, topic)
"""
