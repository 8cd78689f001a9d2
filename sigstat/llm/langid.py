"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and every run of other characters than letters becomes one mark, also before the first and after the last
word. All n-grams of 1 to ``ORDERS`` of these letters and marks (single marks apart) are hashed to ``BUCKETS`` numbers. Training
counts them over the whole text of every row with a language: a task adds up its own counts, the sums meet in one aggregation.
The table of log-probabilities (languages x buckets, add-``ALPHA``) is broadcast for at most ``SHARD`` languages at a time, 16 MB;
more languages take one pass over the texts for each such shard, which carry the best language and the sum of likelihoods on.
Scoring gathers the table's rows of a piece's n-grams and adds them up per text, in slices of bounded size; long texts are taken
in spans. Log-likelihoods are divided by the number of orders, whose n-grams overlap; the smoothed prior counts documents.

Null texts and texts without a letter (categories L*) are ``und`` with score 0, as is every text where nothing was learned. Rows
without a language teach nothing, an empty string is a language like others; repeated rows teach once each. Of equally likely
languages the one first in UTF-8 order is given. A null id is held out as the empty string would be. Columns of the output's
names are replaced, other columns stay.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigstat.llm.batches import column, pieces, texts

ORDERS, BUCKETS, ALPHA = 4, 1 << 16, 0.5
#: Languages whose table is broadcast at once, numbers gathered at once, characters of a text handled at once.
SHARD, SLICE, SPAN = 64, 1 << 20, 1 << 20
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def buckets(codes: np.ndarray, n: int, size: int) -> np.ndarray:
    """Hash of the n-gram that starts at each place."""
    length = len(codes) - n + 1
    h = np.full(length, n, np.uint64)
    for k in range(n):
        h = (h ^ codes[k : k + length]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def marked(text: str, doc: np.ndarray, open_: bool) -> tuple[np.ndarray, np.ndarray]:
    """Letters of a joined text with one 0 for what is between words; ``open_``: what comes before it is such a mark."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[points]
    before = np.empty(len(letter), bool)
    before[:1], before[1:] = not open_, letter[:-1] & (doc[1:] == doc[:-1])
    before[1:] |= doc[1:] != doc[:-1]
    keep = letter | before
    return np.where(letter, points, 0)[keep].astype(np.uint64), doc[keep]


def grams(texts_: list[str | None], size: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all n-grams, one order and span after the other; text numbers never fall within a pair."""
    lower = [f" {(x or '').lower()} " for x in texts_]
    at = 0
    while at < len(lower):
        end, length = at, 0
        while end < len(lower) and (end == at or length + len(lower[end]) <= SPAN):
            length += len(lower[end])
            end += 1
        carry, open_ = np.zeros(0, np.uint64), False
        whole = lower[at] if end == at + 1 else "".join(lower[at:end])
        numbers = np.repeat(np.arange(at, end), [len(x) for x in lower[at:end]])
        for begin in range(0, len(whole), SPAN):  # one span, but for a long text, which then is alone
            codes, doc = marked(whole[begin : begin + SPAN], numbers[begin : begin + SPAN], open_)
            codes = np.concatenate((carry, codes))
            doc = np.concatenate((np.full(len(carry), at), doc))
            for n in range(1, ORDERS + 1):
                fresh = max(len(carry) - n + 1, 0)  # n-grams that end in the carry were counted with the span before
                if len(codes) - n + 1 <= fresh:
                    continue
                hashed, own = buckets(codes[fresh:], n, size), doc[fresh : len(doc) - n + 1]
                valid = own == doc[fresh + n - 1 :]
                if n == 1:
                    valid &= codes[fresh:] != 0
                yield own[valid], hashed[valid]
            carry, open_ = codes[max(len(codes) - ORDERS + 1, 0) :], not letters()[ord(whole[min(begin + SPAN, len(whole)) - 1])]
        at = end


def held_out(doc_id: Column) -> Column:
    """The fold that training leaves out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def counted(rows: DataFrame, names: list[str], text: str = "text", lang: str = "lang", size: int = BUCKETS) -> np.ndarray:
    """How often each n-gram bucket occurs in the texts of each of the named languages."""
    place = {v: k for k, v in enumerate(names)}

    def run(batches):
        sums = np.zeros(len(names) * size, np.int64)
        for part in pieces(batches, text):
            own = np.array([place[v] for v in column(part, lang).to_pylist()], np.int64)
            for doc, bucket in grams(texts(part, text), size):
                sums += np.bincount(own[doc] * size + bucket, minlength=len(sums))
        found = np.flatnonzero(sums)
        for begin in range(0, len(found), 1 << 16):
            some = found[begin : begin + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array((some // size).astype(np.int32)), pa.array((some % size).astype(np.int32)), pa.array(sums[some])], ["lang", "bucket", "n"])

    found = rows.filter(F.col(lang).isin(names)).select(text, lang).mapInArrow(run, "lang int, bucket int, n long")
    table = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most SHARD x buckets rows
    out = np.zeros((len(names), size), np.int64)
    out[table["lang"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", size: int = BUCKETS, shard: int = SHARD) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """For each shard of languages: their names in order, log priors, and log-probabilities by (bucket, language).

    The driver holds the distinct language names and one shard's table.
    """
    share = {r[0]: r["count"] for r in rows.filter(F.col(lang).isNotNull()).groupBy(lang).count().collect()}
    names = sorted(share, key=lambda v: v.encode("utf-8", "surrogatepass"))
    total = sum(share.values()) + len(names)
    for begin in range(0, len(names), shard):
        some = names[begin : begin + shard]
        counts = counted(rows, some, text, lang, size) + ALPHA
        table = np.log(counts / counts.sum(1, keepdims=True)).T.astype(np.float32)
        yield some, np.log([(share[v] + 1) / total for v in some]), np.ascontiguousarray(table)


def likelihoods(texts_: list[str | None], prior: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log of prior times likelihood, by (text, language)."""
    out = np.zeros((len(texts_), len(prior)))
    step = max(1, SLICE // len(prior))
    for doc, bucket in grams(texts_, len(table)):
        for begin in range(0, len(doc), step):
            own = doc[begin : begin + step]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            out[own[first]] += np.add.reduceat(table[bucket[begin : begin + step]], first, axis=0, dtype=np.float64)
    return out / ORDERS + prior


def predicted(docs: DataFrame, model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the most likely language and its posterior probability; ``model`` gives shards as ``fit`` does."""
    fields = [f for f in docs.schema.fields if f.name not in (lang_pred, score)]
    state = ["__best", "__sum"]
    out = docs.select(*(f.name for f in fields), F.lit(UNKNOWN).alias(lang_pred), *(F.lit(float("-inf")).alias(c) for c in state))
    schema = T.StructType([*fields, T.StructField(lang_pred, T.StringType()), *(T.StructField(c, T.DoubleType()) for c in state)])
    spark = docs.sparkSession
    for names, prior, table in model:
        shared = spark.sparkContext.broadcast((names, prior, table))  # at most SHARD languages

        def run(batches, shared=shared):
            for part in pieces(batches, text):
                names, prior, table = shared.value
                bodies = column(part, text).to_pylist()
                known = np.array([has_letter(x) for x in bodies], bool)
                found = likelihoods(bodies, prior, table)
                top = found.argmax(1)
                best, before = found.max(1), column(part, state[0]).to_numpy()
                own = best + np.log(np.exp(found - best[:, None]).sum(1))
                better = known & (best > before)
                lang = [names[t] if b else v for t, b, v in zip(top.tolist(), better.tolist(), column(part, lang_pred).to_pylist())]
                sums = np.where(known, np.logaddexp(column(part, state[1]).to_numpy(), own), -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, f.name) for f in fields), pa.array(lang, pa.string()), pa.array(np.where(better, best, before)), pa.array(sums)], [f.name for f in schema.fields]
                )

        out = out.mapInArrow(run, schema)
    posterior = F.when(F.col(state[0]) == float("-inf"), 0.0).otherwise(F.least(F.exp(F.col(state[0]) - F.col(state[1])), F.lit(1.0)))
    return out.select(*(f.name for f in fields), lang_pred, posterior.alias(score))


def op11_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the language predicted from its text, learned outside the held-out fold."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    return predicted(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
