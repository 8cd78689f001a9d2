"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, order ``ORDER``: an n-gram is a 60-bit number of five 12-bit symbols (code points below
U+0600 are their own symbol, the others share 2 494 classes; symbol 0 stands before a text). It is trained on the documents
that are labelled good, outside the held-out fold, all of them. Tasks count their n-grams, Spark adds the counts up by
n-gram; lower orders count distinct continuations; discounts come from the counts of counts of each order; probabilities are
made order by order by joins of the n-grams with their contexts and with the next lower order.

Which documents are trusted is settled by two Bloom bitmaps of fixed size, so that their texts need not move to be counted.
For scoring, documents are dealt to chunks by their id and move once, packed. Each chunk lists its distinct n-grams, these
join with the model on the n-gram (backing off by joins where one is unseen), and the values go back to the chunk, where the
perplexity of every whole text is summed up. A document is kept if its perplexity is at most its language's limit: the
quantile ``UPPER`` of the held-out trusted documents of that language, or of all such documents for a language that has none
(in logarithms; n characters add ``SLACK`` / sqrt(n), as the mean over few varies more). Without trusted documents all texts
are kept. Chunks are cut by bytes of text, so that a task's share doesn't grow with the input or with the length of texts; a
single longer text makes its chunk longer.

Null and empty texts have no perplexity and are not kept. Rows without an id go to chunks by their text and are never
trusted. Of repeated labels of an id the lowest counts.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigstat.llm import pretokens
from sigstat.llm.batches import column, cut, pieces, texts, written
from sigstat.llm.exact_dedup import filter_bits, present, probed
from sigstat.llm.toxicity import held_out

ORDER, BITS = 5, 12
OWN, SHARED = 0x600, 4095 - 0x601
UPPER, SLACK = 0.97, 0.5
#: Bytes of text of a chunk; at least so many chunks; distinct n-grams that a task holds before it sends them.
BYTES, CHUNKS, HELD = 24 << 20, 24, 1 << 20


def grams(texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character of the texts, and how many each text has."""
    size = np.fromiter(map(len, texts_), np.int64, len(texts_))
    points = pretokens.points("".join(texts_)).astype(np.int64)
    symbols = np.where(points < OWN, points + 1, OWN + 1 + points % SHARED)
    lead = ORDER - 1
    line = np.zeros(len(points) + lead * (len(texts_) + 1), np.int64)
    at = np.arange(len(points)) + lead * (np.repeat(np.arange(len(texts_)), size) + 1)
    line[at] = symbols
    key = np.zeros(len(points), np.int64)
    for k in range(ORDER):
        key = (key << BITS) | line[at - (lead - k)]
    return key, size


def _tail(key: Column, order: int) -> Column:
    """The last ``order`` symbols."""
    return key.bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, c): how often each n-gram occurs."""

    def run(batches):
        keys, counts, held = [], [], 0

        def merged():
            place, key = pd.factorize(np.concatenate(keys))
            total = np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(total)], ["key", "c"])

        for part in pieces(batches, text):
            place, key = pd.factorize(grams(texts(part, text))[0])
            keys.append(key), counts.append(np.bincount(place, minlength=len(key)))
            held += len(key)
            if held > HELD:
                batch = merged()
                if batch.num_rows > HELD // 2:
                    yield batch
                    keys, counts, held = [], [], 0
                else:
                    keys, counts = [batch.column(0).to_numpy()], [batch.column(1).to_numpy()]
                    held = batch.num_rows
        if keys:
            yield merged()

    return docs.select(text).mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


class Model:
    """Tables of a Kneser-Ney model; the driver holds just five rows of sums."""

    def __init__(self, counts: DataFrame):
        table = written(counts)
        tables = {ORDER: table}
        for n in range(ORDER - 1, 0, -1):
            tables[n] = table = written(table.groupBy(_tail(F.col("key"), n).alias("key")).agg(F.count("*").alias("c")))
        self.seen, self.context = {}, {}
        for n in range(1, ORDER + 1):
            cuts = self.discounts(tables[n])
            less = F.element_at(F.array(*(F.lit(d) for d in cuts)), F.least("c", F.lit(3)).cast("int"))
            sums = [F.sum((F.col("c") == k).cast("long") if k < 3 else (F.col("c") >= 3).cast("long")) for k in (1, 2, 3)]
            spare = sum((s * d for s, d in zip(sums, cuts, strict=True)), F.lit(0.0)) / F.sum("c")
            if n == 1:
                row = tables[1].agg(F.sum("c").alias("total"), spare.alias("g"), F.count("*").alias("n")).first()
                total, self.rest = row.total or 1, (row.g or 1.0) / ((row.n or 0) + 1)
                made = tables[1].select("key", (F.greatest(F.col("c") - less, F.lit(0.0)) / total + self.rest).alias("p"))
            else:
                context = tables[n].groupBy(F.shiftright("key", BITS).alias("context")).agg(F.sum("c").alias("total"), spare.alias("g"))
                context = self.context[n] = written(context)
                own = tables[n].select("key", "c", F.shiftright("key", BITS).alias("context"), _tail(F.col("key"), n - 1).alias("low"))
                lower = self.seen[n - 1].select(F.col("key").alias("low"), F.col("p").alias("q"))
                own = own.join(context, "context").join(lower, "low")
                made = own.select("key", (F.greatest(F.col("c") - less, F.lit(0.0)) / F.col("total") + F.col("g") * F.col("q")).alias("p"))
            self.seen[n] = written(made)

    @staticmethod
    def discounts(table: DataFrame) -> list[float]:
        """The three discounts of an order, from its counts of counts (halves where these don't suffice)."""
        n1, n2, n3, n4 = (x or 0 for x in table.agg(*(F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4))).first())
        if not (n1 and n2 and n3 and n4):
            return [0.5, 0.5, 0.5]
        y = n1 / (n1 + 2 * n2)
        made = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        return [min(max(d, 0.05), k - 0.05) for d, k in zip(made, (1, 2, 3), strict=True)]

    def probability(self, keys: DataFrame) -> DataFrame:
        """Distinct n-grams with lp, the natural logarithm of the last symbol's probability after the others."""
        now = keys
        now = now.withColumns({f"k{n}": _tail(F.col("key"), n) for n in range(1, ORDER + 1)})
        now = now.join(self.seen[1].select(F.col("key").alias("k1"), F.col("p").alias("p1")), "k1", "left")
        now = now.withColumn("q", F.coalesce("p1", F.lit(self.rest))).drop("p1", "k1")
        for n in range(2, ORDER + 1):
            now = now.withColumn("context", F.shiftright(f"k{n}", BITS))
            now = now.join(self.context[n].select("context", "g"), "context", "left")
            now = now.join(self.seen[n].select(F.col("key").alias(f"k{n}"), "p"), f"k{n}", "left")
            now = now.withColumn("q", F.coalesce("p", F.coalesce("g", F.lit(1.0)) * F.col("q"))).drop("p", "g", "context", f"k{n}")
        return now.select(*keys.columns, F.log("q").cast("float").alias("lp"))


def trusted(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts labelled good outside the held-out fold, without moving most of them.

    One Bloom bitmap has the good ids, another those ids that the first lets through by mistake. What passes the first and
    not the second is good for certain; only what passes both, a few percent, is joined with the labels.
    """
    good = cut(_good(labels, label).filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("__id")))
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).filter(F.col("__id").isNotNull())
    bits = filter_bits(good.count())
    first = cut(present(good, "__id", bits))
    wrong = cut(probed(rows.select("__id"), "__id", first, bits, "__may").filter("__may").select("__id").distinct().join(good, "__id", "left_anti"))
    more = filter_bits(wrong.count())
    near = probed(rows, "__id", first, bits, "__may").filter("__may").drop("__may")
    near = probed(near, "__id", cut(present(wrong, "__id", more)), more, "__doubt")
    return near.filter("NOT __doubt").select("text").unionByName(near.filter("__doubt").drop("__doubt").join(good, "__id").select("text"))


def _good(labels: DataFrame, label: str) -> DataFrame:
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.groupBy("doc_id").agg(F.min(label).alias("good")).filter("good = 1").select("doc_id")


def packed(docs: DataFrame, chunks: int, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(chunk, blob): the documents of a chunk, in compressed lists of (id, language, text)."""
    import zstandard

    where = F.pmod(F.when(F.col(doc_id).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id)), F.lit(chunks)).cast("int")
    rows = docs.select(where.alias("chunk"), F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches):
        press = zstandard.ZstdCompressor(level=6)
        for part in pieces(batches, "text", 4 << 20):
            lists: dict[int, list] = {}
            for row in zip(*(column(part, n).to_pylist() for n in ("chunk", "id", "lang")), texts(part), strict=True):
                lists.setdefault(row[0], []).append(row[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(lists), pa.int32()), pa.array([press.compress(pickle.dumps(x)) for x in lists.values()], pa.binary())], ["chunk", "blob"]
            )

    return rows.mapInArrow(run, "chunk int, blob binary")


def unpacked(blobs: pa.ChunkedArray):
    """Pieces of about a megabyte."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    rows, size = [], 0
    for blob in blobs:
        for row in pickle.loads(press.decompress(blob.as_py())):
            rows.append(row)
            size += len(row[2])
            if size > 1 << 20:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def perplexities(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, lang, n_symbols and mean log probability of every row (null for texts without characters)."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    dealt = packed(docs, max(CHUNKS, size // BYTES), doc_id, text, lang).repartition("chunk")

    def listed(table: pa.Table) -> pa.Table:
        own = np.zeros(0, np.int64)
        for rows in unpacked(table.column("blob")):
            own = pd.unique(np.concatenate((own, pd.unique(grams([r[2] for r in rows])[0]))))
        return pa.table({"chunk": pa.array(np.full(len(own), table.column("chunk")[0].as_py(), np.int32)), "key": pa.array(own)})

    kind = dict(docs.dtypes)[doc_id]
    kinds = {f.name: f for f in docs.schema.fields}
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kinds[doc_id].dataType)

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        key, value = right.column("key").to_numpy(), right.column("lp").to_numpy()
        order = np.argsort(key)
        key, value = key[order], value[order].astype(np.float64)
        ids, langs, sizes, sums = [], [], [], []
        for rows in unpacked(left.column("blob")):
            own, size = grams([r[2] for r in rows])
            place, distinct = pd.factorize(own)
            total = np.concatenate(([0.0], np.cumsum(value[np.searchsorted(key, distinct)][place] if len(own) else own)))
            end = np.cumsum(size)
            sums.append((total[end] - total[end - size]) / np.maximum(size, 1))
            ids += [r[0] for r in rows]
            langs += [r[1] for r in rows]
            sizes.append(size)
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        mean = np.concatenate(sums) if sums else np.zeros(0)
        return pa.table(
            {"doc_id": pa.array(ids, id_type), "lang": pa.array(langs, pa.string()), "n_symbols": pa.array(size), "mean_lp": pa.array(mean, mask=size == 0)}
        )

    # the first chunk of a key goes along, and is asked for, and nulls are ruled out before the exchange (there are none), so that
    # both reads of ``keys`` have the same columns and filters and share one exchange
    listed_keys = dealt.groupBy("chunk").applyInArrow(listed, "chunk int, key long").filter("chunk IS NOT NULL AND key IS NOT NULL")
    keys = listed_keys.repartition("key")
    distinct = keys.groupBy("key").agg(F.min("chunk").alias("first"))
    values = keys.join(model.probability(distinct), "key").filter("first <= chunk")
    both = dealt.groupBy("chunk").cogroup(values.select("chunk", "key", "lp").groupBy("chunk"))
    return both.applyInArrow(summed, f"doc_id {kind}, lang string, n_symbols long, mean_lp double")


def judged(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", lang: str = "lang", upper: float = UPPER
) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, limit and kept of every row."""
    model = Model(counted(trusted(docs, labels, label, doc_id, text), "text"))
    scored = cut(perplexities(docs, model, doc_id, text, lang))
    known = _good(labels, label).filter(held_out(F.col("doc_id")))
    base = scored.join(known, "doc_id", "left_semi").filter("mean_lp IS NOT NULL")
    point = F.percentile_approx(-F.col("mean_lp"), F.lit(upper), 10_000)
    limits = base.groupBy("lang").agg(point.alias("__limit")).withColumnRenamed("lang", "__lang")
    pooled = base.agg(point).first()[0]  # one number
    other = float("inf") if pooled is None else float(pooled)
    limit = F.coalesce("__limit", F.lit(other)) + SLACK / F.sqrt(F.greatest("n_symbols", F.lit(1)))
    return scored.join(limits, F.col("lang").eqNullSafe(F.col("__lang")), "left").select(
        "doc_id", "lang", "n_symbols", F.exp(-F.col("mean_lp")).alias("perplexity"), F.exp(limit).alias("limit"),
        F.coalesce(-F.col("mean_lp") <= limit, F.lit(False)).alias("kept"),
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its perplexity, its language's limit and whether it is kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    return judged(docs, spark.read.parquet(f"{folder}/labels.parquet"))
