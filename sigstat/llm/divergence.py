"""Source divergence audit: how the word use of each source of a language differs from its other sources and the language.

Strings are materialised late. Pass 1 reads the texts and ships (language, 64-bit digest of a term, documents) alone; digests
in ``LEAST`` documents of some language mark slots of a bitmap of fixed size (``SLOTS`` bits, 8 MB at most), which is broadcast.
Pass 2 reads the texts again and writes, without a shuffle, the counts of terms on marked slots by (language, source, digest),
and beside them the string of each digest once per task. The counts shuffle without strings; the least and the greatest string
of each digest are aggregated from the others. Where both differ, two terms share a digest: those digests are marked in a
bitmap of the same size and their terms alone are counted once more by string, so that a clash splits into its terms. Merged
counts are never below single ones, so no kept term is missed before; slots that are marked by chance pass rows which the exact
count drops. Strings join back for the terms that can reach the report: of each group those within the first ``TOP`` values,
ties included.

Distances of sources are sums over blocks of about ``BLOCK`` terms: a task takes one block for two tiles of at most ``TILE``
sources as a dense matrix, in which a source without a term has the share of a count of zero, and sums of pairs add up.
Shares are whole numbers, products are decimals of 31 digits: no rounding anywhere.

Null text, language and source count as the empty string. Groups without terms, and languages without kept terms, are there with
distance 0. Every row is a document, also a repeated one or one with a null id. A term of any length counts; texts are
taken in spans. Other columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigstat.llm.batches import column, gather, pieces, release, texts, written

#: Fixed by the contract: documents of a kept term, smoothing, scale of shares, terms in a group's report.
LEAST, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of terms in UTF-8 after lower-casing: the contract's class, whose characters beyond ASCII are these bytes.
TERM = re.compile(rb"[a-z\x80-\xff]+")
SLOTS, HELD, SPAN, BLOCK, TILE = 1 << 26, 1 << 21, 1 << 20, 4096, 64
BITMAP = 32768  # bits of a row that bitmap_construct_agg makes
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish of a 64-bit hash."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@functools.cache
def byte_values() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are of terms, and a random number for each byte."""
    every = np.arange(256)
    inside = ((every >= ord("a")) & (every <= ord("z"))) | (every >= 0x80)
    return inside, mixed((every.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))


@functools.cache
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2^64."""
    out = []
    for x in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(size, x, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return tuple(out)


def terms_of(body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit digest of each term: differences of one running polynomial over the bytes."""
    inside, value = byte_values()
    flags = np.zeros(len(body) + 2, bool)
    flags[1:-1] = inside[body]
    edges = np.flatnonzero(flags[1:] != flags[:-1])
    start, end = edges[::2], edges[1::2]
    size = 1 << max(len(body), SPAN).bit_length()
    up, down = powers(size) if size <= 4 * SPAN else powers.__wrapped__(size)  # a term longer than a span
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(value[body] * up[: len(body)], out=sums[1:])
    return start, end, mixed((sums[end] - sums[start]) * down[start])


def spans(body: bytes) -> Iterator[bytes]:
    """A long text in parts; no term is cut."""
    at = 0
    while at < len(body):
        end = at + SPAN
        if end < len(body):
            over = TERM.match(body, end)
            end = over.end() if over else end
        yield body[at:end]
        at = end


def ordered(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the keys, the first one first, and where a new combination begins in it."""
    order = np.argsort(keys[-1])
    for key in keys[-2::-1]:
        small = key.astype(np.uint16) if len(key) and key.max() < 1 << 16 else key  # radix sort
        order = order[np.argsort(small[order], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


class Span:
    """Terms of some whole texts, or of a part of one: distinct digests with an example, and counts by (text, digest)."""

    def __init__(self, body: bytes, ends: np.ndarray, bits: int, marked: np.ndarray | None, slots: int):
        self.body = np.frombuffer(body, np.uint8)
        start, end, digest = terms_of(self.body)
        self.ends = ends
        doc = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(start, ends), prepend=0))
        order, new = ordered(digest >> np.uint64(64 - bits))
        self.digest = (digest[order[new]] >> np.uint64(64 - bits)).view(np.int64)
        code = np.empty(len(order), np.int64)
        code[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))
        self.example = order[new]
        self.hit = np.ones(len(new), bool)
        if marked is not None:
            slot = self.digest % slots
            self.hit = (marked[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
            take = self.hit[code]
            self.at, doc, code = np.flatnonzero(take), doc[take], code[take]
        else:
            self.at = np.arange(len(code))
        self.start, self.end, self.words = start, end, code
        pair, n = np.unique(doc * max(len(new), 1) + code, return_counts=True)
        self.doc, self.code = np.divmod(pair, max(len(new), 1))
        self.n = n

    def term(self, k: int) -> bytes:
        return self.body[self.start[k] : self.end[k]].tobytes()

    def clashes(self) -> np.ndarray:
        """Codes whose marked occurrences are not all equal to the example, byte by byte."""
        own, other = self.at, self.example[self.words]
        size = self.end - self.start
        same = size[own] == size[other]
        wrong = np.unique(self.words[~same])
        own, other, words = own[same], other[same], self.words[same]
        differ = self.body[gather(self.start[own], size[own])] != self.body[gather(self.start[other], size[own])]
        return np.union1d(wrong, np.repeat(words, size[own])[differ]) if differ.any() else wrong


def parts(batches, by: list[str], bits: int, marked: np.ndarray | None = None, slots: int = SLOTS):
    """(groups of the texts, Span, whether this ends a text that came in several) for texts in bounded pieces."""
    for part in pieces(batches, "text"):
        groups = list(zip(*(column(part, c).to_pylist() for c in by), strict=True))
        bodies = [t.encode("utf-8", "surrogatepass").lower() for t in texts(part)]  # of bytes: A-Z only
        if len(bodies) == 1 and len(bodies[0]) > SPAN:
            own = list(spans(bodies[0]))
            for k, body in enumerate(own, 1):
                yield groups, Span(body, np.array([len(body)]), bits, marked, slots), k == len(own), True
        else:
            yield groups, Span(b"\n".join(bodies), np.cumsum([len(x) + 1 for x in bodies]), bits, marked, slots), True, False


def tallies(batches, by: list[str], bits: int = 64, marked: np.ndarray | None = None, slots: int = SLOTS, seen=None):
    """Groups and, for each group and digest that occur together, its number, the digest, documents and occurrences.

    Counts are given out whenever ``HELD`` of them are held, and at the end. ``seen`` is called with every Span.
    """
    groups = defaultdict()
    groups.default_factory = groups.__len__
    held, long, size = [], [], 0

    def summed(group, digest, docs, n):
        order, new = ordered(group, digest)
        return group[order[new]], digest[order[new]], *(np.add.reduceat(x[order], new) if len(new) else x for x in (docs, n))

    def flush():
        yield list(groups), *summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        groups.clear(), held.clear()

    for own, span, last, several in parts(batches, by, bits, marked, slots):
        if seen:
            seen(span)
        if several:  # a term counts as one document
            long.append((span.digest[span.code], span.n))
            if not last:
                continue
            digest, n = (np.concatenate(x) for x in zip(*long, strict=True))
            _, digest, _, n = summed(np.zeros(len(digest), np.int64), digest, n, n)
            found = (np.full(len(digest), groups[own[0]]), digest, np.ones(len(digest), np.int64), n)
            long.clear()
        else:
            group = np.array([groups[g] for g in own], np.int64)[span.doc]
            found = summed(group, span.digest[span.code], np.ones(len(group), np.int64), span.n)
        held.append(found)
        size += len(found[0])
        if size > HELD:
            yield from flush()
            size = 0
    if held:
        yield from flush()
    release()


def bitmap(found: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Bits of the slots of the column ``digest``: at most ``slots`` / 8 bytes."""
    slot = F.pmod("digest", F.lit(slots))
    rows = found.groupBy(F.floor(slot / BITMAP).alias("part")).agg(F.bitmap_construct_agg(slot % BITMAP).alias("bits")).toArrow()
    out = np.zeros(-(-slots // BITMAP) * BITMAP // 8, np.uint8)
    for part, made in zip(rows["part"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        out[part * BITMAP // 8 : (part + 1) * BITMAP // 8] = np.frombuffer(made, np.uint8)
    return out


def frequent(docs: DataFrame, least: int = LEAST, bits: int = 64) -> DataFrame:
    """Digests that occur in ``least`` documents of a language."""

    def run(batches):
        for groups, group, digest, n, _ in tallies(batches, ["lang"], bits):
            langs = pa.array([g[0] for g in groups], pa.string())
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(group)), pa.array(digest), pa.array(n)], ["lang", "digest", "docs"])

    found = docs.select("lang", "text").mapInArrow(run, "lang string, digest long, docs long").groupBy("lang", "digest").agg(F.sum("docs").alias("docs"))
    return found.filter(F.col("docs") >= least).select("digest")


def occurrences(docs: DataFrame, marked: np.ndarray, slots: int = SLOTS, bits: int = 64) -> DataFrame:
    """(lang, source, digest, docs, n, term): counts without a term, summed up within a task, and rows of a digest and its term.

    A term is given again only where its digest last stood for another one, so a task gives all terms of a digest.
    """
    shared = docs.sparkSession.sparkContext.broadcast(marked)
    names = ["lang", "source", "digest", "docs", "n", "term"]

    def run(batches):
        known: dict[int, bytes] = {}
        new: list[tuple[int, bytes]] = []

        def seen(span):
            codes = np.flatnonzero(span.hit)
            for digest, k in zip(span.digest[codes].tolist(), span.example[codes].tolist(), strict=True):
                term = span.term(k)
                if known.get(digest) != term:
                    known[digest] = term
                    new.append((digest, term))
            for code in span.clashes():
                new.extend((int(span.digest[code]), t) for t in {span.term(k) for k in span.at[span.words == code]})
            if len(known) > HELD:
                known.clear()

        for groups, group, digest, own, n in tallies(batches, names[:2], bits, shared.value, slots, seen):
            at = pa.array(group)
            langs, sources = (pa.array([g[k] for g in groups], pa.string()).take(at) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([langs, sources, pa.array(digest), pa.array(own), pa.array(n), pa.nulls(len(at), pa.string())], names)
            none, zero = pa.nulls(len(new), pa.string()), pa.array(np.zeros(len(new), np.int64))
            strings = pa.array([t.decode("utf-8", "surrogatepass") for _, t in new], pa.string())
            yield pa.RecordBatch.from_arrays([none, none, pa.array([d for d, _ in new], pa.int64()), zero, zero, strings], names)
            new.clear()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, digest long, docs long, n long, term string")


def by_string(docs: DataFrame, marked: np.ndarray, slots: int = SLOTS, bits: int = 64) -> DataFrame:
    """(lang, source, digest, term, docs, n) of the terms on marked slots, which are few: each document's own counts."""
    shared = docs.sparkSession.sparkContext.broadcast(marked)
    names = ["lang", "source", "digest", "term", "docs", "n"]

    def run(batches):
        long = Counter()
        for own, span, last, several in parts(batches, names[:2], bits, shared.value, slots):
            ends = np.searchsorted(span.at, np.searchsorted(span.start, span.ends))
            for group, a, b in zip(own, np.append(0, ends[:-1]), ends, strict=True):
                found = Counter((int(span.digest[c]), span.term(k)) for c, k in zip(span.words[a:b], span.at[a:b], strict=True))
                if several:
                    long.update(found)
                    found, long = (long, Counter()) if last else (Counter(), long)
                if found:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(names, (*group, d, t.decode("utf-8", "surrogatepass"), 1, n), strict=True)) for (d, t), n in found.items()],
                        pa.schema([(c, pa.int64() if c in ("digest", "docs", "n") else pa.string()) for c in names]),
                    )
        release()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, digest long, term string, docs long, n long")


def share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * v)), exact; null without kept terms."""
    below = f"nullif(cast({total} + {SMOOTH} * v as decimal(20,0)), cast(0 as decimal(20,0)))"
    return F.expr(f"1 + (cast({count} + {SMOOTH} as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div {below}")


def distances(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value): sums of |p - q| over the terms of ``rows``, for every two sources that meet in a task, both ways.

    ``rows``: lang, block, source, tile, tiles, v, term key, p, p0; a row without a term key for each source and block. Terms that
    no source of a task has are not listed there: all ``v`` terms count as such once, in block 0, and listed ones are taken off.
    """

    def run(key, table):
        lang, block, low, high = (k.as_py() for k in key)
        v = 0 if block else table["v"][0].as_py()
        names, place = np.unique(table["source"].to_numpy(), return_inverse=True)
        tile, rest = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
        tile[place], rest[place] = table["tile"].to_numpy(), table["p0"].to_numpy()
        found = table["term"].is_valid().to_numpy()
        terms, code = np.unique(table["term"].to_numpy()[found], return_inverse=True)
        shares = np.repeat(rest[:, None], len(terms), axis=1)
        shares[place[found], code] = table["p"].drop_null().to_numpy()
        left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        a, b, value = [], [], []
        for k in left:
            others = right[right > k] if low == high else right
            a += [names[k]] * len(others)
            b += names[others].tolist()
            value += (np.abs(shares[others] - shares[k]).sum(1) + (v - len(terms)) * np.abs(rest[others] - rest[k])).tolist()
        return pa.table([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(value, pa.int64())], ["lang", "a", "b", "value"])

    met = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    spread = rows.select("*", met.alias("__other"))
    spread = spread.withColumns({"__low": F.least("tile", "__other"), "__high": F.greatest("tile", "__other")})
    sums = spread.groupBy("lang", "block", "__low", "__high").applyInArrow(run, "lang string, a string, b string, value long")
    total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return total.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("__e"), "value").select("lang", "__e.*", "value")


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP, slots: int = SLOTS, bits: int = 64
) -> DataFrame:
    """lang, source, part, item, value, rank: distances to all other sources, and the terms a source uses more than its language."""
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))))
    raw = written(occurrences(docs, bitmap(frequent(docs, least, bits), slots), slots, bits))
    named = written(raw.filter("term IS NOT NULL").groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")))
    split = raw.filter("lang IS NOT NULL").select("lang", "source", "digest", "docs", "n", F.lit("").alias("exact"))
    clash = named.filter("low <> high").select("digest")
    if not clash.isEmpty():  # these digests are counted again, by string
        again = by_string(docs, bitmap(clash, slots), slots, bits).join(clash, "digest", "left_semi")
        split = split.join(clash, "digest", "left_anti").unionByName(again.select("lang", "source", "digest", "docs", "n", F.col("term").alias("exact")))
    per = ["lang", "digest", "exact"]
    counts = split.groupBy("source", *per).agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    counts = written(counts)
    kept = counts.groupBy(*per).agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least).drop("docs")
    used = written(counts.drop("docs").join(kept, per))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    groups = (
        docs.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .na.fill(0, ["v", "lang_total", "total"])
        .withColumn("tile", F.floor(place / TILE).cast("int"))
        .withColumn("tiles", F.max("tile").over(W.partitionBy("lang")) + 1)
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / BLOCK).cast("int")))
        .withColumn("p0", F.coalesce(share("0", "total"), F.lit(0)))
    )
    groups = written(groups)
    rows = used.join(groups, ["lang", "source"]).withColumn("p", share("n", "total")).withColumn("q", share("lang_n", "lang_total"))
    tiled = ["lang", "source", "tile", "tiles", "v", "p0"]
    term = F.concat_ws(":", "digest", "exact")
    cells = rows.select(*tiled, "p", term.alias("term"), F.pmod(F.xxhash64("digest", "exact"), F.col("blocks")).cast("int").alias("block"))
    heads = groups.select(*tiled, F.lit(None).cast("long").alias("p"), F.lit(None).cast("string").alias("term"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    pairs = distances(cells.unionByName(heads)).select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    own = W.partitionBy("lang", "source")
    more = rows.filter("p > q").select("lang", "source", "digest", "exact", (F.col("p") - F.col("q")).alias("value"))
    more = more.withColumn("__r", F.rank().over(own.orderBy(F.desc("value")))).filter(F.col("__r") <= top)
    listed = more.join(named.select("digest", "low"), "digest").select(
        "lang", "source", F.lit("term").alias("part"), F.when(F.col("exact") == "", F.col("low")).otherwise(F.col("exact")).alias("item"), "value"
    )
    order = own.orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, listed)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between the sources of each language, and each source's overused terms."""
    return audit(spark.read.parquet(f"{folder}/documents.parquet"))


_CLASS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_CLASS}')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST}
), l AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang
), c AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY w.lang, w.source, w.term
), t AS (
  SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), g AS (
  SELECT s.lang, s.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v, l.total AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN t USING (lang, source) LEFT JOIN l USING (lang)
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH})) // (g.total + {SMOOTH} * g.v) AS p,
    1 + ({SCALE}::HUGEINT * (k.n + {SMOOTH})) // (g.lang_total + {SMOOTH} * g.v) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), x AS (
  SELECT a.lang, a.source, b.source AS other, sum(abs(a.p - b.p)) AS value FROM f a JOIN f b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.other = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM f WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
