"""Toxicity by Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned from labelled rows: words, and stems (word beginnings) that many toxic words share. Its trie is
intersected with the Levenshtein automaton of one edit (terms of ``FUZZY`` letters or more) and made deterministic; the
table of that automaton runs over all words of a batch at once, one letter a step, and words that can't match drop out.
A hit weighs by how much more often that term, at that distance, occurs in a toxic row's words than in another's. A context window adds up the hits within
``WINDOW`` words; hits between quotation marks near them are added up apart, so that quotation can count less than abuse.
A logistic model of these sums gives the score.

Fitting takes at most ``SAMPLE`` labelled rows (those with the smallest hash of their id), at most ``TERMS`` terms; both are
parameters. Scoring takes whole texts. Null and empty texts have no hits; without any labelled row of both kinds every score
is the smoothed share of toxic rows. Label rows without an id or label are ignored; of repeated ones the larger label counts.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigstat.llm import pretokens
from sigstat.llm.batches import column, gather, pieces, texts, written

SAMPLE, TERMS, LEAST, CHANCE = 20_000, 300, 4, 1e-6
STEMS, FUZZY, WINDOW, NEAR = range(3, 9), 5, 16, 80
QUOTES = "\"“”„«»‹›"
THRESHOLD = 0.7


def words_of(texts_: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """Joined lower-case text, starts and ends of its words, and where each text ends in it."""
    lower = [x.lower() for x in texts_]
    whole = "\n".join(lower) + "\n"
    inside = np.concatenate(([False], np.isin(pretokens.classes()[pretokens.points(whole)], (pretokens.LETTER, pretokens.NUMBER)), [False]))
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return whole, turn[::2], turn[1::2], np.cumsum(np.fromiter((len(x) + 1 for x in lower), np.int64, len(lower)))


# ---- automaton


@dataclass
class Automaton:
    symbols: dict[int, int]  # code point -> column; column 0 is any other
    table: np.ndarray  # state x column -> state; 0 is the dead state, 1 the start
    found: np.ndarray  # state -> 2 * term + distance of a word that ends there, or -1

    def run(self, cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that match, and their codes."""
        map_ = np.zeros(0x110000, np.int32)
        for c, k in self.symbols.items():
            map_[c] = k
        sym = map_[cp]
        flat, width = self.table.ravel(), self.table.shape[1]
        word, at, end = np.arange(len(start)), start.copy(), end.copy()
        state = np.ones(len(start), np.int64)
        hits, codes = [], []
        while len(word):
            state = flat[state * width + sym[at]]
            at = at + 1
            over = (at == end) & (state > 0)
            if over.any():
                code = self.found[state[over]]
                hits.append(word[over][code >= 0]), codes.append(code[code >= 0])
            on = (state > 0) & (at < end)
            word, at, end, state = word[on], at[on], end[on], state[on]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hit, code = np.concatenate(hits), np.concatenate(codes)
        order = np.argsort(hit, kind="stable")
        return hit[order], code[order]


def automaton(terms: list[tuple[str, bool]]) -> Automaton:
    """The trie of (term, is a stem) with up to one edit, as a deterministic table."""
    nodes: list[dict[str, int]] = [{}]
    ends: dict[int, int] = {}
    longest = [0]  # length of the longest term through the node: edits only where a long enough term is ahead
    for k, (term, _) in enumerate(terms):
        node = 0
        for c in term:
            longest[node] = max(longest[node], len(term))
            if c not in nodes[node]:
                nodes[node][c] = len(nodes)
                nodes.append({}), longest.append(0)
            node = nodes[node][c]
        longest[node] = max(longest[node], len(term))
        ends[node] = k

    def closed(items: set) -> frozenset:
        out = set(items)
        for node, edits in items:
            if node >= 0 and edits == 0 and longest[node] >= FUZZY:
                out.update((child, 1) for child in nodes[node].values())
        # a stem that is complete accepts whatever follows
        for node, edits in list(out):
            if node >= 0 and node in ends and terms[ends[node]][1] and (edits == 0 or len(terms[ends[node]][0]) >= FUZZY):
                out.add((-1 - ends[node], edits))
        best = {}
        for node, edits in out:
            best[node] = min(edits, best.get(node, 9))
        return frozenset(best.items())

    def step(items: frozenset, c: str | None) -> frozenset:
        out = set()
        for node, edits in items:
            if node < 0:
                out.add((node, edits))
                continue
            if c is not None and (child := nodes[node].get(c)) is not None:
                out.add((child, edits))
            if edits == 0 and longest[node] >= FUZZY:
                out.add((node, 1))
                out.update((child, 1) for child in nodes[node].values())
        return closed(out)

    def code(items: frozenset) -> int:
        best = (9, -1)
        for node, edits in items:
            k = -1 - node if node < 0 else ends.get(node, -1)
            if k >= 0 and (edits == 0 or len(terms[k][0]) >= FUZZY):
                best = min(best, (edits, k))
        return -1 if best[1] < 0 else 2 * best[1] + best[0]

    letters = sorted({c for term, _ in terms for c in term})
    number = {c: k + 1 for k, c in enumerate(letters)}
    start = closed({(0, 0)})
    states, rows, todo = {frozenset(): 0, start: 1}, {0: np.zeros(len(letters) + 1, np.int32)}, [start]
    while todo:
        items = todo.pop()
        other = step(items, None)
        row = {0: other}
        ahead = {c for node, _ in items if node >= 0 for c in nodes[node]}
        row |= {number[c]: step(items, c) for c in ahead}
        for target in row.values():
            if target not in states:
                states[target] = len(states)
                todo.append(target)
        made = np.full(len(letters) + 1, states[other], np.int32)
        for k, target in row.items():
            made[k] = states[target]
        rows[states[items]] = made
    found = np.full(len(states), -1, np.int32)
    for items, k in states.items():
        found[k] = code(items)
    return Automaton({ord(c): k for c, k in number.items()}, np.stack([rows[k] for k in range(len(states))]), found)


# ---- features


def hits(machine: Automaton, texts_: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Words of each text; text, code, word number and whether it stands between quotation marks, of every hit."""
    whole, start, end, bounds = words_of(texts_)
    cp = pretokens.points(whole)
    word, code = machine.run(cp, start, end)
    text = np.searchsorted(bounds, start[word], "right")
    sizes = np.diff(np.searchsorted(start, np.concatenate(([0], bounds))))
    marks = np.flatnonzero(np.isin(cp, [ord(c) for c in QUOTES]))
    if not len(marks):
        return sizes, (text, code, word, np.zeros(len(word), bool))
    low = np.maximum(start[word] - NEAR, np.where(text > 0, bounds[text - 1], 0))
    high = np.minimum(end[word] + NEAR, bounds[text])
    before = np.searchsorted(marks, start[word]) > np.searchsorted(marks, low)
    after = np.searchsorted(marks, high) > np.searchsorted(marks, end[word])
    return sizes, (text, code, word, before & after)


def features(sizes: np.ndarray, text: np.ndarray, code: np.ndarray, word: np.ndarray, quoted: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Constant; strongest window, total and density of the hits outside quotation marks; strongest window within them.

    ``sizes`` has the number of words of each text.
    """
    n = len(sizes)
    out = np.zeros((n, 5))
    out[:, 0] = 1
    weight = weights[code]
    for place, own in ((1, ~quoted), (4, quoted)):
        t, p, w = text[own], word[own], weight[own]
        if len(t):
            running = np.concatenate(([0.0], np.cumsum(w)))
            until = np.minimum(np.searchsorted(p, p + WINDOW), np.searchsorted(t, t, "right"))
            np.maximum.at(out[:, place], t, running[until] - running[:-1])
            if place == 1:
                total = np.bincount(t, w, n)
                out[:, 2], out[:, 3] = np.log1p(total), np.log1p(100 * total / np.maximum(sizes, 10))
    return out


@dataclass
class Model:
    machine: Automaton
    terms: list[tuple[str, bool]]
    weights: np.ndarray
    beta: np.ndarray

    def scores(self, texts_: list[str]) -> np.ndarray:
        sizes, found = hits(self.machine, texts_)
        x = features(sizes, *found, self.weights)
        return 1 / (1 + np.exp(-np.clip(x @ self.beta, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the constant is free."""
    beta = np.zeros(x.shape[1])
    free = np.full(x.shape[1], ridge)
    free[0] = 1e-9
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - free * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(free + 1e-12), grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


# ---- fitting


def held_out(doc_id: Column) -> Column:
    """Rows that learning never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(text, y) of at most ``sample`` labelled rows outside the held-out fold; so few that their ids may be broadcast."""
    few = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col(label)).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", "y")


def _counted(rows: DataFrame) -> DataFrame:
    """Document frequency of every word and stem among toxic and other rows; kind is the stem's length, 0 for a word."""

    def run(batches):
        for part in pieces(batches, "text"):
            label = column(part, "y").to_pylist()
            sums: dict = defaultdict(lambda: [0, 0])
            for x, y in zip(texts(part), label, strict=True):
                whole, start, end, _ = words_of([x])
                words = {whole[a:b] for a, b in zip(start.tolist(), end.tolist())}
                seen = {(w, 0) for w in words if len(w) >= 3}
                seen.update((w[:k], k) for w in words for k in STEMS if len(w) > k)
                for s in seen:
                    sums[s][y] += 1
            yield pa.RecordBatch.from_pylist(
                [{"term": t, "kind": k, "clean": c, "toxic": x} for (t, k), (c, x) in sums.items()],
                pa.schema([("term", pa.string()), ("kind", pa.int32()), ("clean", pa.int64()), ("toxic", pa.int64())]),
            )

    sums = rows.mapInArrow(run, "term string, kind int, clean long, toxic long")
    return sums.groupBy("term", "kind").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def chance(toxic: int, clean: int, share: float) -> float:
    """How likely these counts are if toxic rows are ``share`` of all."""
    ways = math.lgamma(toxic + clean + 1) - math.lgamma(toxic + 1) - math.lgamma(clean + 1)
    return math.exp(ways + toxic * math.log(share) + clean * math.log1p(-share))


def lexicon(counts: DataFrame, clean: int, toxic: int, terms: int = TERMS) -> list[tuple[str, bool]]:
    """Terms far more frequent in toxic rows; of a stem and its one longer form the longer."""
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = (
        counts.filter((F.col("toxic") >= LEAST) & (odds > 2) & (F.col("toxic") > F.col("clean")))
        .orderBy((odds * F.col("toxic")).desc(), "term", "kind")
        .limit(20 * terms)
        .collect()
    )
    best = [r for r in best if chance(r.toxic, r.clean, toxic / (toxic + clean)) < CHANCE]
    found = {(r.term, r.kind): r.toxic for r in best}
    below: Counter = Counter()
    for (term, kind), n in found.items():
        for k in STEMS:
            if len(term) > k and (kind == 0 or kind > k):
                below[term[:k], k] = max(below[term[:k], k], n)
    chosen: list[tuple[str, bool]] = []
    for r in best:
        key = (r.term, r.kind)
        longer = below[key] if r.kind else 0
        shorter = any((r.term[:k], k) in found and below[r.term[:k], k] < 0.8 * found[r.term[:k], k] for k in STEMS if len(r.term) > k and (not r.kind or r.kind > k))
        if longer < 0.8 * r.toxic and not shorter:
            chosen.append((r.term, r.kind > 0))
    return sorted(chosen[:terms])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, terms: int = TERMS) -> Model:
    """Learn lexicon, weights and logistic model from labelled rows outside the held-out fold."""
    rows = written(training_rows(docs, labels, label, sample))
    sums = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    clean, toxic = sums.get(0, 0), sums.get(1, 0)
    prior = math.log((toxic + 0.5) / (clean + 0.5))
    if not clean or not toxic:
        return Model(automaton([]), [], np.zeros(0), np.array([prior, 0, 0, 0, 0]))
    chosen = lexicon(_counted(rows), clean, toxic, terms)
    machine = automaton(chosen)

    def run(batches):
        for part in pieces(batches, "text"):
            sizes, (text, code, word, quoted) = hits(machine, texts(part))
            cut_ = np.searchsorted(text, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_pylist(
                [{"y": y, "size": n, "code": code[a:b].tolist(), "word": word[a:b].tolist(), "quoted": quoted[a:b].tolist()} for y, n, a, b in zip(column(part, "y").to_pylist(), sizes.tolist(), cut_, cut_[1:])],
                pa.schema([("y", pa.int32()), ("size", pa.int64()), ("code", pa.list_(pa.int32())), ("word", pa.list_(pa.int64())), ("quoted", pa.list_(pa.bool_()))]),
            )

    found = rows.mapInArrow(run, "y int, size long, code array<int>, word array<long>, quoted array<boolean>").collect()  # at most the sample
    y = np.array([r.y for r in found], float)
    sizes = np.array([r.size for r in found])
    text = np.repeat(np.arange(len(found)), [len(r.code) for r in found])
    code = np.array([c for r in found for c in r.code], np.int64)
    word = np.array([w for r in found for w in r.word], np.int64)
    quoted = np.array([q for r in found for q in r.quoted], bool)
    codes = 2 * len(chosen)
    words = [max(float(sizes[y == k].sum()), 1.0) for k in (0, 1)]
    rates = [(np.bincount(code, y[text] == k, codes) + 0.5) / n for k, n in zip((0, 1), words, strict=True)]
    weights = np.maximum(np.log(rates[1]) - np.log(rates[0]), 0) * (np.bincount(code, y[text], codes) >= 2)
    word = word + text * (1 << 32)  # windows never reach into the next text
    return Model(machine, chosen, weights, logistic(features(sizes, text, code, word, quoted, weights), y))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score; it replaces a column of that name."""
    fields = [f for f in docs.schema.fields if f.name != out]
    names = [f.name for f in fields]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of terms

    def run(batches):
        for part in pieces(batches, text):
            yield pa.RecordBatch.from_arrays([*(column(part, n) for n in names), pa.array(shared.value.scores(texts(part, text)))], [*names, out])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that aren't predicted toxic, with their columns."""
    own = "__toxicity"  # the text goes to Python once, with the row
    return score(docs, fit(docs, labels), out=own).filter(F.col(own) < threshold).select(*docs.columns)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its score, learned outside the held-out fold."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
