"""Conversation structure repair: cheapest edits by Four-Russians block tables.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Its rows are symbols (initial, truncated or not, or
bound to go) and an automaton of four states reads them; the cost from each state to the end is a vector of four numbers, which
less its minimum takes few values. They are enumerated once; a table then gives, for every such vector behind a block of
``LENGTH`` symbols, the vector before the block and the cost added. All conversations of a piece are carried from their ends to
their beginnings block by block, one lookup each. For the trace each block is expanded backward again, symbol by symbol, so that
every row knows the vector behind it; going forward, a table by vector, symbol and state has the first letter of all cheapest edits
in ASCII order, which makes the audit the least of all cheapest ones.

A conversation of more than ``CHUNK`` rows is cut into chunks of that many rows, which are worked on apart: each is read from the
four unit vectors at once (a min-plus matrix), one pass in reverse order composes the matrices to the vector behind each chunk, the
exits of a chunk for each entry follow from it, one pass forward composes these, and every chunk traces itself. These passes
stream over one small row per chunk. Order within hot conversations comes in blocks from ``ordered_scan``. SHA-256 goes through
a conversation's text in order, by its definition: chunks' texts are streamed to it, sorted, and never held together.

Null role and text, and null ids and turns within the damage key, are one space; a null conv_id is a conversation of its own. Rows
of one turn are ordered by role, then text. A repeated row is a duplicate like any other. A conversation without rows after damage
has zeros, an empty audit and the digest of nothing; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigstat.llm.batches import column, pieces, release, written
from sigstat.plans import skew
from sigstat.plans.ordered import ordered_scan
from sigstat.plans.skew import attach, find_hot_keys, largest_group

#: Fixed by the contract: characters that do not count, ends of a sentence, costs, legal neighbours.
BLANK, ENDS, LEGAL = " \t\n\x0b\x0c\r", ".!?", ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. Where user or assistant leads from each, and where each kept initial may.
START, SYSTEM, USER, ASSISTANT = range(4)
ADDED = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
#: Symbols: 0 no row, 1 to 8 initial (s, u, a, other) and truncated or not, 9 bound to go.
GONE, SYMBOLS = 9, 10
LENGTH, CHUNK, NEVER = 4, 1024, 1 << 20
#: Inserts behind the last row, by state.
TAIL = ((), (USER, ASSISTANT), (ASSISTANT,), ())
FAULTS = ("blank", "duplicate", "truncated")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the contract's damage."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate(word("text"), ENDS, "")).otherwise(word("text"))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("__kind")).filter("__kind <> 0")
    rows = rows.select("conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(word("role")).alias("role"), text.alias("text"), "__kind")
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("__kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", copies.alias("__copy")).drop("__copy")


# --- tables


def normal(vector) -> tuple[tuple[int, ...], int]:
    low = min(vector)
    return tuple(min(v - low, NEVER) if v < NEVER else NEVER for v in vector), low


def row_edits(symbol: int, x: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row, without inserts."""
    edits = [("D", DELETE, x)]
    if symbol != GONE:
        initial, cut = divmod(symbol - 1, 2)
        if x in KEPT[initial]:
            edits.append(("K", TRUNCATED * cut, KEPT[initial][x]))
        edits.append(("R", REROLE + TRUNCATED * cut, ADDED[x]))
    return edits


def before(symbol: int, after) -> list[int]:
    """Costs before a row from those behind it."""
    costs = [min(c + after[y] for _, c, y in row_edits(symbol, x)) for x in range(4)]
    for _ in range(4):
        costs = [min(costs[x], INSERT + costs[ADDED[x]]) for x in range(4)]
    return costs


class Tables:
    """Vectors, their transitions by symbol and by block, and the moves of a trace."""

    def __init__(self):
        end = tuple(INSERT * len(t) for t in TAIL)
        units = [tuple(0 if x == y else NEVER for x in range(4)) for y in range(4)]
        self.vectors, self.number = [], {}
        for v in (end, *units):
            self._add(v)
        one, added = [], []
        for v in self.vectors:  # grows while it is read
            found = [(v, 0)] + [normal(before(s, v)) for s in range(1, SYMBOLS)]
            one.append([self._add(w) for w, _ in found])
            added.append([low for _, low in found])
        self.one, self.one_cost = np.array(one, np.int32), np.array(added, np.int32)
        self.block, self.cost = self.one, self.one_cost
        for _ in range(LENGTH - 1):  # a block is a symbol in front of a shorter block
            cost = self.cost[:, None, :] + self.one_cost[self.block].transpose(0, 2, 1)
            self.block = self.one[self.block].transpose(0, 2, 1).reshape(len(one), -1)
            self.cost = cost.reshape(len(one), -1)
        self.moves, known = [], {}
        self.move = np.zeros((len(one), SYMBOLS, 4), np.int32)
        self.to = np.zeros((len(one), SYMBOLS, 4), np.int32)
        for v, s, x in product(range(len(one)), range(SYMBOLS), range(4)):
            made = self._least(s, self.vectors[v], x) if s else ("", (), x)
            self.move[v, s, x] = known.setdefault(made, len(known))
            self.to[v, s, x] = made[2]
        self.moves = list(known)

    def _add(self, vector) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    @staticmethod
    def _least(symbol: int, after, x: int) -> tuple[str, tuple[int, ...], int]:
        """Letters up to and with that of the row, states that inserts lead to, the state behind the row."""
        letters, inserted, costs = "", [], before(symbol, after)
        while True:
            edits = [(a, c + after[y], y) for a, c, y in row_edits(symbol, x)] + [("I", INSERT + costs[ADDED[x]], None)]
            letter, _, y = min((e for e in edits if e[1] == costs[x]), key=lambda e: e[0])
            letters += letter
            if letter != "I":
                return letters, tuple(inserted), y
            x = ADDED[x]
            inserted.append(x)


@functools.cache
def tables() -> Tables:
    return Tables()


# --- many conversations at once


def padded(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols as a matrix, one group a row, with no-row symbols behind; which places are rows."""
    sizes = np.diff(np.append(starts, len(symbols)))
    width = -(-int(sizes.max(initial=1)) // LENGTH) * LENGTH
    there = np.arange(width) < sizes[:, None]
    out = np.zeros(there.shape, np.int64)
    out[there] = symbols
    return out, there


def backward(symbols: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors before the first symbol, the cost added to them, and the vectors behind each block."""
    t = tables()
    codes = symbols.reshape(len(symbols), -1, LENGTH) @ SYMBOLS ** np.arange(LENGTH - 1, -1, -1)
    ends, cost = np.empty(codes.shape, np.int32), np.zeros(len(codes), np.int64)
    for k in range(codes.shape[1] - 1, -1, -1):
        ends[:, k] = vector
        cost += t.cost[vector, codes[:, k]]
        vector = t.block[vector, codes[:, k]]
    return vector, cost, ends


def forward(symbols: np.ndarray, ends: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The move at each place, and the state behind the last."""
    t = tables()
    moves = np.zeros(symbols.shape, np.int32)
    for k in range(ends.shape[1]):
        own = symbols[:, k * LENGTH : (k + 1) * LENGTH]
        behind = [ends[:, k]]
        for j in range(LENGTH - 1, 0, -1):
            behind.append(t.one[behind[-1], own[:, j]])
        for j, vector in enumerate(reversed(behind)):
            moves[:, k * LENGTH + j] = t.move[vector, own[:, j], state]
            state = t.to[vector, own[:, j], state]
    return moves, state


def edited(moves: list[int], roles: list[str], bodies: list[str]) -> tuple[str, list[str]]:
    """The letters of a group's edits, and the lines that stay."""
    known, letters, lines = tables().moves, [], []
    for move, role, body in zip(moves, roles, bodies, strict=True):
        audit, inserted, state = known[move]
        letters.append(audit)
        lines += [f"{ROLE[x]}:" for x in inserted]
        if audit[-1] != "D":
            lines.append(f"{role if audit[-1] == 'K' else ROLE[state]}:{body}")
    return "".join(letters), lines


def tail(state: int) -> tuple[str, list[str]]:
    return "I" * len(TAIL[state]), [f"{ROLE[x]}:" for x in TAIL[state]]


# --- tables of rows


def marked(rows: DataFrame, hot=None) -> DataFrame:
    """Add position, size, fault (1 to 3, 0 none), symbol, illegal and fresh (a turn not seen before) to the rows."""
    end = F.rtrim("text", F.lit(BLANK))
    initial = F.substring("role", 1, 1)
    scan = ordered_scan(
        rows, ["conv_id"], ["turn", "role", "text"], index="pos", size="size",
        lag={"__prev": initial, "__turn": F.struct("turn")}, hot=hot,
    )
    same = ["conv_id", "role", "text"]
    if hot is None:  # conversations are whole in a task: no exchange
        scan = scan.withColumn("__first", F.min("pos").over(W.partitionBy(*same)))
    else:
        scan = attach(scan, scan.groupBy(*same).agg(F.min("pos").alias("__first")), same)
    blank, again = end == "", F.col("pos") > F.col("__first")
    cut = ~F.substring(end, -1, 1).isin(list(ENDS))
    fault = F.when(blank, 1).when(again, 2).when(cut, 3).otherwise(0)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return scan.select(
        "conv_id", "turn", "role", "text", "pos", "size",
        fault.alias("fault"),
        F.when(fault.isin(1, 2), GONE).otherwise(1 + 2 * place + cut.cast("int")).alias("symbol"),
        (F.col("__prev").isNotNull() & ~F.concat("__prev", initial).isin(list(LEGAL))).alias("illegal"),
        (F.col("turn").isNotNull() & (F.col("__turn").isNull() | ~F.col("__turn.turn").eqNullSafe(F.col("turn")))).alias("fresh"),
    )


def groups(batches, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Batches that begin and end where a conversation or chunk does, from rows in order; one that is longer is taken alone."""
    held: list[pa.RecordBatch] = []
    for part in pieces(batches, "text"):
        starts = np.flatnonzero(column(part, "pos").to_numpy() % chunk == 0)
        if len(starts):
            if held or starts[-1]:
                yield from pa.Table.from_batches([*held, part.slice(0, int(starts[-1]))]).combine_chunks().to_batches()
            held = [part.slice(int(starts[-1]))]
        else:
            held.append(part)
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    release()


STATS = "gaps long, blank long, duplicate long, truncated long, illegal long"


def whole(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The report of conversations of at most ``chunk`` rows; each is whole and in order in a partition of ``rows``."""
    fields = [rows.schema["conv_id"], *T.StructType.fromDDL(f"{STATS}, cost long, audit string, repaired_sha256 string")]

    def run(batches):
        for part in groups(batches, chunk):
            starts = np.flatnonzero(column(part, "pos").to_numpy() == 0)
            symbols, there = padded(column(part, "symbol").to_numpy().astype(np.int64), starts)
            vector, cost, ends = backward(symbols, np.zeros(len(starts), np.int64))
            moves, state = forward(symbols, ends, np.zeros(len(starts), np.int64))
            cost += np.array([v[START] for v in tables().vectors])[vector]
            moves, roles, bodies = moves[there].tolist(), column(part, "role").to_pylist(), column(part, "text").to_pylist()
            audits, digests = [], []
            for a, b, x in zip(starts, np.append(starts[1:], part.num_rows), state.tolist(), strict=True):
                audit, lines = edited(moves[a:b], roles[a:b], bodies[a:b])
                more, last = tail(x)
                audits.append(audit + more)
                digests.append(hashlib.sha256("\n".join(lines + last).encode("utf-8", "surrogatepass")).hexdigest())
            fault = column(part, "fault").to_numpy()
            turn, known = column(part, "turn").fill_null(0).to_numpy(), column(part, "turn").is_valid().to_numpy(zero_copy_only=False)
            add = lambda x: np.add.reduceat(x.astype(np.int64), starts)
            fresh = add(column(part, "fresh").to_numpy(zero_copy_only=False))
            big = np.iinfo(np.int64)
            high = np.maximum.reduceat(np.where(known, turn, big.min), starts)
            low = np.minimum.reduceat(np.where(known, turn, big.max), starts)
            gaps = np.where(fresh > 0, np.where(fresh > 0, high, 0) - np.where(fresh > 0, low, 0) + 1 - fresh, 0)
            counts = [gaps, *(add(fault == k) for k in (1, 2, 3)), add(column(part, "illegal").to_numpy(zero_copy_only=False))]
            yield pa.RecordBatch.from_arrays(
                [column(part, "conv_id").take(pa.array(starts)), *map(pa.array, counts), pa.array(cost), pa.array(audits, pa.string()), pa.array(digests, pa.string())],
                [f.name for f in fields],
            )

    return rows.mapInArrow(run, T.StructType(fields))


def chunked(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The report of conversations of more than ``chunk`` rows."""
    key = rows.schema["conv_id"]
    rows = written(rows.withColumn("chunk", F.floor(F.col("pos") / chunk)))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("pos", "symbol"))), lambda r: r["symbol"].cast("long"))
    table = rows.groupBy("conv_id", "chunk").agg(in_order.alias("symbols"))
    state = "chunk long, symbols array<bigint>, matrix array<int>, vector int, exits array<int>, entry int, cost long, last boolean"
    fields = [key, *T.StructType.fromDDL(state)]
    names = [f.name for f in fields]

    def lists(part, name):
        own = column(part, name)
        sizes = own.value_lengths().to_numpy(zero_copy_only=False)
        return padded(own.flatten().to_numpy(), np.cumsum(sizes) - sizes)[0]

    def matrices(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                symbols, t = lists(part, "symbols"), tables()
                flat = np.zeros((part.num_rows, 4, 4), np.int32)
                for y in range(4):
                    vector, cost, _ = backward(symbols, np.full(part.num_rows, 1 + y))
                    flat[:, :, y] = np.minimum(np.array(t.vectors)[vector] + cost[:, None], NEVER)
                none = pa.nulls(part.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [column(part, "conv_id"), column(part, "chunk"), column(part, "symbols"), pa.array(flat.reshape(-1, 16).tolist(), pa.list_(pa.int32())), none,
                     pa.nulls(part.num_rows, pa.list_(pa.int32())), none, pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.bool_())], names,
                )

    def composed(batches):
        """Chunks of a conversation in reverse order: the vector behind each, and the whole cost at the first."""
        now, ahead, total = object(), None, 0
        for batch in batches:
            out = batch.to_pylist()
            for r in out:
                if r["conv_id"] != now:
                    now, ahead, total, r["last"] = r["conv_id"], tables().vectors[0], 0, True
                else:
                    r["last"] = False
                r["vector"] = tables().number[ahead]
                m = r["matrix"]
                ahead, low = normal([min(m[4 * x + y] + ahead[y] for y in range(4)) for x in range(4)])
                total += low
                r["cost"], r["matrix"] = total + ahead[START], None
            yield pa.RecordBatch.from_pylist(out, batch.schema)

    def exits(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                symbols = lists(part, "symbols")
                _, _, ends = backward(symbols, column(part, "vector").to_numpy().astype(np.int64))
                found = np.stack([forward(symbols, ends, np.full(part.num_rows, x))[1] for x in range(4)], 1)
                data = {n: column(part, n) for n in names} | {"exits": pa.array(found.tolist(), pa.list_(pa.int32())), "symbols": pa.nulls(part.num_rows, pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_arrays(list(data.values()), names)

    def entered(batches):
        """Chunks of a conversation in order: the state before each."""
        now, x = object(), START
        for batch in batches:
            out = batch.to_pylist()
            for r in out:
                if r["conv_id"] != now:
                    now, x = r["conv_id"], START
                r["entry"], x = x, r["exits"][x]
            yield pa.RecordBatch.from_pylist(out, batch.schema)

    schema = T.StructType(fields)
    table = table.mapInArrow(matrices, schema).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
    table = table.mapInArrow(composed, schema).mapInArrow(exits, schema)
    table = written(table.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(entered, schema))
    own = attach(rows, table.select("conv_id", "chunk", "vector", "entry", "last"), ["conv_id", "chunk"], "inner")
    traced_fields = [key, *T.StructType.fromDDL("chunk long, audit string, text string")]

    def traced(batches):
        for part in groups(batches, chunk):
            starts = np.flatnonzero(column(part, "pos").to_numpy() % chunk == 0)
            symbols, there = padded(column(part, "symbol").to_numpy().astype(np.int64), starts)
            take = pa.array(starts)
            _, _, ends = backward(symbols, column(part, "vector").take(take).to_numpy().astype(np.int64))
            moves, state = forward(symbols, ends, column(part, "entry").take(take).to_numpy().astype(np.int64))
            last = column(part, "last").take(take).to_pylist()
            moves, roles, bodies = moves[there].tolist(), column(part, "role").to_pylist(), column(part, "text").to_pylist()
            audits, kept = [], []
            for a, b, x, end in zip(starts, np.append(starts[1:], part.num_rows), state.tolist(), last, strict=True):
                audit, lines = edited(moves[a:b], roles[a:b], bodies[a:b])
                more, extra = tail(x) if end else ("", [])
                audits.append(audit + more)
                kept.append("\n".join(lines + extra) if lines or extra else None)
            yield pa.RecordBatch.from_arrays(
                [column(part, "conv_id").take(take), column(part, "chunk").take(take), pa.array(audits, pa.string()), pa.array(kept, pa.string())], [f.name for f in traced_fields]
            )

    def joined(batches):
        """Chunks of a conversation in order: its whole audit, and the digest of its text."""

        def row():
            return {"conv_id": now, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        now, audit, digest, first = object(), [], None, True
        out = pa.schema([("conv_id", pa_kind), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for part in pieces(batches, "text"):
            done = []
            for r in part.to_pylist():
                if r["conv_id"] != now:
                    if digest:
                        done.append(row())
                    now, audit, digest, first = r["conv_id"], [], hashlib.sha256(), True
                audit.append(r["audit"])
                if r["text"] is not None:
                    digest.update(("" if first else "\n").encode() + r["text"].encode("utf-8", "surrogatepass"))
                    first = False
            yield pa.RecordBatch.from_pylist(done, out)
        if digest:
            yield pa.RecordBatch.from_pylist([row()], out)

    from pyspark.sql.pandas.types import to_arrow_type

    pa_kind = to_arrow_type(key.dataType)
    parts = own.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "pos").mapInArrow(traced, T.StructType(traced_fields))
    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    texts = parts.mapInArrow(joined, T.StructType([key, *T.StructType.fromDDL("audit string, repaired_sha256 string")]))
    count = lambda c: F.sum(c.cast("long"))
    span = F.max("turn") - F.min("turn") + 1 - count(F.col("fresh"))
    stats = rows.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *(count(F.col("fault") == k + 1).alias(n) for k, n in enumerate(FAULTS)), count(F.col("illegal")).alias("illegal")
    )
    costs = table.filter("chunk = 0").select("conv_id", "cost")
    return attach(attach(stats, costs, ["conv_id"], "inner"), texts, ["conv_id"], "inner")


def repaired(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, faults before, cost and letters of the cheapest edits, and the digest of the repaired conversation."""
    rows = damaged(conversations)
    largest = largest_group(rows, ["conv_id"])
    hot = find_hot_keys(rows, ["conv_id"], ["turn", "role", "text"]) if largest > skew.BLOCK_ROWS else None
    scan = marked(rows, hot)
    if largest <= chunk:  # the window has each conversation whole in a task
        report = whole(scan.sortWithinPartitions("conv_id", "pos"), chunk)
    else:
        scan = written(scan)
        small = scan.filter(F.col("size") <= chunk).repartition("conv_id").sortWithinPartitions("conv_id", "pos")
        report = whole(small, chunk).unionByName(chunked(scan.filter(F.col("size") > chunk), chunk))
    every = attach(conversations.select("conv_id").distinct(), report, ["conv_id"])
    longs = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return every.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation's faults after the damage, and its cheapest repair."""
    return repaired(spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text"))


def _step(x: str) -> str:
    """Edits of a row from the state ``x``: letter, cost, next state, line."""
    return f"""SELECT 'D' AS letter, {DELETE} AS c, {x} AS y, '' AS line
      UNION ALL SELECT 'K', CASE WHEN f.fault = 3 THEN {TRUNCATED} ELSE 0 END,
        CASE f.initial WHEN 's' THEN {SYSTEM} WHEN 'u' THEN {USER} ELSE {ASSISTANT} END, chr(10) || f.role || ':' || f.text
        WHERE f.fault NOT IN (1, 2) AND ((f.initial = 's' AND {x} = {START}) OR (f.initial = 'u' AND {x} <> {USER}) OR (f.initial = 'a' AND {x} = {USER}))
      UNION ALL SELECT 'R', {REROLE} + CASE WHEN f.fault = 3 THEN {TRUNCATED} ELSE 0 END, CASE WHEN {x} = {USER} THEN {ASSISTANT} ELSE {USER} END,
        chr(10) || CASE WHEN {x} = {USER} THEN 'assistant:' ELSE 'user:' END || f.text WHERE f.fault NOT IN (1, 2)"""


def _inserts() -> str:
    rows = []
    for x in range(4):
        y, line = x, ""
        for k in range(3):
            rows.append(f"({x}, '{'I' * k}', {INSERT * k}, {y}, '{line}')")
            y = ADDED[y]
            line += f"|{ROLE[y]}:"
    return f"SELECT x, letters, c, y, replace(line, '|', chr(10)) AS line FROM (VALUES {', '.join(rows)}) AS v(x, letters, c, y, line)"


_LAST = r"regexp_extract(text, '[^\x20\x09-\x0D](?:[\x20\x09-\x0D]*)$')"
SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) AS r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(1 + (xor(c, b) & 255))::INT]))) % 20 AS kind
  FROM conversations, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '{ENDS}', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM h WHERE kind <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial FROM d
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
    WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 2
    WHEN left({_LAST}, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o
), n AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN {LEGAL}) AS illegal FROM f GROUP BY conv_id
), ins AS ({_inserts()}), p AS (
  SELECT conv_id, 0 AS i, {START} AS x, 0 AS cost, '' AS audit, '' AS body FROM n
  UNION ALL
  SELECT conv_id, i, x, cost, audit, body FROM (
    SELECT p.conv_id, p.i + 1 AS i, e.y AS x, p.cost + ins.c + e.c AS cost, p.audit || ins.letters || e.letter AS audit, p.body || ins.line || e.line AS body,
      row_number() OVER (PARTITION BY p.conv_id, e.y ORDER BY p.cost + ins.c + e.c, p.audit || ins.letters || e.letter) AS best
    FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1 JOIN ins ON ins.x = p.x, LATERAL ({_step('ins.y')}) e
  ) WHERE best = 1
), ended AS (
  SELECT p.conv_id, cost + c AS cost, audit || letters AS audit, body || line AS body
  FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.rows = p.i JOIN ins ON ins.x = p.x WHERE ins.y IN ({START}, {ASSISTANT})
), best AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS k FROM ended
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(substr(body, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id AND best.k = 1
"""
