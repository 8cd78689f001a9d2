"""Hierarchical records as a flat node table, and questionnaires over it.

A node table has ``doc_id, node_id, parent_id, level, seq, ordinal, entry, value,
is_structural, subtree_end``: ``seq`` numbers nodes in pre-order, ``subtree_end`` is
the last number below a node, so a subtree is an interval and "first below" is the
next hit in one ordered pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.patterns import glob_to_regex
from ..plans import skew
from ..plans.asof import asof_join
from ..plans.ordered import AUTO, LARGE, STORED, attach, once, ordered_scan, stored
from ..plans.skew import BLOCK, TIE, find_hot_keys, row_hash, with_blocks
from ..registry import operator
from ..session import materialise

NODE = ("doc_id", "node_id", "parent_id", "level", "seq", "ordinal", "entry", "value", "is_structural", "subtree_end")
BLOCK_ROWS = 400_000  # windows in a chain each hold a block of wide rows: 2 million of them spill in a task of 1 GB


def block_rows() -> int:
    return min(BLOCK_ROWS, skew.BLOCK_ROWS)


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


@operator("split_entries")
def split_entries(lines: DataFrame, entry_delim: str, kv_delim: str, keep: Sequence[str] = ("doc_id", "line_no"), text: str = "lines") -> DataFrame:
    """Entries of each line: ``pos, key, value, raw``; blanks go, entries without the delimiter have nulls."""
    parts = F.split(F.col(text), _quoted(entry_delim), -1)
    rows = lines.select(*keep, F.posexplode(parts).alias("pos", "raw")).where(F.col("raw").rlike(r"\S"))
    at = F.instr("raw", kv_delim)
    key = F.when(at > 0, F.regexp_replace(F.substring("raw", F.lit(1), at - 1), r"^\s+|\s+$", ""))
    value = F.when(at > 0, F.regexp_replace(F.substring("raw", at + len(kv_delim), F.length("raw")), r"^\s+|\s+$", ""))
    return rows.select(*keep, "pos", key.alias("key"), value.alias("value"), "raw")


def _nested(marks: DataFrame, hot, parents: bool = True) -> DataFrame:
    """``end``, and ``parent`` if asked for, of nodes in pre-order, from ``doc_id, node, depth`` where no depth exceeds the last by more than one.

    ``last``, the depth of the node before, is found by a pass of its own unless ``marks``, a scan of stored tables then, has it.

    A node closes what is open from the depth of the node before down to its own, and each node is closed at most
    once; so openings, closings and children, keyed by the level that they concern, meet in one ordered pass, whatever
    the depth.  ``end`` is the number of the node that closes, null at the end of the document.
    """
    if "last" not in marks.columns:
        marks = ordered_scan(marks, ["doc_id"], ["node"], lag={"last": "depth"}, hot=hot, rows=block_rows(), numbered=True)
        hot = AUTO if hot == STORED else hot
    elif hot is None:  # small documents: the exchange by document serves the levels too, and nodes are fewer than events
        marks = marks.repartition("doc_id")
    event = lambda level, kind: F.struct(level.cast("int").alias("__l"), F.lit(kind).alias("__kind"))
    last, depth = F.col("last"), F.col("depth")
    shut = F.transform(F.sequence(F.when(last >= depth, depth), last), lambda level: event(level, 0))
    own = F.array(*([event(depth - 1, 1)] if parents else []), event(depth, 2))
    events = F.concat(F.coalesce(shut, F.array().cast("array<struct<__l:int,__kind:int>>")), own)
    events = marks.select("doc_id", F.col("node").alias("__t"), F.explode(events).alias("__e")).select("doc_id", "__t", "__e.*")
    # node and kind in one number, the order: few bytes to move
    events = events.select("doc_id", "__l", (F.col("__t") * 4 + F.col("__kind")).alias("__at"))
    node, kind = F.shiftright("__at", 2), F.pmod("__at", F.lit(4))
    scan = ordered_scan(
        events, ["doc_id", "__l"], ["__at"],
        ffill={"__up": F.when(kind == 2, node)}, bfill={"__shut": F.when(kind == 0, node)},
        hot=hot, rows=block_rows(), numbered=True,
    )
    if not parents:
        return scan.where(kind == 2).select("doc_id", node.alias("node"), F.col("__shut").alias("end"))
    both = scan.where(kind > 0).select(
        "doc_id", node.alias("node"), F.when(kind == 1, F.col("__up")).alias("parent"),
        F.when(kind == 2, F.col("__shut")).alias("end"), F.when(kind == 2, F.col("__l")).alias("depth"),
    )
    # a node's two rows never meet in a task before the exchange: no table of sums beside the sorts there
    return both.repartition("doc_id", "node").groupBy("doc_id", "node").agg(*[F.max(c).alias(c) for c in ("parent", "end", "depth")])


def _open_nodes(entries: DataFrame, depth_key: str, order: list[str], hot) -> DataFrame:
    """Entries with their number, the node that each opens, the open node, its depth and that of the node before; markers that jump are left out.

    One pass over blocks in order, written once.  What a block takes from those before it (the last level, the height, its
    minimum, the open node) decides the step of the block's first marker and shifts the rest, so that inside blocks the
    first marker counts 0 and a row per block carries the rest.  The height is a sum of steps that never falls below 0:
    the running sum less its running minimum.
    """
    marker = F.col("key").eqNullSafe(F.lit(depth_key)) & F.col("value").rlike(r"^\d+$")
    base = entries.select("doc_id", *order, "key", "value", F.when(marker, F.col("value").try_cast("long")).alias("__level"))
    if hot in (AUTO, STORED):
        hot = find_hot_keys(base, ["doc_id"], order, block_rows(), counted=True)
    if hot is None:
        blocked = base.withColumns({TIE: F.lit(0), BLOCK: F.lit(-1)})
    else:  # the hash is taken again behind the exchange and doesn't move
        blocked = hot.dealt(with_blocks(base, hot, order).drop(TIE), F.size(F.flatten("__runs")) + 1)
        blocked = blocked.withColumn(TIE, row_hash(blocked.drop(BLOCK)))
    w = W.partitionBy("doc_id", BLOCK).orderBy(*order, *([] if hot is None else [TIE]))
    run, past = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    level, was, rn, rf = F.col("__level"), F.col("__was"), F.col("__rn"), F.col("__rf")
    local = blocked.withColumns({"__rn": F.row_number().over(w), "__was": F.last("__level", True).over(past)})
    later = level.isNotNull() & was.isNotNull()
    jump = later & (level > was + 1)
    step = F.when(later & ~jump, F.when(level > was, 1).otherwise(level - was)).otherwise(0)
    local = local.withColumn("__kind", F.when(jump, 2).when(later, 1).otherwise(0))
    kinds = {f"__{n}": F.sum((F.col("__kind") == k).cast("int")).over(run).cast("int") for n, k in (("c", 1), ("x", 2))}
    local = local.withColumns({"__rf": F.min(F.when(level.isNotNull(), rn)).over(run), "__s": F.sum(step.cast("long")).over(run), **kinds})
    place = (rn - 1 - F.col("__x") + F.col("__c")).cast("int")  # of a node in its block, one less than its number there
    sums = F.when(level.isNotNull(), F.col("__s"))
    local = local.withColumns({
        "__low": F.min(sums).over(run), "__ps": F.when(F.col("__kind") == 1, F.col("__s") - step), "__pl": F.when(F.col("__kind") == 1, F.min(sums).over(past)),
        "__open": F.last(F.when(F.col("__kind") == 1, place), True).over(run),
    })
    local = materialise(local.drop(*order, TIE, "__was"), "local")

    end = lambda c: F.max_by(c, "__rn")
    blocks = local.where(F.col(BLOCK) >= 0).groupBy("doc_id", BLOCK).agg(
        F.max("__rn").cast("long").alias("n"), F.min("__rf").alias("rf"), F.min(F.when(rn == rf, level)).alias("first"),
        F.max_by("__level", F.when(level.isNotNull(), rn)).alias("last"), end("__s").alias("s"), end("__c").alias("c"), end("__x").alias("x"),
        F.min("__low").alias("low"), end("__open").alias("open"),
    )
    before = W.partitionBy("doc_id").orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("in", F.last("last", True).over(before))
    first, last = F.col("first"), F.col("in")
    leap = F.coalesce(first > last + 1, F.lit(False))
    blocks = blocks.withColumns({
        "__dx": leap.cast("int"), "__dc": (first.isNotNull() & ~leap).cast("int"),
        "__ds": F.when(first.isNull() | leap, 0).when(last.isNull() | (first > last), 1).otherwise(first - last).cast("long"),
    })
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    blocks = blocks.withColumns({
        "__on": total("n"), "__os": total(F.col("s") + F.col("__ds")), "__oc": total(F.col("c") + F.col("__dc")), "__ox": total(F.col("x") + F.col("__dx")),
    })
    shift = F.col("__on") - F.col("__ox") - F.col("__dx") + F.col("__oc") + F.col("__dc") + 1
    left = shift + F.coalesce("open", F.when(F.col("__dc") == 1, F.col("rf") - 1))
    blocks = blocks.withColumns({
        "__il": F.min(F.col("__os") + F.col("__ds") + F.col("low")).over(before), "__io": F.last(left, True).over(before),
    })
    keep = ["__dx", "__dc", "__ds", "__on", "__os", "__oc", "__ox", "__il", "__io"]
    carry = materialise(blocks.select("doc_id", BLOCK, *keep), "carry")

    rows = attach(local, carry, ["doc_id", BLOCK])
    zero = F.lit(0)
    seen = rf.isNotNull()
    of = lambda c, other: F.when(seen, F.coalesce(c, F.lit(other))).otherwise(zero)
    dx, dc, ds = of("__dx", 0), of("__dc", 1), of("__ds", 1)
    was_s, head = F.coalesce("__os", zero), F.coalesce(rn == rf, F.lit(False))
    x, c = F.coalesce("__ox", zero) + dx + F.col("__x"), F.coalesce("__oc", zero) + dc + F.col("__c")
    # numbers: 0 the first node, 1 its level leaf, then entries with a node before each marker; a detached marker takes its leaf with it
    seq = F.coalesce("__on", zero) + rn - 1 - x + c + 2
    low = F.least("__il", F.when(seen, was_s + ds + F.col("__low")))
    height = was_s + ds + F.col("__s") - F.least(low, zero)
    # the height before a marker: that of the row before in its block, or at the end of the blocks before
    inside = was_s + ds + F.col("__ps") - F.least("__il", was_s + ds + F.col("__pl"), zero)
    last = F.when(head, F.when(F.col("__io").isNotNull(), was_s - F.least("__il", zero))).otherwise(inside)
    base_ = F.coalesce("__on", zero) - F.coalesce("__ox", zero) - dx + F.coalesce("__oc", zero) + dc + 1
    opened = F.coalesce(base_ + F.col("__open"), F.when(seen & (dc == 1), base_ + rf - 1), F.col("__io"))
    detached = (F.col("__kind") == 2) | (head & (dx == 1))
    kept = (F.col("__kind") == 1) | (head & (dx == 0))
    return rows.where(~detached).select(
        "doc_id", "key", "value", seq.cast("long").alias("seq"), F.when(kept, seq - 1).cast("long").alias("__node"),
        opened.cast("long").alias("__open"), height.cast("int").alias("__depth"), F.when(kept, last).cast("int").alias("__last"),
    )


@operator("build_tree")
def build_tree(entries: DataFrame, depth_key: str, order: Sequence[str] = ("line_no", "pos"), hot=AUTO) -> DataFrame:
    """Node table of the entries of each document.

    ``depth_key=<digits>`` opens an unnamed node one below the open level (or beside
    or above it) with the entry as its first leaf; other entries are leaves of the
    open node; entries before the first marker, and the top nodes, belong to an
    unnamed first node, which gets a leaf ``depth_key=1`` if it has none.  A level
    that jumps by more than one leaves its node detached: it is not in the result,
    and what follows goes to the node that was open.
    """
    hot = once(entries, ["doc_id"], hot, block_rows())
    scan = _open_nodes(entries, depth_key, list(order), hot)
    hot = stored(hot)
    marks = scan.where("__node is not null").select("doc_id", *[F.col(f"__{c}").alias(c) for c in ("node", "depth", "last")])
    if hot is None:
        nested = _nested(marks, hot)
    else:  # a few numbers of each marker, so that passes over levels don't read all entries again
        nested = materialise(_nested(materialise(marks, "marks"), hot), "nested")
    last = scan.groupBy("doc_id").agg(
        F.max("seq").alias("__last"), F.min(F.when(F.col("__depth") == 0, F.col("__node"))).alias("__top"),
        F.bool_or(F.col("__open").isNull() & F.col("key").eqNullSafe(F.lit(depth_key))).alias("__has"),
    )
    last = materialise(last, "last")
    none, zero, one = F.lit(None).cast("string"), F.lit(0).cast("long"), F.lit(1).cast("long")
    # top nodes stand beside the first node (number 0); depth 1 hangs on it unless a top node is open
    up = F.when(F.col("depth") == 0, F.lit(None).cast("long")).otherwise(F.coalesce("parent", F.lit(0)))
    inner = attach(nested.withColumn("parent_id", up), last, ["doc_id"], "inner")
    # leaves follow their node at once, so the first inner child tells how many there are
    inner = ordered_scan(inner, ["doc_id", "parent_id"], ["node"], index="__k", cummin={"__head": "node"}, hot=hot, rows=block_rows(), numbered=True)
    head = F.col("__head") - F.when(F.col("parent_id") > 0, F.col("parent_id") + 1).otherwise(1 + F.col("__has").cast("long"))
    structural = inner.select(
        "doc_id", F.col("node").alias("node_id"), "parent_id", F.col("depth").alias("level"), F.col("node").alias("seq"),
        (F.col("__k") + F.when(F.col("parent_id").isNull(), 1).otherwise(head)).alias("ordinal"),
        none.alias("entry"), none.alias("value"), F.lit(True).alias("is_structural"), F.coalesce(F.col("end") - 1, F.col("__last")).alias("subtree_end"),
    )

    def leaf(rows: DataFrame, parent, ordinal) -> DataFrame:
        return rows.select(
            "doc_id", F.col("seq").alias("node_id"), parent.alias("parent_id"), (F.col("__depth") + 1).alias("level"), "seq", ordinal.alias("ordinal"),
            F.col("key").alias("entry"), "value", F.lit(False).alias("is_structural"), F.col("seq").alias("subtree_end"),
        )

    lead = F.coalesce("__open", F.col("__has").cast("long"))  # entries before the first marker belong to the first node
    leaves = leaf(attach(scan, last.select("doc_id", "__has"), ["doc_id"]), F.coalesce("__open", zero), F.col("seq") - lead - 1)
    first = last.select(
        "doc_id", zero.alias("node_id"), F.lit(None).cast("long").alias("parent_id"), F.lit(0).alias("level"), zero.alias("seq"), zero.alias("ordinal"),
        none.alias("entry"), none.alias("value"), F.lit(True).alias("is_structural"), F.coalesce(F.col("__top") - 1, F.col("__last")).alias("subtree_end"),
    )
    added = last.where("not __has").select(
        "doc_id", one.alias("node_id"), zero.alias("parent_id"), F.lit(1).alias("level"), one.alias("seq"), zero.alias("ordinal"),
        F.lit(depth_key).alias("entry"), F.lit("1").alias("value"), F.lit(False).alias("is_structural"), one.alias("subtree_end"),
    )
    return structural.unionByName(leaves).unionByName(first).unionByName(added).select(*NODE)


def _is_onset(time_word: bool):
    low = F.lower("entry")
    hit = F.contains(low, F.lit("onset")) | F.contains(low, F.lit("firstframe"))
    if time_word:
        hit = hit & F.contains(low, F.lit("time"))
    return hit & ~F.contains(low, F.lit("ack")) & ~F.contains(low, F.lit("delay"))


@operator("node_onsets")
def node_onsets(nodes: DataFrame, hot=AUTO) -> DataFrame:
    """Structural nodes with ``onset``: their first onset leaf, else the first one below; 0 counts as missing."""
    leaf = nodes.where(~F.col("is_structural") & _is_onset(True) & (F.col("value") != ""))
    own = leaf.groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.min_by(F.col("value").try_cast("double"), "seq").alias("__v"))
    own = own.select("doc_id", "node_id", F.when(F.col("__v") != 0, F.col("__v")).alias("__own"))
    inner = nodes.where("is_structural")
    hot = once(inner, ["doc_id"], hot, block_rows())
    hot = LARGE if hot == AUTO else hot
    rows = attach(inner, own, ["doc_id", "node_id"])
    hit = F.when(F.col("__own").isNotNull(), F.struct("seq", F.col("__own").alias("onset")))
    scan = ordered_scan(rows, ["doc_id"], ["seq"], bfill={"__nx": hit}, hot=hot, rows=block_rows(), numbered=True)
    below = F.when(F.col("__nx.seq") <= F.col("subtree_end"), F.col("__nx.onset"))
    return scan.withColumn("onset", F.coalesce("__own", below)).drop("__own", "__nx")


def _sizes(inner: DataFrame, deepest: int) -> DataFrame:
    """``__size`` of each structural node, itself, its leaves and all below it.

    A node passes on what it has gathered, twice as far at each round, so joins grow with the logarithm of the depth.
    """
    ways = inner.select("doc_id", "node_id", F.col("parent_id").alias("__up"), (F.col("__leaves") + 1).alias("__size"))
    reach = 1
    while reach <= deepest:
        live = ways.where("__up is not null")
        below = live.groupBy("doc_id", F.col("__up").alias("node_id")).agg(F.sum("__size").alias("__below"))
        reach *= 2
        if reach <= deepest:
            above = ways.select("doc_id", F.col("node_id").alias("__up"), F.col("__up").alias("__next"))
            further = attach(live, above, ["doc_id", "__up"], "inner").select("doc_id", "node_id", F.col("__next").alias("__up"), "__size")
            ways = further.unionByName(ways.where("__up is null"))
        ways = attach(ways, below, ["doc_id", "node_id"]).withColumn("__size", F.col("__size") + F.coalesce("__below", F.lit(0))).drop("__below")
        if reach <= deepest:
            ways = materialise(ways, "sizes")
    return ways.select("doc_id", "node_id", "__size")


def renumber(inner: DataFrame, leaves: DataFrame, deepest: int, hot=AUTO) -> DataFrame:
    """The node table of structural nodes with their parents, in the order of ``__k, seq`` among their siblings, leaves first below each.

    A node's number is that of its parent, the parent's leaves and the sizes of the siblings before it on top; these
    steps add up along the way to the root, twice as far at each join, so joins grow with the logarithm of the depth and
    nothing is ordered but siblings.  Leaves are numbered below their parent and join once.
    """
    counts = leaves.groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.count(F.lit(1)).alias("__leaves"))
    inner = materialise(attach(inner, counts, ["doc_id", "node_id"]).na.fill(0, ["__leaves"]), "inner")
    wide = once(inner, ["doc_id", "parent_id"], AUTO if hot == STORED else hot, block_rows())
    rows = attach(inner, _sizes(inner, deepest), ["doc_id", "node_id"])
    rows = ordered_scan(
        rows, ["doc_id", "parent_id"], ["__k", "seq"], index="__rank", cumsum={"__upto": "__size"}, hot=LARGE if wide == AUTO else wide, rows=block_rows()
    )
    rows = attach(rows, inner.select("doc_id", F.col("node_id").alias("parent_id"), F.col("__leaves").alias("__pl")), ["doc_id", "parent_id"])
    step = F.col("__upto") - F.col("__size") + F.coalesce(F.col("__pl") + 1, F.lit(0))
    kept = ["doc_id", "node_id", "parent_id", "level", "entry", "value", "is_structural", "__size"]
    rows = rows.select(*kept, (F.col("__rank") + F.coalesce("__pl", F.lit(0))).alias("ordinal"), F.col("parent_id").alias("__up"), step.alias("seq"))
    rows = materialise(rows, "steps")
    reach = 1
    while reach <= deepest:
        above = rows.select("doc_id", F.col("node_id").alias("__up"), F.col("__up").alias("__next"), F.col("seq").alias("__more"))
        longer = attach(rows.where("__up is not null"), above, ["doc_id", "__up"], "inner")
        longer = longer.withColumns({"__up": F.col("__next"), "seq": F.col("seq") + F.col("__more")}).drop("__next", "__more")
        rows = longer.unionByName(rows.where("__up is null"))
        reach *= 2
        if reach <= deepest:
            rows = materialise(rows, "steps")
    rows = materialise(rows.drop("__up"), "numbered")
    out = rows.withColumn("subtree_end", F.col("seq") + F.col("__size") - 1)
    # numbering and join take the same key, so that the leaves move once; a struct's nulls are equal
    key = F.struct("doc_id", "parent_id").alias("__key")
    place = rows.select(F.struct("doc_id", F.col("node_id").alias("parent_id")).alias("__key"), F.col("seq").alias("__ps"))
    leaves = ordered_scan(leaves.select(key, "node_id", "level", "seq", "entry", "value"), ["__key"], ["seq"], index="ordinal", hot=hot, rows=block_rows(), numbered=True)
    low = leaves.drop("seq").join(place, "__key", "left").select("*", "__key.*").withColumn("seq", F.col("__ps") + 1 + F.col("ordinal"))
    return out.select(*NODE).unionByName(low.withColumns({"subtree_end": F.col("seq"), "is_structural": F.lit(False)}).select(*NODE))


@operator("reparent_by_onset")
def reparent_by_onset(nodes: DataFrame, deepest: int | None = None, hot=AUTO) -> DataFrame:
    """Nodes of each level under the parent they follow in time.

    A level where a node has no onset stays as it is; where parents have none, siblings
    are sorted in place; otherwise each node goes to the last parent with an onset at or
    before its own, or to the first parent.  Leaves come first.  All levels are joined in
    one as-of pass, keyed by level.
    """
    hot = once(nodes, ["doc_id"], hot, block_rows())
    deepest = deepest if deepest is not None else nodes.where("is_structural").agg(F.max("level")).first()[0] or 0
    # written once; what is joined by level has a row per document and level
    on = materialise(node_onsets(nodes, hot), "onsets")
    hot = stored(hot)
    known = F.when(F.col("onset").isNotNull(), F.struct("onset", "seq", "node_id"))
    flags = on.groupBy("doc_id", "level").agg(F.count_if(F.col("onset").isNull()).alias("__bad"), F.min(known)["node_id"].alias("__pid"))
    flags = materialise(flags, "flags")
    parents = flags.select("doc_id", (F.col("level") + 1).alias("level"), F.col("__bad").alias("__pbad"), F.col("__pid").alias("__first"))
    move = F.coalesce((F.col("level") >= 2) & (F.col("__bad") == 0) & (F.col("__pbad") == 0), F.lit(False))
    flags = materialise(attach(flags.drop("__pid"), parents, ["doc_id", "level"]).withColumn("__move", move).drop("__pbad"), "moves")
    rows = attach(on, flags, ["doc_id", "level"])
    # only levels below which nodes move
    targets = on.where("onset is not null").select(
        "doc_id", (F.col("level") + 1).alias("level"), F.col("onset").alias("__pt"), F.col("seq").alias("__ps"), F.col("node_id").alias("__pid")
    )
    targets = attach(targets, flags.where("__move").select("doc_id", "level"), ["doc_id", "level"], "left_semi")
    cols = ["doc_id", "node_id", "parent_id", "level", "seq", "entry", "value", "is_structural"]
    moved = rows.where("__move").select(*cols, "onset", "__first")
    moved = asof_join(moved, targets, ["doc_id", "level"], "onset", "__pt", ["__ps", "__pid"], "__hit", hot=hot, rows=block_rows())
    moved = moved.withColumn("parent_id", F.coalesce("__hit.__pid", "__first")).select(*cols, F.col("onset").alias("__k"))
    stay = rows.where(~F.col("__move")).select(*cols, F.when(F.col("__bad") == 0, F.col("onset")).alias("__k"))
    return renumber(moved.unionByName(stay), nodes.where(~F.col("is_structural")).select(*cols), deepest, hot)


@operator("node_property")
def node_property(nodes: DataFrame, keys: Sequence[str] | str, hot=AUTO) -> DataFrame:
    """Structural nodes with one column per key: own leaf of that name, else the first one below."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    hits = {
        f"__nx{i}": F.when(~F.col("is_structural") & (F.col("entry") == k), F.struct("seq", "value")) for i, k in enumerate(keys)
    }
    rows = nodes.where(F.col("is_structural") | F.col("entry").isin(keys))  # others neither ask nor answer
    # a leaf answers with its value alone; the rest of it doesn't move
    asked = ("doc_id", "seq", "entry", "value", "is_structural")
    rows = rows.select(*[c if c in asked else F.when(F.col("is_structural"), F.col(c)).alias(c) for c in rows.columns])
    scan = ordered_scan(rows, ["doc_id"], ["seq"], bfill=hits, hot=stored(hot), rows=block_rows(), numbered=True).where("is_structural")
    props = {k: F.when(F.col(f"__nx{i}.seq") <= F.col("subtree_end"), F.col(f"__nx{i}.value")) for i, k in enumerate(keys)}
    return scan.withColumns({f"prop_{k}": c for k, c in props.items()}).drop(*hits)


def structural_children(nodes: DataFrame, of: DataFrame) -> DataFrame:
    """Structural nodes whose parent is among the given nodes."""
    par = of.select("doc_id", F.col("node_id").alias("parent_id")).distinct()
    return attach(nodes.where("is_structural"), par, ["doc_id", "parent_id"], "left_semi").select(*NODE)


@operator("select_branches")
def select_branches(nodes: DataFrame, selectors: Sequence[str], hot=AUTO) -> DataFrame:
    """Branches by ``key: glob``; each further selector looks at the children of what matched."""
    hot = once(nodes, ["doc_id"], hot, block_rows())
    current = nodes.where("is_structural").select(*NODE)
    for i, text in enumerate(selectors):
        key, glob = (s.strip() for s in text.split(":", 1))
        props = node_property(nodes, key, hot).where(F.col(f"prop_{key}").rlike(glob_to_regex(glob)))
        current = attach(current, props.select("doc_id", "node_id"), ["doc_id", "node_id"], "left_semi")
        if i < len(selectors) - 1:
            current = structural_children(nodes, current)
    return current


def below(rows: DataFrame, tops: DataFrame, hot=AUTO) -> DataFrame:
    """Rows at or below the given nodes, once per node that covers them.

    Coverage is a running sum: +1 where a subtree begins, -1 behind its end.
    """
    at = F.col("seq").cast("double")
    marks = tops.select("doc_id", at.alias("__at"), F.lit(0).alias("__kind"), F.lit(1).alias("__delta")).unionByName(
        tops.select("doc_id", (F.col("subtree_end") + 0.5).alias("__at"), F.lit(0).alias("__kind"), F.lit(-1).alias("__delta"))
    )
    body = rows.select("*", at.alias("__at"), F.lit(1).alias("__kind"), F.lit(0).alias("__delta"))
    both = body.unionByName(marks, allowMissingColumns=True)
    scan = ordered_scan(both, ["doc_id"], ["__at", "__kind"], cumsum={"__cover": "__delta"}, hot=LARGE if hot == AUTO else hot, rows=block_rows(), numbered=True)
    hit = scan.where((F.col("__kind") == 1) & (F.col("__cover") > 0))
    return hit.withColumn("__again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__cover")))).select(*rows.columns)


@operator("questionnaire")
def questionnaire(
    nodes: DataFrame,
    data: str,
    position: str | None = None,
    labels: Sequence[str] | None = None,
    label_field: str | None = None,
    x: str | None = None,
    selectors: Sequence[str] = (),
    conditions: Sequence[str] = (),
    across: bool = False,
    hot=AUTO,
) -> DataFrame:
    """Mean, deviation and count of a value per category: ``doc_id, condition, pos, x, mean, sd, count``.

    Categories are positions into a fixed ``labels`` list (all appear, others are
    skipped), positions named by a field of the tree, or the values of ``x``.
    ``conditions`` are globs on leaf values; their nodes' children are taken, else all
    nodes below the selection that have the value.  Empty values count but do not enter
    the mean; one value has no deviation.  ``across`` pools the documents.
    """
    hot = once(nodes, ["doc_id"], hot, block_rows())
    picked = select_branches(nodes, selectors, hot) if selectors else nodes.where("is_structural").select(*NODE)
    want = [k for k in (data, position, label_field, x) if k]
    props = node_property(nodes, list(dict.fromkeys(want)), hot)
    doc = [] if across else ["doc_id"]
    if conditions:
        named = nodes.where(~F.col("is_structural") & F.col("entry").isNotNull())
        tags = F.array_compact(F.array(*[
            F.when(F.coalesce("value", F.lit("")).rlike(glob_to_regex(p)), F.lit(p.replace("*", "").upper())) for p in conditions
        ]))
        par = named.select("doc_id", F.col("parent_id").alias("node_id"), F.explode(tags).alias("condition")).distinct()
        par = attach(par, picked.select("doc_id", "node_id"), ["doc_id", "node_id"], "left_semi")
        target = attach(props, par.withColumnRenamed("node_id", "parent_id"), ["doc_id", "parent_id"], "inner")
    else:
        kept = props.select("doc_id", "node_id", "seq", *[f"prop_{k}" for k in dict.fromkeys(want)])
        target = below(kept, picked, hot) if selectors else kept
        if x and not position:
            direct = nodes.where(~F.col("is_structural") & F.col("entry").isin([x, data])).groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(
                F.max_by(F.when(F.col("entry") == x, F.col("value")), F.when(F.col("entry") == x, F.col("seq"))).alias("__px"),
                F.max_by(F.when(F.col("entry") == data, F.col("value")), F.when(F.col("entry") == data, F.col("seq"))).alias("__pd"),
            )
            target = target.drop(f"prop_{x}", f"prop_{data}").join(direct, ["doc_id", "node_id"]).withColumnsRenamed(
                {"__px": f"prop_{x}", "__pd": f"prop_{data}"}
            )
        target = target.withColumn("condition", F.lit(None).cast("string"))
    raw = F.col(f"prop_{data}")
    target = target.where(raw.isNotNull()).withColumn("__v", raw.try_cast("double"))
    group = [*doc, "condition"]
    stats = [F.avg("__v").alias("mean"), F.stddev_samp("__v").alias("sd"), F.count(F.lit(1)).alias("count")]
    if position:
        target = target.withColumn("pos", F.col(f"prop_{position}").try_cast("int")).where("pos is not null and pos <> 0")
        if labels:
            hit = target.where(F.col("pos").between(1, len(labels)))
            got = hit.groupBy(*group, "pos").agg(*stats)
            frame = target.select(*group).distinct().select("*", F.posexplode(F.array(*[F.lit(v) for v in labels])).alias("pos", "x"))
            frame = frame.withColumn("pos", F.col("pos") + 1)
            got = got.withColumnsRenamed({g: f"__{g}" for g in [*group, "pos"]})
            cond = F.lit(True)
            for g in [*group, "pos"]:
                cond = cond & F.col(g).eqNullSafe(F.col(f"__{g}"))
            return frame.join(got, cond, "left").select(*group, "pos", "x", "mean", "sd", F.coalesce("count", F.lit(0)).alias("count"))
        name = F.min_by(F.nullif(F.col(f"prop_{label_field}"), F.lit("")), F.when(F.col(f"prop_{label_field}") != "", F.struct("doc_id", "seq")))
        got = target.groupBy(*group, "pos").agg(name.alias("x"), *stats)
        return got.where("x is not null")
    if not x:
        raise ValueError("give position with labels or label_field, or x")
    got = target.where(F.col(f"prop_{x}").isNotNull()).groupBy(*group, F.col(f"prop_{x}").alias("x")).agg(*stats)
    return got.select(*group, F.col("x").try_cast("int").alias("pos"), "x", "mean", "sd", "count")
