"""Queries over hierarchical records: nations as documents, customers and orders as levels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.tree import build_tree, node_onsets, node_property, questionnaire, reparent_by_onset, select_branches, split_entries
from ..session import materialise
from .base import query, rounded, rsql, table


@query("split_entries", r"""
SELECT doc_id, line_no, CAST(pos AS INTEGER) AS pos, CASE WHEN contains(raw, ', ') THEN regexp_replace(split_part(raw, ', ', 1), '^\s+|\s+$', '', 'g') END AS key,
  CASE WHEN contains(raw, ', ') THEN regexp_replace(substr(raw, instr(raw, ', ') + 2), '^\s+|\s+$', '', 'g') END AS value, raw
FROM (SELECT doc_id, line_no, unnest(parts) AS raw, unnest(range(len(parts))) AS pos FROM (
  SELECT doc_id, line_no, string_split(line, '. ') AS parts FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))))
WHERE regexp_matches(raw, '\S')""")
def entries(spark, folder):
    d = table(spark, folder, "documents")
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "lines")).withColumn("line_no", F.col("line_no").cast("long"))
    return split_entries(lines, ". ", ", ")


def _entries(spark, folder):
    """Title, then per customer a level 1 with name and segment, per order a level 2 with onset, price, position, priority."""
    n, c, o = (table(spark, folder, t) for t in ("nation", "customer", "orders"))

    def cells(*pairs):
        return F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.lit(k).alias("key"), v.cast("string").alias("value")) for i, (k, v) in enumerate(pairs)])).alias("e")

    none = F.lit(-1).cast("long")
    head = n.select(F.col("n_nationkey").alias("doc_id"), none.alias("cust"), none.alias("ord"), cells(("Title", F.col("n_name"))))
    mid = c.select(F.col("c_nationkey").alias("doc_id"), F.col("c_custkey").alias("cust"), none.alias("ord"), cells(("Level", F.lit(1)), ("Name", F.col("c_name")), ("Segment", F.col("c_mktsegment"))))
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1990-01-01"))
    low = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("doc_id"), F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("ord"),
        cells(("Level", F.lit(2)), ("Order", F.col("o_orderkey")), ("OnsetTime", day), ("Price", F.col("o_totalprice")), ("Pos", F.substring("o_orderpriority", 1, 1)), ("Priority", F.col("o_orderpriority"))),
    )
    return head.unionByName(mid).unionByName(low).select("doc_id", "cust", "ord", "e.k", "e.key", "e.value")


def nodes(spark, folder):
    return materialise(build_tree(_entries(spark, folder), "Level", ["cust", "ord", "k"]), "nodes", "zstd")


NODES = """ent AS (
  SELECT n_nationkey AS doc_id, CAST(-1 AS BIGINT) AS cust, CAST(-1 AS BIGINT) AS ord, 0 AS k, 'Title' AS key, n_name AS value FROM nation
  UNION ALL SELECT c_nationkey, c_custkey, -1, unnest([0, 1, 2]), unnest(['Level', 'Name', 'Segment']), unnest(['1', c_name, c_mktsegment]) FROM customer
  UNION ALL SELECT c_nationkey, o_custkey, o_orderkey, unnest([0, 1, 2, 3, 4, 5]), unnest(['Level', 'Order', 'OnsetTime', 'Price', 'Pos', 'Priority']),
    unnest(['2', CAST(o_orderkey AS VARCHAR), CAST(date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS VARCHAR), CAST(o_totalprice AS VARCHAR), substr(o_orderpriority, 1, 1), o_orderpriority])
    FROM orders JOIN customer ON o_custkey = c_custkey),
num AS (SELECT *, row_number() OVER w - 1 AS i, count(*) FILTER (key = 'Level') OVER w AS c, CASE WHEN key = 'Level' THEN CAST(value AS INTEGER) END AS lv
  FROM ent WINDOW w AS (PARTITION BY doc_id ORDER BY cust, ord, k)),
sq AS (SELECT *, i + c + 2 AS seq, CASE WHEN lv IS NOT NULL THEN i + c + 1 END AS node FROM num),
op AS (SELECT *, max(node) OVER b AS open, max(CASE WHEN lv = 1 THEN node END) OVER b AS open1, max(seq) OVER (PARTITION BY doc_id) AS last,
  min(CASE WHEN lv = 1 THEN node END) OVER a AS next1, min(node) OVER a AS nextany FROM sq
  WINDOW b AS (PARTITION BY doc_id ORDER BY i), a AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
raw AS (
  SELECT doc_id, node AS node_id, CASE WHEN lv = 1 THEN 0 ELSE open1 END AS parent_id, lv AS level, node AS seq, NULL AS entry, NULL AS value, true AS is_structural, coalesce(CASE WHEN lv = 1 THEN next1 ELSE nextany END - 1, last) AS subtree_end FROM op WHERE lv IS NOT NULL
  UNION ALL SELECT doc_id, seq, coalesce(open, 0), CASE WHEN open IS NULL THEN 1 WHEN open = open1 THEN 2 ELSE 3 END, seq, key, value, false, seq FROM op
  UNION ALL SELECT doc_id, 0, NULL, 0, 0, NULL, NULL, true, max(last) FROM op GROUP BY doc_id
  UNION ALL SELECT doc_id, 1, 0, 1, 1, 'Level', '1', false, 1 FROM op GROUP BY doc_id),
nodes AS (SELECT doc_id, CAST(node_id AS BIGINT) AS node_id, CAST(parent_id AS BIGINT) AS parent_id, CAST(level AS INTEGER) AS level, CAST(seq AS BIGINT) AS seq,
  CAST(row_number() OVER (PARTITION BY doc_id, parent_id ORDER BY seq) - 1 AS BIGINT) AS ordinal, entry, value, is_structural, CAST(subtree_end AS BIGINT) AS subtree_end FROM raw)"""


@query("build_tree", f"WITH {NODES} SELECT * FROM nodes WHERE entry IS DISTINCT FROM 'Price'")
def tree(spark, folder):
    # the text of a price differs between the engines; the node is compared below as a number
    return nodes(spark, folder).where("entry is null or entry <> 'Price'")


def _climbing(spark, folder):
    """Per nation its orders in turn, each a level marker and a leaf; levels climb to 61 and fall again, every eleventh key skips two."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").alias("doc_id"), F.col("o_orderkey").alias("ord"))
    i = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")) - 1
    level = 61 - F.abs(F.pmod(i, F.lit(120)) - 60) + F.when(F.pmod("ord", F.lit(11)) == 0, 2).otherwise(0)
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("key"), v.cast("string").alias("value")) for k, (n, v) in enumerate([("Level", level), ("Order", F.col("ord"))])])
    return rows.select("doc_id", "ord", cells.alias("cells")).select("doc_id", "ord", F.explode("cells").alias("e")).select("doc_id", "ord", "e.*")


@query("build_tree_jumps", """
WITH RECURSIVE m AS (
  SELECT c_nationkey AS doc_id, o_orderkey AS ord, row_number() OVER w AS i, 61 - abs((row_number() OVER w - 1) % 120 - 60) + CASE WHEN o_orderkey % 11 = 0 THEN 2 ELSE 0 END AS lv
  FROM orders JOIN customer ON o_custkey = c_custkey WINDOW w AS (PARTITION BY c_nationkey ORDER BY o_orderkey)
), s AS (
  SELECT doc_id, 0::BIGINT AS i, NULL::BIGINT AS ord, NULL::BIGINT AS was, [-2, -1]::BIGINT[] AS stack FROM (SELECT DISTINCT doc_id FROM m)
  UNION ALL
  SELECT m.doc_id, m.i, m.ord, m.lv, CASE WHEN s.was IS NULL OR m.lv = s.was + 1 THEN list_append(s.stack, m.ord) WHEN m.lv > s.was THEN s.stack
    ELSE list_append(s.stack[:greatest(len(s.stack) - (s.was - m.lv), 2) - 1], m.ord) END
  FROM s JOIN m ON m.doc_id = s.doc_id AND m.i = s.i + 1
)
SELECT doc_id, CAST(ord AS VARCHAR) AS "order", CAST(stack[-1] AS VARCHAR) AS owner, CAST(len(stack) - 1 AS INTEGER) AS level,
  CASE WHEN stack[-2] >= 0 THEN CAST(stack[-2] AS VARCHAR) END AS up FROM s WHERE i > 0""")
def tree_jumps(spark, folder):
    """Every order's leaf: the order that opened its node, and the one that opened the node above."""
    t = materialise(build_tree(_climbing(spark, folder), "Level", ["ord", "k"]), "nodes")
    leaf = t.where("entry = 'Order'").select("doc_id", F.col("parent_id").alias("node_id"), F.col("value").alias("order"), "level", "seq")
    owner = leaf.groupBy("doc_id", "node_id").agg(F.min_by("order", "seq").alias("owner"))
    above = owner.select("doc_id", F.col("node_id").alias("parent_id"), F.col("owner").alias("up"))
    inner = t.where("is_structural").select("doc_id", "node_id", "parent_id").join(above, ["doc_id", "parent_id"], "left")
    return leaf.join(owner, ["doc_id", "node_id"]).join(inner, ["doc_id", "node_id"]).select("doc_id", "order", "owner", "level", "up")


_FIRST = "fo AS (SELECT c_nationkey AS doc_id, c_custkey, c_name, c_mktsegment, arg_min(o, o_orderkey) AS o FROM customer JOIN orders o ON o_custkey = c_custkey GROUP BY ALL)"


@query("node_onsets", """
SELECT c_nationkey AS doc_id, CAST(2 AS INTEGER) AS level, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE))::DOUBLE AS onset, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
UNION ALL SELECT doc_id, 1, date_diff('day', DATE '1990-01-01', CAST(d AS DATE))::DOUBLE, count(*) FROM (SELECT c_nationkey AS doc_id, c_custkey, arg_min(o_orderdate, o_orderkey) AS d FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) GROUP BY ALL
UNION ALL SELECT n_nationkey, 0, date_diff('day', DATE '1990-01-01', CAST(d AS DATE))::DOUBLE, 1 FROM nation LEFT JOIN (
  SELECT c_nationkey, arg_min(o_orderdate, (c_custkey, o_orderkey)) AS d FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL) ON n_nationkey = c_nationkey""")
def onsets(spark, folder):
    return node_onsets(nodes(spark, folder)).groupBy("doc_id", "level", "onset").agg(F.count(F.lit(1)).alias("n"))


@query("reparent_by_onset", """
WITH o AS (SELECT c_nationkey AS doc_id, c_custkey, c_name, o_orderkey, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS t FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT doc_id, c_custkey, c_name, arg_min(t, o_orderkey) AS pt FROM o GROUP BY ALL), bad AS (SELECT DISTINCT c_nationkey AS doc_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)),
f AS (SELECT doc_id, arg_min(c_name, (pt, c_custkey)) AS first FROM p GROUP BY doc_id),
a AS (SELECT o.doc_id, o.c_custkey, o.o_orderkey, o.t, any_value(o.c_name) AS own, arg_max(p.c_name, (p.pt, p.c_custkey)) AS hit FROM o LEFT JOIN p ON o.doc_id = p.doc_id AND p.pt <= o.t GROUP BY ALL),
r AS (SELECT doc_id, c_custkey, o_orderkey, t, CASE WHEN doc_id IN (SELECT doc_id FROM bad) THEN own ELSE coalesce(hit, first) END AS parent FROM a JOIN f USING (doc_id))
SELECT doc_id, CAST(o_orderkey AS VARCHAR) AS "order", parent, CAST(2 + row_number() OVER (PARTITION BY doc_id, parent ORDER BY t, c_custkey, o_orderkey) AS BIGINT) AS ordinal FROM r""")
def reparented(spark, folder):
    t = reparent_by_onset(nodes(spark, folder), 2)
    name = t.where("entry = 'Name'").select("doc_id", F.col("parent_id").alias("cid"), F.col("value").alias("parent"))
    key = t.where("entry = 'Order'").select("doc_id", F.col("parent_id").alias("node_id"), F.col("value").alias("order"))
    moved = t.where("is_structural").select("doc_id", "node_id", F.col("parent_id").alias("cid"), "ordinal")
    return key.join(moved, ["doc_id", "node_id"]).join(name, ["doc_id", "cid"]).select("doc_id", "order", "parent", "ordinal")


@query("reparent_numbering", "SELECT count(*) AS documents, true AS in_order, true AS nested FROM nation")
def numbering(spark, folder):
    """After the move numbers still run in pre-order: children follow their parent inside its interval."""
    t = reparent_by_onset(nodes(spark, folder), 2)
    up = t.where("is_structural").select("doc_id", F.col("node_id").alias("parent_id"), F.col("seq").alias("ps"), F.col("subtree_end").alias("pe"))
    both = t.join(up, ["doc_id", "parent_id"])
    ok = both.groupBy("doc_id").agg(
        F.bool_and(F.col("seq") > F.col("ps")).alias("a"), F.bool_and(F.col("subtree_end") <= F.col("pe")).alias("b"),
        (F.count_distinct("seq") == F.count(F.lit(1))).alias("c"),
    )
    return ok.agg(F.count(F.lit(1)).alias("documents"), F.bool_and(F.col("a") & F.col("c")).alias("in_order"), F.bool_and("b").alias("nested"))


@query("node_property", rsql("""
SELECT c_nationkey AS doc_id, 2 AS level, o_totalprice AS price, o_orderpriority AS priority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
UNION ALL SELECT c_nationkey, 1, p, q, count(*) FROM (SELECT c_nationkey, c_custkey, arg_min(o_totalprice, o_orderkey) AS p, arg_min(o_orderpriority, o_orderkey) AS q FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) GROUP BY ALL
UNION ALL SELECT n_nationkey, 0, p, q, 1 FROM nation LEFT JOIN (SELECT c_nationkey, arg_min(o_totalprice, (c_custkey, o_orderkey)) AS p, arg_min(o_orderpriority, (c_custkey, o_orderkey)) AS q FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL) ON n_nationkey = c_nationkey""", "price", 4))
def properties(spark, folder):
    p = node_property(nodes(spark, folder), ["Price", "Priority"])
    return rounded(p.groupBy("doc_id", "level", F.col("prop_Price").cast("double").alias("price"), F.col("prop_Priority").alias("priority")).agg(F.count(F.lit(1)).alias("n")), 4)


@query("select_branches", f"""
WITH {NODES}, pr AS (SELECT s.doc_id, s.node_id, s.parent_id, s.level, arg_min(l.value, l.seq) FILTER (l.entry = 'Segment') AS seg, arg_min(l.value, l.seq) FILTER (l.entry = 'Priority') AS pri
  FROM nodes s JOIN nodes l ON s.doc_id = l.doc_id AND l.seq > s.seq AND l.seq <= s.subtree_end AND l.entry IN ('Segment', 'Priority') WHERE s.is_structural GROUP BY ALL)
SELECT k.doc_id, k.node_id, k.level FROM pr k JOIN pr u ON k.doc_id = u.doc_id AND k.parent_id = u.node_id WHERE u.seg LIKE 'BUILD%' AND regexp_matches(k.pri, '^[12]-')""")
def branches(spark, folder):
    return select_branches(nodes(spark, folder), ["Segment: BUILD*", "Priority: [12]-*"]).select("doc_id", "node_id", "level")


_LABELS = ["urgent", "high", "medium", "unspecified"]
_ORD = """o AS (SELECT c_nationkey AS doc_id, c_mktsegment AS condition, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS pos, o_orderpriority AS pri, o_totalprice AS v FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query("questionnaire_labels", rsql(f"""
WITH {_ORD}, g AS (SELECT DISTINCT doc_id, condition FROM o WHERE condition IN ('BUILDING', 'MACHINERY')), l AS (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS pos, unnest({_LABELS}) AS x),
gl AS (SELECT * FROM g, l)
SELECT gl.doc_id, gl.condition, gl.pos, x, avg(v) AS mean, stddev_samp(v) AS sd, count(v) AS count
FROM gl LEFT JOIN o ON gl.doc_id = o.doc_id AND gl.condition = o.condition AND gl.pos = o.pos GROUP BY ALL""", "mean, sd", 6))
def quest_labels(spark, folder):
    return rounded(questionnaire(nodes(spark, folder), "Price", "Pos", _LABELS, conditions=["BUILD*", "MACHINERY"]).replace("BUILD", "BUILDING", "condition"), 6)


@query("questionnaire_dynamic", rsql(f"WITH {_ORD} SELECT 'MACHINERY' AS condition, pos, min(pri) AS x, avg(v) AS mean, stddev_samp(v) AS sd, count(v) AS count FROM o WHERE condition = 'MACHINERY' GROUP BY pos", "mean, sd", 6))
def quest_dynamic(spark, folder):
    return rounded(questionnaire(nodes(spark, folder), "Price", "Pos", label_field="Priority", conditions=["MACHINERY"], across=True), 6)


@query("questionnaire_axis", rsql(f"WITH {_ORD} SELECT doc_id, CAST(NULL AS VARCHAR) AS condition, pos, CAST(pos AS VARCHAR) AS x, avg(v) AS mean, stddev_samp(v) AS sd, count(v) AS count FROM o GROUP BY ALL", "mean, sd", 6))
def quest_axis(spark, folder):
    return rounded(questionnaire(nodes(spark, folder), "Price", x="Pos"), 6)


@query("questionnaire_selected", f"""
WITH {NODES}, seg AS (SELECT s.doc_id, s.node_id, s.seq, s.subtree_end, arg_min(l.value, l.seq) AS seg FROM nodes s JOIN nodes l
  ON s.doc_id = l.doc_id AND l.seq > s.seq AND l.seq <= s.subtree_end AND l.entry = 'Segment' WHERE s.is_structural GROUP BY ALL),
pick AS (SELECT * FROM seg WHERE seg = 'BUILDING'),
cov AS (SELECT n.doc_id, n.node_id, n.seq, n.subtree_end FROM nodes n JOIN pick p ON n.doc_id = p.doc_id AND n.seq BETWEEN p.seq AND p.subtree_end WHERE n.is_structural),
v AS (SELECT c.doc_id, c.node_id, count(DISTINCT c.again) AS times, arg_min(CAST(l.value AS INTEGER), l.seq) AS pos
  FROM (SELECT *, row_number() OVER () AS again FROM cov) c JOIN nodes l ON l.doc_id = c.doc_id AND l.entry = 'Pos' AND l.seq > c.seq AND l.seq <= c.subtree_end GROUP BY ALL)
SELECT doc_id, CAST(NULL AS VARCHAR) AS condition, pos, sum(times)::BIGINT AS count FROM v GROUP BY ALL""")
def quest_selected(spark, folder):
    """A node covered by several selected branches counts once for each."""
    out = questionnaire(nodes(spark, folder), "Price", "Pos", label_field="Priority", selectors=["Segment: BUILDING"])
    return out.select("doc_id", "condition", "pos", "count")
