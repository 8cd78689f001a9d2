"""Queries over tests, effect sizes, resampling and correlation.

The twins of p values integrate the densities numerically, or count rank sums; the operators use
continued fractions and series.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.inference import (
    anova_oneway, correlation_matrix, effect_size, fdr_bh, kruskal, mann_whitney, significance_stars, ttest, wilcoxon,
)
from ..operators.resample import GOLDEN, MIX, bootstrap_ci
from .base import chi2_sql, fisher_sql, means_sql, normal_sql, query, rounded, rsql, student_sql, table, trials

AB = "l_linestatus"
_S = """s AS (SELECT channel, count(*) FILTER (condition = 'F')::DOUBLE AS na, count(*) FILTER (condition = 'O')::DOUBLE AS nb, avg(value) FILTER (condition = 'F') AS ma, avg(value) FILTER (condition = 'O') AS mb,
  var_samp(value) FILTER (condition = 'F') AS va, var_samp(value) FILTER (condition = 'O') AS vb FROM obs GROUP BY channel)"""


def _t_sql(kind: str, t: str, df: str, source: str = "s", ctes: str = "") -> str:
    body = f"SELECT channel, ma, mb, va, vb, {t} AS t, {df} AS df FROM {source}"
    p = f"SELECT *, {student_sql('t', 'df')} AS p FROM ({body})"
    out = f"SELECT channel, 'F' AS condition_a, 'O' AS condition_b, '{kind}' AS test_type, t, p, (ma - mb) / sqrt((va + vb) / 2) AS cohens_d, p < 0.05 AS significant FROM ({p})"
    return rsql(f"WITH {means_sql(AB)}, {_S}{ctes} {out}", "t, p, cohens_d", 5)


def _t(spark, folder, **kw):
    return rounded(ttest(trials(spark, folder, AB), digits=False, **kw), 5)


@query("ttest_independent", _t_sql("independent", "(ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb))", "na + nb - 2"))
def t_independent(spark, folder):
    return _t(spark, folder)


@query("ttest_welch", _t_sql("welch", "(ma - mb) / sqrt(va / na + vb / nb)", "pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1))"))
def t_welch(spark, folder):
    return _t(spark, folder, kind="welch")


_PAIRED = """r AS (SELECT *, row_number() OVER (PARTITION BY channel, condition ORDER BY epoch_id) AS rk FROM obs),
pr AS (SELECT a.channel, a.value - b.value AS d FROM r a JOIN r b ON a.channel = b.channel AND a.rk = b.rk AND a.condition = 'F' AND b.condition = 'O')"""


@query("ttest_paired", _t_sql("paired", "tt", "pairs - 1e0", "s JOIN q USING (channel)",
       f", {_PAIRED}, q AS (SELECT channel, count(d) AS pairs, avg(d) / (stddev_samp(d) / sqrt(count(d))) AS tt FROM pr GROUP BY channel)"))
def t_paired(spark, folder):
    return _t(spark, folder, kind="paired")


_RANK = "rk AS (SELECT *, rank() OVER (PARTITION BY channel ORDER BY value) + (count(*) OVER (PARTITION BY channel, value) - 1) / 2.0 AS r FROM obs)"


@query("mann_whitney", rsql(f"""WITH {means_sql(AB)}, {_RANK},
u AS (SELECT channel, count(*) FILTER (condition = 'F')::DOUBLE AS n1, count(*) FILTER (condition = 'O')::DOUBLE AS n2, (sum(r) FILTER (condition = 'F'))::DOUBLE - n1 * (n1 + 1) / 2 AS statistic FROM rk GROUP BY channel),
ties AS (SELECT channel, sum(t * t * t - t) AS ties FROM (SELECT channel, value, count(*)::DOUBLE AS t FROM obs GROUP BY ALL) GROUP BY channel),
z AS (SELECT *, greatest(0e0, (greatest(statistic, n1 * n2 - statistic) - n1 * n2 / 2 - 0.5e0) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1))))) AS z FROM u JOIN ties USING (channel)),
p AS (SELECT *, {normal_sql("z")} AS p FROM z)
SELECT channel, 'Mann-Whitney U' AS test, 'F' AS condition_a, 'O' AS condition_b, statistic, p, p < 0.05 AS significant FROM p""", "statistic, p", 4))
def u_test(spark, folder):
    """Samples of more than eight suppliers: the normal form."""
    return rounded(mann_whitney(trials(spark, folder, AB), digits=False), 4)


@query("mann_whitney_exact", rsql("""
WITH obs AS (SELECT l_linenumber, l_linestatus AS condition, year(l_shipdate) AS y, avg(l_extendedprice) AS value FROM lineitem GROUP BY ALL),
rk AS (SELECT *, rank() OVER (PARTITION BY l_linenumber ORDER BY value) AS r FROM obs),
u AS (SELECT l_linenumber, count(*) FILTER (condition = 'F') AS n1, count(*) FILTER (condition = 'O') AS n2, (sum(r) FILTER (condition = 'F'))::BIGINT - n1 * (n1 + 1) // 2 AS u FROM rk GROUP BY ALL),
picks AS (SELECT l_linenumber, n1, n2, u, list_sum([((m >> i_) & 1) * (i_ + 1) FOR i_ IN range(n1 + n2)])::BIGINT - n1 * (n1 + 1) // 2 AS any_u FROM u, LATERAL (SELECT unnest(range(1::BIGINT << (n1 + n2))) AS m) WHERE bit_count(m) = n1),
p AS (SELECT l_linenumber, u, least(1e0, 2e0 * count(*) FILTER (any_u >= greatest(u, n1 * n2 - u)) / count(*)) AS p FROM picks GROUP BY ALL)
SELECT l_linenumber, 'price' AS channel, 'Mann-Whitney U' AS test, 'F' AS condition_a, 'O' AS condition_b, u::DOUBLE AS statistic, p, p < 0.05 AS significant FROM p""", "statistic, p"))
def u_exact(spark, folder):
    """A few years a side and line number; the twin counts all ways to choose the ranks."""
    years = table(spark, folder, "lineitem").select(
        "l_linenumber", F.col("l_linestatus").alias("condition"), F.year("l_shipdate").alias("epoch_id"), F.col("l_extendedprice").alias("price")
    )
    return rounded(mann_whitney(years, ["l_linenumber"], ["price"], by=["l_linenumber"], digits=False))


@query("wilcoxon", rsql(f"""WITH RECURSIVE {means_sql(AB)}, {_PAIRED}, w AS (SELECT channel, d, rank() OVER (PARTITION BY channel ORDER BY abs(d)) + (count(*) OVER (PARTITION BY channel, abs(d)) - 1) / 2.0 AS r FROM pr WHERE d <> 0),
s AS (SELECT channel, count(*)::DOUBLE AS n, least(sum(r) FILTER (d > 0), sum(r) FILTER (d < 0))::DOUBLE AS statistic FROM w GROUP BY channel),
tied AS (SELECT channel, sum(t * t * t - t) AS ties FROM (SELECT channel, abs(d) AS m, count(*)::DOUBLE AS t FROM w GROUP BY ALL) GROUP BY channel),
zero AS (SELECT channel, count(*) FILTER (d = 0) AS zeros FROM pr GROUP BY channel),
ways AS (SELECT 0 AS k, [CASE WHEN i_ = 1 THEN 1e0 ELSE 0e0 END FOR i_ IN range(1, 1277)] AS c
  UNION ALL SELECT k + 1, [c[i_] + CASE WHEN i_ > k + 1 THEN c[i_ - k - 1] ELSE 0e0 END FOR i_ IN range(1, 1277)] FROM ways WHERE k < 50),
j AS (SELECT s.*, ties, least(1e0, 2e0 * list_sum(c[1:floor(statistic + 1e-9)::INTEGER + 1]) / pow(2e0, n)) AS exact_p, zeros,
  (statistic - n * (n + 1) / 4) / sqrt((n * (n + 1) * (2 * n + 1) - ties / 2) / 24) AS z FROM s JOIN tied USING (channel) JOIN zero USING (channel) LEFT JOIN ways ON k = n),
p AS (SELECT *, CASE WHEN n <= 50 AND ties = 0 AND zeros = 0 THEN exact_p ELSE {normal_sql("z")} END AS p FROM j)
SELECT channel, 'Wilcoxon Signed-Rank' AS test, 'F' AS condition_a, 'O' AS condition_b, statistic, p, p < 0.05 AS significant FROM p""", "statistic, p", 4))
def signed_rank(spark, folder):
    return rounded(wilcoxon(trials(spark, folder, AB), digits=False), 4)


@query("kruskal", rsql(f"""WITH {means_sql()}, {_RANK}, g AS (SELECT channel, condition, sum(r) AS r, count(*)::DOUBLE AS m FROM rk GROUP BY ALL),
n AS (SELECT channel, sum(t)::DOUBLE AS n, sum(t * t * t - t)::DOUBLE AS ties FROM (SELECT channel, value, count(*)::DOUBLE AS t FROM obs GROUP BY ALL) GROUP BY channel),
h AS (SELECT channel, count(*) - 1 AS df, (12 / (n * (n + 1)) * sum(r * r / m) - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS statistic FROM g JOIN n USING (channel) GROUP BY channel, n, ties),
p AS (SELECT *, {chi2_sql("statistic", "df")} AS p FROM h)
SELECT channel, 'Kruskal-Wallis H' AS test, 'all' AS condition_a, 'all' AS condition_b, statistic, p, p < 0.05 AS significant FROM p""", "statistic, p", 3))
def h_test(spark, folder):
    return rounded(kruskal(trials(spark, folder), digits=False), 3)


@query("anova_oneway", rsql(f"""
WITH l AS (SELECT * FROM (SELECT l_returnflag, l_quantity, l_extendedprice FROM lineitem) UNPIVOT (v FOR dv IN (l_quantity, l_extendedprice))),
c AS (SELECT dv, l_returnflag, count(*)::DOUBLE AS n, avg(v) AS m, var_pop(v) * count(*) AS ss FROM l GROUP BY ALL), g AS (SELECT dv, avg(v) AS g, count(*) AS nn FROM l GROUP BY dv),
t AS (SELECT dv, sum(n * pow(m - g, 2)) AS b, sum(ss) AS w, count(*) AS k, max(nn) AS nn FROM c JOIN g USING (dv) GROUP BY dv),
f AS (SELECT dv, (b / (k - 1)) / (w / (nn - k)) AS F, k - 1 AS df1, nn - k AS df2, b / (b + w) AS eta_sq FROM t),
p AS (SELECT *, {fisher_sql("F", "df1", "df2")} AS raw FROM f),
a AS (SELECT *, least(1e0, min(raw * m / r) OVER (ORDER BY raw ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p FROM (SELECT *, count(*) OVER (ORDER BY raw) AS r, count(*) OVER () AS m FROM p))
SELECT dv, 'l_returnflag' AS factor, F, df1, df2, eta_sq, p, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS sig FROM a""", "F, eta_sq, p", 5))
def anova(spark, folder):
    return rounded(anova_oneway(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"], "l_returnflag", apply_fdr=True), 5)


@query("fdr_bh", rsql("""
WITH p AS (SELECT doc_id, lang, (n_chars % 977) / 977.0 AS p FROM documents), c AS (SELECT lang, p, count(*) AS c FROM p GROUP BY ALL),
r AS (SELECT lang, p, sum(c) OVER (PARTITION BY lang ORDER BY p) AS r, sum(c) OVER (PARTITION BY lang) AS m FROM c),
a AS (SELECT lang, p, least(1.0, min(p * m / r) OVER (PARTITION BY lang ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS adj FROM r)
SELECT doc_id, lang, p, adj FROM p JOIN a USING (lang, p)""", "p, adj"))
def adjusted(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "lang", ((F.col("n_chars") % 977) / 977.0).alias("p"))
    return rounded(fdr_bh(d, "p", ["lang"], "adj"))


@query("significance_stars", """
SELECT doc_id, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS stars,
  CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' WHEN p < 0.1 THEN '.' ELSE 'n.s.' END AS fine FROM (SELECT doc_id, (n_chars % 997) / 4000e0 AS p FROM documents)""")
def stars(spark, folder):
    p = (F.col("n_chars") % 997) / 4000.0
    return table(spark, folder, "documents").select("doc_id", significance_stars(p).alias("stars"), significance_stars(p, fine=True).alias("fine"))


@query("effect_size_eta", rsql(f"""WITH {means_sql()}, c AS (SELECT channel, condition, count(*) AS n, avg(value) AS m, var_pop(value) * count(*) AS ss FROM obs GROUP BY ALL), g AS (SELECT channel, avg(value) AS g FROM obs GROUP BY channel)
SELECT channel, 'eta_squared' AS metric, 'all' AS condition_a, 'all' AS condition_b, sum(n * pow(m - g, 2)) / (sum(n * pow(m - g, 2)) + sum(ss)) AS value, CAST(NULL AS DOUBLE) AS ci_low, CAST(NULL AS DOUBLE) AS ci_high FROM c JOIN g USING (channel) GROUP BY channel""", "value", 4))
def eta(spark, folder):
    return rounded(effect_size(trials(spark, folder), "eta_sq"), 4)


@query("effect_size_d", rsql(f"WITH {means_sql(AB)}, {_S} SELECT channel, 'cohens_d' AS metric, 'F' AS condition_a, 'O' AS condition_b, (ma - mb) / sqrt((va + vb) / 2) AS value, true AS inside FROM s", "value", 4))
def cohens_d(spark, folder):
    """The drawn limits have no SQL twin; that they enclose the estimate does."""
    out = effect_size(trials(spark, folder, AB))
    return rounded(out.withColumn("inside", F.col("value").between(F.col("ci_low"), F.col("ci_high"))).drop("ci_low", "ci_high"), 4)


def _boot(method):
    def run(spark, folder):
        df = trials(spark, folder).select("condition", "epoch_id", "quantity", "price")
        out = bootstrap_ci(df, ["condition"], ["epoch_id"], method=method)
        inside = (F.col("ci_lower") < F.col("mean")) & (F.col("mean") < F.col("ci_upper"))
        near = F.col("error") < F.col("mean")
        return rounded(out.select("condition", "variable", "n", "mean", inside.alias("inside"), near.alias("near")))

    return run


for _m in ("percentile", "bca", "normal"):
    query(f"bootstrap_ci_{_m}", rsql(f"WITH {means_sql()} SELECT condition, channel AS variable, count(*) AS n, avg(value) AS mean, true AS inside, true AS near FROM obs WHERE channel <> 'discount' GROUP BY ALL", "mean"))(_boot(_m))


_MOD, _GOLDEN, (_S1, _F1), (_S2, _F2) = 1 << 64, GOLDEN, *MIX


def draws_sql(obs: str, group: list[str], n_boot: int) -> str:
    """r: every draw of every resample of the groups of ``obs`` (value, epoch_id), by the operator's own seeded numbers."""
    by = ", ".join(group)
    return f"""u AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY epoch_id) - 1 AS k FROM {obs}),
g AS (SELECT {by}, count(*) AS n, avg(value) AS mean, ('0x' || substr(md5({" || '|' || ".join(group)} || '|42'), 1, 15))::UBIGINT AS seed FROM u GROUP BY {by}),
z0 AS (SELECT {by}, n, mean, b, ((seed::UHUGEINT + ((b * n + j + 1)::UHUGEINT * {_GOLDEN}) % {_MOD}) % {_MOD})::UBIGINT AS z FROM g, range({n_boot}) AS rb(b), LATERAL (SELECT unnest(range(g.n)) AS j)),
z1 AS (SELECT * REPLACE (((xor(z, z >> {_S1})::UHUGEINT * {_F1}) % {_MOD})::UBIGINT AS z) FROM z0),
z2 AS (SELECT * REPLACE (((xor(z, z >> {_S2})::UHUGEINT * {_F2}) % {_MOD})::UBIGINT AS z) FROM z1),
r AS (SELECT z2.*, u.value FROM z2 JOIN u ON {" AND ".join(f"u.{c} = z2.{c}" for c in group)} AND u.k = (xor(z, z >> 31) % n)::BIGINT)"""


@query("bootstrap_ci_limits", rsql(f"""WITH {means_sql()}, wanted AS (SELECT condition, channel AS variable, epoch_id, value FROM obs WHERE channel <> 'discount'),
{draws_sql('wanted', ['condition', 'variable'], 200)}, m AS (SELECT condition, variable, n, mean, b, avg(value) AS boot FROM r GROUP BY ALL)
SELECT condition, variable, 'percentile' AS method, n, quantile_cont(boot, 0.025) AS ci_lower, quantile_cont(boot, 0.975) AS ci_upper FROM m GROUP BY ALL
UNION ALL SELECT condition, variable, 'normal', n, mean - 1.959963984540054 * stddev_samp(boot), mean + 1.959963984540054 * stddev_samp(boot) FROM m GROUP BY condition, variable, n, mean""", "ci_lower, ci_upper", 3))
def boot_limits(spark, folder):
    """The limits themselves, from the same seeded numbers."""
    df = trials(spark, folder).select("condition", "epoch_id", "quantity", "price")
    out = [bootstrap_ci(df, ["condition"], ["epoch_id"], n_boot=200, method=m).withColumn("method", F.lit(m)) for m in ("percentile", "normal")]
    return rounded(out[0].unionByName(out[1]).select("condition", "variable", "method", "n", "ci_lower", "ci_upper"), 3)


@query("effect_size_limits", rsql(f"""WITH {means_sql(AB)}, {draws_sql('obs', ['channel', 'condition'], 200)},
m AS (SELECT channel, b, avg(value) FILTER (condition = 'F') AS ma, avg(value) FILTER (condition = 'O') AS mb, var_samp(value) FILTER (condition = 'F') AS va, var_samp(value) FILTER (condition = 'O') AS vb FROM r GROUP BY ALL),
d AS (SELECT channel, (ma - mb) / sqrt((va + vb) / 2) AS d FROM m)
SELECT channel, quantile_cont(d, 0.025) AS ci_low, quantile_cont(d, 0.975) AS ci_high FROM d GROUP BY channel""", "ci_low, ci_high", 4))
def effect_limits(spark, folder):
    return rounded(effect_size(trials(spark, folder, AB), n_boot=200).select("channel", "ci_low", "ci_high"), 4)


_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("correlation_pearson", rsql("""
WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS ab, corr(l_quantity, l_discount) AS ac, corr(l_extendedprice, l_discount) AS bc FROM lineitem)
SELECT 'l_quantity' AS feature, 1e0 AS l_quantity, ab AS l_extendedprice, ac AS l_discount FROM c UNION ALL SELECT 'l_extendedprice', ab, 1, bc FROM c UNION ALL SELECT 'l_discount', ac, bc, 1 FROM c""", "l_quantity, l_extendedprice, l_discount"))
def pearson(spark, folder):
    return rounded(correlation_matrix(table(spark, folder, "lineitem"), [*_COLS, "l_returnflag", "absent"]))


@query("correlation_spearman", rsql("""
WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b,
  rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0 AS c FROM lineitem), c AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc FROM r)
SELECT 'l_quantity' AS feature, 1e0 AS l_quantity, ab AS l_extendedprice, ac AS l_discount FROM c UNION ALL SELECT 'l_extendedprice', ab, 1, bc FROM c UNION ALL SELECT 'l_discount', ac, bc, 1 FROM c""", "l_quantity, l_extendedprice, l_discount"))
def spearman(spark, folder):
    return rounded(correlation_matrix(table(spark, folder, "lineitem"), _COLS, "spearman"))


@query("correlation_kendall", rsql("""
WITH c AS (SELECT l_quantity AS x, l_discount AS y, count(*)::DOUBLE AS n FROM lineitem GROUP BY ALL), n AS (SELECT sum(n) AS n FROM c),
s AS (SELECT sum(a.n * b.n * sign(a.x - b.x) * sign(a.y - b.y)) / 2 AS s FROM c a, c b),
tx AS (SELECT sum(t * (t - 1) / 2) AS tx FROM (SELECT sum(n) AS t FROM c GROUP BY x)), ty AS (SELECT sum(t * (t - 1) / 2) AS ty FROM (SELECT sum(n) AS t FROM c GROUP BY y)),
k AS (SELECT s / sqrt((n * (n - 1) / 2 - tx) * (n * (n - 1) / 2 - ty)) AS k FROM s, n, tx, ty)
SELECT 'l_quantity' AS feature, 1e0 AS l_quantity, k AS l_discount FROM k UNION ALL SELECT 'l_discount', k, 1 FROM k""", "l_quantity, l_discount"))
def kendall_tau(spark, folder):
    return rounded(correlation_matrix(table(spark, folder, "lineitem"), ["l_quantity", "l_discount"], "kendall"))
