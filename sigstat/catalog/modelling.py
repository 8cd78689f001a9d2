"""Queries over regressions, the mixed model and leave-one-group-out evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.classify import (
    classification_report, forest, logo_classify, logo_gaussian, loso_window_dataset, permutation_p, permutation_test, permute_labels, window_covariance,
)
from ..operators.mixed import mixed_model
from ..operators.models import contrasts, is_ordinal, linreg_grouped, linreg_wide, ols_cell_means, ridge
from ..session import materialise
from .base import WAVES, means_sql, query, rounded, rsql, student_sql, table, trials, waves

_OLS = f"""{means_sql()}, c AS (SELECT channel, condition, count(*)::DOUBLE AS n, avg(value) AS beta, var_pop(value) * count(*) AS ss FROM obs GROUP BY ALL),
f AS (SELECT channel, sum(n) - count(*) AS df, sum(ss) AS ssr FROM c GROUP BY channel), ols AS (SELECT channel, condition, beta, beta / sqrt(ssr / df / n) AS tvalue, sqrt(ssr / df / n) AS se, df FROM c JOIN f USING (channel))"""


@query("ols_cell_means", rsql(f"WITH {_OLS} SELECT *, {student_sql('tvalue', 'df')} AS pvalue FROM ols", "beta, tvalue, pvalue, se, df", 4))
def cell_means(spark, folder):
    return rounded(ols_cell_means(trials(spark, folder)), 4)


@query("ols_cell_means_dims", rsql("""
WITH o AS (SELECT l_returnflag AS condition, l_suppkey AS epoch_id, l_linestatus || '_l_quantity' AS channel, avg(l_quantity) AS v FROM lineitem GROUP BY ALL),
c AS (SELECT channel, condition, count(*)::DOUBLE AS n, avg(v) AS beta, var_pop(v) * count(*) AS ss FROM o GROUP BY ALL), f AS (SELECT channel, sum(n) - count(*) AS df, sum(ss) AS ssr FROM c GROUP BY channel)
SELECT channel, condition, beta, sqrt(ssr / df / n) AS se FROM c JOIN f USING (channel)""", "beta, se"))
def cell_means_dims(spark, folder):
    df = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("condition"), F.col("l_suppkey").alias("epoch_id"), "l_linestatus", "l_quantity")
    return rounded(ols_cell_means(df, channels=["l_quantity"]).select("channel", "condition", "beta", "se"))


@query("contrasts", rsql(f"""WITH {_OLS}, w AS (SELECT unnest(['a_vs_r', 'a_vs_r', 'mean', 'mean', 'mean']) AS contrast, unnest(['A', 'R', 'A', 'N', 'X']) AS condition, unnest([1.0, -1.0, 0.5, 0.5, 3.0]) AS w)
SELECT channel, contrast, sum(w * beta) AS value, sqrt(sum(w * w * se * se)) AS se, sum(w * beta) / sqrt(sum(w * w * se * se)) AS t, 'bar' AS plot_type FROM ols JOIN w USING (condition) GROUP BY ALL""", "value, se, t", 4))
def contrasted(spark, folder):
    return rounded(contrasts(ols_cell_means(trials(spark, folder)), {"a_vs_r": {"A": 1, "R": -1}, "mean": {"A": 0.5, "N": 0.5, "X": 3}}), 4)


_LINE = """SELECT {g}, regr_slope(y, x) AS slope, sqrt((1 - regr_r2(y, x)) * regr_syy(y, x) / regr_sxx(y, x) / (count(y) - 2)) AS slope_se, regr_r2(y, x) AS r_squared, arg_min(y, x) AS value_first, arg_max(y, x) AS value_last,
  {m} (arg_max(y, x) - arg_min(y, x)) / (abs(arg_min(y, x)) + 1e-9) * 100 AS total_change_pct, {e} count(y) AS n_observations FROM ({t}) WHERE y IS NOT NULL GROUP BY ALL HAVING count(y) >= 3"""


def _line_sql(**parts) -> str:
    """The line with its p value (0 where the points lie on it) and whether it is below 0.05."""
    p = f"CASE WHEN slope_se = 0 THEN 0e0 ELSE {student_sql('slope / slope_se', 'n_observations - 2')} END"
    return f"SELECT *, p_value < 0.05 AS significant FROM (SELECT *, {p} AS p_value FROM ({_LINE.format(**parts)}))"


_YEARS = """SELECT year(l_shipdate) AS x, avg(l_quantity) AS q, avg(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS p, CASE WHEN year(l_shipdate) < 1996 THEN 1e0 END AS few FROM lineitem GROUP BY ALL"""


@query("linreg_wide", rsql(_line_sql(g='"column"', m="avg(y) AS value_mean,", e="min(x)::DOUBLE AS x_start, max(x)::DOUBLE AS x_end,",
       t=f'SELECT * FROM ({_YEARS}) UNPIVOT (y FOR "column" IN (q, p))'), "slope, slope_se, p_value, r_squared, value_first, value_last, value_mean, total_change_pct, x_start, x_end", 5))
def lines_wide(spark, folder):
    li = table(spark, folder, "lineitem")
    y = F.year("l_shipdate")
    wide = li.groupBy(y.alias("year")).agg(
        F.avg("l_quantity").alias("q"), F.avg(F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice"))).alias("p"),
        F.max(F.when(y < 1992, F.lit(1.0))).alias("few"),
    )
    return rounded(linreg_wide(wide, "year", ["q", "p", "few"], rounded=False), 5)


@query("linreg_grouped", rsql(_line_sql(g='l_returnflag, l_linestatus, "group_label"', m="", e="", t="""SELECT l_returnflag, l_linestatus, 'flag ' || l_returnflag AS group_label, year(l_shipdate) AS x, avg(l_extendedprice) AS y FROM lineitem GROUP BY ALL"""),
       "slope, slope_se, p_value, r_squared, value_first, value_last, total_change_pct", 4))
def lines_grouped(spark, folder):
    s = table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")).agg(F.avg("l_extendedprice").alias("value"))
    s = s.withColumn("country", F.concat(F.lit("flag "), "l_returnflag"))
    return rounded(linreg_grouped(s, "l_returnflag", "l_linestatus", label="country", rounded=False), 4)


@query("ridge", rsql("""
WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my FROM lineitem),
g AS (SELECT sum((l_quantity - mx) * (l_quantity - mx)) + 10 AS a, sum((l_quantity - mx) * (l_discount - mz)) AS b, sum((l_discount - mz) * (l_discount - mz)) + 10 AS c,
  sum((l_quantity - mx) * (l_extendedprice - my)) AS d, sum((l_discount - mz) * (l_extendedprice - my)) AS e FROM lineitem, m),
k AS (SELECT (d * c - b * e) / (a * c - b * b) AS bq, (a * e - b * d) / (a * c - b * b) AS bd FROM g)
SELECT 'l_extendedprice' AS target, count(*) AS n_samples, 2 AS n_features, sqrt(avg(pow(l_extendedprice - my - bq * (l_quantity - mx) - bd * (l_discount - mz), 2))) AS rmse,
  avg(abs(l_extendedprice - my - bq * (l_quantity - mx) - bd * (l_discount - mz))) AS mae, 1 - sum(pow(l_extendedprice - my - bq * (l_quantity - mx) - bd * (l_discount - mz), 2)) / sum(pow(l_extendedprice - my, 2)) AS r2,
  'l_quantity,l_discount' AS features_used, max(my - bq * mx - bd * mz) AS intercept, max(bq) AS coef_l_quantity, max(bd) AS coef_l_discount FROM lineitem, m, k""", "rmse, mae, r2, intercept, coef_l_quantity, coef_l_discount", 4))
def ridged(spark, folder):
    li = table(spark, folder, "lineitem").select("l_extendedprice", "l_quantity", "l_discount")
    return rounded(ridge(li, "l_extendedprice", 10.0), 4)


@query("mixed_model_summary")
def mixed_summary(spark, folder):
    """No SQL twin: an iterative REML fit; checked against closed forms in the tests."""
    li = table(spark, folder, "lineitem").select("l_suppkey", "l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    return mixed_model(li, "price", "l_quantity", "l_suppkey", slopes=False).summary


@query("mixed_model_rows", "SELECT l_suppkey, count(*) AS n, true AS adds_up FROM lineitem GROUP BY l_suppkey")
def mixed_rows(spark, folder):
    li = table(spark, folder, "lineitem").select("l_suppkey", "l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    rows = mixed_model(li, "price", "l_quantity", "l_suppkey", slopes=False).rows
    ok = F.abs(F.col("lmm_fit_group") + F.col("lmm_residual") - F.col("price")) < 1e-9
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.bool_and(ok).alias("adds_up"))


@query("is_ordinal", "SELECT count(DISTINCT l_linenumber) AS n_distinct, true AS whole, count(DISTINCT l_linenumber) <= 9 AS is_ordinal FROM lineitem")
def ordinal(spark, folder):
    return is_ordinal(table(spark, folder, "lineitem"), "l_linenumber")


def _customers(spark, folder):
    c = table(spark, folder, "customer")
    return c.select("c_custkey", "c_mktsegment", (F.col("c_acctbal") > 4500).cast("int").alias("rich"), (F.col("c_acctbal") / 1000 + F.col("c_nationkey") / 10).alias("f1"), F.col("c_nationkey").cast("double").alias("f2"))


@query("logo_classify", "SELECT c_mktsegment, CAST(CAST(c_acctbal > 4500 AS INTEGER) AS VARCHAR) AS y, count(*) AS n, true AS known FROM customer GROUP BY ALL")
def logo(spark, folder):
    """Every row is predicted once, with a known label; the trees themselves have no SQL twin."""
    pred = logo_classify(_customers(spark, folder), "rich", "c_mktsegment", ["f1", "f2"], ["c_custkey"], lambda: forest(20))
    return pred.groupBy("c_mktsegment", "y").agg(F.count_distinct("c_custkey").alias("n"), F.bool_and(F.col("pred").isin("0", "1")).alias("known"))


_GAUSSIAN = """c AS (SELECT c_custkey, c_mktsegment, c_acctbal / 1000 + c_nationkey / 10 AS f1, c_nationkey::DOUBLE AS f2, CAST(c_acctbal > 4500 AS INTEGER)::VARCHAR AS rich, (c_custkey % 3)::VARCHAR AS third FROM customer),
l AS (SELECT * FROM c UNPIVOT (y FOR target IN (rich, third))), w AS (SELECT greatest(var_pop(f1), var_pop(f2)) * 1e-9 AS low FROM c),
m AS (SELECT g.c_mktsegment, target, y, count(*) AS n, avg(f1) AS a1, avg(f2) AS a2, var_pop(f1) + any_value(low) AS v1, var_pop(f2) + any_value(low) AS v2 FROM l, w, (SELECT DISTINCT c_mktsegment FROM c) g WHERE l.c_mktsegment <> g.c_mktsegment GROUP BY ALL),
s AS (SELECT l.c_custkey, l.c_mktsegment, l.target, l.y, m.y AS class, ln(n) - (ln(v1) + pow(f1 - a1, 2) / v1 + ln(v2) + pow(f2 - a2, 2) / v2) / 2 AS p FROM l JOIN m ON l.c_mktsegment = m.c_mktsegment AND l.target = m.target)"""


@query("logo_gaussian", f"WITH {_GAUSSIAN} SELECT c_custkey, c_mktsegment, target, y, class AS pred FROM s QUALIFY row_number() OVER (PARTITION BY c_custkey, target ORDER BY p DESC, class) = 1")
def gaussian(spark, folder):
    """Every prediction of two targets; the twin trains each fold on the other groups' rows."""
    df = _customers(spark, folder).withColumn("third", (F.col("c_custkey") % 3).cast("string"))
    return logo_gaussian(df, ["rich", "third"], "c_mktsegment", ["f1", "f2"], ["c_custkey"])


@query("classification_report_targets", rsql(f"""WITH {_GAUSSIAN}, p AS (SELECT c_mktsegment, target, y, class AS p FROM s QUALIFY row_number() OVER (PARTITION BY c_custkey, target ORDER BY s.p DESC, class) = 1),
k AS (SELECT DISTINCT target, y AS class_label FROM p), t AS (SELECT k.target, class_label, count(*) FILTER (y = class_label) AS n_samples, count(*) FILTER (y = class_label AND p = class_label)::DOUBLE AS tp, count(*) FILTER (p = class_label) AS said, count(DISTINCT c_mktsegment) AS n_subjects FROM p JOIN k USING (target) GROUP BY ALL),
r AS (SELECT target, class_label, n_samples, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS precision, tp / n_samples AS recall, n_subjects FROM t)
SELECT target, class_label, n_samples, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score, avg(recall) OVER (PARTITION BY target) AS balanced_accuracy, n_subjects FROM r""", "precision, recall, f1_score, balanced_accuracy"))
def target_reports(spark, folder):
    return rounded(classification_report(gaussian(spark, folder), "c_mktsegment", by=["target"]))


@query("classification_report", rsql("""
WITH p AS (SELECT lang, CAST(quality AS VARCHAR) AS y, CAST(toxic AS VARCHAR) AS p FROM labels JOIN documents USING (doc_id)), c AS (SELECT DISTINCT y AS class_label FROM p),
m AS (SELECT class_label, count(*) FILTER (y = class_label) AS n_samples, count(*) FILTER (y = class_label AND p = class_label)::DOUBLE AS tp, count(*) FILTER (p = class_label) AS said FROM p, c GROUP BY ALL),
r AS (SELECT class_label, n_samples, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS precision, tp / n_samples AS recall FROM m)
SELECT class_label, n_samples, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score, (SELECT avg(recall) FROM r) AS balanced_accuracy,
  (SELECT count(DISTINCT lang) FROM p) AS n_subjects FROM r""", "precision, recall, f1_score, balanced_accuracy"))
def report(spark, folder):
    p = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")
    p = p.select("lang", F.col("quality").cast("string").alias("y"), F.col("toxic").cast("string").alias("pred"))
    return rounded(classification_report(p, "lang"))


@query("permute_labels", """SELECT CAST(perm AS INTEGER) AS perm, l_returnflag, l_linestatus, count(*) AS n, true AS shuffled FROM lineitem, (SELECT unnest(range(3)) AS perm) GROUP BY ALL""")
def permuted(spark, folder):
    """Each permutation keeps the labels of every group; some label moves."""
    li = table(spark, folder, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("id"), "l_returnflag", "l_linestatus"
    )
    out = materialise(permute_labels(li, "l_linestatus", "l_returnflag", ["id"], 3), "permuted")
    was = li.groupBy("id").agg(F.min("l_linestatus").alias("was"))
    both = out.join(was, "id")
    moved = both.groupBy("perm").agg((F.count_if(F.col("l_linestatus") != F.col("was")) > 0).alias("shuffled"))
    return out.groupBy("perm", "l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")).join(moved, "perm")


@query("permutation_p", rsql("""
WITH o AS (SELECT lang, avg(n_chars) AS score FROM documents GROUP BY lang)
SELECT lang, score AS observed, count(*) AS n_permutations, (count(*) FILTER (n_chars >= score) + 1e0) / (count(*) + 1e0) AS p_value_permutation,
  CASE WHEN (count(*) FILTER (n_chars >= score) + 1e0) / (count(*) + 1e0) < 0.1 THEN '.' ELSE 'n.s.' END AS significance FROM documents JOIN o USING (lang) GROUP BY lang, score""", "observed, p_value_permutation"))
def perm_p(spark, folder):
    d = table(spark, folder, "documents").select("lang", F.col("n_chars").cast("double").alias("score"))
    return rounded(permutation_p(d.groupBy("lang").agg(F.avg("score").alias("score")), d, by=["lang"]))


@query("permutation_test", "SELECT CAST(CAST(c_acctbal > 4500 AS INTEGER) AS VARCHAR) AS class_label, count(*) AS n_samples, 5 AS n_subjects, CAST(2 AS BIGINT) AS n_permutations, true AS ok FROM customer GROUP BY ALL".replace("5 AS n_subjects", "CAST(5 AS BIGINT) AS n_subjects"))
def perm_test(spark, folder):
    out = permutation_test(_customers(spark, folder), "rich", "c_mktsegment", ["f1", "f2"], ["c_custkey"], n_perms=2, trees=5, perm_trees=3)
    ok = F.col("p_value_permutation").between(1 / 3 - 1e-9, 1.0) & F.col("balanced_accuracy").between(0.0, 1.0)
    return out.select("class_label", "n_samples", "n_subjects", "n_permutations", ok.alias("ok"))


def _labelled(spark, folder):
    w = waves(spark, folder)
    cond = F.when(F.col("participant_id") % 3 == 0, "pos_a").when(F.col("participant_id") % 3 == 1, "x_NEG").otherwise("rest")
    return w.withColumn("condition", cond)


_WIN = f"""{WAVES}, src AS (SELECT participant_id, CASE WHEN participant_id % 3 = 0 THEN 'pos_a' WHEN participant_id % 3 = 1 THEN 'x_NEG' ELSE 'rest' END AS condition, epoch_id, seq, x, y FROM waves),
win AS (SELECT participant_id, condition, epoch_id, CAST(k AS BIGINT) AS window_idx, seq - k * 16 AS win_pos, x, y FROM src, (SELECT unnest(range(3)) AS k) WHERE seq >= k * 16 AND seq < k * 16 + 32)"""


@query("loso_window_dataset", rsql(f"WITH {_WIN} SELECT *, CASE WHEN condition = 'pos_a' THEN 1 ELSE 0 END AS y_mood FROM win WHERE condition <> 'rest'", "x, y"))
def pilot_windows(spark, folder):
    out = loso_window_dataset(_labelled(spark, folder), None, ["participant_id"], ["x", "y"], 64.0, targets=["mood"], window_sec=0.5, step_sec=0.25)
    return rounded(out.drop("time"))


@query("loso_window_dataset_study", rsql(f"""WITH {_WIN}, w AS (SELECT * REPLACE ('trial_' || (CAST(substr(epoch_id, 2) AS BIGINT) + 1) AS condition) FROM win)
SELECT w.*, CAST(p_size / 5.0 >= 5 AS INTEGER) AS y_valence, CAST(p_retailprice / 200.0 >= 5 AS INTEGER) AS y_arousal FROM w JOIN part ON condition = 'trial_' || p_partkey""", "x, y"))
def study_windows(spark, folder):
    w = waves(spark, folder).withColumn("condition", F.concat(F.lit("trial_"), (F.substring("epoch_id", 2, 99).cast("long") + 1).cast("string")))
    lab = table(spark, folder, "part").select(
        F.concat(F.lit("trial_"), F.col("p_partkey").cast("string")).alias("trial_id"), (F.col("p_size") / 5.0).alias("valence"), (F.col("p_retailprice") / 200.0).alias("arousal")
    )
    out = loso_window_dataset(w, lab, ["participant_id"], ["x", "y"], 64.0, window_sec=0.5, step_sec=0.25)
    return rounded(out.drop("time"))


@query("window_covariance", rsql(f"""WITH {_WIN}, c AS (SELECT participant_id, epoch_id, window_idx, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM win GROUP BY ALL)
SELECT participant_id, epoch_id, window_idx, unnest(['x', 'x', 'y', 'y']) AS channel_a, unnest(['x', 'y', 'x', 'y']) AS channel_b,
  unnest([0.9 * a + 0.1 * (a + c) / 2, 0.9 * b, 0.9 * b, 0.9 * c + 0.1 * (a + c) / 2]) AS cov FROM c""", "cov", 8))
def window_cov(spark, folder):
    from ..operators.segment import segment_windows_samples

    win = segment_windows_samples(_labelled(spark, folder), ["participant_id"], 64.0, 0.5, 0.25)
    return rounded(window_covariance(win, ["participant_id", "epoch_id", "window_idx"], ["x", "y"], 0.1), 8)
