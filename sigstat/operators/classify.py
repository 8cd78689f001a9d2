"""Leave-one-group-out classification, permutation test and the window data sets for it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import EPOCH
from ..plans import skew
from ..plans.ordered import AUTO, attach, ordered_scan
from ..plans.skew import tasks
from ..registry import operator
from ..session import materialise
from .filters import apply_zero_phase, band_design
from .inference import significance_stars
from .segment import segment_windows_samples
from .spectral import channel_covariance


LABEL_BLOCKS = 4  # blocks of labels to a block of rows


def forest(trees: int = 100, seed: int = 42):
    """The default classifier; any estimator with the same columns may replace it."""
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(numTrees=trees, seed=seed, featuresCol="__features", labelCol="__label", predictionCol="__pred")


@operator("logo_classify")
def logo_classify(
    df: DataFrame, target: str, group: str, features: Sequence[str], ids: Sequence[str] = (),
    estimator: Callable = forest, parallel: int = 4,
) -> DataFrame:
    """Predictions of a model trained without the row's group: ``ids, group, y, pred``.

    Rows with nulls are dropped, labels are text.  One model per group is trained on
    the whole remaining table; a few folds are submitted at a time so that the cluster
    stays busy.
    """
    from pyspark.ml.feature import VectorAssembler

    data = df.select(*dict.fromkeys([*ids, group]), F.col(target).cast("string").alias("y"), *[F.col(f).cast("double").alias(f) for f in features])
    data = data.dropna(subset=[group, "y", *features])
    data = VectorAssembler(inputCols=list(features), outputCol="__features").transform(data)
    classes = sorted(r[0] for r in data.select("y").distinct().collect())
    groups = [r[0] for r in data.select(group).distinct().collect()]
    if len(classes) < 2 or len(groups) < 2:
        raise ValueError(f"{len(classes)} classes in {len(groups)} groups are too few")
    names = F.array(*[F.lit(c) for c in classes])
    label = (F.array_position(names, F.col("y")) - 1).cast("double")
    data = materialise(data.withColumn("__label", label), "folds")

    def fold(g):
        model = estimator().fit(data.where(F.col(group) != g))
        return model.transform(data.where(F.col(group) == g)).select(
            *dict.fromkeys([*ids, group]), "y", names[F.col("__pred").cast("int")].alias("pred")
        )

    with ThreadPoolExecutor(parallel) as pool:
        return reduce(DataFrame.unionByName, pool.map(fold, groups))


@operator("logo_gaussian")
def logo_gaussian(df: DataFrame, targets: Sequence[str], group: str, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Leave-one-group-out predictions of Gaussian naive Bayes for several targets: ``ids, group, target, y, pred``.

    Counts, sums and squares per target, group and class are made in one aggregate over all rows; the model of a fold is
    the sums of all rows less those of its group, so that the number of groups and targets adds no job and no scan.
    Features are taken from their mean over the table, variances get a billionth of the largest feature variance.  Rows
    with a null group, feature or label are left out for that target; of equally likely classes the first in text order
    wins; a group that holds all rows of its target gets null predictions.
    """
    keep = list(dict.fromkeys([*ids, group]))
    rows = df.select(*keep, *[F.col(t).cast("string").alias(f"__y{i}") for i, t in enumerate(targets)], *[F.col(f).cast("double").alias(f"__f{j}") for j, f in enumerate(features)])
    rows = rows.dropna(subset=[group, *[f"__f{j}" for j in range(len(features))]])
    mean = rows.agg(*[F.avg(f"__f{j}").alias(f"__m{j}") for j in range(len(features))], *[F.var_pop(f"__f{j}").alias(f"__w{j}") for j in range(len(features))])
    x = [F.col(f"__f{j}") - F.col(f"__m{j}") for j in range(len(features))]
    least = F.greatest(*[F.col(f"__w{j}") for j in range(len(features))], F.lit(0.0)) * 1e-9
    labels = F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"__y{i}").alias("y")) for i, t in enumerate(targets)])
    long = attach(rows, mean, []).select(*keep, F.array(*x).alias("__x"), least.alias("__least"), F.inline(labels)).where("y is not null")

    size = len(features)
    first, second = [F.sum(F.col("__x")[j]) for j in range(size)], [F.sum(F.col("__x")[j] * F.col("__x")[j]) for j in range(size)]
    cell = long.groupBy("target", group, "y").agg(F.count(F.lit(1)).cast("double").alias("__n"), F.array(*first).alias("__s"), F.array(*second).alias("__q"), F.max("__least").alias("__least"))
    total = cell.groupBy("target", "y").agg(
        F.sum("__n").alias("__tn"), F.array(*[F.sum(F.col("__s")[j]) for j in range(size)]).alias("__ts"),
        F.array(*[F.sum(F.col("__q")[j]) for j in range(size)]).alias("__tq"), F.max("__least").alias("__low"),
    )
    folds = cell.select("target", group).distinct().join(total, "target").join(cell.drop("__least"), ["target", group, "y"], "left")
    n = F.col("__tn") - F.coalesce("__n", F.lit(0.0))
    none = F.array(*[F.lit(0.0)] * size)
    minus = lambda a, b: F.zip_with(a, F.coalesce(b, none), lambda u, v: u - v)
    folds = folds.withColumn("__left", n).where("__left > 0")
    centre = F.transform(minus(F.col("__ts"), F.col("__s")), lambda v: v / F.col("__left"))
    square = F.transform(minus(F.col("__tq"), F.col("__q")), lambda v: v / F.col("__left"))
    folds = folds.select("target", group, "y", "__left", "__low", centre.alias("__c"), square.alias("__r"))
    spread = F.zip_with("__r", "__c", lambda r, c: F.greatest(r - c * c, F.lit(0.0)) + F.col("__low"))
    model = folds.select("target", group, F.struct(F.col("y").alias("y"), F.log("__left").alias("prior"), F.col("__c").alias("c"), spread.alias("v")).alias("__class"))
    # as many entries as the target has classes
    model = model.groupBy("target", group).agg(F.sort_array(F.collect_list("__class")).alias("__classes"))

    def likely(k):
        apart = F.zip_with("__x", k["c"], lambda a, b: (a - b) * (a - b))
        return k["prior"] - F.aggregate(F.zip_with(apart, k["v"], lambda d, v: (F.log(v) + d / v) / 2), F.lit(0.0), lambda a, b: a + b)

    scored = attach(long, model, ["target", group]).withColumn("__p", F.transform("__classes", likely))
    best = F.get(F.col("__classes"), (F.array_position("__p", F.array_max("__p")) - 1).cast("int"))["y"]
    return scored.select(*keep, "target", "y", best.alias("pred"))


@operator("classification_report")
def classification_report(pred: DataFrame, group: str | None = None, y: str = "y", y_hat: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class and the balanced accuracy (mean recall).

    Ratios with nothing in the denominator are 0.
    """
    by = list(by)
    conf = pred.groupBy(*by, F.col(y).alias("__y"), F.col(y_hat).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    hits = F.sum(F.when(F.col("__y") == F.col("__p"), F.col("__n")).otherwise(0))
    true = conf.groupBy(*by, F.col("__y").alias("class_label")).agg(F.sum("__n").alias("n_samples"), hits.alias("__tp"))
    said = conf.groupBy(*by, F.col("__p").alias("class_label")).agg(F.sum("__n").alias("__said"))
    per = true.join(said, [*by, "class_label"], "left")

    def ratio(a, b):
        return F.coalesce(F.when(b > 0, a / b), F.lit(0.0))

    tp, sup, out = F.col("__tp"), F.col("n_samples"), F.coalesce("__said", F.lit(0))
    per = per.select(*by, "class_label", "n_samples", ratio(tp, out).alias("precision"), ratio(tp, sup).alias("recall"))
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    acc = per.groupBy(*by).agg(F.avg("recall").alias("balanced_accuracy"))
    res = attach(per.withColumn("f1_score", f1), acc, by, "inner")
    if group:
        res = attach(res, pred.groupBy(*by).agg(F.count_distinct(group).alias("n_subjects")), by, "inner")
    return res


@operator("permute_labels")
def permute_labels(
    df: DataFrame, target: str, group: str, ids: Sequence[str], n_perms: int, seed: int = 42, features: Sequence[str] = (), hot=AUTO
) -> DataFrame:
    """Copies of the table, one per permutation, with labels shuffled inside each group.

    The k-th row of a group by id takes the label of the k-th row by a seeded hash, so
    a repeated task gives the same shuffle.
    """
    rows = df.select(*dict.fromkeys([*ids, group, *features]), F.col(target).alias("__y"))
    perm = F.explode(F.sequence(F.lit(0), F.lit(n_perms - 1)))
    key, by_hash = ["perm", group], F.xxhash64(F.lit(seed), "perm", *ids)
    total, small = 0, True
    if hot is not None:
        counted = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).agg(F.sum("__n"), F.max("__n"), F.min("__n")).first()
        total, most, small = counted[0] or 0, counted[1] or 0, (counted[2] or 0) <= skew.BLOCK_ROWS
        hot = None if most <= skew.BLOCK_ROWS else hot
    if hot is None:
        # places are the same in every permutation
        place = ordered_scan(rows.drop("__y"), [group], [*ids], index="__k", hot=None).withColumn("perm", perm)
        place = place.select(*[c for c in place.columns if c not in ("perm", "__k")], "perm", "__k")
        copies = rows.select(group, *[i for i in ids if i != group], "__y").withColumn("perm", perm).withColumn("__h", by_hash)
        label = ordered_scan(copies, key, ["__h", *ids], index="__k", hot=None)
        return attach(place, label.select(*key, "__k", F.col("__y").alias(target)), [*key, "__k"], "inner").drop("__k")

    ranked = _ranked(rows, group, list(ids), total)
    large = ranked.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > skew.BLOCK_ROWS)
    wide = F.ceil(F.col("__n") / max(1, skew.BLOCK_ROWS // LABEL_BLOCKS))
    base = F.sum(wide).over(W.orderBy(group).rowsBetween(W.unboundedPreceding, 0)) - wide
    large = materialise(large.select(group, wide.alias("__wide"), base.alias("__base")), "large")
    label = attach(ranked.select(*dict.fromkeys([*ids, group]), "__y", "__k"), large, [group]).withColumn("perm", perm).withColumn("__h", by_hash)
    label = label.select("perm", F.col(group).alias("__g"), "__h", "__k", "__y", "__wide", "__base")
    moved = _by_hash(label.where("__wide is not null"), large.agg(F.sum("__wide")).first()[0], n_perms)
    if small:
        at = F.row_number().over(W.partitionBy("perm", "__g").orderBy("__h", "__k")) - 1
        moved = moved.unionByName(label.where("__wide is null").select("perm", "__g", at.cast("long").alias("__k"), "__y"))
    # a struct's nulls are equal; a place meets its labels of all permutations, so that it moves once
    moved = moved.withColumn("__g", F.struct(F.col("__g").alias("g")))
    place = ranked.drop("__y").withColumn("__g", F.struct(F.col(group).alias("g")))
    n = tasks(rows, total * n_perms)
    both = place.repartition(n, "__k", "__g").join(moved.repartition(n, "__k", "__g"), ["__k", "__g"])
    return both.select(*[c for c in rows.columns if c != "__y"], "perm", F.col("__y").alias(target))


def _ranked(rows: DataFrame, group: str, ids: list[str], total: int) -> DataFrame:
    """Rows of large groups with ``__k``, their place in their group by id: sorted in ranges of group and ids and written once.

    A range is a task of the sort; its rows are counted along, and a row per group and range carries the count across the borders.
    """
    order = list(dict.fromkeys([group, *ids]))
    ranked = rows.repartitionByRange(tasks(rows, total), *order).sortWithinPartitions(*order)
    ranked = materialise(ranked.withColumn("__k", F.monotonically_increasing_id()), "ranked").withColumn("__part", F.shiftright("__k", 33))
    ends = ranked.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__k").alias("__first"))
    before = W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")
    carry = materialise(ends.select(group, "__part", shift.alias("__shift")), "places")
    return attach(ranked, carry, [group, "__part"]).withColumn("__k", F.col("__k") + F.col("__shift")).drop("__part", "__shift")


def _by_hash(label: DataFrame, wide: int, n_perms: int) -> DataFrame:
    """Labels of large groups with ``__k``, their place in their group and permutation by ``__h`` (ids, here places by id, decide between equal hashes).

    A hash is spread evenly, so that equal ranges of it are the blocks of a group: no cuts to find and to search.  Each task
    sorts a block, or a run of them, by one number and counts along; a row per block carries the count across the borders.
    """
    run = -(-n_perms * wide // skew.MOST_TASKS)
    within = F.shiftright((F.shiftright("__h", 33) + F.lit(1 << 30)) * F.col("__wide"), 31)
    label = label.withColumn("__block", F.col("perm").cast("long") * wide + F.col("__base") + within)
    task = F.floor(F.col("__block") / run).cast("int")
    blocks = label.groupBy("perm", "__base", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = lambda *keys: F.coalesce(F.sum("__n").over(W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    carry = materialise(blocks.select("__block", (before("perm", "__base") - before(task)).alias("__shift")), "carry")
    # the sort compares this number alone, but for equal hashes
    number = F.shiftleft(F.pmod("__block", F.lit(run)), 40) + F.shiftright("__h", 24) + F.lit(1 << 39)
    label = label.select("perm", "__g", "__h", "__k", "__y", "__block", number.alias("__number")).repartitionById(-(-n_perms * wide // run), task)
    label = label.sortWithinPartitions("__number", "__h", "__k")
    label = label.select("perm", "__g", "__y", "__block", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
    return attach(label, carry, ["__block"]).select("perm", "__g", (F.col("__at") + F.col("__shift")).alias("__k"), "__y")


@operator("permutation_p", inputs=("observed", "permuted"))
def permutation_p(observed: DataFrame, permuted: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """p = (k + 1) / (n + 1) with k permuted scores at or above the observed one, and its stars."""
    by = list(by)
    obs = observed.select(*by, F.col(score).alias("__obs"))
    rows = attach(permuted.select(*by, F.col(score).alias("__s")), obs, by, "inner")
    n = F.count(F.lit(1))
    p = (F.count_if(F.col("__s") >= F.col("__obs")) + 1.0) / (n + 1.0)
    out = rows.groupBy(*by).agg(F.max("__obs").alias("observed"), n.alias("n_permutations"), p.alias("p_value_permutation"))
    return out.withColumn("significance", significance_stars(F.col("p_value_permutation"), fine=True))


@operator("permutation_test")
def permutation_test(
    df: DataFrame, target: str, group: str, features: Sequence[str], ids: Sequence[str], n_perms: int = 1000,
    trees: int = 100, perm_trees: int = 30, seed: int = 42, parallel: int = 4,
) -> DataFrame:
    """Report of ``logo_classify`` with the p value of its balanced accuracy under shuffled labels.

    Cost grows with permutations x groups; ``n_perms`` is the knob.
    """
    clean = df.dropna(subset=[target, group, *features])
    report = classification_report(logo_classify(clean, target, group, features, ids, lambda: forest(trees, seed), parallel), group)
    shuffled = materialise(permute_labels(clean, target, group, ids, n_perms, seed, features), "perms")

    def score(i):
        pred = logo_classify(shuffled.where(F.col("perm") == i), target, group, features, (), lambda: forest(perm_trees, seed), 1)
        return classification_report(pred).agg(F.max("balanced_accuracy")).first()[0]

    with ThreadPoolExecutor(parallel) as pool:
        scores = list(pool.map(score, range(n_perms)))
    table = df.sparkSession.createDataFrame([(float(s),) for s in scores], "score double")
    obs = report.agg(F.max("balanced_accuracy").alias("score"))
    p = permutation_p(obs, table).drop("observed")
    return attach(report.withColumn("target", F.lit(target)), p, [], "inner")


# fixed values: montage order of the 32-channel cap
CANONICAL_32 = (
    "Fp1", "AF3", "F3", "F7", "FC5", "FC1", "C3", "T7",
    "CP5", "CP1", "P3", "P7", "PO3", "O1", "Oz", "Pz",
    "P4", "P8", "PO4", "O2", "T8", "CP2", "CP6", "C4",
    "FC2", "FC6", "F4", "F8", "AF4", "Fp2", "Fz", "Cz",
)


def order_channels(channels: Sequence[str]) -> list[str]:
    """The channels of the montage in its order; all given channels when none is of it."""
    return [c for c in CANONICAL_32 if c in set(channels)] or list(channels)


@operator("loso_window_dataset", inputs=("epochs", "labels"))
def loso_window_dataset(
    epochs: DataFrame,
    labels: DataFrame | None,
    keys: Sequence[str],
    channels: Sequence[str],
    sfreq: float,
    mode: str = "auto",
    targets: Sequence[str] = ("valence", "arousal"),
    threshold: float = 5.0,
    window_sec: float = 4.0,
    step_sec: float = 2.0,
    band: tuple[float, float] | None = None,
    time: str = "time",
    hot=AUTO,
) -> DataFrame:
    """Labelled windows in long form: keys, condition, epoch, window, sample and one label per target.

    ``study`` labels are ``rating >= threshold`` of the trial named by the condition;
    ``pilot`` labels are 1 for conditions containing POS, 0 for NEG (POS first);
    ``auto`` is study when any condition contains ``trial_``.
    Windows without any label go, a target a window has no label for is null.  The optional band-pass runs per window, and only
    when its upper edge lies below half the rate.
    """
    if mode == "auto":
        named = F.lower(F.col("condition").cast("string")).contains("trial_")
        mode = "study" if epochs.agg(F.bool_or(named)).first()[0] else "pilot"
    used = order_channels(channels)
    wins = segment_windows_samples(epochs.select(*keys, *EPOCH, time, *used), keys, sfreq, window_sec, step_sec, "epoch_id", time, hot)
    if mode == "study":
        lab = labels.select(
            *[k for k in keys if k in labels.columns], F.col("trial_id").cast("string").alias("condition"),
            *[(F.col(t) >= float(threshold)).cast("int").alias(f"y_{t}") for t in targets],
        ).dropna(how="all", subset=[f"y_{t}" for t in targets])
        out = wins.join(lab, [*[k for k in keys if k in labels.columns], "condition"])
    elif mode == "pilot":
        up = F.upper("condition")
        y = F.when(F.contains(up, F.lit("POS")), 1).when(F.contains(up, F.lit("NEG")), 0)
        out = wins.withColumns({f"y_{t}": y for t in targets}).where(y.isNotNull())
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if band and 0 < band[0] < band[1] < sfreq / 2:
        zpk = band_design("bandpass", band[0], band[1], sfreq, 4)
        rest = [c for c in out.columns if c not in used]
        long = out.unpivot(rest, used, "__ch", "__v")
        unit = [*keys, "epoch_id", "window_idx", "__ch"]
        long = apply_zero_phase(long, unit, "__v", ["win_pos"], zpk, 27, hot=hot)
        out = long.groupBy(*rest).agg(*[F.max(F.when(F.col("__ch") == c, F.col("__v"))).alias(c) for c in used])
    return out


@operator("window_covariance")
def window_covariance(windows: DataFrame, keys: Sequence[str], channels: Sequence[str], shrinkage: float = 0.0) -> DataFrame:
    """Channel covariance per window, optionally shrunk to the scaled identity."""
    cov = channel_covariance(windows, keys, channels)
    if not shrinkage:
        return cov
    mu = cov.where("channel_a = channel_b").groupBy(*keys).agg(F.avg("cov").alias("__mu"))
    s = float(shrinkage)
    ident = F.when(F.col("channel_a") == F.col("channel_b"), F.col("__mu")).otherwise(F.lit(0.0))
    return attach(cov, mu, list(keys), "inner").select(
        *keys, "channel_a", "channel_b", ((1 - s) * F.col("cov") + s * ident).alias("cov")
    )
