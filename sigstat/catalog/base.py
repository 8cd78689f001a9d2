"""Input tables of the registered queries, in Spark and as SQL text.

Every query and its SQL twin start from the same named inputs, so that the two state
the same operator over the same rows of the given tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import seconds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL twin where there is one."""

    def register(func):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is already registered")
        QUERIES[name] = func
        if sql is not None:
            SQL[name] = sql
        return func

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, only: Iterable[str] | None = None) -> DataFrame:
    """Round the double columns and turn -0.0 into 0.0, as ``rsql`` does."""
    names = set(only) if only is not None else None
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (names is None or f.name in names):
            c = (F.round(c, digits) + F.lit(0.0)).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def rsql(body: str, cols: str, digits: int = 6) -> str:
    """``body`` with the named columns rounded; a leading WITH stays in front."""
    reps = ", ".join(f"round({c.strip()}, {digits}) + 0.0 AS {c.strip()}" for c in cols.split(","))
    return f"SELECT * REPLACE ({reps}) FROM ({body}) AS q"


DAY = 86400.0
FIRST = 1704067200.0  # 2024-01-01, first day of the events table


def signal(spark, folder) -> DataFrame:
    """events as a signal: participant_id, seq, time, value."""
    e = table(spark, folder, "events")
    return e.select(F.col("user_id").alias("participant_id"), F.col("event_id").alias("seq"), seconds(e, "ts").alias("time"), "value")


SIGNAL = "signal AS (SELECT user_id AS participant_id, event_id AS seq, epoch_us(ts) / 1e6 AS time, value FROM events)"


def intervals(spark, folder) -> DataFrame:
    """Ten consecutive three-day intervals per user, A and B in turn."""
    users = table(spark, folder, "events").select(F.col("user_id").alias("participant_id")).distinct()
    k = F.col("k")
    start = F.lit(FIRST) + k * (3 * DAY)
    return users.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).select(
        "participant_id", F.when(k % 2 == 0, "A").otherwise("B").alias("condition"), F.floor(k / 2).cast("int").alias("ordinal"),
        start.alias("start"), (start + 3 * DAY).alias("stop"),
    )


INTERVALS = f"""intervals AS (
  SELECT participant_id, CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS condition, k // 2 AS ordinal,
         {FIRST}e0 + k * {3 * DAY} AS start, {FIRST}e0 + (k + 1) * {3 * DAY} AS stop
  FROM (SELECT DISTINCT user_id AS participant_id FROM events), (SELECT unnest(range(10)) AS k))"""


def epochs(spark, folder) -> DataFrame:
    """Samples inside the intervals: participant_id, condition, epoch_id, time, seq, value."""
    from ..operators.segment import epoch_by_events

    return epoch_by_events(signal(spark, folder), intervals(spark, folder), ["participant_id"], width=3 * DAY)


EPOCHS = f"""{SIGNAL}, {INTERVALS}, epochs AS (
  SELECT s.participant_id, condition, condition || '_' || ordinal AS epoch_id, time, seq, value
  FROM signal s JOIN intervals i ON s.participant_id = i.participant_id AND time BETWEEN start AND stop)"""


def waves(spark, folder) -> DataFrame:
    """embeddings as 64-sample series: participant_id (label), condition, epoch_id, seq, time, x, y.

    ``y`` is the square of ``x`` less 0.01, a second channel of the same series.
    """
    e = table(spark, folder, "embeddings")
    x = F.col("x").cast("double")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("seq", "x")).select(
        F.col("label").alias("participant_id"),
        F.when(F.col("vec_id") % 2 == 0, "A").otherwise("B").alias("condition"),
        F.concat(F.lit("v"), F.lpad(F.col("vec_id").cast("string"), 8, "0")).alias("epoch_id"),
        F.col("seq").cast("long").alias("seq"), (F.col("seq") / 64.0).alias("time"), x.alias("x"), (x * x - 0.01).alias("y"),
    )


WAVES = """waves AS (
  SELECT label AS participant_id, CASE WHEN vec_id % 2 = 0 THEN 'A' ELSE 'B' END AS condition,
         'v' || lpad(CAST(vec_id AS VARCHAR), 8, '0') AS epoch_id, seq, seq / 64.0 AS time, x, x * x - 0.01 AS y
  FROM (SELECT vec_id, label, CAST(i - 1 AS BIGINT) AS seq, CAST(embedding[i] AS DOUBLE) AS x
        FROM embeddings, (SELECT unnest(range(1, 65)) AS i)))"""


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
LINE_SQL_ORDER = ", ".join(LINE_ORDER)
LINE_CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark, folder) -> DataFrame:
    """lineitem as a four-channel signal per supplier, in shipping order."""
    return table(spark, folder, "lineitem").select("l_suppkey", *LINE_ORDER, "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def trials(spark, folder, condition: str = "l_returnflag") -> DataFrame:
    """lineitem as epochs: condition, epoch_id (supplier), channels quantity, price, discount."""
    return table(spark, folder, "lineitem").select(
        F.col(condition).alias("condition"), F.col("l_suppkey").alias("epoch_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
    )


def trials_sql(condition: str = "l_returnflag") -> str:
    return f"""trials AS (SELECT {condition} AS condition, l_suppkey AS epoch_id, l_quantity AS quantity,
  l_extendedprice AS price, l_discount AS discount FROM lineitem)"""


def means_sql(condition: str = "l_returnflag") -> str:
    """Long epoch means of the trials: condition, epoch_id, channel, value."""
    return trials_sql(condition) + """, obs AS (
  SELECT condition, epoch_id, channel, value FROM (
    SELECT condition, epoch_id, avg(quantity) AS quantity, avg(price) AS price, avg(discount) AS discount
    FROM trials GROUP BY condition, epoch_id)
  UNPIVOT (value FOR channel IN (quantity, price, discount)))"""


STEPS = 4000


def simpson_sql(f: str, low: str, high: str) -> str:
    """Integral of ``f``, an expression of ``$x``, from low to high by Simpson's rule."""
    at = f"(({low}) + (({high}) - ({low})) * i_ / {STEPS}e0)"
    weight = f"CASE WHEN i_ % {STEPS} = 0 THEN 1e0 WHEN i_ % 2 = 1 THEN 4e0 ELSE 2e0 END"
    return f"(({high}) - ({low})) / {3 * STEPS}e0 * list_sum([({weight}) * ({f.replace('$x', at)}) FOR i_ IN range({STEPS + 1})])"


def fisher_sql(f: str, d1: str, d2: str) -> str:
    """P(F > f) as the share of an integral: F = d2 / d1 tan^2(u), where u has density cos^(d2 - 1) sin^(d1 - 1)."""
    density = f"pow(cos($x), ({d2}) - 1) * pow(sin($x), ({d1}) - 1)"
    angle, wide = f"atan(sqrt(({d1}) * ({f}) / ({d2})))", f"(15 + sqrt({d1})) / sqrt({d2})"
    part = simpson_sql(density, angle, f"least(pi() / 2, {angle} + {wide})")
    return f"least(1e0, ({part}) / ({simpson_sql(density, '0e0', f'least(pi() / 2, {wide})')}))"


def student_sql(t: str, df: str) -> str:
    """Two-sided p of t: t^2 has an F distribution."""
    return fisher_sql(f"({t}) * ({t})", "1e0", df)


def chi2_sql(x: str, k: str) -> str:
    """P(chi^2 > x) as the share of an integral over the root, with density u^(k - 1) exp(-u^2 / 2)."""
    density, wide = f"pow($x, ({k}) - 1) * exp(-($x) * ($x) / 2)", f"(15 + sqrt({k}))"
    part = simpson_sql(density, f"sqrt({x})", f"sqrt({x}) + {wide}")
    return f"({part}) / ({simpson_sql(density, '0e0', wide)})"


def normal_sql(z: str) -> str:
    """Two-sided p of a normal deviate."""
    return chi2_sql(f"({z}) * ({z})", "1e0")
