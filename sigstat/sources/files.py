"""File sources and sinks: CSV, text lines, Parquet folders, results, profile."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import operator


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    warn_below: int | None = None,
) -> DataFrame:
    """CSV with header.  Give a schema: inference reads the files a second time.

    ``warn_below`` (the usual value is 5) counts at most that many rows and warns
    when there are none or few.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if warn_below:
        n = df.limit(warn_below).count()
        if n < warn_below:
            warnings.warn("no data rows" if n == 0 else f"only {n} data rows", stacklevel=2)
    return df


def read_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", numbered: bool = True
) -> DataFrame:
    """One row per line, split on ``\\n`` only: ``doc_id`` (file), ``line_no``, ``lines``.

    Line numbers and the empty line after a final line end need a file as one value,
    of 2 GB at most.  ``numbered=False`` reads large UTF-8 files in splits instead.
    """
    doc = F.col("_metadata.file_path")
    utf8 = encoding.upper().replace("_", "-") in ("UTF-8", "UTF8")
    if not numbered:
        if not utf8:
            raise ValueError("splits need UTF-8")
        return spark.read.text(path, lineSep="\n").select(doc.alias("doc_id"), F.col("value").alias("lines"))
    if utf8:
        files, body = spark.read.text(path, wholetext=True), F.col("value")
    else:
        files, body = spark.read.format("binaryFile").load(path), F.decode("content", encoding)
    return files.select(doc.alias("doc_id"), F.posexplode(F.split(body, "\n", -1)).alias("line_no", "lines")).select(
        "doc_id", F.col("line_no").cast("long"), "lines"
    )


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Parquet files with a diagonal union of their schemas (missing columns are null)."""
    reader = spark.read.option("mergeSchema", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


_WIDTH = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def _common(types: list[T.DataType]) -> T.DataType:
    first = types[0]
    if all(t == first for t in types):
        return first
    ranks = [next((i for i, w in enumerate(_WIDTH) if isinstance(t, w)), None) for t in types]
    if all(r is not None for r in ranks):
        if any(isinstance(t, T.FloatType) for t in types) and any(isinstance(t, (T.IntegerType, T.LongType)) for t in types):
            return T.DoubleType()
        return _WIDTH[max(ranks)]()
    if any(isinstance(t, T.DecimalType) for t in types) and all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    return T.StringType()


@operator("union_relaxed", inputs=("dfs",))
def union_relaxed(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name: missing columns are null, numeric types widen."""
    dfs = list(dfs)
    seen: dict[str, list[T.DataType]] = {}
    for df in dfs:
        for f in df.schema.fields:
            seen.setdefault(f.name, []).append(f.dataType)
    target = {n: _common(ts) for n, ts in seen.items()}
    cast = [df.select(*[F.col(c).cast(target[c]).alias(c) for c in df.columns]) for df in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


@operator("entity_from_path")
def entity_from_path(df: DataFrame, path: str = "_metadata.file_path", pattern: str | None = None) -> DataFrame:
    """Add ``participant_id`` (first two ``_`` tokens of the stem) and ``modality`` (third).

    With ``pattern`` the id is the first group of the regular expression instead,
    falling back to the stem.
    """
    stem = F.regexp_replace(F.regexp_extract(F.col(path), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    parts = F.split(stem, "_")
    if pattern:
        found = F.regexp_extract(stem, pattern, 1)
        pid = F.when(found != "", found).otherwise(stem)
    else:
        pid = F.when(F.size(parts) >= 2, F.concat_ws("_", F.slice(parts, 1, 2))).otherwise(stem)
    modality = F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit(""))
    return df.select("*", pid.alias("participant_id"), modality.alias("modality"))


def write_result(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    compression: str = "gzip",
    mode: str = "errorifexists",
    dynamic: bool = False,
) -> str:
    """Write Parquet (gzip by default; zstd is the other usual choice).

    ``dynamic=True`` with ``mode='overwrite'`` replaces only the partitions present
    in ``df``: the stored form of a correction for single participants.
    """
    writer = df.write.mode(mode).option("compression", compression)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


@operator("profile")
def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-null values, smallest and largest value."""
    n = len(df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"__n{i}"))
        if isinstance(f.dataType, T.NumericType):
            aggs += [F.min(c).cast("double").alias(f"__lo{i}"), F.max(c).cast("double").alias(f"__hi{i}")]
    one = df.agg(*aggs)
    have = set(one.columns)
    none = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("__rows").alias("rows"),
            F.col(f"__n{i}").alias("non_null"),
            (F.col(f"__lo{i}") if f"__lo{i}" in have else none).alias("min"),
            (F.col(f"__hi{i}") if f"__hi{i}" in have else none).alias("max"),
        )
        for i, f in enumerate(df.schema.fields[:n])
    ]
    return one.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows, for looking at a table; a limit is the feature here."""
    return df.limit(rows)
