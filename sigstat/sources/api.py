"""Landed JSON responses of indicator services, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import operator

DEFAULT_YEAR = 2025  # fixed value: period used when a response names none


def _records(df: DataFrame, body: str, response_index: int) -> DataFrame:
    """One row per record of the response array, as a variant with its position."""
    parsed = df.withColumn(
        "__records", F.try_variant_get(F.try_parse_json(F.col(body)), f"$[{int(response_index)}]", "array<variant>")
    )
    return parsed.select("*", F.posexplode("__records").alias("__pos", "__rec")).drop("__records")


@operator("normalise_api_json")
def normalise_api_json(
    df: DataFrame,
    keys: Sequence[str] = ("participant_id",),
    meta: Sequence[str] = (),
    response_index: int = 1,
    record_value: str = "value",
    record_date: str = "date",
    body: str = "body",
) -> DataFrame:
    """Records of JSON responses -> ``keys, source, indicator, indicator_code, year, value, meta``.

    Null values are skipped, a missing date gives year 0, rows without an
    indicator code or with a body that is not an array give nothing.  ``meta``
    names scalar columns that describe the entity and are kept.
    """
    rec = _records(df.where(F.col("indicator_code").isNotNull() & (F.col("indicator_code") != "")), body, response_index)
    value = F.try_variant_get("__rec", f"$.{record_value}", "double")
    date = F.try_variant_get("__rec", f"$.{record_date}", "string")
    return rec.where(value.isNotNull()).select(
        *keys,
        "source",
        "indicator",
        "indicator_code",
        F.coalesce(date.try_cast("int"), F.lit(0)).alias("year"),
        value.alias("value"),
        *[c for c in meta if c not in {*keys, "api"}],
    )


@operator("latest_period")
def latest_period(
    df: DataFrame,
    keys: Sequence[str] = ("participant_id",),
    order: str = "ordinal",
    response_index: int = 1,
    record_date: str = "date",
    body: str = "body",
    default: int = DEFAULT_YEAR,
) -> DataFrame:
    """Newest period per key: date of the first record of the first indicator, else the default."""
    parsed = F.try_parse_json(F.col(body))
    date = F.try_variant_get(parsed, f"$[{int(response_index)}][0].{record_date}", "string").try_cast("int")
    return df.groupBy(*keys).agg(
        F.coalesce(F.min_by(date, F.col(order)), F.lit(default)).alias("period")
    )
