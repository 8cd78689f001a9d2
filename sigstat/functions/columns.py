"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: column names with a meaning of their own, never channels
RESERVED = ("condition", "epoch_id", "time", "sfreq", "participant_id", "region", "seq",
            "parent_epoch_id", "window_idx")

EPOCH = ("condition", "epoch_id")


def seconds(df: DataFrame, name: str) -> Column:
    """A timestamp (either kind) or number as float seconds."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")) / F.lit(1e6)
    return F.col(name).cast("double")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def infer_channels(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are neither reserved nor excluded."""
    skip = {*RESERVED, *exclude}
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c.cast("double"))


def total(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def ratio(a, b) -> Column:
    """a / b, null where b is 0 (a plain division raises under ANSI rules)."""
    return F.try_divide(a, b)


def field(array, name: str) -> Column:
    """One field of an array of structs, as an array."""
    return F.transform(array, lambda s: s[name])
