"""Recorded streams: manifest of a file's streams and selection of one of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import glob_to_regex
from ..registry import operator


@operator("stream_manifest")
def stream_manifest(
    df: DataFrame,
    file: str = "file",
    stream: str = "stream_idx",
    type_col: str = "type",
    name_col: str = "name",
    channel: str = "channel",
) -> DataFrame:
    """One row per stream of a file: index, type, name, samples, channels.

    Input is the long sample table.  Names keep letters, digits, ``_`` and ``-``;
    missing types read ``Unknown`` and missing names ``stream``.  ``few_samples``
    marks streams of fewer than ten samples.
    """
    per_channel = df.groupBy(file, stream, channel).agg(
        F.count(F.lit(1)).alias("__n"), F.min(type_col).alias("__type"), F.min(name_col).alias("__name")
    )
    out = per_channel.groupBy(file, stream).agg(
        F.max("__n").alias("samples"),
        F.count(F.lit(1)).alias("n_channels"),
        F.min("__type").alias("__type"),
        F.min("__name").alias("__name"),
    )
    name = F.regexp_replace(F.coalesce("__name", F.lit("stream")), r"[^\p{Alnum}_-]", "")
    return out.select(
        file,
        stream,
        F.coalesce("__type", F.lit("Unknown")).alias("type"),
        name.alias("name"),
        "samples",
        "n_channels",
        (F.col("samples").between(1, 9)).alias("few_samples"),
    )


@operator("select_stream")
def select_stream(
    manifest: DataFrame,
    selector: str,
    file: str = "file",
    stream: str = "stream_idx",
    strict: bool = False,
) -> DataFrame:
    """First matching stream per file.

    ``type:X`` compares whole types, ``name:X`` looks for X inside the name, both
    ignoring case; anything else is a shell glob on the name.  ``strict`` raises
    when nothing matches.
    """
    kind, _, want = selector.partition(":")
    if kind == "type":
        hit = F.lower("type") == want.lower()
    elif kind == "name":
        hit = F.contains(F.lower("name"), F.lit(want.lower()))
    else:
        hit = F.col("name").rlike(glob_to_regex(selector))
    rest = [c for c in manifest.columns if c != file]
    row = F.min_by(F.struct(*rest), F.col(stream)).alias("__row")
    out = manifest.where(hit).groupBy(file).agg(row).select(file, *[F.col("__row")[c].alias(c) for c in rest])
    if strict and out.isEmpty():
        raise ValueError(f"no stream matches {selector!r}")
    return out


def stream_samples(samples: DataFrame, chosen: DataFrame, keys: Sequence[str] = ("file", "stream_idx")) -> DataFrame:
    """The samples of the chosen streams."""
    return samples.join(chosen.select(*keys), list(keys), "left_semi")
