"""Arrow batches in bounded pieces, and the folder that executors share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task handles at once (one longer document is taken alone).
PIECE = 1 << 20


def release() -> None:
    """Give memory that a task no longer needs back to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc keeps its own way
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def pieces(batches, column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cut batches where the text of ``column`` passes ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        wide = pa.types.is_large_string(text.type)
        at = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1]
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(at, at[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
        batch = text = at = None
    release()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a piece; null counts as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from its flat values."""
    at = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


def gather(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, .. of every range, one range after the other."""
    total = int(length.sum())
    shift = np.cumsum(length) - length
    return np.repeat(start - shift, length) + np.arange(total)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sigstat-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The same rows with a new lineage: a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The same rows as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
