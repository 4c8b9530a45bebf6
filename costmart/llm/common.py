"""Helpers shared by the operators: tables, written intermediates, Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

CHUNK_BYTES = 4 << 20  # text bytes a Python worker holds expanded at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet under the shared checkpoint folder and reread.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, valid) of a string or binary Arrow array, without copies.

    ``offsets`` has one entry more than rows; null rows are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    valid = np.ones(n, bool) if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), valid
    _, off, data = column.buffers()
    kind = np.int64 if large else np.int32
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0], valid


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` has at most ``limit`` bytes (or one row)."""
    for batch in batches:
        _, offsets, _ = utf8(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(n, max(start + 1, stop))
            yield batch.slice(start, stop - start)
            start = stop
