"""Helpers shared by the operators: stored tables, Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.session import scratch_dir

#: Bytes of text that a task handles at once.
SLICE_BYTES = 4 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder that all executors share and read back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str):
    """64 bits that depend on all the columns, nulls included."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the offsets of the texts; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(sizes)))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(total, total[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)
