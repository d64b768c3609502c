"""Helpers shared by the operators: one-time bindings, reading tables, numpy on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost import session


# Settings of these operators, over those of the session.
_SETTINGS = {
    # Whole texts go to Python workers a few megabytes at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # A side is broadcast by its measured size: of a stage, or of the files of a stage table.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Settings of the session that these operators leave as Spark has them.
_OWN = ["spark.sql.adaptive.advisoryPartitionSizeInBytes"]


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators rely on."""
    session.tune(spark)
    for key in _OWN:
        spark.conf.unset(key)
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty) and the bounds of each row in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    width = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int) -> list[pa.RecordBatch]:
    """The batch in consecutive parts of about ``limit`` bytes of ``column``, one row at least."""
    if not batch.num_rows:
        return []
    _, at = text_bytes(batch.column(column))
    parts, first = [], 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        parts.append(batch.slice(first, last - first))
        first = last
    return parts
