"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checkpoints import cut, shared_folder  # noqa: F401  # for the operators of this subpackage

#: Bytes of text that one step of a task works on at a time.
PIECE_BYTES = 1 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices whose text column holds about `limit` bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        size = pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_text(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text", limit: int = PIECE_BYTES) -> DataFrame:
    """Apply `fn` (Arrow slice -> columns) to every slice of `df` inside Spark's tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, column, limit):
            out = fn(piece)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings, null as the empty string."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def values(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_key(name: str):
    """The long column `name`, freed from the partitioning of what computed it.

    A join on the plain output of an aggregation reuses that aggregation's
    partitioning, and then a hot key cannot be split at run time.  On this
    expression both sides of the join are shuffled, and AQE splits hot keys.
    """
    return F.col(name).cast("decimal(20,0)").cast("long").alias(name)
