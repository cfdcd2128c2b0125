"""Tables of a catalogue or of a database server."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table of the session's catalogue, or some of its columns."""
    df = spark.table(name)
    return df if columns is None else df.select(*columns)


def read_server(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16, **options: str) -> DataFrame:
    """A table of a database server by JDBC; with a numeric key and its bounds, in parallel ranges of the key."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and bounds:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return reader.load()
