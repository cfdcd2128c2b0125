"""Text sources and sinks: whitespace tables, CSV snapshots, canonical JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import null_nan
from ..operators.checks import strict
from ..operators.digest import canonical_json, content_digest


def read_whitespace(spark: SparkSession, path: str, schema: T.StructType, header: Sequence[str] | None = None, comment: str = "#") -> DataFrame:
    """A table of columns apart by white space.

    Blank lines and comments are skipped.  A line of another width raises, and
    so does a header (the first comment line) that does not name the given
    columns.  Values are cast as the schema says; what is no value is null.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> ''")
    if header is not None:
        first = lines.filter(F.col("value").startswith(comment)).take(1)
        names = first[0][0].lstrip(comment).split() if first else []
        if names != [*header]:
            raise ValueError(f"header is {names}, not {[*header]}")
    parts = F.split("value", r"\s+")
    rows = lines.filter(~F.col("value").startswith(comment)).select(parts.alias("p"))
    strict(rows.filter(F.size("p") != len(schema.fields)), f"lines that have not {len(schema.fields)} fields")
    return rows.select(*[F.get("p", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV snapshot with a header: empty cells and NaN are null, t and f are booleans."""
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType) for f in schema.fields])
    df = spark.read.schema(text).option("header", True).option("nanValue", "NaN").option("enforceSchema", False).csv(path)
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(c.isin("t", "true"), True).when(c.isin("f", "false"), False)
        elif isinstance(f.dataType, T.DoubleType | T.FloatType):
            c = null_nan(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_snapshot(df: DataFrame, path: str, key: Sequence[str], null: str = "") -> None:
    """CSV with a header, range-sorted by the key, nulls as the marker.  An existing folder is refused."""
    df.repartitionByRange(*key).sortWithinPartitions(*key).write.option("header", True).option("nullValue", null).option("emptyValue", '""').csv(path)


def export_snapshot(df: DataFrame, path: str, key: Sequence[str], columns: Sequence[str], seed: str = "", null: str = "") -> DataFrame:
    """Write the declared columns as a snapshot, range-sorted by the key; what is returned is its digest (one row: n_rows, hash_sum, hash_xor, sha256).

    The digest is that of the rows: it depends neither on how many files hold
    them nor on how the writer quotes.
    """
    rows = df.select(*columns)
    write_snapshot(rows, path, key, null)
    return content_digest(rows, seed)


def write_json_lines(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """Canonical JSON lines (sorted keys, no spaces, nulls written), range-sorted by the key."""
    df.repartitionByRange(*key).sortWithinPartitions(*key).select(canonical_json(df).alias("value")).write.text(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines of a known schema; a line that is none raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
