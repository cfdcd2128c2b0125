"""Canonical rows, content digests, run identities."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(df: DataFrame) -> Column:
    """The row as JSON: keys sorted, no spaces, nulls written."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


#: Hex digits of a row's hash that name its group, level by level; above the last there is one group of all.
LEVELS = (6, 3)


def content_digest(df: DataFrame, seed: str = "") -> DataFrame:
    """One row: rows, order-free sum and xor of row hashes, and a SHA-256 over all rows' SHA-256 that no order of rows changes.

    The last is built in levels: rows are hashed, sorted and hashed again inside
    the groups of the longest prefix, the groups' hashes inside those of the
    next, and so on.  With 16 million groups at the first level, and 4,096
    hashes at most in one above it, no task holds all rows at any size.
    """
    rows = df.select(F.sha2(F.concat(F.lit(seed), canonical_json(df)), 256).alias("h"))
    x = F.conv(F.substring("h", 1, 15), 16, 10).cast("long")
    level = rows.select(F.col("h").alias("p"), F.col("h").alias("d"), F.lit(1).cast("long").alias("n"), x.cast("decimal(38,0)").alias("s"), x.alias("b"))
    for digits in (*LEVELS, 0):
        hashes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "d"))), lambda e: e["d"]), "\n")
        sums = [F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"), F.expr("bit_xor(b)").alias("b"), F.sha2(hashes, 256).alias("d")]
        level = level.groupBy(F.substring("p", 1, digits).alias("p")).agg(*sums) if digits else level.agg(*sums)
    return level.select(F.col("n").alias("n_rows"), F.col("s").cast("string").alias("hash_sum"), F.col("b").alias("hash_xor"), F.col("d").alias("sha256"))


def run_id(parts: Mapping[str, str]) -> str:
    """SHA-256 over the digests that a run depends on (policy, inputs, implementation)."""
    return hashlib.sha256(json.dumps(dict(parts), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def provenance(tables: Mapping[str, DataFrame], source: str, version: str) -> DataFrame:
    """table, source, version, n_rows, sha256, loaded_at: one row per table, one timestamp for all."""
    now, out = F.current_timestamp(), None
    for name, df in tables.items():
        row = content_digest(df).select(F.lit(name).alias("table"), F.lit(source).alias("source"), F.lit(version).alias("version"), "n_rows", "sha256")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("loaded_at", now)
