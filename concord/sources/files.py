"""Inventory of files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files above this size are hashed in steps; up to it, a file is one value of a row.
WHOLE = 1 << 28
_STEP = 1 << 24


def inventory(spark: SparkSession, folder: str, pattern: str = "*", whole: int = WHOLE) -> DataFrame:
    """path (below the folder), bytes, sha256, modified of the files below the folder whose name fits the pattern.

    Files of any size: those above `whole` bytes are streamed in a task each,
    from any store that Arrow opens by the path's scheme.  Spark's reader leaves empty files out.
    """
    base = folder.rstrip("/").rsplit("/", 1)[-1]
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    below = F.element_at(F.split("path", F.lit(f"/\\Q{base}\\E/"), 2), -1)
    facts = [below.alias("path"), F.col("length").alias("bytes")]
    small = rows.filter(F.col("length") <= whole).select(*facts, F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))
    large = rows.filter(F.col("length") > whole).select("path", *[c.alias(n) for c, n in zip(facts, ("below", "bytes"), strict=True)], F.col("modificationTime").alias("modified"))

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [sha256_of(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:3], pa.array(digests, pa.string()), batch.column(3)], names=["path", "bytes", "sha256", "modified"])

    return small.unionByName(large.mapInArrow(streamed, "path string, bytes long, sha256 string, modified timestamp"))


def sha256_of(uri: str) -> str:
    """SHA-256 of a file's bytes, in memory of a step."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    out = hashlib.sha256()
    with store.open_input_stream(path) as f:
        while part := f.read(_STEP):
            out.update(part)
    return out.hexdigest()
