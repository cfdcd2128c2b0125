"""Small files that appear whole and at most once, on any file system that Spark's session can reach."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with this text unless it exists; False if it does.

    The text is written beside it first and then takes its name in one step, so
    nobody reads half of it, whatever dies when.  On a local disk that step is a
    hard link; elsewhere a rename that refuses to overwrite, which is atomic
    where the file system's renames are (HDFS; not in plain object stores).
    """
    p, fs = _handle(spark, path)
    fs.mkdirs(p.getParent())
    spare = f"{path}.{uuid.uuid4().hex}.tmp"
    q, _ = _handle(spark, spare)
    out = fs.create(q, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(_local(spare), _local(path))
                return True
            except FileExistsError:
                return False
        jvm = spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(q.toUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(q, p, options)
            return True
        except Exception:
            if fs.exists(p):
                return False
            raise
    finally:
        fs.delete(q, False)


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def texts(spark: SparkSession, folder: str, suffix: str) -> dict[str, str]:
    """name -> text of the files of the folder that end in `suffix`; none if there is no such folder."""
    p, fs = _handle(spark, folder)
    if not fs.exists(p):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(suffix)]
    return {n: t for n in sorted(names) if (t := text(spark, f"{folder}/{n}")) is not None}


def text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    p, fs = _handle(spark, path)
    try:
        stream = fs.open(p)
    except Exception:
        if fs.exists(p):
            raise
        return None
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def children(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of the last change in milliseconds) of what the folder holds."""
    p, fs = _handle(spark, folder)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    p, fs = _handle(spark, path)
    fs.delete(p, True)
