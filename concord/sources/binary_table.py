"""Fixed-width binary tables (big-endian rows of one layout) as a Spark data source, for reading and writing.

    register(spark)
    spark.read.format("binary_table").option("layout", "id K, mag E, name 8A, v 3D").option("offset", 2880).load(path)
    df.write.format("binary_table").option("layout", "id K, mag E").mode("overwrite").save(folder)

A file is cut into ranges of rows, each a task of its own; only the wanted
columns are decoded, and of the file only the rows that filters on source_row
leave.  The path is one of a shared file system, or a URI of a store that Arrow
opens by its scheme (hdfs, s3, gs, file).  Columns: the layout's, and
source_row, the row's ordinal.  What is written is a folder of files, one for
each task, and a list of them that appears last; read back, their rows are
numbered through in the order of the tasks.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from ..operators.normalise import column_type

#: The list of a folder's files, with their rows.
PARTS = "_parts.json"
#: Numpy kinds of the column codes.
_KINDS = {"D": ">f8", "E": ">f4", "K": ">i8", "J": ">i4", "I": ">i2", "L": "S1"}


def parse_layout(text: str) -> list[tuple[str, str]]:
    """[(name, code)] of "name code, name code"."""
    out = [tuple(p.split()) for p in text.split(",")]
    if any(len(p) != 2 for p in out):
        raise ValueError(f"not a layout: {text!r}")
    return out  # type: ignore[return-value]


def row_type(layout: list[tuple[str, str]]) -> np.dtype:
    fields = []
    for name, code in layout:
        n, kind = int(code[:-1] or 1), code[-1]
        fields.append((name, f"S{n}") if kind == "A" else (name, _KINDS[kind], (n,)) if n > 1 else (name, _KINDS[kind]))
    return np.dtype(fields)


def _store(path: str):
    """(file system, path inside it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def opened(path: str):
    """The file, for reading at any place."""
    store, inside = _store(path)
    return store.open_input_file(inside)


def files_of(path: str, offset: int, width: int) -> list[tuple[str, int]]:
    """(file, rows) of a table: one file, or those that a folder lists."""
    from pyarrow import fs

    store, inside = _store(path)
    if store.get_file_info(inside).type == fs.FileType.Directory:
        with store.open_input_stream(f"{inside}/{PARTS}") as f:
            return [(f"{path.rstrip('/')}/{name}", rows) for name, rows in json.loads(f.read())]
    return [(path, (store.get_file_info(inside).size - offset) // width)]


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach Python data sources (off by default)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BinaryTable)


@dataclass
class Rows(InputPartition):
    path: str
    first: int  # ordinal of the file's first row
    start: int
    stop: int


class BinaryTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binary_table"

    def schema(self) -> T.StructType:
        layout = parse_layout(self.options["layout"])
        out = T.StructType([T.StructField("source_row", T.LongType(), False)])
        for name, code in layout:
            out.add(name, column_type(code))
        return out

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return BinaryReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return BinaryWriter(self.options, overwrite)


class BinaryReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.path, self.offset = options["path"], int(options.get("offset", 0))
        self.layout, self.per_task = parse_layout(options["layout"]), int(options.get("rowspertask", 1 << 20))
        self.names = schema.fieldNames()
        self.n = int(options["rows"]) if "rows" in options else None
        self.low, self.high, self.only = 0, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of source_row with numbers choose the rows to read; the others are left to Spark."""
        for f in filters:
            if getattr(f, "attribute", None) != ("source_row",):
                yield f
            elif isinstance(f, EqualTo | In):
                chosen = {v for v in (f.value if isinstance(f, In) else (f.value,)) if v is not None}
                self.only = chosen if self.only is None else self.only & chosen
            elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif isinstance(f, LessThan | LessThanOrEqual):
                high = f.value + isinstance(f, LessThanOrEqual)
                self.high = high if self.high is None else min(self.high, high)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        files = files_of(self.path, self.offset, row_type(self.layout).itemsize)
        firsts = [0, *accumulate(rows for _, rows in files)]
        n = firsts[-1] if self.n is None else self.n
        if n > firsts[-1]:
            raise ValueError(f"the table holds {firsts[-1]} rows, not {n}")
        low, high = self.low, n if self.high is None else min(n, self.high)
        if self.only is not None:
            wanted = [(i, i + 1) for i in sorted(self.only) if low <= i < high]
            joined: list[tuple[int, int]] = []
            for a, z in wanted:  # neighbours are read at once
                joined[-1:] = [(joined[-1][0], z)] if joined and joined[-1][1] == a else [*joined[-1:], (a, z)]
        else:
            joined = [(low, high)] if low < high else []
        out = []
        for a, z in joined:
            while a < z:
                k = bisect_right(firsts, a) - 1
                stop = min(z, a + self.per_task, firsts[k + 1])
                out.append(Rows(files[k][0], firsts[k], a, stop))
                a = stop
        return out or [Rows(files[0][0] if files else self.path, 0, 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if partition.start == partition.stop:
            return
        kind, codes = row_type(self.layout), dict(self.layout)
        file = opened(partition.path)
        for a in range(partition.start, partition.stop, 65536):
            z = min(partition.stop, a + 65536)
            rows = np.frombuffer(file.read_at((z - a) * kind.itemsize, self.offset + (a - partition.first) * kind.itemsize), dtype=kind)
            cols = []
            for name in self.names:
                if name == "source_row":
                    cols.append(pa.array(np.arange(a, z), pa.int64()))
                    continue
                v, code = rows[name], codes[name]
                if code[-1] == "A":
                    cols.append(pa.array([x.decode("ascii", "replace").strip() for x in v.tolist()], pa.string()))
                elif code[-1] == "L":
                    cols.append(pa.array(v == b"T"))
                else:
                    v = v.astype(v.dtype.newbyteorder("="))
                    cols.append(pa.array(v) if v.ndim == 1 else pa.array(list(v)))
            yield pa.RecordBatch.from_arrays(cols, names=self.names)


@dataclass
class Written(WriterCommitMessage):
    task: int
    name: str
    rows: int


class BinaryWriter(DataSourceArrowWriter):
    """Every task writes a file of its own name, which counts only once the list names it: what a task that is run twice leaves is no part of the table."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.layout = parse_layout(options["layout"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        kind, task, name, n = row_type(self.layout), TaskContext.get().partitionId(), f"part-{uuid.uuid4().hex}.bin", 0
        store, inside = _store(self.path)
        store.create_dir(inside)
        with store.open_output_stream(f"{inside}/{name}") as out:
            for batch in iterator:
                out.write(encoded(batch, self.layout, kind))
                n += batch.num_rows
        return Written(task, name, n)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, inside = _store(self.path)
        store.create_dir(inside)
        if not self.overwrite and store.get_file_info(f"{inside}/{PARTS}").type != fs.FileType.NotFound:
            self.abort(messages)
            raise FileExistsError(f"{self.path} holds a table")
        parts = [(m.name, m.rows) for m in sorted((m for m in messages if m), key=lambda m: m.task) if m.rows]
        spare = f"{inside}/{PARTS}.{uuid.uuid4().hex}"
        with store.open_output_stream(spare) as out:
            out.write(json.dumps(parts).encode())
        store.move(spare, f"{inside}/{PARTS}")
        kept = {name for name, _ in parts}
        for info in store.get_file_info(fs.FileSelector(inside)):
            if info.base_name.startswith("part-") and info.base_name not in kept:
                store.delete_file(info.path)

    def abort(self, messages: list[Written | None]) -> None:
        store, inside = _store(self.path)
        for m in messages:
            if m:
                store.delete_file(f"{inside}/{m.name}")


def encoded(batch: pa.RecordBatch, layout: list[tuple[str, str]], kind: np.dtype) -> bytes:
    """The rows in big-endian bytes.  The format has no null, and no room for longer texts or arrays: they raise."""
    rows = np.zeros(batch.num_rows, dtype=kind)
    for name, code in layout:
        column = batch.column(batch.schema.get_field_index(name))
        if column.null_count:
            raise ValueError(f"{name} has nulls, which a binary table cannot hold")
        if code[-1] == "A":
            raw = [x.encode("ascii") for x in column.to_pylist()]
            if any(len(x) > int(code[:-1] or 1) for x in raw):
                raise ValueError(f"{name} has texts longer than {code}")
            rows[name] = raw
        elif code[-1] == "L":
            rows[name] = np.where(column.to_numpy(zero_copy_only=False), b"T", b"F")
        elif (width := int(code[:-1] or 1)) > 1:
            if pa.compute.any(pa.compute.not_equal(pa.compute.list_value_length(column), width)).as_py() or column.flatten().null_count:
                raise ValueError(f"{name} has arrays of another length than {width}, or nulls in them")
            rows[name] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        else:
            rows[name] = column.to_numpy(zero_copy_only=False)
    return rows.tobytes()
