"""Readers, writers and installs."""

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators.checks import Violation
from concord.sources import files, once, runs, tables, text
from concord.sources.binary_table import BinaryReader, BinaryTable, register

SCHEMA = T.StructType().add("id", "long").add("x", "double").add("name", "string")


def test_whitespace_tables(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("# id x name\n 1   2.5 a\n\n2\tbad  b\n3 NaN c\n")
    rows = text.read_whitespace(spark, str(path), SCHEMA, ["id", "x", "name"]).orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in rows] == [(1, "a"), (2, "b"), (3, "c")]
    assert rows[0]["x"] == 2.5 and rows[1]["x"] is None and np.isnan(rows[2]["x"])
    with pytest.raises(ValueError, match="header"):
        text.read_whitespace(spark, str(path), SCHEMA, ["id", "y", "name"])
    path.write_text("1 2.5\n")
    with pytest.raises(Violation):
        text.read_whitespace(spark, str(path), SCHEMA)


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    (tmp_path / "s.csv").write_text("id,x,ok\n1,NaN,t\n2,,f\n3,1.5,\n")
    schema = T.StructType().add("id", "long").add("x", "double").add("ok", "boolean")
    df = text.read_snapshot(spark, f"{path}.csv", schema)
    assert sorted(map(tuple, df.collect())) == [(1, None, True), (2, None, False), (3, 1.5, None)]
    text.write_snapshot(df, path, ["id"])
    with pytest.raises(PySparkException):
        text.write_snapshot(df, path, ["id"])


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, None, "é\n"), (1, 0.5, "")], SCHEMA)
    text.write_json_lines(df, str(tmp_path / "j"), ["id"])
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "j")).collect())
    assert lines == ['{"id":1,"name":"","x":0.5}', '{"id":2,"name":"é\\n","x":null}']
    back = text.read_json_lines(spark, str(tmp_path / "j"), SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "bad.json").write_text("{nonsense\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        text.read_json_lines(spark, str(tmp_path / "bad.json"), SCHEMA).collect()


def test_binary_tables(spark, tmp_path):
    kind = np.dtype([("id", ">i8"), ("mag", ">f4"), ("ok", "S1"), ("name", "S6"), ("v", ">f8", (3,))])
    rows = np.zeros(1000, kind)
    rows["id"], rows["mag"], rows["ok"], rows["name"] = np.arange(1000) * 7, np.arange(1000) / 4, np.where(np.arange(1000) % 2, b"T", b"F"), b"ab "
    rows["v"] = np.arange(3000).reshape(1000, 3)
    path = tmp_path / "t.bin"
    path.write_bytes(b"HEADER..." + rows.tobytes())
    register(spark)
    read = spark.read.format("binary_table").option("layout", "id K, mag E, ok L, name 6A, v 3D").option("offset", 9).option("rowsPerTask", 128)
    df = read.load(str(path))
    assert df.rdd.getNumPartitions() == 8
    got = df.orderBy("source_row").collect()
    assert [r["source_row"] for r in got] == list(range(1000))
    assert tuple(got[5]) == (5, 35, 1.25, True, "ab", [15.0, 16.0, 17.0])
    assert df.select("v").agg(F.sum(F.expr("v[2]"))).first()[0] == rows["v"][:, 2].sum()


def test_inventory(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"abc")
    r = files.inventory(spark, str(tmp_path), "*.txt").first()
    assert (r["path"], r["bytes"], r["sha256"][:8]) == ("a.txt", 3, "ba7816bf")


def test_runs_install_verify_and_go(spark, tmp_path):
    folder = str(tmp_path / "product")
    t = {"a": spark.createDataFrame([(1, "x"), (2, None)], "id long, s string"), "b": spark.range(5)}
    assert runs.install(spark, folder, "r1", t) == "installed"
    assert runs.install(spark, folder, "r1", t) == "verified"
    with pytest.raises(runs.RunConflict):
        runs.install(spark, folder, "r1", {**t, "b": spark.range(6)})
    assert runs.install(spark, folder, "r2", {**t, "b": spark.range(6)}) == "installed"
    assert runs.read_run(spark, folder, "b").count() == 11
    # rows changed behind the manifest's back are found
    attempt = runs.manifest(spark, folder, "r1")["attempt"]
    spark.range(4).write.mode("overwrite").parquet(f"{folder}/b/attempt={attempt}")
    with pytest.raises(runs.RunConflict, match="has changed"):
        runs.install(spark, folder, "r1", t)
    assert runs.remove(spark, folder, "r1") == 2 and runs.remove(spark, folder, "r1") == 0
    assert runs.installed(spark, folder, "r1") == {} and runs.read_run(spark, folder, "b").count() == 6
    with pytest.raises(FileNotFoundError):
        runs.read_run(spark, folder, "b", "r1")
    assert [(r["table"], r["run_id"], r["n_rows"]) for r in runs.provenance(spark, folder).orderBy("table").collect()] == [("a", "r2", 2), ("b", "r2", 6)]


def attempts(folder):
    import os

    return sorted(f"{t}/{a}" for t in os.listdir(folder) if t != "_manifests" for a in os.listdir(f"{folder}/{t}")) if os.path.isdir(folder) else []


STEPS = ["stage a", "stage b", "digest", "before the commit", "after the commit", "clean up"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_dies_is_there_whole_or_not_at_all(spark, tmp_path, monkeypatch, step):
    """An installer that is killed (no clean-up runs) after any of its writes."""
    folder, t = str(tmp_path / "p"), {"a": spark.range(3), "b": spark.range(5)}

    class Killed(BaseException):
        pass

    def kill(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(runs, "_discard", lambda *_: None)
        real_staged, real_once = runs._staged, once.create_once
        if step.startswith("stage"):
            m.setattr(runs, "_staged", lambda df, path, rules, name: (real_staged(df, path, rules, name), kill())[0] if name == step[-1] else real_staged(df, path, rules, name))
        elif step == "digest":
            m.setattr(runs, "_digest", kill)
        elif step == "before the commit":
            m.setattr(once, "create_once", kill)
        elif step == "after the commit":
            m.setattr(once, "create_once", lambda *x: (real_once(*x), kill())[0])
        else:
            m.setattr(once, "create_once", lambda *x: (real_once(*x), real_once(*x))[1])  # the answer is lost: it looks as if another had won
        if step == "clean up":
            assert runs.install(spark, folder, "r1", t) == "verified"
        else:
            with pytest.raises(Killed):
                runs.install(spark, folder, "r1", t)
    if step in ("after the commit", "clean up"):
        assert [runs.read_run(spark, folder, n).count() for n in t] == [3, 5] and runs.install(spark, folder, "r1", t) == "verified"
    else:
        assert runs.installed(spark, folder, "r1") == {}
        for n in t:
            with pytest.raises(FileNotFoundError):
                runs.read_run(spark, folder, n)
        assert runs.install(spark, folder, "r1", t) == "installed"
        assert [runs.read_run(spark, folder, n, "r1").count() for n in t] == [3, 5]
    assert runs.sweep(spark, folder) == 0
    left = len(attempts(folder)) - 2
    assert runs.sweep(spark, folder, -1.0) == left and len(attempts(folder)) == 2 and runs.read_run(spark, folder, "b").count() == 5


@pytest.mark.parametrize("same", [True, False])
def test_two_installers_at_once(spark, tmp_path, monkeypatch, same):
    import threading
    from concurrent.futures import ThreadPoolExecutor

    folder, gate, real = str(tmp_path / "p"), threading.Barrier(2), once.create_once

    def together(*x):
        gate.wait(60)
        return real(*x)

    monkeypatch.setattr(once, "create_once", together)

    def one(n):
        try:
            return runs.install(spark, folder, "r1", {"a": spark.range(3), "b": spark.range(n)})
        except runs.RunConflict:
            return "conflict"

    with ThreadPoolExecutor(2) as pool:
        said = sorted(pool.map(one, [5, 5 if same else 6]))
    assert said == (["installed", "verified"] if same else ["conflict", "installed"])
    assert runs.read_run(spark, folder, "b").count() == runs.installed(spark, folder, "r1")["b"][0] and len(attempts(folder)) == 2


def test_rules_are_checked_by_the_job_that_writes(spark, tmp_path):
    folder = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 0.5, None), (2, 2.0, "x"), (None, None, "y")], "id long, vx double, s string")
    rules = {"t": {"id": F.col("id") > 0, "range": F.col("vx").between(0, 1) | F.col("vx").isNull()}}
    with pytest.raises(runs.LoadRefused, match="'id': 1, 'range': 1"):
        runs.install(spark, folder, "r1", {"first": spark.range(2), "t": df}, rules)
    assert runs.manifest(spark, folder, "r1") is None and attempts(folder) == []
    assert runs.install(spark, folder, "r1", {"t": df.filter("id = 1")}, rules) == "installed"
    told = runs.manifest(spark, folder, "r1")["tables"]["t"]
    assert (told["rows"], told["nulls"]) == (1, {"id": 0, "vx": 0, "s": 1})
    assert runs.install(spark, folder, "r2", {"t": df}, source="file", version="7") == "installed"
    assert runs.manifest(spark, folder, "r2")["tables"]["t"]["nulls"] == {c: df.filter(F.col(c).isNull()).count() for c in df.columns}
    assert {tuple(r) for r in runs.provenance(spark, folder).select("run_id", "source", "version").collect()} == {("r1", "", ""), ("r2", "file", "7")}
    assert runs.install(spark, folder, "empty", {"t": df.limit(0)}, rules) == "installed" and runs.read_run(spark, folder, "t", "empty").count() == 0


def test_a_file_is_created_once(spark, tmp_path):
    for path in (f"{tmp_path}/a b/x.json", f"file://{tmp_path}/c/x.json"):
        assert once.create_once(spark, path, "one é") and not once.create_once(spark, path, "two")
        assert once.text(spark, path) == "one é" and once.texts(spark, path.rsplit("/", 1)[0], ".json") == {"x.json": "one é"}
    assert once.text(spark, f"{tmp_path}/none") is None and once.texts(spark, f"{tmp_path}/none", ".json") == {}


def test_large_files_are_streamed(spark, tmp_path):
    import hashlib

    (tmp_path / "a.bin").write_bytes(bytes(range(256)) * 400)
    (tmp_path / "b.bin").write_bytes(b"x")
    whole = {tuple(r) for r in files.inventory(spark, str(tmp_path), "*.bin").collect()}
    assert {tuple(r) for r in files.inventory(spark, str(tmp_path), "*.bin", whole=1000).collect()} == whole
    assert {(r[0], r[2]) for r in whole} == {("a.bin", hashlib.sha256(bytes(range(256)) * 400).hexdigest()), ("b.bin", hashlib.sha256(b"x").hexdigest())}


def test_binary_tables_by_uri(spark, tmp_path):
    (tmp_path / "t.bin").write_bytes(np.arange(10, dtype=">i8").tobytes())
    register(spark)
    df = spark.read.format("binary_table").option("layout", "id K").load(f"file://{tmp_path}/t.bin")
    assert [r["id"] for r in df.orderBy("source_row").collect()] == list(range(10))


def test_filters_on_the_row_reach_the_file(spark, tmp_path):
    (tmp_path / "t.bin").write_bytes(np.arange(100_000, dtype=">i8").tobytes())
    register(spark)
    df = spark.read.format("binary_table").option("layout", "id K").option("rowsPerTask", 1000).load(str(tmp_path / "t.bin"))
    for where, want in (("source_row >= 500 and source_row < 1700", range(500, 1700)), ("source_row = 77777", [77777]), ("source_row in (3, 4, 5, 99999, 200000)", [3, 4, 5, 99999]), ("source_row > 99997 and id > 99998", [99999]), ("source_row < 0", []), ("source_row between 10 and 12 and source_row <> 11", [10, 12])):
        got = df.filter(where)
        assert sorted(r["id"] for r in got.collect()) == list(want)
        assert got.rdd.getNumPartitions() <= 2
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

    def ranges(*filters):
        reader = BinaryReader({"path": str(tmp_path / "t.bin"), "layout": "id K", "rowspertask": "1000"}, df.schema)
        left = list(reader.pushFilters(list(filters)))
        return left, [(p.start, p.stop) for p in reader.partitions()]

    other = EqualTo(("id",), 5)
    assert ranges(GreaterThanOrEqual(("source_row",), 98_500), LessThan(("source_row",), 99_600), other) == ([other], [(98_500, 99_500), (99_500, 99_600)])
    assert ranges(In(("source_row",), (7, 8, 50_000))) == ([], [(7, 9), (50_000, 50_001)])


def test_binary_tables_are_written_and_read(spark, tmp_path):
    register(spark)
    at, layout = str(tmp_path / "out"), "id K, x D, ok L, name 4A, v 2E"
    df = spark.range(1000).select("id", (F.col("id") / 7).alias("x"), (F.col("id") % 2 == 0).alias("ok"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.array(F.col("id").cast("float"), F.lit(0.5).cast("float")).alias("v"))
    ordered = df.repartitionByRange(5, "id").sortWithinPartitions("id")
    ordered.write.format("binary_table").option("layout", layout).mode("append").save(at)
    back = spark.read.format("binary_table").option("layout", layout).load(at)
    assert [tuple(r) for r in back.orderBy("source_row").collect()] == [(i, *r) for i, r in enumerate(map(tuple, df.orderBy("id").collect()))]
    assert [tuple(r) for r in back.filter("source_row between 399 and 401").select("id", "name").orderBy("id").collect()] == [(i, f"n{i}") for i in (399, 400, 401)]
    with pytest.raises((PySparkException, Py4JJavaError), match="Writing job failed"):
        ordered.write.format("binary_table").option("layout", layout).mode("append").save(at)
    df.limit(3).write.format("binary_table").option("layout", "id K").mode("overwrite").save(at)
    assert spark.read.format("binary_table").option("layout", "id K").load(at).count() == 3
    for bad, where in ((df.withColumn("x", F.lit(None).cast("double")), "nulls"), (df.withColumn("name", F.lit("too long")), "longer"), (df.withColumn("v", F.array(F.lit(1.0).cast("float"))), "length")):
        with pytest.raises((PySparkException, Py4JJavaError), match=where):
            bad.write.format("binary_table").option("layout", layout).mode("overwrite").save(at)
    assert spark.read.format("binary_table").option("layout", "id K").load(at).count() == 3
    df.limit(0).write.format("binary_table").option("layout", layout).mode("overwrite").save(str(tmp_path / "none"))
    assert spark.read.format("binary_table").option("layout", layout).load(str(tmp_path / "none")).count() == 0


def test_exported_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(3, None, "c"), (1, 0.5, "a"), (2, 1.5, "b")], SCHEMA)
    r = text.export_snapshot(df, str(tmp_path / "s"), ["id"], ["id", "x"], "v1|").first()
    again = text.export_snapshot(df.repartition(3), str(tmp_path / "s2"), ["id"], ["id", "x"], "v1|").first()
    assert r == again and r["n_rows"] == 3
    assert [x["id"] for x in text.read_snapshot(spark, str(tmp_path / "s"), T.StructType(SCHEMA.fields[:2])).collect()] == [1, 2, 3]


def test_tables_of_the_catalogue_and_of_a_server(spark, tmp_path):
    spark.range(5).selectExpr("id", "id * 2 AS x").createOrReplaceTempView("t_view")
    assert tables.read_table(spark, "t_view", ["x"]).columns == ["x"] and tables.read_table(spark, "t_view").count() == 5
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    spark.range(100).selectExpr("id", "id * 2 AS x").write.format("jdbc").options(url=url, dbtable="t", driver=driver).save()
    whole = tables.read_server(spark, url, "t", driver=driver)
    parts = tables.read_server(spark, url, "t", key="ID", bounds=(0, 100), parts=4, driver=driver)
    assert parts.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect())) == [(i, 2 * i) for i in range(100)]
