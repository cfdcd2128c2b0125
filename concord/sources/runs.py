"""Installing the tables of a run in one commit, verifying a repeated install, removing a run.

A product is a folder.  Every attempt to install a run writes its tables beside
what is there, under an id of its own; what makes it the run is one small file,
the manifest, which names the attempt's tables with their rows, digests and
origin, and which can be created only once.  Readers go through manifests
alone, so they see all tables of a run or none, whatever dies when.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import holds
from ..operators.digest import content_digest
from . import once

MANIFESTS = "_manifests"


class RunConflict(RuntimeError):
    """A run of this id is installed with other contents."""


class LoadRefused(RuntimeError):
    """Rows of a table break its rules: nothing has been installed."""


def _manifest_path(folder: str, run_id: str) -> str:
    return f"{folder.rstrip('/')}/{MANIFESTS}/{run_id}.json"


def _data_path(folder: str, table: str, attempt: str) -> str:
    return f"{folder.rstrip('/')}/{table}/attempt={attempt}"


def manifest(spark: SparkSession, folder: str, run_id: str) -> dict | None:
    """What is written down of an installed run: attempt, installed_at, and for each table rows, sha256, nulls, source, version."""
    found = once.text(spark, _manifest_path(folder, run_id))
    return None if found is None else json.loads(found)


def installed(spark: SparkSession, folder: str, run_id: str) -> dict[str, tuple[int, str]]:
    """table -> (rows, digest) as written down for the run; empty if it is not installed."""
    found = manifest(spark, folder, run_id)
    return {name: (t["rows"], t["sha256"]) for name, t in found["tables"].items()} if found else {}


def read_run(spark: SparkSession, folder: str, table: str, run_id: str | None = None) -> DataFrame:
    """The table, with run_id, of all installed runs, or of one: then only its files are read."""
    if run_id is None:
        found = [json.loads(x) for x in once.texts(spark, f"{folder.rstrip('/')}/{MANIFESTS}", ".json").values()]
    else:
        found = [m] if (m := manifest(spark, folder, run_id)) else []
    runs = {m["attempt"]: m["run_id"] for m in found if table in m["tables"]}
    if not runs:
        raise FileNotFoundError(f"no installed run{'' if run_id is None else ' ' + run_id} has a table {table} in {folder}")
    rows = spark.read.option("basePath", f"{folder.rstrip('/')}/{table}").parquet(*[_data_path(folder, table, a) for a in runs])
    # a row for each run
    named = spark.createDataFrame([*runs.items()], "attempt string, run_id string")
    return rows.withColumn("attempt", F.col("attempt").cast("string")).join(F.broadcast(named), "attempt").drop("attempt")


def _staged(df: DataFrame, path: str, rules: Mapping[str, Column], name: str) -> dict:
    """Write a table; rows and nulls are counted, and rules checked, by the job that writes it."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in df.columns], *[F.count_if(~holds(rule)).alias(f"rule {r}") for r, rule in rules.items()]]
    df.observe(seen, *metrics).write.parquet(path)
    got = seen.get
    broken = {r: got[f"rule {r}"] for r in rules if got[f"rule {r}"]}
    if broken:
        raise LoadRefused(f"{name}: rows that break a rule: {broken}")
    return {"rows": got["rows"], "nulls": {c: got[f"null {c}"] for c in df.columns}}


def _digest(df: DataFrame) -> tuple[int, str]:
    row = content_digest(df).first()
    return row["n_rows"], row["sha256"]


def install(spark: SparkSession, folder: str, run_id: str, tables: Mapping[str, DataFrame], rules: Mapping[str, Mapping[str, Column]] | None = None, source: str = "", version: str = "") -> str:
    """Install the tables of a run together; `installed`, or `verified` if the run is there with the same contents.

    `rules` are conditions that every row of a table must meet (null counts as
    breaking); they are counted while the table is written, and LoadRefused
    leaves nothing installed.  A run of the same id with other contents, or
    whose stored rows no longer have the digests written down for them, raises
    RunConflict and changes nothing; of two installers at once, one commits and
    the other verifies or raises.  Digests are those of the written rows.
    An attempt that dies leaves files that no manifest names: see `sweep`.
    """
    if manifest(spark, folder, run_id):
        return _verified(spark, folder, run_id, {n: _digest(df) for n, df in tables.items()})
    attempt, facts = uuid.uuid4().hex, {}
    try:
        for name, df in tables.items():
            path = _data_path(folder, name, attempt)
            facts[name] = _staged(df, path, (rules or {}).get(name, {}), name)
            rows, sha = _digest(spark.read.parquet(path).select(*df.columns))
            if rows != facts[name]["rows"]:
                raise RuntimeError(f"{name}: {facts[name]['rows']} rows written, {rows} read back")
            facts[name] |= {"sha256": sha, "source": source, "version": version}
        told = {"run_id": run_id, "attempt": attempt, "installed_at": datetime.now(timezone.utc).isoformat(), "tables": facts}
        if once.create_once(spark, _manifest_path(folder, run_id), json.dumps(told, sort_keys=True)):
            return "installed"
        said = _verified(spark, folder, run_id, {n: (f["rows"], f["sha256"]) for n, f in facts.items()})
    except BaseException:
        # the commit may have happened though its answer was lost: then the files belong to the run
        if (manifest(spark, folder, run_id) or {}).get("attempt") != attempt:
            _discard(spark, folder, attempt, [*tables])
        raise
    _discard(spark, folder, attempt, [*tables])
    return said


def _verified(spark: SparkSession, folder: str, run_id: str, new: Mapping[str, tuple[int, str]]) -> str:
    if installed(spark, folder, run_id) != dict(new):
        raise RunConflict(f"run {run_id} is installed with other contents")
    for name in new:
        if _digest(read_run(spark, folder, name, run_id).drop("run_id")) != new[name]:
            raise RunConflict(f"{name} of run {run_id} has changed since it was installed")
    return "verified"


def _discard(spark: SparkSession, folder: str, attempt: str, names: list[str]) -> None:
    for name in names:
        once.delete(spark, _data_path(folder, name, attempt))


def remove(spark: SparkSession, folder: str, run_id: str) -> int:
    """Take a run away; the number of its tables.  Its manifest goes first, and with it the run; then the files."""
    found = manifest(spark, folder, run_id)
    if not found:
        return 0
    once.delete(spark, _manifest_path(folder, run_id))
    _discard(spark, folder, found["attempt"], [*found["tables"]])
    return len(found["tables"])


def sweep(spark: SparkSession, folder: str, older_than: float = 7 * 24 * 3600.0) -> int:
    """Delete the files of attempts that no manifest names and that nothing has been added to for `older_than` seconds; how many."""
    named = {json.loads(x)["attempt"] for x in once.texts(spark, f"{folder.rstrip('/')}/{MANIFESTS}", ".json").values()}
    gone, now = 0, time.time()
    for table, _ in once.children(spark, folder):
        for name, changed in once.children(spark, f"{folder.rstrip('/')}/{table}") if table != MANIFESTS else []:
            if name.startswith("attempt=") and name.removeprefix("attempt=") not in named and now - changed / 1000 > older_than:
                once.delete(spark, f"{folder.rstrip('/')}/{table}/{name}")
                gone += 1
    return gone


def provenance(spark: SparkSession, folder: str) -> DataFrame:
    """table, run_id, source, version, n_rows, sha256, installed_at of every table of every installed run, from the commits themselves."""
    found = [json.loads(x) for x in once.texts(spark, f"{folder.rstrip('/')}/{MANIFESTS}", ".json").values()]
    rows = [(n, m["run_id"], t["source"], t["version"], t["rows"], t["sha256"], datetime.fromisoformat(m["installed_at"])) for m in found for n, t in m["tables"].items()]
    return spark.createDataFrame(rows, "table string, run_id string, source string, version string, n_rows long, sha256 string, installed_at timestamp")


def register(rows: DataFrame, folder: str) -> None:
    """Append the provenance of a load outside of runs, one row for each of its tables and one time for all, in one write."""
    rows.coalesce(1).write.mode("append").parquet(f"{folder.rstrip('/')}/provenance")


def load(df: DataFrame, path: str, schema: T.StructType, mode: str = "errorifexists") -> None:
    """Write a table with the columns of the target schema, in its order.  What exists is not overwritten unless asked."""
    from ..operators.normalise import conform

    conform(df, schema).write.mode(mode).parquet(path)
