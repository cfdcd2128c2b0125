"""Every registered query with SQL gives the rows that DuckDB gives for it."""

import math
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from concord.plans import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def cell(x):
    if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if type(x).__name__ in ("bool", "bool_"):
        return str(bool(x))
    return repr(round(float(x), 6) + 0.0) if isinstance(x, int | float) or hasattr(x, "dtype") else str(x)


def rows(frame):
    return sorted(tuple(map(cell, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for name in os.listdir(FOLDER):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, oracle, name):
    got = registry.queries()[name](spark, FOLDER).toPandas()
    want = oracle.execute(registry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_is_stable(spark, name):
    frames = [registry.queries()[name](spark, FOLDER).drop("loaded_at").toPandas() for _ in range(2)]
    assert rows(frames[0]) == rows(frames[1])


def test_knn_answers_for_every_vector(spark):
    got = registry.queries()["knn"](spark, FOLDER).groupBy("vec_id").agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
    ids = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id")
    assert got.join(ids, "vec_id").filter("ranks = array(1, 2, 3, 4, 5)").count() == ids.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.queries()) >= set(registry.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
