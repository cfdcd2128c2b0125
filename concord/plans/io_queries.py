"""Queries that write tables to the shared folder in some form and read them back, and that clean names and types."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ascii_text
from ..operators import checks as C
from ..operators import digest as D
from ..operators import normalise as N
from ..operators.checkpoints import shared_folder
from ..sources import binary_table, runs, tables, text
from .quality_queries import digest_sql
from .views import Tables, with_views

SQL: dict[str, str] = {}


def _new(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def sanitised_names(spark: SparkSession, d: str) -> DataFrame:
    """A table with unruly names, cleaned and counted."""
    x = Tables(spark, d).customer.toDF("Cust Key", "NAME (full)", "select", "Acct-Bal", "1st segment")
    return N.sanitise(x).groupBy("c_1st_segment").agg(F.count("cust_key").alias("n"), F.count_distinct("name_full").alias("names"), F.max("c_select").alias("nation"), F.round(F.max("acct_bal"), 6).alias("best"))


SQL["sanitised_names"] = "SELECT c_mktsegment AS c_1st_segment, count(c_custkey) AS n, count(DISTINCT c_name) AS names, max(c_nationkey) AS nation, round(max(c_acctbal), 6) AS best FROM customer GROUP BY 1"


def inferred_types(spark: SparkSession, d: str) -> DataFrame:
    """The types that the columns of a table have when all of it is text."""
    o = Tables(spark, d).orders
    return N.infer_text_types(o.select(*[F.col(c).cast("string").alias(c) for c in o.columns], F.lit(None).cast("string").alias("nothing"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.lit(" 7.5 ")).alias("mixed")))


SQL["inferred_types"] = """SELECT c AS "column", CASE WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+')) THEN 'integer' WHEN bool_and(try_cast(v AS DOUBLE) IS NOT NULL) THEN 'decimal' ELSE 'string' END AS type FROM (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority', 'mixed']) AS c,
  unnest([o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus, o_totalprice::VARCHAR, o_orderdate::VARCHAR, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::VARCHAR ELSE '7.5' END]) AS v FROM orders) GROUP BY c UNION ALL SELECT 'nothing', 'string'"""


def coded_types(spark: SparkSession, d: str) -> DataFrame:
    """Text cast by column codes; names that come as padded bytes."""
    t = Tables(spark, d)
    x = t.part.select(F.col("p_partkey").cast("string").alias("p_partkey"), F.col("p_size").cast("string").alias("p_size"), F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("p_brand"), F.col("p_retailprice").cast("string").alias("p_retailprice"), F.concat("p_name", F.lit("   ")).cast("binary").alias("p_name"))
    out = N.cast_by(x, {"p_partkey": "K", "p_size": "I", "p_brand": "10A", "p_retailprice": "D"}).withColumn("p_name", ascii_text(F.col("p_name")))
    return out.groupBy("p_brand").agg(F.sum("p_partkey").alias("keys"), F.max("p_size").cast("int").alias("size"), F.round(F.sum("p_retailprice"), 2).alias("price"), F.min("p_name").alias("name"))


SQL["coded_types"] = "SELECT p_brand, sum(p_partkey)::BIGINT AS keys, max(p_size) AS size, round(sum(p_retailprice), 2) AS price, min(p_name) AS name FROM part GROUP BY p_brand"


def snapshot_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Customers as a CSV snapshot in key order, null marked, read back under their schema."""
    c = Tables(spark, d).customer.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"), (F.col("c_nationkey") > 12).alias("far"))
    text.export_snapshot(c, at := _new(spark, "snapshot"), ["c_custkey"], c.columns)
    return text.read_snapshot(spark, at, c.schema)


SQL["snapshot_round_trip"] = "SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal, c_nationkey > 12 AS far FROM customer"


def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as canonical JSON lines, read back."""
    s = Tables(spark, d).supplier
    text.write_json_lines(s, at := _new(spark, "lines"), ["s_suppkey"])
    return text.read_json_lines(spark, at, s.schema)


SQL["json_round_trip"] = "SELECT * FROM supplier"


def whitespace_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Line items as a table of columns apart by blanks, with blank lines and comments, read under a schema; one value is none."""
    x = Tables(spark, d).lineitem
    line = F.concat_ws("  ", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.when(F.col("l_orderkey") % 10 == 0, "none").otherwise(F.col("l_quantity").cast("string")), F.concat(F.lit(" "), "l_returnflag"))
    rows = x.select(F.explode(F.array(line, F.lit(""), F.lit("# a comment"))).alias("value"))
    rows.write.text(at := _new(spark, "table"))
    return text.read_whitespace(spark, at, T.StructType().add("key", "long").add("line", "integer").add("quantity", "double").add("flag", "string"))


SQL["whitespace_round_trip"] = "SELECT l_orderkey AS key, l_linenumber AS line, CASE WHEN l_orderkey % 10 <> 0 THEN l_quantity END AS quantity, l_returnflag AS flag FROM lineitem"


def binary_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a big-endian binary table in key order, read back from the third row on; the filter on the row reaches the files."""
    binary_table.register(spark)
    o = Tables(spark, d).orders
    layout, at = "o_orderkey K, o_totalprice D, o_orderstatus 1A, large L, pair 2D", _new(spark, "binary")
    rows = o.select("o_orderkey", "o_totalprice", "o_orderstatus", (F.col("o_totalprice") > 1e5).alias("large"), F.array(F.col("o_custkey").cast("double"), F.lit(0.5)).alias("pair"))
    rows.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.format("binary_table").option("layout", layout).mode("append").save(at)
    back = spark.read.format("binary_table").option("layout", layout).load(at).filter("source_row >= 2")
    return back.select("source_row", "o_orderkey", "o_totalprice", "o_orderstatus", "large", F.get("pair", F.lit(0)).cast("long").alias("o_custkey"))


SQL["binary_round_trip"] = "SELECT * FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS source_row, o_orderkey, o_totalprice, o_orderstatus, o_totalprice > 1e5 AS large, o_custkey FROM orders) WHERE source_row >= 2"


def installed_runs(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of a product, the first installed twice and then removed; what is left, with what each step said."""
    t = Tables(spark, d)
    folder, first = _new(spark, "product"), {"orders": t.orders.select("o_orderkey", "o_custkey"), "nation": t.nation}
    said = [runs.install(spark, folder, "r1", first), runs.install(spark, folder, "r1", first), runs.install(spark, folder, "r2", {"orders": t.orders_v2().select("o_orderkey", "o_custkey"), "nation": t.nation})]
    said.append(str(runs.remove(spark, folder, "r1")))
    left = [runs.read_run(spark, folder, n).groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), "run_id", "n") for n in first]
    return left[0].unionByName(left[1]).withColumn("said", F.lit(" ".join(said)))


SQL["installed_runs"] = "SELECT 'orders' AS \"table\", 'r2' AS run_id, (SELECT count(*) FROM orders WHERE o_orderkey % 100 <> 1) + (SELECT count(*) FROM orders WHERE o_orderkey < 5) AS n, 'installed verified installed 2' AS said UNION ALL SELECT 'nation', 'r2', count(*), 'installed verified installed 2' FROM nation"


def checked_load(spark: SparkSession, d: str) -> DataFrame:
    """What a load says of its tables: rows, and nulls of each column, counted by the job that writes them under rules; and the digest of one."""
    t = Tables(spark, d)
    folder = _new(spark, "checked")
    o = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    loads = {"orders": o, "dirty": t.dirty().select("id", "code", "x")}
    runs.install(spark, folder, "r1", loads, {"orders": {"key": F.col("o_orderkey") >= 0, "status": F.col("o_orderstatus").isNull() | F.col("o_orderstatus").isin("F", "O", "P")}})
    told = runs.manifest(spark, folder, "r1")["tables"]
    rows = [(n, f["rows"], c, k) for n, f in told.items() for c, k in f["nulls"].items()]
    digests = runs.provenance(spark, folder).select("table", F.when(F.col("table") == "orders", F.col("sha256")).alias("sha256"))
    return spark.createDataFrame(rows, "table string, n_rows long, column string, n_null long").join(digests, "table")


_CHECKED_JSON = """'{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":' || CASE WHEN o_orderkey % 9 <> 0 THEN '"' || o_orderstatus || '"' ELSE 'null' END || '}'"""
SQL["checked_load"] = with_views("SELECT 'orders' AS \"table\", n_rows, c AS \"column\", n AS n_null, (SELECT sha256 FROM (" + digest_sql(f"SELECT {_CHECKED_JSON} AS j FROM orders") + ")) AS sha256 FROM (SELECT count(*) AS n_rows, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus']) AS c, unnest([0, 0, count(*) FILTER (o_orderkey % 9 = 0)]) AS n FROM orders) UNION ALL SELECT 'dirty', n_rows, c, n, NULL FROM (SELECT count(*) AS n_rows, unnest(['id', 'code', 'x']) AS c, unnest([count(*) FILTER (id IS NULL), count(*) FILTER (code IS NULL), count(*) FILTER (x IS NULL)]) AS n FROM dirty)", "dirty")


def loaded_table(spark: SparkSession, d: str) -> DataFrame:
    """Parts loaded under a target schema of another order and other types, beside a provenance that two loads append to, and read as a table of the catalogue."""
    p = Tables(spark, d).part
    folder = _new(spark, "load")
    target = T.StructType().add("p_name", "string").add("p_size", "long").add("p_partkey", "long")
    runs.load(p, f"{folder}/part", target)
    for version in ("1", "2"):
        runs.register(D.provenance({"part": p.select("p_partkey")}, "testdata", version), folder)
    loads = spark.read.parquet(f"{folder}/provenance").agg(F.count(F.lit(1)).alias("n_loads"), F.count_distinct("sha256").alias("n_contents")).withColumn("k", F.lit(1))
    spark.read.parquet(f"{folder}/part").createOrReplaceTempView(view := f"part_{uuid.uuid4().hex}")
    return tables.read_table(spark, view, ["p_size", "p_partkey", "p_name"]).withColumn("k", F.lit(1)).join(loads, "k").drop("k")


SQL["loaded_table"] = "SELECT p_size::BIGINT AS p_size, p_partkey, p_name, 2::BIGINT AS n_loads, 1::BIGINT AS n_contents FROM part"


def resolved_keys(spark: SparkSession, d: str) -> DataFrame:
    """Line items with the status of their order; a line without one would halt the query."""
    t = Tables(spark, d)
    out = C.resolve(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), t.orders, "o_orderkey", ["o_orderstatus"])
    return out.groupBy("o_orderstatus", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


SQL["resolved_keys"] = "SELECT o_orderstatus, l_returnflag, count(*) AS n FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL"


def run_identity(spark: SparkSession, d: str) -> DataFrame:
    """The identity of a run over the digests of its policy and its input."""
    c = Tables(spark, d).customer.select("c_custkey", "c_name")
    sha = D.content_digest(c).first()["sha256"]  # one row
    return spark.range(1).select(F.lit(D.run_id({"policy": "p-1", "customer": sha})).alias("run_id"))


_CUSTOMERS = digest_sql("""SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS j FROM customer""")
SQL["run_identity"] = f"""SELECT sha256('{{"customer":"' || sha256 || '","policy":"p-1"}}') AS run_id FROM ({_CUSTOMERS})"""

QUERIES = {f.__name__: f for f in (sanitised_names, inferred_types, coded_types, snapshot_round_trip, json_round_trip, whitespace_round_trip, binary_round_trip, installed_runs, checked_load, loaded_table, resolved_keys, run_identity)}
