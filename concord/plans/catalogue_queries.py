"""Queries on contracts, links, arrays and fits of whole catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import separation_arcsec, separation_by_cosines
from ..operators import center
from ..operators import checks as C
from ..operators import outliers as O
from ..operators import reconcile as R
from ..operators import splits as S
from ..operators.checkpoints import cut
from .tension_queries import _development, rounded, tension_sql
from .views import Tables, with_views

SQL: dict[str, str] = {}


def _arrays(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Vectors, and a version of them with changed elements, other lengths and missing arrays on either side."""
    x, i, e = t.embeddings, F.col("vec_id"), F.col("embedding")
    one = F.transform(e, lambda v, k: F.when((k == i % 64) | (k == 5), v + F.lit(1).cast("float")).otherwise(v))
    source = x.select("vec_id", F.when(i % 29 != 0, e).alias("embedding"), "label")
    target = F.when(i % 7 == 0, None).when(i % 11 == 0, F.slice(e, 1, 63)).when(i % 13 == 0, F.concat(e, F.array(F.lit(None).cast("float")))).when(i % 5 == 0, one).otherwise(e)
    return source, x.select("vec_id", target.alias("embedding"), F.when(i % 17 == 0, F.col("label") + 1).otherwise(F.col("label")).alias("label"))


_ARRAYS_SQL = """s AS (SELECT vec_id, CASE WHEN vec_id % 29 <> 0 THEN embedding END AS e, label FROM embeddings), t AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 11 = 0 THEN embedding[1:63] WHEN vec_id % 13 = 0 THEN list_append(embedding, NULL)
  WHEN vec_id % 5 = 0 THEN list_transform(embedding, lambda v, k: CASE WHEN k - 1 = vec_id % 64 OR k - 1 = 5 THEN v + 1 ELSE v END) ELSE embedding END AS e, CASE WHEN vec_id % 17 = 0 THEN label + 1 ELSE label END AS label FROM embeddings)"""


def reconcile_arrays(spark: SparkSession, d: str) -> DataFrame:
    """The ledger of array and scalar columns: one row for a whole array, or one for each element that differs."""
    out = R.reconcile(*_arrays(Tables(spark, d)), "vec_id", ["embedding", "label"])
    return out.select("vec_id", F.coalesce("column", F.lit("-")).alias("column"), F.coalesce("index", F.lit(-1)).alias("index"), "kind")


SQL["reconcile_arrays"] = f"""WITH {_ARRAYS_SQL}, j AS (SELECT s.vec_id, s.e AS a, t.e AS b, s.label AS la, t.label AS lb FROM s JOIN t USING (vec_id)), u AS (SELECT vec_id, unnest(range(len(a))) AS k, unnest(a) AS x, unnest(b) AS y FROM j WHERE len(a) = len(b))
  SELECT vec_id, 'embedding' AS "column", -1::INT AS index, 'mismatch' AS kind FROM j WHERE (a IS NULL) <> (b IS NULL) OR len(a) <> len(b) UNION ALL SELECT vec_id, 'embedding', k::INT, 'mismatch' FROM u WHERE x IS DISTINCT FROM y UNION ALL SELECT vec_id, 'label', -1, 'mismatch' FROM j WHERE la IS DISTINCT FROM lb"""


def reconcile_typed(spark: SparkSession, d: str) -> DataFrame:
    """A source of wider types against a target of the declared ones: what does not fit, and what differs after the exact cast."""
    o = Tables(spark, d).orders
    big = F.col("o_orderkey") * 3_000_000
    source = o.select("o_orderkey", big.alias("number"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") * 40).alias("small"), F.col("o_orderstatus").cast("binary").alias("status"))
    target = o.select("o_orderkey", F.when(big <= 2147483647, big).cast("int").alias("number"), F.when(F.col("o_orderkey") % 50 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast("float").alias("price"), F.when(F.col("o_custkey") * 40 <= 32767, F.col("o_custkey") * 40).cast("short").alias("small"), "o_orderstatus")
    declared = {"number": "integer", "price": "real", "small": "smallint", "status": "text"}
    out = R.reconcile(source, target.withColumnRenamed("o_orderstatus", "status"), "o_orderkey", list(declared), declared)
    return out.groupBy("column", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"))


SQL["reconcile_typed"] = """WITH x AS (SELECT 'number' AS "column", 'cast' AS kind, o_orderkey FROM orders WHERE o_orderkey * 3000000 > 2147483647 UNION ALL SELECT 'small', 'cast', o_orderkey FROM orders WHERE o_custkey * 40 > 32767 UNION ALL SELECT 'price', 'mismatch', o_orderkey FROM orders WHERE o_orderkey % 50 = 0)
  SELECT "column", kind, count(*) AS n, min(o_orderkey) AS first FROM x GROUP BY ALL"""


def conformance(spark: SparkSession, d: str) -> DataFrame:
    """The vectors' later version against the contract of the first: a column that came, one that went, a type, a place, and array lengths."""
    t = Tables(spark, d)
    later = _arrays(t)[1].select("vec_id", F.col("label").cast("long").alias("label"), "embedding", F.lit("x").alias("note"))
    contract = R.schema_frame(t.embeddings.withColumn("origin", F.lit("-"))).withColumn("array_length", F.when(F.col("column") == "embedding", 64))
    return R.conformance(later, contract)


SQL["conformance"] = f"WITH {_ARRAYS_SQL} SELECT * FROM (VALUES ('label', 'type_differs', 1::BIGINT), ('label', 'moved', 1), ('embedding', 'moved', 1), ('note', 'unexpected', 1), ('origin', 'missing', 1)) v(\"column\", diagnostic, n) UNION ALL SELECT 'embedding', 'wrong_length', count(*) FROM t WHERE len(e) <> 64"


def row_rules(spark: SparkSession, d: str) -> DataFrame:
    """Conditions across columns: shares that sum to 1, a price that fits its quantity, dates in order."""
    t = Tables(spark, d)
    paid = t.lineitem.groupBy("l_orderkey").agg(*[F.avg((F.col("l_returnflag") == f).cast("double")).alias(f"share_{f}") for f in "ANR"], F.sum("l_quantity").alias("q"))
    x = t.orders.join(paid, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return C.row_rules(x, {"shares_sum_to_1": C.sums_to(["share_A", "share_N", "share_R"], 1.0), "price_above_quantity": F.col("o_totalprice") > F.col("q") * 100, "some_line": F.col("q").isNotNull()})


SQL["row_rules"] = """WITH p AS (SELECT l_orderkey, avg((l_returnflag = 'A')::INT) + avg((l_returnflag = 'N')::INT) + avg((l_returnflag = 'R')::INT) AS s, sum(l_quantity) AS q FROM lineitem GROUP BY 1), x AS (SELECT o_totalprice, s, q FROM orders LEFT JOIN p ON o_orderkey = l_orderkey),
  f AS (SELECT 'shares_sum_to_1' AS rule, count(*) AS n_rows, count(*) FILTER (NOT coalesce(abs(s - 1) <= 1e-6, false)) AS n_failed FROM x UNION ALL SELECT 'price_above_quantity', count(*), count(*) FILTER (NOT coalesce(o_totalprice > q * 100, false)) FROM x UNION ALL SELECT 'some_line', count(*), count(*) FILTER (q IS NULL) FROM x)
  SELECT *, CASE WHEN n_rows = 0 THEN 'NO_DATA' WHEN n_failed = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM f"""


def linkage(spark: SparkSession, d: str) -> DataFrame:
    """Links of sources to targets: what resolves, what is shared, whether the id spaces are apart, and whether two formulas agree."""
    t = Tables(spark, d)
    links = t.cat().select("id", F.when(F.col("id") % 4 != 0, F.col("id") % 120).alias("link"), "ra", "dec")
    sep = lambda f: F.when(F.col("t_dec") > -900, f(F.col("ra"), F.col("dec"), F.col("t_ra"), F.col("t_dec")))
    return C.linkage_evidence(links, t.sky_targets(), "id", "link", "t_id", sep(separation_arcsec), sep(separation_by_cosines))


SQL["linkage"] = with_views("""WITH c AS (SELECT id, CASE WHEN id % 4 <> 0 THEN id % 120 END AS link FROM cat), g AS (SELECT t_id, count(*) AS n FROM c JOIN sky_targets ON link = t_id GROUP BY t_id)
  SELECT 'carriers' AS metric, count(*) AS value FROM c UNION ALL SELECT 'linked', count(link) FROM c UNION ALL SELECT 'resolved', count(*) FROM c WHERE link IN (SELECT t_id FROM sky_targets) UNION ALL SELECT 'unresolved', count(*) FROM c WHERE link NOT IN (SELECT t_id FROM sky_targets) UNION ALL SELECT 'targets_used', count(*) FROM g
  UNION ALL SELECT 'targets_shared', count(*) FROM g WHERE n > 1 UNION ALL SELECT 'targets_unused', count(*) FROM sky_targets WHERE t_id NOT IN (SELECT t_id FROM g) UNION ALL SELECT 'same_number', count(*) FROM c WHERE id = link UNION ALL SELECT 'ids_in_both_spaces', count(*) FROM c WHERE id IN (SELECT t_id FROM sky_targets)
  UNION ALL SELECT 'separations', count(*) FROM c JOIN sky_targets ON link = t_id WHERE t_dec > -900 UNION ALL SELECT 'formulas_differ', 0""", "cat", "sky_targets")  # fmt: skip


def modulus_sample(spark: SparkSession, d: str) -> DataFrame:
    """One event in sixteen by its persisted ordinal, summed up by type."""
    x = S.modulus_sample(Tables(spark, d).events, "event_id", 16, 3)
    return x.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.sum("user_id").alias("users"))


SQL["modulus_sample"] = "SELECT event_type, count(*) AS n, min(event_id) AS first, sum(user_id)::BIGINT AS users FROM events WHERE event_id % 16 = 3 GROUP BY event_type"


def sigma_fit(spark: SparkSession, d: str) -> DataFrame:
    """The fitted systematic floor on development rows, and the spreads just below and above it: they must lie around 1, or all below."""
    dev = _development(Tables(spark, d)).filter(center.is_development(F.col("split")))
    dev = cut(dev.select("delta_b", "sigma_a_b", "sigma_b_b"))  # fitted on, and looked at again
    floor = center.fit_floor(dev, "delta_b", "sigma_a_b", "sigma_b_b", 0.0, 2.0)
    near = center.spread_by_floor(dev, "delta_b", "sigma_a_b", "sigma_b_b", [max(0.0, floor - 1e-5), floor + 1e-5]).orderBy("floor")
    spread = near.agg(F.max("spread").alias("above"), F.min("spread").alias("below"))
    return spread.select(F.lit(round(floor, 4)).alias("floor"), (F.col("above") >= 1 - 1e-4).alias("reaches_1"), (F.col("below") <= 1 + 1e-4).alias("falls_to_1"))


#: The same floor by bisection over the grid of ten-thousandths: the last at which the spread is above 1.
SQL["sigma_fit"] = tension_sql(""", w AS (SELECT delta_b AS d, sigma_a_b ** 2 + sigma_b_b ** 2 AS s FROM t WHERE custkey % 5 < 3 AND delta_b IS NOT NULL AND sigma_a_b IS NOT NULL AND sigma_b_b IS NOT NULL),
  g0 AS (SELECT unnest(range(0, 21)) / 10.0::DOUBLE AS f), v0 AS (SELECT f, d / sqrt(s + f ** 2) AS v FROM w, g0), m0 AS (SELECT f, quantile_cont(v, 0.5) AS m FROM v0 GROUP BY f), s0 AS (SELECT v0.f, quantile_cont(abs(v - m), 0.5) * 1.4826 AS spread FROM v0 JOIN m0 USING (f) GROUP BY v0.f), b0 AS (SELECT coalesce(max(f) FILTER (spread > 1), -1) AS lo FROM s0),
  g1 AS (SELECT lo + unnest(range(0, 101)) / 1000.0::DOUBLE AS f FROM b0 WHERE lo >= 0), v1 AS (SELECT f, d / sqrt(s + f ** 2) AS v FROM w, g1), m1 AS (SELECT f, quantile_cont(v, 0.5) AS m FROM v1 GROUP BY f), s1 AS (SELECT v1.f, quantile_cont(abs(v - m), 0.5) * 1.4826 AS spread FROM v1 JOIN m1 USING (f) GROUP BY v1.f), b1 AS (SELECT max(f) FILTER (spread > 1) AS lo FROM s1),
  g2 AS (SELECT lo + unnest(range(0, 101)) / 100000.0::DOUBLE AS f FROM b1), v2 AS (SELECT f, d / sqrt(s + f ** 2) AS v FROM w, g2), m2 AS (SELECT f, quantile_cont(v, 0.5) AS m FROM v2 GROUP BY f), s2 AS (SELECT v2.f, quantile_cont(abs(v - m), 0.5) * 1.4826 AS spread FROM v2 JOIN m2 USING (f) GROUP BY v2.f)
  SELECT CASE WHEN (SELECT lo FROM b0) < 0 THEN 0.0 ELSE (SELECT round(max(f) FILTER (spread > 1), 4) FROM s2) END AS floor, (SELECT lo FROM b0) >= 0 AS reaches_1, true AS falls_to_1""")  # fmt: skip


def ratio_axes(spark: SparkSession, d: str) -> DataFrame:
    """Customers by two axes: the offset of the balance from its nation's mean, and how extreme it is within its segment."""
    c = Tables(spark, d).customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return rounded(O.extreme_axis("c_acctbal", ["c_mktsegment"], "extreme", O.offset_axis("c_acctbal", ["c_nationkey"], "offset", c)).select("c_custkey", "offset", "extreme"))


SQL["ratio_axes"] = "WITH x AS (SELECT c_custkey, c_acctbal, abs(c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_nationkey)) AS o, min(c_acctbal) OVER (PARTITION BY c_mktsegment) AS lo, max(c_acctbal) OVER (PARTITION BY c_mktsegment) AS hi FROM customer) SELECT c_custkey, round(o / avg(o) OVER (), 6) AS \"offset\", round(abs(2 * (c_acctbal - lo) / nullif(hi - lo, 0) - 1), 6) AS extreme FROM x"

QUERIES = {f.__name__: f for f in (reconcile_arrays, reconcile_typed, conformance, row_rules, linkage, modulus_sample, sigma_fit, ratio_axes)}
