"""Queries on profiling, checking, reconciling and digesting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import guarded_ratio, null_nan, r6, separation_by_cosines, separation_arcsec
from ..operators import checks as C
from ..operators import digest as D
from ..operators import normalise as N
from ..operators import outliers as O
from ..operators import profile as P
from ..operators import reconcile as R
from ..operators import sky
from ..operators.neighbours import nearest_in_features
from .tension_queries import rounded, scored_sample, tension_sql
from .views import Tables, with_views

SQL: dict[str, str] = {}

# ---- cleaning and profiling --------------------------------------------------


def sentinel_null(spark: SparkSession, d: str) -> DataFrame:
    x = N.clean(Tables(spark, d).dirty(), {"x": (-999.0, -99.9)}, {"code": (-999,)}, ["x"])
    return x.select("id", r6(null_nan(F.col("x"))).alias("x"), F.coalesce(F.isnan("x"), F.lit(False)).alias("was_nan"), F.coalesce("code", F.lit(-1)).alias("code"))


SQL["sentinel_null"] = with_views("SELECT id, CASE WHEN isfinite(x) AND NOT (abs(x + 999) <= 1e-8 + 1e-5 * 999 OR abs(x + 99.9) <= 1e-8 + 1e-5 * 99.9) THEN round(x, 6) + 0.0::DOUBLE END AS x, coalesce(isnan(x), false) AS was_nan, CASE WHEN code = -999 THEN -1 ELSE code END AS code FROM dirty", "dirty")


def guarded_ratio_query(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    bottom = F.when(F.col("p_partkey") % 10 == 0, 0.0).when(F.col("p_partkey") % 11 == 0, None).otherwise(F.col("p_size").cast("double"))
    return p.select("p_partkey", r6(guarded_ratio(F.col("p_retailprice"), bottom)).alias("ratio"))


SQL["guarded_ratio"] = "SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 OR p_partkey % 11 = 0 OR p_size = 0 THEN NULL ELSE round(p_retailprice / p_size, 6) END AS ratio FROM part"


def null_counts(spark: SparkSession, d: str) -> DataFrame:
    x = N.clean(Tables(spark, d).dirty(), {"x": (-999.0,)}, {"code": (-999,)})
    return rounded(P.null_counts(x, ["x", "code", "c_mktsegment"], {"x": [-999.0, -99.9]}))


SQL["null_counts"] = with_views("WITH y AS (SELECT CASE WHEN abs(x + 999) <= 1e-8 + 1e-5 * 999 THEN NULL ELSE x END AS x, nullif(code, -999) AS code, c_mktsegment FROM dirty) " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, round(avg(({c} IS NULL)::INT), 6) AS share, {s} AS n_sentinel FROM y" for c, s in (("x", "count(*) FILTER (x IN (-999.0, -99.9))"), ("code", "0::BIGINT"), ("c_mktsegment", "0::BIGINT"))), "dirty")


def candidate_sentinels(spark: SparkSession, d: str) -> DataFrame:
    x = Tables(spark, d).dirty().withColumn("y", F.when(F.col("id") % 30 == 0, 9999.0).otherwise(F.col("x")))
    return rounded(P.candidate_sentinels(x, ["x", "y"], [-99.0], least=20))


SQL["candidate_sentinels"] = with_views("""WITH l AS (SELECT 'x' AS c, x AS v FROM dirty UNION ALL SELECT 'y', CASE WHEN id % 30 = 0 THEN 9999.0 ELSE x END FROM dirty), t AS (SELECT c, count(*) FILTER (v IS NOT NULL AND NOT isnan(v)) AS n_valid FROM l GROUP BY c)
  SELECT l.c AS "column", v AS value, count(*) AS n, any_value(n_valid) AS n_valid FROM l JOIN t USING (c) WHERE isfinite(v) AND v = floor(v) AND regexp_full_match(abs(v)::DECIMAL(20, 0)::VARCHAR, '9{2,}') AND v <> -99 GROUP BY l.c, v HAVING count(*) >= 20 AND count(*) * 1000 >= any_value(n_valid)""", "dirty")  # fmt: skip

_PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem_profile(t: Tables) -> DataFrame:
    return P.profile_numeric(t.lineitem, _PROFILED)


def profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of lineitem and of the dirty balance, each row with its self-check."""
    t = Tables(spark, d)
    out = _lineitem_profile(t).unionByName(P.profile_numeric(t.dirty(), ["x"]))
    ok = F.col("n_null") + F.col("n_nan") + F.col("n_valid") == F.col("n_rows")
    return rounded(out.withColumn("consistent", ok & F.coalesce(F.col("n_1") >= F.col("n_2"), F.lit(True)) & F.coalesce(F.col("n_2") >= F.col("n_3"), F.lit(True)) & F.coalesce(F.col("lo") <= F.col("hi"), F.lit(True))))


def _profile_sql(c: str, source: str) -> str:
    tops = ", ".join(f"max(CASE WHEN rn = {i} THEN v END) AS top_{i}, max(CASE WHEN rn = {i} THEN n END) AS n_{i}" for i in (1, 2, 3))
    return f"""SELECT s.*, t.*, true AS consistent FROM (SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, count(*) FILTER (isnan({c})) AS n_nan, count(*) FILTER ({c} IS NOT NULL AND NOT isnan({c})) AS n_valid,
      round(min({c}) FILTER (isfinite({c})), 6) AS lo, round(max({c}) FILTER (isfinite({c})), 6) AS hi FROM {source}) s, (SELECT {tops} FROM (SELECT {c} AS v, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rn FROM {source} WHERE {c} IS NOT NULL AND NOT isnan({c}) GROUP BY {c})) t"""


SQL["profile_numeric"] = with_views(" UNION ALL ".join([_profile_sql(c, "lineitem") for c in _PROFILED] + [_profile_sql("x", "dirty")]), "dirty")


def profile_text(spark: SparkSession, d: str) -> DataFrame:
    return P.profile_text(Tables(spark, d).part, ["p_brand", "p_type", "p_name"])


SQL["profile_text"] = " UNION ALL ".join(f"""SELECT s.*, t.* FROM (SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, min(length({c}))::INT AS min_length, max(length({c}))::INT AS max_length FROM part) s,
  (SELECT {', '.join(f'max(CASE WHEN rn = {i} THEN v END) AS top_{i}, max(CASE WHEN rn = {i} THEN n END) AS n_{i}' for i in (1, 2, 3))} FROM (SELECT {c} AS v, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rn FROM part GROUP BY {c})) t""" for c in ("p_brand", "p_type", "p_name"))  # fmt: skip


def profile_array(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of the components: large ones count as 1, the others are rounded; some vectors are missing whole."""
    coarse = F.transform("embedding", lambda y: F.when(y.cast("double") > 0.05, 1.0).otherwise(F.round(y.cast("double"), 2)))
    return rounded(P.profile_array(Tables(spark, d).embeddings.select(F.when(F.col("vec_id") % 40 != 3, coarse).alias("e")), "e"))


_TOPS = ", ".join(f"max(CASE WHEN rn = {i} THEN v END) AS top_{i}, max(CASE WHEN rn = {i} THEN n END) AS n_{i}" for i in (1, 2, 3))
SQL["profile_array"] = f"""WITH x AS (SELECT CASE WHEN vec_id % 40 <> 3 THEN list_transform(embedding, lambda y: CASE WHEN y::DOUBLE > 0.05 THEN 1 ELSE round(y::DOUBLE, 2) END) END AS e FROM embeddings), l AS (SELECT unnest(range(len(e))) AS i, unnest(e)::DOUBLE + 0.0 AS v FROM x), z AS (SELECT count(*) FILTER (e IS NULL) AS n_absent FROM x),
  t AS (SELECT i, {_TOPS} FROM (SELECT i, v, count(*) AS n, row_number() OVER (PARTITION BY i ORDER BY count(*) DESC, v) AS rn FROM l GROUP BY i, v) GROUP BY i)
  SELECT l.i::INT AS index, count(*) + any_value(n_absent) AS n_rows, count(*) FILTER (v IS NULL) + any_value(n_absent) AS n_null, count(*) FILTER (isnan(v)) AS n_nan, count(*) FILTER (v IS NOT NULL AND NOT isnan(v)) AS n_valid, round(min(v), 6) + 0.0::DOUBLE AS lo, round(max(v), 6) + 0.0::DOUBLE AS hi, any_value(n_absent) AS n_absent,
  {', '.join(f'any_value(top_{i}) AS top_{i}, any_value(n_{i}) AS n_{i}' for i in (1, 2, 3))} FROM l JOIN t USING (i), z GROUP BY l.i"""  # fmt: skip


def array_shape(spark: SparkSession, d: str) -> DataFrame:
    x = Tables(spark, d).embeddings
    bad = F.when(F.col("vec_id") % 50 == 0, F.slice("embedding", 1, 10)).when(F.col("vec_id") % 51 == 0, F.concat(F.slice("embedding", 1, 63), F.array(F.lit(None).cast("float")))).otherwise(F.col("embedding"))
    return P.array_shape(x.select(bad.alias("e")), "e", 64)


SQL["array_shape"] = "WITH b AS (SELECT CASE WHEN vec_id % 50 = 0 THEN embedding[1:10] WHEN vec_id % 51 = 0 THEN list_append(embedding[1:63], NULL) ELSE embedding END AS e FROM embeddings) SELECT count(e) AS n_arrays, count(*) FILTER (e IS NULL) AS n_null, count(*) FILTER (len(e) <> 64) AS n_wrong_size, sum(len(e) - list_count(e))::BIGINT AS null_elements, 0::BIGINT AS sentinel_elements FROM b"


def col_select(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = N.select_by_name(t.lineitem, prefixes=["l_ext"], suffixes=["key", "_tax"])
    return out.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in out.columns]).select("n", *[F.round(f"sum_{c}", 2).alias(f"sum_{c}") for c in out.columns])


SQL["col_select"] = "SELECT count(*) AS n, " + ", ".join(f"round(sum({c}::DOUBLE), 2) AS sum_{c}" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax")) + " FROM lineitem"

# ---- reconciliation ----------------------------------------------------------
_COMPARED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def reconcile_unique(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return _ledger(R.reconcile(t.orders, t.orders_v2(), "o_orderkey", _COMPARED), "o_orderkey")


SQL["reconcile_unique"] = with_views("""WITH a AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_orderkey, count(*) AS n FROM orders_v2 GROUP BY 1)
  SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, '-' AS "column", -1::INT AS index, CASE WHEN b.n IS NULL THEN 'absent_in_target' WHEN a.n IS NULL THEN 'absent_in_source' ELSE 'multiplicity' END AS kind FROM a FULL JOIN b USING (o_orderkey) WHERE a.n IS NULL OR b.n IS NULL OR a.n > 1 OR b.n > 1
  """ + "".join(f" UNION ALL SELECT o_orderkey, '{c}', -1::INT, 'mismatch' FROM orders x JOIN orders_v2 y USING (o_orderkey) WHERE x.{c} IS DISTINCT FROM y.{c}" for c in _COMPARED), "orders_v2")  # fmt: skip


def _ledger(out: DataFrame, key: str) -> DataFrame:
    return out.select(key, F.coalesce("column", F.lit("-")).alias("column"), F.coalesce("index", F.lit(-1)).alias("index"), "kind")


def reconcile_tree(spark: SparkSession, d: str) -> DataFrame:
    """The ledger of reconcile_unique by a tree of digests, which compares cells only where these differ."""
    t = Tables(spark, d)
    return _ledger(R.tree_reconcile(t.orders, t.orders_v2(), "o_orderkey", _COMPARED, few=1000), "o_orderkey")


SQL["reconcile_tree"] = SQL["reconcile_unique"]

_LINE = ["l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]


def reconcile_repeated(spark: SparkSession, d: str) -> DataFrame:
    """Lines by their order, a key that mostly repeats: only orders of one line on both sides are compared."""
    t = Tables(spark, d)
    return _ledger(R.reconcile(t.lineitem, t.lineitem_v2(), "l_orderkey", _LINE), "l_orderkey")


SQL["reconcile_repeated"] = with_views("""WITH a AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey, count(*) AS n FROM lineitem_v2 GROUP BY 1), k AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.n, 0) AS s, coalesce(b.n, 0) AS t FROM a FULL JOIN b USING (l_orderkey))
  SELECT l_orderkey, '-' AS "column", -1::INT AS index, CASE WHEN t = 0 THEN 'absent_in_target' WHEN s = 0 THEN 'absent_in_source' ELSE 'multiplicity' END AS kind FROM k WHERE s <> 1 OR t <> 1
  """ + "".join(f" UNION ALL SELECT l_orderkey, '{c}', -1::INT, 'mismatch' FROM k JOIN lineitem x USING (l_orderkey) JOIN lineitem_v2 y USING (l_orderkey) WHERE s = 1 AND t = 1 AND x.{c} IS DISTINCT FROM y.{c}" for c in _LINE), "lineitem_v2")  # fmt: skip


def reconcile_multiset(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return R.multiset_difference(t.lineitem, t.lineitem_v2(), t.lineitem.columns)


SQL["reconcile_multiset"] = with_views("""WITH a AS (SELECT *, 1 AS ss, 0 AS tt FROM lineitem UNION ALL SELECT *, 0, 1 FROM lineitem_v2), n AS (SELECT sum(ss) AS s, sum(tt) AS t FROM a GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
  SELECT count(*) AS n_tuples, count(*) FILTER (s = t) AS n_equal, count(*) FILTER (s > t) AS n_more_in_source, count(*) FILTER (s < t) AS n_more_in_target, coalesce(sum(s - t) FILTER (s > t), 0)::BIGINT AS rows_more_in_source, coalesce(sum(t - s) FILTER (s < t), 0)::BIGINT AS rows_more_in_target FROM n""", "lineitem_v2")  # fmt: skip


def _holed(df: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return df.withColumn("o_totalprice", F.when(k % 17 == 0, None).when(k % 19 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")))


def table_equality(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return R.column_equality(t.orders, _holed(t.orders_v2()), "o_orderkey", _COMPARED)


SQL["table_equality"] = with_views("WITH h AS (SELECT * REPLACE (CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'nan'::DOUBLE ELSE o_totalprice END AS o_totalprice) FROM orders_v2) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_common, count(*) FILTER (x.{c} IS NOT DISTINCT FROM y.{c}) AS n_equal, count(*) FILTER ((x.{c} IS NULL) <> (y.{c} IS NULL)) AS n_null_mismatch, {'count(*) FILTER (isnan(y.o_totalprice))' if c == 'o_totalprice' else '0::BIGINT'} AS n_nan_mismatch,
    count(*) FILTER (x.{c} <> y.{c}{' AND NOT isnan(y.o_totalprice)' if c == 'o_totalprice' else ''}) AS n_value_mismatch FROM orders x JOIN h y USING (o_orderkey)""" for c in _COMPARED), "orders_v2")  # fmt: skip


def value_drift(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rounded(R.value_drift(t.orders, t.orders_v2(), "o_orderkey", "o_totalprice", "o_orderstatus"))


SQL["value_drift"] = with_views("WITH x AS (SELECT a.o_orderstatus, b.o_totalprice - a.o_totalprice AS d, (b.o_totalprice - a.o_totalprice) / abs(a.o_totalprice) AS r FROM orders a JOIN orders_v2 b USING (o_orderkey)) SELECT o_orderstatus, count(*) AS n_valid, count(*) FILTER (d = 0) AS n_exact, round(avg((d = 0)::INT), 6) AS match, " + ", ".join(f"round(quantile_cont(d, {m / 100}), 6) + 0.0::DOUBLE AS d_p{m}" for m in (1, 16, 50, 84, 99)) + ", round(quantile_cont(r, 0.5), 6) + 0.0::DOUBLE AS r_median, round(max(abs(r)), 6) AS r_max, round(avg((abs(r) > 0.001)::INT), 6) AS above_0, round(avg((abs(r) > 0.1)::INT), 6) AS above_1 FROM x GROUP BY o_orderstatus", "orders_v2")


def pair_compare(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    nudged = t.orders_v2().withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") * (1 + 1e-12)).otherwise(F.col("o_totalprice")))
    return R.compare_pairs(t.orders, nudged, "o_orderkey", "o_totalprice")


SQL["pair_compare"] = with_views("WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * (1 + 1e-12::DOUBLE) ELSE o_totalprice END AS b FROM orders_v2), x AS (SELECT o.o_orderkey AS l, n.o_orderkey AS r, o_totalprice AS a, b FROM orders o FULL JOIN n ON o.o_orderkey = n.o_orderkey) SELECT count(*) FILTER (l IS NOT NULL AND r IS NOT NULL) AS n_common, count(*) FILTER (r IS NULL) AS n_left_only, count(*) FILTER (l IS NULL) AS n_right_only, count(*) FILTER (a = b) AS n_exact, count(*) FILTER (abs(a - b) <= 1e-9::DOUBLE * greatest(abs(a), abs(b))) AS n_within FROM x", "orders_v2")


def id_space(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return R.id_space(t.orders, t.orders_v2(), "o_orderkey")


SQL["id_space"] = with_views("SELECT (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders_v2)) AS retained, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2)) AS dropped, (SELECT count(*) FROM orders_v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS added, (SELECT count(*) = 0 FROM orders_v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS new_is_subset", "orders_v2")


def agreement(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    inv = {"same_customer": F.col("p_o_custkey").eqNullSafe(F.col("r_o_custkey")), "same_price": F.col("p_o_totalprice").eqNullSafe(F.col("r_o_totalprice")), "price_within_2_percent": F.abs(F.col("p_o_totalprice") - F.col("r_o_totalprice")) <= 0.02 * F.col("p_o_totalprice")}
    return R.agreement(t.orders, t.orders_v2(), "o_orderkey", inv)


SQL["agreement"] = with_views("WITH x AS (SELECT p.o_orderkey AS a, r.o_orderkey AS b, p.o_custkey AS c1, r.o_custkey AS c2, p.o_totalprice AS t1, r.o_totalprice AS t2 FROM orders p FULL JOIN orders_v2 r ON p.o_orderkey = r.o_orderkey), i AS (SELECT * FROM x WHERE a IS NOT NULL AND b IS NOT NULL) SELECT 'present' AS invariant, count(*) AS n_failed FROM x WHERE a IS NULL OR b IS NULL UNION ALL SELECT 'same_customer', count(*) FROM i WHERE c1 <> c2 UNION ALL SELECT 'same_price', count(*) FROM i WHERE t1 <> t2 UNION ALL SELECT 'price_within_2_percent', count(*) FROM i WHERE abs(t1 - t2) > 0.02 * t1", "orders_v2")


def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    """Columns that changed between two versions, with the values that each held."""
    t = Tables(spark, d)
    old = R.schema_frame(t.orders)
    new = R.schema_frame(t.orders_v2().drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("int")).withColumn("o_note", F.lit("-")))
    held = t.orders.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("n_values")) for c in t.orders.columns]).alias("p")).select(F.inline("p"))
    out = R.schema_diff(old, new).join(held, "column", "left")
    return out.select("column", "status", F.coalesce("old_type", F.lit("-")).alias("old_type"), F.coalesce("new_type", F.lit("-")).alias("new_type"), F.coalesce("n_values", F.lit(0)).alias("n_values"))


SQL["schema_diff"] = "SELECT t.*, CASE WHEN old_type = '-' THEN 0 ELSE (SELECT count(*) FROM orders) END AS n_values FROM (VALUES ('o_orderkey', 'unchanged', 'bigint', 'bigint'), ('o_custkey', 'type_changed', 'bigint', 'int'), ('o_orderstatus', 'unchanged', 'string', 'string'), ('o_totalprice', 'unchanged', 'double', 'double'), ('o_orderdate', 'unchanged', 'timestamp_ntz', 'timestamp_ntz'), ('o_orderpriority', 'removed', 'string', '-'), ('o_note', 'added', '-', 'string')) t(\"column\", status, old_type, new_type)"


def manifest_diff(spark: SparkSession, d: str) -> DataFrame:
    """All files of the tables as they lie there, against a declaration that is wrong in every way: a hash, a size, a time, one file twice, one that is gone, one left out."""
    from ..sources.files import inventory

    seen = inventory(spark, d, "*.parquet")
    name = F.col("path")
    declared = seen.withColumns({
        "sha256": F.when(name == "nation.parquet", F.lit("0")).otherwise(F.col("sha256")),
        "bytes": F.when(name == "orders.parquet", F.col("bytes") + 1).otherwise(F.col("bytes")),
        "modified": F.when(name == "part.parquet", F.col("modified") - F.expr("INTERVAL 2 SECONDS")).otherwise(F.col("modified")),
    }).filter(name != "supplier.parquet")
    again = declared.filter(name == "region.parquet")
    return R.manifest_diff(declared.unionByName(again).unionByName(again.withColumn("path", F.lit("gone.parquet"))), seen)


SQL["manifest_diff"] = "SELECT * FROM (VALUES ('nation.parquet', 'hash_differs'), ('orders.parquet', 'size_differs'), ('part.parquet', 'time_differs'), ('supplier.parquet', 'extra'), ('region.parquet', 'duplicate_declared'), ('gone.parquet', 'missing')) t(path, diagnostic)"

# ---- checks ------------------------------------------------------------------


def orphans(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    stray = t.lineitem.withColumn("l_orderkey", F.when(F.col("l_quantity") == 50, F.col("l_orderkey") + 900_000_000).otherwise(F.col("l_orderkey")))
    return C.orphans(t.orders, stray, "o_orderkey", "l_orderkey")


SQL["orphans"] = "WITH l AS (SELECT CASE WHEN l_quantity = 50 THEN l_orderkey + 900000000 ELSE l_orderkey END AS l_orderkey FROM lineitem) SELECT 'left' AS direction, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM l) UNION ALL SELECT 'right', count(*), count(DISTINCT l_orderkey) FROM l WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"


def key_unique(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    a, b = C.key_unique(t.orders, "o_orderkey"), C.key_unique(t.lineitem, "l_orderkey", "l_linenumber")
    return a.withColumn("table", F.lit("orders")).unionByName(b.withColumn("table", F.lit("lineitem")))


SQL["key_unique"] = "SELECT 'orders' AS \"table\", count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)), count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"
_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def row_counts(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return C.row_counts({n: getattr(t, n) for n in _COUNTED})


SQL["row_counts"] = " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n FROM {n}" for n in _COUNTED)
_BOUNDS = {"l_quantity": (1, 50), "l_discount": (0, 0.05), "l_tax": (0, 0.08), "l_extendedprice": (0, 1e6)}


def range_checks(spark: SparkSession, d: str) -> DataFrame:
    return rounded(C.range_checks(Tables(spark, d).lineitem, _BOUNDS))


SQL["range_checks"] = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(min({c}), 6) AS lo, round(max({c}), 6) AS hi, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median, count(*) FILTER ({c} < {a} OR {c} > {b}) AS n_outside, CASE WHEN count(*) FILTER ({c} < {a} OR {c} > {b}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem" for c, (a, b) in _BOUNDS.items())


def expectations(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    metrics = C.row_counts({n: getattr(t, n) for n in ("region", "nation", "customer", "orders")}).select(F.col("table").alias("name"), F.col("n").cast("double").alias("observed"))
    prior = spark.createDataFrame([("region", 5.0), ("nation", 26.0), ("customer", 10.0), ("extra", 1.0)], "name string, prior double")
    return C.expectations(metrics, prior)


SQL["expectations"] = "WITH m AS (" + " UNION ALL ".join(f"SELECT '{n}' AS name, count(*)::DOUBLE AS observed FROM {n}" for n in ("region", "nation", "customer", "orders")) + "), p AS (SELECT * FROM (VALUES ('region', 5.0::DOUBLE), ('nation', 26.0), ('customer', 10.0), ('extra', 1.0)) v(name, prior)) SELECT name, prior, observed, CASE WHEN observed IS NULL THEN 'MISSING' WHEN prior IS NULL THEN 'INFO' WHEN observed = prior THEN 'PASS' WHEN abs(observed - prior) <= 0.05 * abs(prior) THEN 'WARN' ELSE 'FAIL' END AS status FROM m FULL JOIN p USING (name)"


def environment(spark: SparkSession, d: str) -> DataFrame:
    """Entities with the density around them (suppliers of the nation) and their memberships (orders by status)."""
    t = Tables(spark, d)
    around = t.supplier.withColumnRenamed("s_nationkey", "c_nationkey")
    out = C.surroundings(t.customer, "c_nationkey", around, "c_custkey", t.orders.withColumnRenamed("o_custkey", "c_custkey"), "o_orderstatus", "o_totalprice")
    return out.select("c_custkey", "density", "n_groups", r6(F.col("best")).alias("best"))


SQL["environment"] = "SELECT c_custkey, coalesce(d, 0) AS density, coalesce(g, 0) AS n_groups, round(best, 6) AS best FROM customer LEFT JOIN (SELECT s_nationkey, count(*) AS d FROM supplier GROUP BY 1) ON s_nationkey = c_nationkey LEFT JOIN (SELECT o_custkey, count(DISTINCT o_orderstatus) AS g, max(o_totalprice) AS best FROM orders GROUP BY 1) ON o_custkey = c_custkey"


def ordinal_check(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    a = C.ordinal_check(t.events, "event_id").withColumn("table", F.lit("events"))
    return a.unionByName(C.ordinal_check(t.orders_v2(), "o_orderkey").withColumn("table", F.lit("orders_v2")))


def _ordinal_sql(n: str, c: str) -> str:
    return f"SELECT '{n}' AS \"table\", count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct, min({c}) AS lo, max({c}) AS hi, count(*) FILTER ({c} IS NULL) AS n_null, count(*) = count(DISTINCT {c}) AND min({c}) = 0 AND max({c}) = count(*) - 1 AS ok FROM {n}"


SQL["ordinal_check"] = with_views(f"{_ordinal_sql('events', 'event_id')} UNION ALL {_ordinal_sql('orders_v2', 'o_orderkey')}", "orders_v2")


def ordinal_join(spark: SparkSession, d: str) -> DataFrame:
    """Row-aligned halves of events put together by their ordinal; the key has to agree as well."""
    e = Tables(spark, d).events
    left = e.select(F.col("event_id").alias("source_row"), F.col("user_id").alias("id"))
    right = e.select(F.col("event_id").alias("source_row"), F.when(F.col("event_id") % 200 == 7, F.col("user_id") + 1).otherwise(F.col("user_id")).alias("id2"), "value")
    x = N.join_aligned(left, right, "source_row", ["id2", "value"])
    return x.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") != F.col("id2")).alias("n_misaligned"), F.max("value").alias("hi"))


SQL["ordinal_join"] = "SELECT user_id AS id, count(*) AS n, count(*) FILTER (event_id % 200 = 7) AS n_misaligned, max(value) AS hi FROM events GROUP BY user_id"


def histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.histogram(Tables(spark, d).meas(), "z", 0.1))


SQL["histogram"] = with_views("SELECT floor(z / 0.1::DOUBLE)::BIGINT AS bin, count(*) AS n, round(floor(z / 0.1::DOUBLE) * 0.1, 6) + 0.0::DOUBLE AS low FROM meas WHERE isfinite(z) GROUP BY ALL", "meas")

def fidelity(spark: SparkSession, d: str) -> DataFrame:
    """Orders against its later version: structure, then the values of a shared sample."""
    t = Tables(spark, d)
    return R.fidelity(t.orders.withColumn("o_extra", F.lit(1)), t.orders_v2(), "o_orderkey", 1000, "seed-2")


SQL["fidelity"] = with_views("WITH k AS (SELECT o_orderkey FROM orders ORDER BY sha256('seed-2|' || o_orderkey::VARCHAR), o_orderkey LIMIT 1000), n AS (SELECT count(*) AS n FROM k JOIN orders x USING (o_orderkey) JOIN orders_v2 y USING (o_orderkey) WHERE x.o_totalprice <> y.o_totalprice) SELECT 'structure' AS \"check\", 'o_extra' AS \"column\", 1::BIGINT AS n_failed UNION ALL SELECT 'values', 'o_totalprice', n FROM n WHERE n > 0", "orders_v2")


def reconcile_sampled(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return R.ledger_totals(R.sampled_reconciliation(t.orders, t.orders_v2(), "o_orderkey", _COMPARED, 2000, "seed-3"))


SQL["reconcile_sampled"] = with_views("WITH k AS (SELECT o_orderkey FROM orders ORDER BY sha256('seed-3|' || o_orderkey::VARCHAR), o_orderkey LIMIT 2000), a AS (SELECT o_orderkey, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM k) GROUP BY 1), b AS (SELECT o_orderkey, count(*) AS n FROM orders_v2 WHERE o_orderkey IN (SELECT o_orderkey FROM k) GROUP BY 1), l AS (SELECT CASE WHEN b.n IS NULL THEN 'absent_in_target' WHEN a.n > 1 OR b.n > 1 THEN 'multiplicity' END AS kind, '-' AS c FROM a LEFT JOIN b USING (o_orderkey) " + "".join(f" UNION ALL SELECT 'mismatch', '{c}' FROM k JOIN orders x USING (o_orderkey) JOIN orders_v2 y USING (o_orderkey) WHERE x.{c} IS DISTINCT FROM y.{c}" for c in _COMPARED) + ") SELECT kind, c AS \"column\", count(*) AS n FROM l WHERE kind IS NOT NULL GROUP BY kind, c", "orders_v2")


def quality_suite(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    tables = {n: getattr(t, n) for n in ("customer", "orders", "nation", "region")}
    tables |= {"lineitem": t.lineitem.withColumn("l_tax", F.when(F.col("l_orderkey") % 9 != 0, F.col("l_tax"))), "dirty": t.dirty(), "est_a": t.est_a(), "cat": t.cat()}
    return rounded(C.quality_suite(tables, {
        "region": C.Expected(rows=6, columns=2), "nation": C.Expected(rows=25, columns=4, key="n_nationkey"),
        "orders": C.Expected(columns=6, key="o_orderkey", links=[("o_custkey", "customer", "c_custkey")], groups=["o_orderstatus"], units={"o_totalprice": (2.0, 7.0)}, rules={"dated": F.col("o_orderdate").isNotNull()}),
        "customer": C.Expected(links=[("c_nationkey", "nation", "n_nationkey")]),
        "lineitem": C.Expected(key="l_orderkey", bounds={"l_tax": (0, 0.05), "l_quantity": (1, 50)}, nulls={"l_tax": 0.0, "l_quantity": 0.0}, rules={"tax_below_discount": F.col("l_tax") <= F.col("l_discount")}, differences={("l_tax", "l_discount"): 0.01}, coverage={"returned": (F.col("l_returnflag") == "R", 0.2, 0.5)}),
        "dirty": C.Expected(sentinels={"x": [-999.0, -99.9], "code": [-998]}), "est_a": C.Expected(units={"log_a": (2.0, 7.0)}, differences={("l68", "u68"): 0.5}),
        "cat": C.Expected(bounds={"ra": (150, 151), "dec": (2, 2.5)}, coverage={"class": (F.col("class").isNotNull(), 0.999, 1.0)}, groups=["class"]),
    }))


SQL["quality_suite"] = with_views("""WITH l AS (SELECT * REPLACE (CASE WHEN l_orderkey % 9 <> 0 THEN l_tax END AS l_tax) FROM lineitem), x AS (
  SELECT 'rows' AS section, 'region' AS name, count(*)::DOUBLE AS observed, CASE WHEN count(*) = 6 THEN 'PASS' ELSE 'FAIL' END AS status FROM region UNION ALL SELECT 'rows', 'nation', count(*), CASE WHEN count(*) = 25 THEN 'PASS' ELSE 'FAIL' END FROM nation
  UNION ALL SELECT 'columns', * FROM (VALUES ('region', 2.0, 'PASS'), ('nation', 3.0, 'FAIL'), ('orders', 6.0, 'PASS')) v """ + "".join(f" UNION ALL SELECT 'rows', '{n}', count(*), 'INFO' FROM {f}" for n, f in (("orders", "orders"), ("customer", "customer"), ("lineitem", "l"), ("dirty", "dirty"), ("est_a", "est_a"), ("cat", "cat")))
  + "".join(f" UNION ALL SELECT 'key', '{n}.{c}', count(*) - count(DISTINCT {c}), CASE WHEN count(*) = count(DISTINCT {c}) THEN 'PASS' ELSE 'FAIL' END FROM {n}" for n, c in (("nation", "n_nationkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")))
  + "".join(f" UNION ALL SELECT '{s}', '{n}', count(*) FILTER ({bad}), CASE WHEN count(*) FILTER ({bad}) = 0 THEN 'PASS' ELSE 'FAIL' END FROM {f}" for s, n, bad, f in (
    ("link", "orders.o_custkey", "o_custkey NOT IN (SELECT c_custkey FROM customer)", "orders"), ("link", "customer.c_nationkey", "c_nationkey NOT IN (SELECT n_nationkey FROM nation)", "customer"), ("range", "lineitem.l_tax", "l_tax < 0 OR l_tax > 0.05", "l"), ("range", "lineitem.l_quantity", "l_quantity < 1 OR l_quantity > 50", "l"),
    ("range", "cat.ra", "ra < 150 OR ra > 151", "cat"), ("range", "cat.dec", "dec < 2 OR dec > 2.5", "cat"), ("sentinel", "dirty.x", "x IN (-999.0, -99.9)", "dirty"), ("sentinel", "dirty.code", "code = -998", "dirty"), ("rule", "orders.dated", "o_orderdate IS NULL", "orders"), ("rule", "lineitem.tax_below_discount", "NOT coalesce(l_tax <= l_discount, false)", "l")))
  + "".join(f" UNION ALL SELECT '{s}', '{n}', avg(({c})::INT), CASE WHEN avg(({c})::INT) BETWEEN {lo} AND {hi} THEN 'PASS' ELSE 'WARN' END FROM {f}" for s, n, c, lo, hi, f in (
    ("null", "lineitem.l_tax", "l_tax IS NULL", 0, 0, "l"), ("null", "lineitem.l_quantity", "l_quantity IS NULL", 0, 0, "l"), ("coverage", "lineitem.returned", "l_returnflag = 'R'", 0.2, 0.5, "l"), ("coverage", "cat.class", "class IS NOT NULL", 0.999, 1, "cat")))
  + "".join(f" UNION ALL SELECT '{s}', '{n}', quantile_cont({v}, 0.5), CASE WHEN quantile_cont({v}, 0.5) BETWEEN {lo} AND {hi} THEN 'PASS' ELSE '{bad}' END FROM {f}" for s, n, v, lo, hi, bad, f in (
    ("unit", "orders.o_totalprice", "o_totalprice", 2, 7, "FAIL", "orders"), ("unit", "est_a.log_a", "log_a", 2, 7, "FAIL", "est_a"), ("difference", "lineitem.l_tax-l_discount", "abs(l_tax - l_discount)", 0, 0.01, "WARN", "l"), ("difference", "est_a.l68-u68", "abs(l68 - u68)", 0, 0.5, "WARN", "est_a")))
  + """ UNION ALL SELECT 'distribution', 'orders.o_orderstatus=' || o_orderstatus, count(*), 'INFO' FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'distribution', 'cat.class=' || coalesce(class::VARCHAR, '-'), count(*), 'INFO' FROM cat GROUP BY class)
  SELECT section, name, round(observed, 6) AS observed, status FROM x""", "dirty", "est_a", "cat")  # fmt: skip


def head_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile of the first thousand events, with their values where they are few."""
    e = Tables(spark, d).events.withColumn("user_group", (F.col("user_id") % 4).cast("double"))
    out = P.head_profile(e, "event_id", 1000, ["value", "user_group"])
    return rounded(out.select("column", "n_rows", "n_null", "n_valid", "lo", "hi", "n_distinct", F.coalesce(F.array_join("values", ","), F.lit("-")).alias("few")))


SQL["head_profile"] = "WITH h AS (SELECT value, (user_id % 4)::DOUBLE AS user_group FROM events WHERE event_id < 1000) SELECT 'value' AS \"column\", count(*) AS n_rows, count(*) FILTER (value IS NULL) AS n_null, count(value) AS n_valid, round(min(value), 6) AS lo, round(max(value), 6) AS hi, count(DISTINCT value) AS n_distinct, '-' AS few FROM h UNION ALL SELECT 'user_group', count(*), count(*) FILTER (user_group IS NULL), count(user_group), min(user_group), max(user_group), count(DISTINCT user_group), string_agg(DISTINCT user_group::DECIMAL(10, 1)::VARCHAR, ',' ORDER BY user_group::DECIMAL(10, 1)::VARCHAR) FROM h"


# ---- sky ---------------------------------------------------------------------
_HAV = "degrees(2 * asin(least(1.0, sqrt(power(sin((radians({d2}) - radians({d1})) / 2), 2) + cos(radians({d1})) * cos(radians({d2})) * power(sin((radians({r2}) - radians({r1})) / 2), 2))))) * 3600"


def sky_sep(spark: SparkSession, d: str) -> DataFrame:
    """Separations of linked pairs, checked by a second formula."""
    t = Tables(spark, d)
    links = t.cat().select(F.col("id"), "ra", "dec", (F.col("id") % 120).alias("t_id"))
    pairs = links.join(t.sky_targets(), "t_id").filter(sky.valid_coordinates(F.col("t_ra"), F.col("t_dec")))
    sep, other = separation_arcsec(F.col("ra"), F.col("dec"), F.col("t_ra"), F.col("t_dec")), separation_by_cosines(F.col("ra"), F.col("dec"), F.col("t_ra"), F.col("t_dec"))
    x = pairs.select(sep.alias("sep"), other.alias("other"))
    checked = x.agg(F.count_if(F.abs(F.col("sep") - F.col("other")) > 0.01).alias("n_formulas_differ")).withColumn("k", F.lit(1))
    return rounded(C.separation_stats(x, F.col("sep")).withColumn("k", F.lit(1)).join(checked, "k").drop("k"))


SQL["sky_sep"] = with_views(f"WITH p AS (SELECT {_HAV.format(r1='ra', d1='dec', r2='t_ra', d2='t_dec')} AS sep FROM cat JOIN sky_targets ON t_id = id % 120 WHERE t_dec > -900) SELECT count(*) AS n, round(min(sep), 6) AS lo, round(quantile_cont(sep, 0.5), 6) AS median, round(quantile_cont(sep, 0.9), 6) AS p90, round(quantile_cont(sep, 0.99), 6) AS p99, round(max(sep), 6) AS hi, 0::BIGINT AS n_formulas_differ FROM p", "cat", "sky_targets")


def _nearest(t: Tables) -> DataFrame:
    entries = t.sky_targets().select(F.col("t_id").alias("e_id"), F.col("t_ra").alias("e_ra"), F.col("t_dec").alias("e_dec"))
    return sky.nearest(entries, t.cat().select(F.col("id").alias("t_id"), F.col("ra").alias("t_ra"), F.col("dec").alias("t_dec")))


def nearest(spark: SparkSession, d: str) -> DataFrame:
    """Every target's nearest source, and how the matches fall at three radii."""
    found = _nearest(Tables(spark, d)).withColumn("guess", F.col("e_id") * 3)
    classes = sky.match_classes(found, "guess", [30, 120, 1000])
    return rounded(found.select(F.lit("match").alias("kind"), "e_id", F.coalesce("t_id", F.lit(-1)).alias("t_id"), F.coalesce("sep", F.lit(-1.0)).alias("sep")).unionByName(classes.select(F.lit("other_within").alias("kind"), F.col("radius").cast("long").alias("e_id"), F.col("other").alias("t_id"), F.col("none").cast("double").alias("sep"))))


SQL["nearest"] = with_views(f"""WITH e AS (SELECT t_id AS e_id, t_ra AS e_ra, t_dec AS e_dec FROM sky_targets), x AS (SELECT e_id, id, {_HAV.format(r1='e_ra', d1='e_dec', r2='ra', d2='dec')} AS sep FROM e, cat WHERE e_dec > -900),
  b AS (SELECT e_id, min(sep) AS sep, arg_min(id, sep) AS t_id FROM x GROUP BY e_id), m AS (SELECT e.e_id, t_id, sep FROM e LEFT JOIN b USING (e_id))
  SELECT 'match' AS kind, e_id, coalesce(t_id, -1) AS t_id, round(coalesce(sep, -1), 6) AS sep FROM m UNION ALL SELECT 'other_within', r, count(*) FILTER (sep <= r AND t_id <> e_id * 3), count(*) FILTER (sep IS NULL OR sep > r) FROM m, (VALUES (30::BIGINT), (120), (1000)) v(r) GROUP BY r""", "cat", "sky_targets")  # fmt: skip

# ---- digests -----------------------------------------------------------------


def content_digest(spark: SparkSession, d: str) -> DataFrame:
    return D.content_digest(Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


def digest_sql(rows: str) -> str:
    """The digest of `rows`, a query for the column j: the canonical JSON of each row."""
    return f"""WITH h AS (SELECT sha256(j) AS h FROM ({rows})), x AS (SELECT h, ('0x' || h[1:15])::BIGINT AS x FROM h), a AS (SELECT h[1:6] AS p, sha256(string_agg(h, chr(10) ORDER BY h)) AS d FROM h GROUP BY ALL), b AS (SELECT p[1:3] AS p, sha256(string_agg(d, chr(10) ORDER BY p)) AS d FROM a GROUP BY ALL)
  SELECT (SELECT count(*) FROM h) AS n_rows, (SELECT sum(x)::VARCHAR FROM x) AS hash_sum, (SELECT bit_xor(x) FROM x) AS hash_xor, (SELECT sha256(string_agg(d, chr(10) ORDER BY p)) FROM b) AS sha256"""


_ORDER_JSON = """'{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '"}'"""
SQL["content_digest"] = digest_sql(f"SELECT {_ORDER_JSON} AS j FROM orders")


def snapshot_digest(spark: SparkSession, d: str) -> DataFrame:
    """The digest of a snapshot: declared columns only, one version of the table."""
    return D.content_digest(Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus"), seed="snapshot-1|")


SQL["snapshot_digest"] = digest_sql("""SELECT 'snapshot-1|{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS j FROM orders""")


def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_acctbal") < 0, F.lit("owes")).alias("c_note"))
    return c.select("c_custkey", D.canonical_json(c).alias("line")).repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")


SQL["canonical_json"] = "SELECT c_custkey, '{\"c_acctbal\":' || c_acctbal || ',\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\",\"c_note\":' || CASE WHEN c_acctbal < 0 THEN '\"owes\"' ELSE 'null' END || '}' AS line FROM customer"


def provenance(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    tables = {"nation": t.nation, "region": t.region, "orders": t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")}
    rows = D.provenance(tables, "testdata", "1")
    return rows.select("table", "source", "version", "n_rows", "sha256", F.col("loaded_at").isNotNull().alias("dated"))


SQL["provenance"] = "SELECT 'nation' AS \"table\", 'testdata' AS source, '1' AS version, n_rows, sha256, true AS dated FROM (" + digest_sql("""SELECT '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}' AS j FROM nation""") + ") UNION ALL SELECT 'region', 'testdata', '1', n_rows, sha256, true FROM (" + digest_sql("""SELECT '{"r_name":"' || r_name || '","r_regionkey":' || r_regionkey || '}' AS j FROM region""") + ") UNION ALL SELECT 'orders', 'testdata', '1', n_rows, sha256, true FROM (" + SQL["content_digest"] + ")"


# ---- scores ------------------------------------------------------------------
_AXES = ["s_width", "s_delta", "s_class", "s_density"]


def roadmap_scores(spark: SparkSession, d: str) -> DataFrame:
    """Per-axis ranks: interval width, disagreement, class against ratio, density around; high on three axes is consensus."""
    t = Tables(spark, d)
    density = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("density"))
    around = t.customer.join(density, "c_nationkey").select(F.col("c_custkey").alias("custkey"), "density")
    x = scored_sample(t).join(around, "custkey", "left")
    contradicts = F.when((F.col("class") == 0) & (F.col("q") < 50), F.col("chi")).otherwise(F.lit(0.0))
    x = x.select("id", F.round(F.col("u68") - F.col("l68"), 6).alias("s_width"), F.round(F.abs("delta_b"), 6).alias("s_delta"), contradicts.alias("s_class"), F.col("density").cast("double").alias("s_density"))
    return rounded(O.axis_ranks(x, _AXES, high=0.7, least=3))


SQL["roadmap_scores"] = tension_sql(", dn AS (SELECT c_nationkey, count(*) AS density FROM customer GROUP BY 1), ar AS (SELECT c_custkey, density FROM customer JOIN dn USING (c_nationkey)), x AS (SELECT id, round(u68 - l68, 6) AS s_width, round(abs(delta_b), 6) AS s_delta, CASE WHEN class = 0 AND q < 50 THEN chi ELSE 0.0 END AS s_class, density::DOUBLE AS s_density FROM t LEFT JOIN ar ON c_custkey = custkey), k AS (SELECT *, "
  + ", ".join(f"CASE WHEN {a} IS NOT NULL THEN percent_rank() OVER (ORDER BY {a} NULLS LAST) END AS rank_{a}" for a in _AXES) + " FROM x), n AS (SELECT *, " + " + ".join(f"(coalesce(rank_{a}, 0) > 0.7)::INT" for a in _AXES) + " AS n_high, sqrt(" + " + ".join(f"coalesce(rank_{a}, 0) ** 2" for a in _AXES) + ") AS magnitude FROM k) SELECT id, "
  + ", ".join(f"{a}, round(rank_{a}, 6) AS rank_{a}" for a in _AXES) + ", round(magnitude, 6) AS magnitude, n_high::INT AS n_high, n_high >= 3 AS consensus FROM n")


def iforest(spark: SparkSession, d: str) -> DataFrame:
    return rounded(O.isolation_scores(Tables(spark, d).embeddings, "vec_id", "embedding"))


SQL["iforest"] = O.forest_sql("embeddings", "vec_id", "embedding")


def knn(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest of all vectors, of every vector: the k-NN graph."""
    return rounded(nearest_in_features(Tables(spark, d).embeddings, "vec_id", "embedding"))


SQL["knn"] = """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), x AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.v, b.v) AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rank FROM x)
  SELECT vec_id, neighbour, round(distance, 6) AS distance, rank::INT AS rank FROM r WHERE rank <= 5"""


QUERIES = {f.__name__.removesuffix("_query"): f for f in (sentinel_null, guarded_ratio_query, null_counts, candidate_sentinels, profile_numeric, profile_text, profile_array, array_shape, col_select, reconcile_unique, reconcile_tree, reconcile_repeated, reconcile_multiset, table_equality, value_drift, pair_compare, id_space, agreement, schema_diff, manifest_diff, orphans, key_unique, row_counts, range_checks, expectations, environment, ordinal_check, ordinal_join, histogram, fidelity, reconcile_sampled, quality_suite, head_profile, sky_sep, nearest, content_digest, snapshot_digest, canonical_json, provenance, roadmap_scores, iforest, knn)}
