"""Views of the given tables that have the shape of catalogues: estimates, measurements, sources.

Each view exists twice, as a DataFrame and as SQL for the oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The tables of one folder, and the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def est_a(self) -> DataFrame:
        """First estimate: logarithmic, with a 68 % interval and a class."""
        log_a, i = F.log10("o_totalprice"), F.col("o_orderkey")
        kind = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "O", 2)
        return self.orders.select(i.alias("id"), log_a.alias("log_a"), (log_a - 0.05 - (i % 5) / 100).alias("l68"), (log_a + 0.05 + (i % 3) / 100).alias("u68"), kind.alias("class"), F.month("o_orderdate").cast("double").alias("month"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("custkey"))

    def est_b(self) -> DataFrame:
        """Second estimates: linear, with errors that are missing for single lines."""
        net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
        return self.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
            F.round(F.sum("l_extendedprice"), 2).alias("b"), F.round(F.stddev_samp("l_extendedprice"), 6).alias("b_err"), F.round(F.sum(net), 4).alias("b2"), F.round(F.stddev_samp(net), 6).alias("b2_err"),
            F.sum("l_quantity").alias("q"), F.round(F.avg("l_discount") * 100, 6).alias("chi"), F.count(F.lit(1)).alias("n"),
        )

    def meas(self) -> DataFrame:
        """Repeat measurements of entities, with flags, confidences and every kind of bad value."""
        i, flags = F.col("event_id"), {"signup": 0, "view": 2, "click": 3, "purchase": 4, "error": 13}
        flag, conf = F.lit(None).cast("long"), F.lit(None).cast("long")
        for (name, f), c in zip(flags.items(), (0, 80, 95, 97, 95), strict=True):
            flag = F.when(F.col("event_type") == name, F.lit(f).cast("long")).otherwise(flag)
            conf = F.when(F.col("event_type") == name, F.lit(c).cast("long")).otherwise(conf)
        z = F.floor(F.col("value") * 10 + 0.5) / 1000
        return self.events.select(
            i.alias("id"), F.when(i % 50 == 0, -999).when(i % 97 == 0, F.col("user_id") + 1_500_000).otherwise(F.col("user_id")).alias("ent"),
            F.when(i % 53 == 0, None).when(i % 59 == 0, F.lit(math.nan)).when(i % 61 == 0, -z).otherwise(z).alias("z"),
            flag.alias("flag"), F.when(i % 7 == 0, None).when(i % 11 == 0, -99).otherwise(conf).alias("conf"), F.when(i % 200 == 1, 1).otherwise(0).cast("long").alias("prio"),
        )

    def meas_unique(self) -> DataFrame:
        return self.meas().filter("prio = 1")

    def cat(self) -> DataFrame:
        """Sources: tile, class, magnitudes and a place on the sky."""
        i = F.col("c_custkey")
        mag = F.col("c_acctbal") / 300
        c = self.customer.join(self.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return c.select(
            i.alias("id"), F.when(i % 101 == 0, None).otherwise(F.col("n_name")).alias("tile"), F.when(i % 103 == 0, None).when(i % 107 == 0, 7).otherwise(i % 3).alias("class"),
            F.when(i % 89 == 0, None).when(i % 83 == 0, F.lit(math.nan)).otherwise(mag).alias("mag"), (mag + (i % 7) / 10).alias("mag2"),
            F.when(i % 13 == 0, None).otherwise(i % 2 == 0).alias("blend"), (150 + (i * 7919 % 1000) / 1000).alias("ra"), (2 + (i * 104729 % 997) / 1000).alias("dec"),
        )

    def sky_targets(self) -> DataFrame:
        i = F.col("s_suppkey")
        return self.supplier.select(i.alias("t_id"), (150 + (i * 6007 % 1000) / 1000).alias("t_ra"), F.when(i % 17 == 0, -999.0).otherwise(2 + (i * 8111 % 991) / 1000).alias("t_dec"))

    def orders_v2(self) -> DataFrame:
        """A later version of orders: changed, dropped and added rows."""
        o, k = self.orders, F.col("o_orderkey")
        changed = o.filter(k % 100 != 1).withColumn("o_totalprice", F.when(k % 10 == 0, F.round(F.col("o_totalprice") * 1.01, 4)).otherwise(F.col("o_totalprice")))
        added = o.filter(k < 5).withColumn("o_orderkey", k + 100_000_000)
        return changed.unionByName(added)

    def lineitem_v2(self) -> DataFrame:
        k = F.col("l_orderkey")
        return self.lineitem.filter(k % 500 != 0).withColumn("l_tax", F.when(k % 333 == 0, F.lit(0.99)).otherwise(F.col("l_tax")))

    def dirty(self) -> DataFrame:
        """Customers whose balance holds sentinels, -inf and NaN."""
        k, m = F.col("c_custkey"), F.col("c_custkey") % 20
        bad = F.when(m == 1, -999.0).when(m == 2, -99.9).when(m == 3, float("-inf")).when(m == 4, F.lit(math.nan)).otherwise(F.col("c_acctbal"))
        return self.customer.select(k.alias("id"), bad.alias("x"), F.when(k % 19 == 0, -999).otherwise(F.col("c_nationkey")).cast("int").alias("code"), "c_mktsegment")


def bare(sql: str) -> str:
    return " ".join(sql.split())


#: The views as SQL, by name; each may use those before it.
VIEWS = {
    "est_a": """SELECT o_orderkey AS id, log10(o_totalprice) AS log_a, log10(o_totalprice) - 0.05 - (o_orderkey % 5)::DOUBLE / 100 AS l68,
        log10(o_totalprice) + 0.05 + (o_orderkey % 3)::DOUBLE / 100 AS u68, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 WHEN 'O' THEN 2 END AS class,
        month(o_orderdate)::DOUBLE AS month, o_totalprice AS price, o_custkey AS custkey FROM orders""",
    "est_b": """SELECT l_orderkey AS id, round(sum(l_extendedprice), 2) AS b, round(stddev_samp(l_extendedprice), 6) AS b_err,
        round(sum(l_extendedprice * (1 - l_discount)), 4) AS b2, round(stddev_samp(l_extendedprice * (1 - l_discount)), 6) AS b2_err,
        sum(l_quantity) AS q, round(avg(l_discount) * 100, 6) AS chi, count(*) AS n FROM lineitem GROUP BY l_orderkey""",
    "meas": """SELECT event_id AS id, CASE WHEN event_id % 50 = 0 THEN -999 WHEN event_id % 97 = 0 THEN user_id + 1500000 ELSE user_id END AS ent,
        CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN 'nan'::DOUBLE WHEN event_id % 61 = 0 THEN -(floor(value * 10 + 0.5) / 1000) ELSE floor(value * 10 + 0.5) / 1000 END AS z,
        (CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 WHEN 'error' THEN 13 END)::BIGINT AS flag,
        (CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN -99 ELSE CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 80 WHEN 'click' THEN 95 WHEN 'purchase' THEN 97 WHEN 'error' THEN 95 END END)::BIGINT AS conf,
        (CASE WHEN event_id % 200 = 1 THEN 1 ELSE 0 END)::BIGINT AS prio FROM events""",
    "meas_unique": "SELECT * FROM meas WHERE prio = 1",
    "cat": """SELECT c_custkey AS id, CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE n_name END AS tile,
        CASE WHEN c_custkey % 103 = 0 THEN NULL WHEN c_custkey % 107 = 0 THEN 7 ELSE c_custkey % 3 END AS class,
        CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 83 = 0 THEN 'nan'::DOUBLE ELSE c_acctbal / 300 END AS mag, c_acctbal / 300 + (c_custkey % 7)::DOUBLE / 10 AS mag2,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 2 = 0 END AS blend,
        150 + (c_custkey * 7919 % 1000)::DOUBLE / 1000 AS ra, 2 + (c_custkey * 104729 % 997)::DOUBLE / 1000 AS dec
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "sky_targets": """SELECT s_suppkey AS t_id, 150 + (s_suppkey * 6007 % 1000)::DOUBLE / 1000 AS t_ra,
        CASE WHEN s_suppkey % 17 = 0 THEN -999.0 ELSE 2 + (s_suppkey * 8111 % 991)::DOUBLE / 1000 END AS t_dec FROM supplier""",
    "orders_v2": """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN round(o_totalprice * 1.01, 4) ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderkey % 100 <> 1 UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey < 5""",
    "lineitem_v2": "SELECT * REPLACE (CASE WHEN l_orderkey % 333 = 0 THEN 0.99 ELSE l_tax END AS l_tax) FROM lineitem WHERE l_orderkey % 500 <> 0",
    "dirty": """SELECT c_custkey AS id, CASE c_custkey % 20 WHEN 1 THEN -999.0 WHEN 2 THEN -99.9 WHEN 3 THEN '-inf'::DOUBLE WHEN 4 THEN 'nan'::DOUBLE ELSE c_acctbal END AS x,
        (CASE WHEN c_custkey % 19 = 0 THEN -999 ELSE c_nationkey END)::INT AS code, c_mktsegment FROM customer""",
}


def with_views(sql: str, *names: str) -> str:
    """SQL that defines the named views before the query; `sql` may begin with further definitions (WITH ...)."""
    head = ", ".join(f"{n} AS ({bare(VIEWS[n])})" for n in names)
    body = sql.strip()
    return f"WITH {head}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {head} {body}" if head else body
