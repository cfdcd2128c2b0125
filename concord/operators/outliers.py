"""Multi-axis scores, isolation forests."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checkpoints import cut
from .ranks import percent_rank


def axis_ranks(df: DataFrame, axes: Sequence[str], high: float = 0.9, least: int = 3) -> DataFrame:
    """Add rank_<axis> in [0, 1], magnitude (root sum of squared ranks), n_high and consensus (high on `least` axes or more)."""
    out = cut(df)  # every rank is worked out from the same rows
    for a in axes:
        out = percent_rank(out, a, f"__r_{a}").withColumn(f"rank_{a}", F.when(F.col(a).isNotNull(), F.col(f"__r_{a}"))).drop(f"__r_{a}")
    ranks = [F.coalesce(F.col(f"rank_{a}"), F.lit(0.0)) for a in axes]
    n_high = sum((F.when(r > high, 1).otherwise(0) for r in ranks[1:]), F.when(ranks[0] > high, 1).otherwise(0))
    total = sum((r * r for r in ranks[1:]), ranks[0] * ranks[0])
    return out.withColumn("magnitude", F.sqrt(total)).withColumn("n_high", n_high).withColumn("consensus", F.col("n_high") >= least)


def offset_axis(value: str, groups: Sequence[str], into: str, df: DataFrame) -> DataFrame:
    """Add `into`: how far the value lies from its group's mean, in units of the mean distance over all groups (0 in a group of one)."""
    middle = df.groupBy(*groups).agg(F.avg(value).alias("__mean"))
    out = df.join(middle, list(groups), "left").withColumn("__off", F.abs(F.col(value) - F.col("__mean")))
    scale = out.agg(F.avg("__off").alias("__scale")).withColumn("__k", F.lit(1))
    return out.withColumn("__k", F.lit(1)).join(scale, "__k").withColumn(into, F.try_divide("__off", "__scale")).drop("__k", "__mean", "__off", "__scale")


def extreme_axis(value: str, groups: Sequence[str], into: str, df: DataFrame) -> DataFrame:
    """Add `into`: 1 at the least and the largest value of the row's group, 0 in the middle between them; null in a group of one value."""
    span = df.groupBy(*groups).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    at = F.try_divide(F.col(value) - F.col("__lo"), F.col("__hi") - F.col("__lo"))
    return df.join(span, list(groups), "left").withColumn(into, F.abs(2 * at - 1)).drop("__lo", "__hi")


def _drawn(*parts: Column | str | int) -> Column:
    """Hex digits that depend on the parts alone."""
    return F.sha2(F.concat_ws("|", *[F.lit(p).cast("string") if not isinstance(p, Column) else p.cast("string") for p in parts]), 256)


def _share(digits: Column) -> Column:
    """A number in (0, 1) from the first eight hex digits."""
    return (F.conv(F.substring(digits, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)


def _expected(n: Column) -> Column:
    """Mean depth at which an unsuccessful search in a random tree of n rows ends."""
    return F.when(n < 2, F.lit(0.0)).when(n == 2, F.lit(1.0)).otherwise(2 * (F.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n)


def isolation_forest(rows: DataFrame, n: int, trees: int = 32, sample: int = 256, seed: int = 7) -> DataFrame:
    """tree, node, feature, cut_at, path: the inner nodes of an isolation forest, and its leaves with the mean depth of what ends there.

    `rows` are n of columns k, f (arrays of one length without nulls).  A tree
    is grown from the `sample` rows of the least hash of seed, tree and key.  A
    node's feature is that of the least hash of seed, tree, node and number
    among those that differ in the node, and its cut lies at a share of their
    range drawn likewise, so that the same rows give the same forest whatever
    order they come in.  All trees grow together, a level at a time, by an
    aggregate of ranges and a join of rows with their nodes; node i has the
    children 2i + 1 (below the cut) and 2i + 2.
    """
    depth = max(1, math.ceil(math.log2(max(2, min(sample, n)))))
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    picks = rows.withColumn("tree", tree).withColumn("h", _drawn(seed, F.col("tree"), F.col("k")))
    if 4 * sample < n:  # far more than enough for the least ones
        picks = picks.filter(_share(F.col("h")) < 4 * sample / n)
    nth = F.row_number().over(Window.partitionBy("tree").orderBy("h", "k", "f"))
    at = cut(picks.withColumn("n", nth).filter(F.col("n") <= sample).select("tree", F.lit(0).cast("long").alias("node"), "f"))
    forest = None
    for level in range(depth + 1):
        spans = at.select("tree", "node", F.posexplode("f").alias("feature", "v")).groupBy("tree", "node", "feature").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        order = F.when(F.col("hi") > F.col("lo"), _drawn(seed, F.col("tree"), F.col("node"), F.col("feature")))
        nodes = spans.groupBy("tree", "node").agg(F.max("n").alias("n"), F.min_by(F.struct("feature", "lo", "hi"), order).alias("s"))
        inner = F.col("s").isNotNull() & F.lit(level < depth)
        place = F.col("s.lo") + _share(_drawn(seed, F.col("tree"), F.col("node"), "cut")) * (F.col("s.hi") - F.col("s.lo"))
        nodes = cut(nodes.select("tree", "node", F.when(inner, F.col("s.feature")).alias("feature"), F.when(inner, place).alias("cut_at"), F.when(~inner, level + _expected(F.col("n"))).alias("path")))
        forest = nodes if forest is None else forest.unionByName(nodes)
        grown = nodes.filter("feature is not null").select("tree", "node", "feature", "cut_at")
        at = at.join(F.broadcast(grown), ["tree", "node"]).select("tree", (2 * F.col("node") + 1 + (F.get("f", F.col("feature")) >= F.col("cut_at")).cast("long")).alias("node"), "f")
    return forest


def isolation_scores(df: DataFrame, key: str, features: str, trees: int = 32, sample: int = 256, seed: int = 7) -> DataFrame:
    """key, score in (0, 1) of an isolation forest: the larger, the easier a row is set apart.

    All in built-in functions: the forest (at most 2 * trees * sample nodes) is
    a table, sent to all tasks as one row of arrays, and each row walks down its
    trees in one expression.  Rows without features, with a null or NaN among
    them, or with another number of them than the longest have the score null,
    and the forest is grown without them.
    """
    rows = df.select(F.col(key).alias("k"), F.col(features).cast("array<double>").alias("f"))
    whole = F.coalesce(F.forall("f", lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
    size = F.size("f")
    facts = rows.filter(whole).groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("size").desc()).first()
    if facts is None or not facts["size"]:
        return df.select(key, F.lit(None).cast("double").alias("score"))
    fit = whole & (size == facts["size"])
    forest = isolation_forest(rows.filter(fit), facts["n"], trees, sample, seed)
    last = 2 ** (max(1, math.ceil(math.log2(max(2, min(sample, facts["n"]))))) + 1) - 1
    flat = {t: ([-1] * last, [0.0] * last, [0.0] * last) for t in range(trees)}
    for r in forest.collect():  # bounded by the parameters
        for store, name in zip(flat[r["tree"]], ("feature", "cut_at", "path"), strict=True):
            if r[name] is not None:
                store[r["node"]] = r[name]
    one = df.sparkSession.createDataFrame([([*flat.values()],)], "forest array<struct<feature:array<int>,cut_at:array<double>,path:array<double>>>").withColumn("__k", F.lit(1))
    steps = F.array(*[F.lit(i) for i in range(last.bit_length() - 1)])

    def end(tree: Column) -> Column:
        below = lambda node: 2 * node + 1 + (F.get("f", F.get(tree["feature"], node)) >= F.get(tree["cut_at"], node)).cast("int")
        return F.aggregate(steps, F.lit(0), lambda node, _: F.when(F.get(tree["feature"], node) < 0, node).otherwise(below(node)))

    total = F.aggregate("forest", F.lit(0.0), lambda so_far, tree: so_far + F.get(tree["path"], end(tree)))
    scale = _expected(F.lit(float(min(sample, max(2, facts["n"])))))
    score = F.when(fit, F.pow(F.lit(2.0), -(total / trees) / scale))
    return rows.withColumn("__k", F.lit(1)).join(F.broadcast(one), "__k").select(F.col("k").alias(key), score.alias("score"))


def forest_sql(table: str, key: str, features: str, trees: int = 32, sample: int = 256, seed: int = 7, depth: int = 8) -> str:
    """The same in DuckDB, for tables of at least `sample` whole rows of one length (`depth` levels follow from `sample`)."""
    share = lambda h: f"(('0x' || substr({h}, 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE"
    expected = lambda n: f"(CASE WHEN {n} < 2 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + 0.5772156649::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n} END)"
    sql = [
        f"x AS MATERIALIZED (SELECT {key} AS k, {features}::DOUBLE[] AS f FROM {table} WHERE len(list_filter({features}, lambda y: y IS NOT NULL AND NOT isnan(y))) = len({features}))",
        f"a0 AS MATERIALIZED (SELECT tree, 0::BIGINT AS node, f FROM (SELECT t.tree, f, row_number() OVER (PARTITION BY t.tree ORDER BY sha256('{seed}|' || t.tree || '|' || k)) AS n FROM x, range({trees}) t(tree)) WHERE n <= {sample})",
    ]
    for level in range(depth + 1):
        inner = f"{str(level < depth).lower()} AND s IS NOT NULL"
        sql.append(f"l{level} AS (SELECT tree, node, unnest(range(len(f))) AS feature, unnest(f) AS v FROM a{level})")
        sql.append(f"s{level} AS (SELECT tree, node, feature, count(*) AS n, min(v) AS lo, max(v) AS hi FROM l{level} GROUP BY ALL)")
        sql.append(f"n{level} AS MATERIALIZED (SELECT tree, node, max(n) AS n, arg_min(struct_pack(feature := feature, lo := lo, hi := hi), sha256('{seed}|' || tree || '|' || node || '|' || feature)) FILTER (hi > lo) AS s FROM s{level} GROUP BY tree, node)")
        sql.append(f"f{level} AS MATERIALIZED (SELECT tree, node, CASE WHEN {inner} THEN s.feature END AS feature, s.lo + {share(f"sha256('{seed}|' || tree || '|' || node || '|cut')")} * (s.hi - s.lo) AS cut_at, {level} + {expected('n')} AS path FROM n{level})")
        if level < depth:
            sql.append(f"a{level + 1} AS MATERIALIZED (SELECT tree, 2 * node + 1 + (f[feature + 1] >= cut_at)::INT AS node, f FROM a{level} JOIN f{level} USING (tree, node) WHERE feature IS NOT NULL)")
    sql.append(f"w0 AS (SELECT k, f, tree, 0::BIGINT AS node FROM x, range({trees}) t(tree))")
    for level in range(depth + 1):
        sql.append(f"e{level} AS MATERIALIZED (SELECT k, f, tree, node, feature, cut_at, path FROM w{level} JOIN f{level} USING (tree, node))")
        sql.append(f"w{level + 1} AS (SELECT k, f, tree, 2 * node + 1 + (f[feature + 1] >= cut_at)::INT AS node FROM e{level} WHERE feature IS NOT NULL)")
    ends = " UNION ALL ".join(f"SELECT k, path FROM e{level} WHERE feature IS NULL" for level in range(depth + 1))
    return "WITH " + ",\n".join(sql) + f"\nSELECT {key}, score FROM {table} LEFT JOIN (SELECT k, round(pow(2, -(sum(path) / {trees}) / {expected(str(sample))}), 6) AS score FROM ({ends}) GROUP BY k) ON k = {key}"
