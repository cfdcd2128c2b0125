"""Mixing sources to target weights under a time-varying curriculum, natively in Spark SQL.

Sources in code-point order (null last) weigh 1, 2, 3, repeating.  They share
100 % of all words; a target stops at `most` times its source's size and the
excess goes to the others by weight, until none is above.  Documents of a
source are taken in hash order, whole passes first.  Each source's weight
schedule is integrated over training time, and a document's place in its
source's cumulative demand is inverted through that integral to its training
position; the table is range-sorted by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shuffle_partitions

WORD = r"[^\x20\x09-\x0D]+"
#: Relative weight at the start and at the end of training, for the sources of weight 1, 2, 3.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def running(rows: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Add `before_<name>`, the sum over all earlier rows, and `all_<name>`, over all rows, of each of `sums` (name: SQL expression).

    In two levels: inside ranges of the order, and over the ranges, of which
    there are as many as shuffle partitions.
    """
    rows = rows.withColumns({f"__{n}": F.expr(e) for n, e in sums.items()})
    placed = cut(rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).withColumn("__range", F.spark_partition_id()))
    totals = placed.groupBy(F.col("__range").alias("__r")).agg(*[F.sum(f"__{n}").alias(f"__t_{n}") for n in sums])
    up, every = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0)
    totals = totals.select("__r", *[x for n in sums for x in (F.coalesce(F.sum(f"__t_{n}").over(up), zero).alias(f"__b_{n}"), F.sum(f"__t_{n}").over(every).alias(f"all_{n}"))])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(F.broadcast(totals), F.col("__range") == F.col("__r"))
    out = out.withColumns({f"before_{n}": F.col(f"__b_{n}") + F.coalesce(F.sum(f"__{n}").over(inside), zero) for n in sums})
    return out.drop("__range", "__r", *[f"__{n}" for n in sums], *[f"__b_{n}" for n in sums])


def source_targets(sizes: DataFrame, most: float = 3.0) -> DataFrame:
    """src, source_size -> also rank, weight, target: one row for each source, of which there may be any number."""
    ranked = running(sizes.withColumn("none", F.col("src").isNull()), ["none", "src"], {"rank": "1L"}).withColumn("rank", F.col("before_rank") + 1)
    w = F.pmod(F.col("rank") - 1, F.lit(3)) + 1
    rows = ranked.select("src", "source_size", "rank", w.cast("double").alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("ceiling"))
    # filled in order of ceiling/weight: a source is at its ceiling if the level that the rest would get reaches it
    rows = running(rows.withColumn("share", F.col("ceiling") / F.col("weight")), ["share", "rank"], {"size": "source_size", "ceiling": "ceiling", "weight": "weight"})
    rows = rows.withColumn("level", (F.col("all_size") - F.col("before_ceiling")) / (F.col("all_weight") - F.col("before_weight"))).withColumn("full", F.col("share") <= F.col("level"))
    rows = cut(rows.select("src", "source_size", "rank", "weight", "ceiling", "level", "full"))
    level = rows.agg(F.max(F.when(~F.col("full"), F.col("level")))).first()[0]  # one number
    return rows.select("src", "source_size", "rank", "weight", F.when(F.col("full"), F.col("ceiling")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def training_position(share, start: list[float], end: list[float], kind):
    """Invert a linear schedule's integral: the time at which `share` of a source's demand is used up."""
    out = F.lit(None).cast("double")
    for k, (a, b) in enumerate(zip(start, end, strict=True)):
        mean = (a + b) / 2
        if a == b:
            at = share
        else:  # a t + (b - a) t^2 / 2 = mean share
            at = (F.sqrt(F.lit(a * a) + F.lit(2 * (b - a) * mean) * share) - F.lit(a)) / F.lit(b - a)
        out = F.when(kind == k, at).otherwise(out)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", most: float = 3.0, ramps=RAMPS, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, repeats, source, prefix, wanted, kind, and the columns `carry`, of every row.

    `taken` counts the words that the mix takes, repeats counted: whole passes
    over the source, and in the last, partial pass the documents in hash order;
    the one at the end gives only the words still wanted.  `repeats` is the
    number of whole texts (the last one counts from half of it on).  Null text
    has size 0; a null source is a source of its own; empty sources get 0.  The
    hash is that of the id, and of the text where there is none; rows of one
    hash go by id, then size, and those that agree in these take any order.
    Other columns are ignored, whatever their names; an empty table gives an
    empty table.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[source].cast("string").alias("src"), F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.md5(F.coalesce(docs[doc_id].cast("string"), docs[text], F.lit(""))).alias("hash"), *carry)
    rows = cut(rows.withColumn("part", F.substring("hash", 1, 5)))
    # the running sum over a source, in three levels: over 4096 hash parts of it, over 256 of each of these, and inside them
    parts = rows.groupBy("src", "part").agg(F.sum("size").alias("words")).withColumn("wide", F.substring("part", 1, 3))
    wide = cut(parts.groupBy("src", "wide").agg(F.sum("words").alias("words")))
    targets = source_targets(wide.groupBy("src").agg(F.sum("words").alias("source_size")), most)
    before = lambda window, order: F.coalesce(F.sum("words").over(window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wide = wide.select(F.col("src").alias("w_src"), F.col("wide").alias("w"), before(Window.partitionBy("src"), "wide").alias("before_wide"))
    parts = parts.withColumn("before", before(Window.partitionBy("src", "wide"), "part")).join(wide, F.col("src").eqNullSafe(F.col("w_src")) & (F.col("wide") == F.col("w")))
    parts = parts.select("src", "part", (F.col("before") + F.col("before_wide")).alias("before")).alias("p").join(targets.alias("t"), F.col("p.src").eqNullSafe(F.col("t.src")))
    parts = parts.select(F.coalesce("p.src", F.lit("")).alias("key"), F.col("p.src").isNull().alias("none"), F.col("p.part").alias("part"), "before", "source_size", "target", "rank")
    keyed = rows.withColumn("key", F.coalesce("src", F.lit(""))).withColumn("none", F.col("src").isNull())
    inside = Window.partitionBy("key", "none", "part").orderBy("hash", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.join(parts, ["key", "none", "part"]).withColumn("prefix", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    wanted = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0))
    out = out.withColumn("passes", passes).withColumn("wanted", wanted)
    rest = F.col("wanted") - F.col("passes") * F.col("source_size")
    out = out.withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("prefix"))))
    taken = (F.col("size") * F.col("passes") + F.col("more")).cast("long")
    repeats = (F.col("passes") + F.when((F.col("more") > 0) & (F.col("more") * 2 >= F.col("size")), 1).otherwise(0)).cast("long")
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), repeats.alias("repeats"), F.col("src").alias("source"), "prefix", "wanted", F.pmod(F.col("rank") - 1, F.lit(len(ramps))).alias("kind"), *carry)


def _position(plan: DataFrame, turn, ramps=RAMPS):
    """Training position of the given turn (0, 1, ...) of a document, from the middle of its stretch of the demand."""
    share = (turn * F.col("source_size") + F.col("prefix") + F.col("size") / 2) / F.greatest(F.col("wanted"), F.lit(1))
    return training_position(F.least(F.lit(1.0), share), [a for a, _ in ramps], [b for _, b in ramps], F.col("kind"))


def mix(docs: DataFrame, ramps=RAMPS, **names) -> DataFrame:
    """One row per document: what the mix takes of it, and the training position of its first turn (null: not taken)."""
    plan = plan_mix(docs, ramps=ramps, **names)
    at = F.when(F.col("taken") > 0, F.round(_position(plan, F.lit(0), ramps), 6))
    return plan.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "repeats", at.alias("position")).repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def mixed_documents(docs: DataFrame, ramps=RAMPS, doc_id: str = "doc_id", **names) -> DataFrame:
    """The documents as the mix wants them: each repeated `repeats` times, range-sorted by training position.

    Ids may be missing or occur several times: a row is known by its id, source
    and text, and rows that agree in these by their number among them.
    """
    text, source = (docs[names.get(c, c)] for c in ("text", "source"))
    row = F.md5(F.to_json(F.struct(docs[doc_id].cast("string").alias("i"), source.cast("string").alias("s"), F.md5(text).alias("t"))))
    keyed = docs.withColumn("__row", row)
    keyed = keyed.withColumn("__no", F.row_number().over(Window.partitionBy("__row").orderBy("__row")))
    plan = plan_mix(keyed, ramps=ramps, doc_id=doc_id, carry=("__row", "__no"), **names).filter("repeats > 0")
    turns = plan.withColumn("__turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1)))
    turns = turns.select(F.col("__row").alias("__of"), F.col("__no").alias("__nth"), _position(plan, F.col("__turn"), ramps).alias("__at"))
    out = keyed.join(turns, (F.col("__row") == F.col("__of")) & (F.col("__no") == F.col("__nth")))
    return out.repartitionByRange("__at", doc_id).sortWithinPartitions("__at", doc_id).select(*docs.columns)


#: The same in DuckDB, for the default names and ramps.
MIX_SQL = r"""
WITH d AS (SELECT doc_id, source AS src, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, text, '')) AS h FROM documents),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
r AS (SELECT *, row_number() OVER (ORDER BY src IS NULL, src) AS rank FROM s),
w AS (SELECT *, ((rank - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS ceiling FROM r),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY ceiling / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, CASE WHEN ceiling / weight <= level THEN ceiling ELSE weight * max(CASE WHEN ceiling / weight > level THEN level END) OVER () END AS target FROM l),
p AS (SELECT d.*, source_size, target, (rank - 1) % 3 AS kind, round(target)::BIGINT AS wanted,
      coalesce(sum(size) OVER (PARTITION BY d.src ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prefix
      FROM d JOIN t ON d.src IS NOT DISTINCT FROM t.src),
q AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS passes FROM p),
m AS (SELECT *, greatest(0, least(size, wanted - passes * source_size - prefix)) AS more,
      least(1.0::DOUBLE, (prefix + size::DOUBLE / 2) / greatest(wanted, 1)) AS u FROM q)
SELECT doc_id, size, source_size, round(target, 6) AS target, (size * passes + more)::BIGINT AS taken,
  (passes + CASE WHEN more > 0 AND more * 2 >= size THEN 1 ELSE 0 END)::BIGINT AS repeats,
  CASE WHEN size * passes + more > 0 THEN round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, CASE kind WHEN 0 THEN (sqrt(2.25::DOUBLE - 2 * u) - 1.5) / -1.0 WHEN 1 THEN u ELSE (sqrt(0.25::DOUBLE + 2 * u) - 0.5) / 1.0 END)), 6) END AS position
FROM m
"""
