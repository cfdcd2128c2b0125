"""Ranks and percentiles over whole tables without sorting them in one task.

A mergeable quantile sketch (KLL) says within a known error where a rank lies.
One pass over the table then counts exactly what lies below, and only values
near the wanted ranks leave the tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import every, some
from .checkpoints import cut

#: Items of a sketch (some 70 kB at most), and the ranks at which it is read.
SKETCH, GRID = 4096, 1024
#: Three times the rank error that a sketch of this size keeps with 99 %.
SLACK = 3 * 2.296 / SKETCH**0.9021
#: Values near the wanted ranks that one group may bring to a task.
MOST = 1 << 20
#: Groups whose bounds all go out with the tasks.
GROUPS = 10_000
BELOW, ABOVE = float("-inf"), float("nan")  # NaN is the largest number


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sketched(v: Column, steps: int = GRID) -> Column:
    """Approximate quantiles of v at 0, 1/steps, ..., 1 (an aggregate; null without values).  Sketches leave NaN out: it counts as infinite."""
    sketch = F.kll_sketch_agg_double(F.when(F.isnan(v), float("inf")).otherwise(v), F.lit(SKETCH))
    ranks = F.expr(f"array({', '.join(f'{i / steps:.12f}D' for i in range(steps + 1))})")  # as text: a thousand literals at once
    return F.when(F.count(v) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def _bracket(grid: Column, rank: Column, slack: float, low: Column, high: Column) -> tuple[Column, Column]:
    """Values of the grid between which the rank lies within the slack; the old bounds where the grid ends."""
    first, last = F.floor((rank - slack) * GRID).cast("int"), F.ceil((rank + slack) * GRID).cast("int")
    above = F.get(grid, last)
    return F.when(first < 0, low).otherwise(F.get(grid, first)), F.when((last > GRID) | (above == float("inf")), high).otherwise(above)


def _beside(rows: DataFrame, bounds: DataFrame, by: Sequence[str], few: bool = True) -> DataFrame:
    """The rows with their group's bounds; null groups are groups.

    Bounds go out with the tasks, so that rows stay where they are and a large
    group stays spread.  Where groups are not `few`, only bounds of those with
    more rows than one task should sort do, and the other rows are shuffled.
    """
    if not by:
        return rows.withColumn("__k", F.lit(1)).join(F.broadcast(bounds.withColumn("__k", F.lit(1))), "__k").drop("__k")  # one row
    named = bounds.withColumnsRenamed({b: f"__by_{b}" for b in by})
    same = every([F.col(b).eqNullSafe(F.col(f"__by_{b}")) for b in by])
    if few:
        out = rows.join(F.broadcast(named), same)
    else:
        large = F.broadcast(named.filter(F.col("__n") > MOST))
        out = rows.join(large, same).unionByName(rows.join(large, same, "left_anti").join(named.filter(F.col("__n") <= MOST), same))
    return out.drop(*[f"__by_{b}" for b in by])


def _narrowed(rows: DataFrame, bounds: DataFrame, shares: Sequence[float], by: Sequence[str], slack: float, few: bool = True) -> DataFrame:
    """Bounds from sketches of the values inside the old ones, whose rank is then known from a count of those below."""
    v, aggs = F.col("__v"), []
    for i in range(len(shares)):
        low, high = F.get("__low", F.lit(i)), F.get("__high", F.lit(i))
        inside = F.when((v >= low) & (v <= high), v)
        aggs += [F.count_if(v < low).alias(f"b{i}"), F.count(inside).alias(f"n{i}"), _sketched(inside).alias(f"g{i}")]
    found = _beside(rows, bounds, by, few).groupBy(*by, "__n", "__low", "__high").agg(*aggs)
    lows, highs = [], []
    for i, p in enumerate(shares):
        low, high, inner = F.get("__low", F.lit(i)), F.get("__high", F.lit(i)), (F.col("__n") - 1) * F.lit(p) - F.col(f"b{i}")
        there = (inner >= 0) & (inner <= F.col(f"n{i}") - 1) & (F.col(f"n{i}") > 4 / slack)
        new = _bracket(F.col(f"g{i}"), F.try_divide(inner, F.col(f"n{i}")), slack, low, high)
        lows.append(F.when(there, new[0]).otherwise(low))
        highs.append(F.when(there, new[1]).otherwise(high))
    return found.select(*by, "__n", F.array(*lows).alias("__low"), F.array(*highs).alias("__high"))


def _selected(rows: DataFrame, bounds: DataFrame, shares: Mapping[str, float], by: Sequence[str], few: bool = True) -> DataFrame:
    """by, __bounds, a column per share, __missed: of every share, the number of bounds below the gap in which its rank lies, if it lies outside the bounds.

    Values inside some bounds are counted one by one; the others only by the
    gap between bounds in which they lie, which few rows a task leave.
    """
    v, n = F.col("__v"), len(shares)
    low, high = ([F.get(c, F.lit(i)) for i in range(n)] for c in ("__low", "__high"))
    inside = some([(v >= a) & (v <= b) for a, b in zip(low, high, strict=True)])
    gap = sum([F.when(b < v, 1).otherwise(0) for b in high], F.lit(0))
    counts = _beside(rows, bounds, by, few).groupBy(*by, gap.alias("__g"), F.when(inside, v).alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
    counts = _beside(counts, bounds, by, few)
    before = Window.partitionBy(*by).orderBy("__g", F.col("__x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("__lo", F.coalesce(F.sum("__c").over(before), F.lit(0)))
    covers = lambda k: (F.col("__lo") <= k) & (k < F.col("__lo") + F.col("__c"))
    found, out, missed = [], [], []
    for i, p in enumerate(shares.values()):
        pos = (F.col("__n") - 1) * F.lit(float(p))
        k = F.floor(pos)
        lost = F.col("__x").isNull() & (covers(k) | ((pos > k) & covers(k + 1)))
        found += [F.max(F.when(covers(k), F.col("__x"))).alias(f"__l{i}"), F.max(F.when(covers(k + 1), F.col("__x"))).alias(f"__h{i}"), F.max(pos - k).alias(f"__f{i}"), F.max(F.when(lost, F.col("__g"))).alias(f"__m{i}")]
    picked = placed.groupBy(*by).agg(F.first(F.struct("__n", "__low", "__high")).alias("__bounds"), *found)
    for i, name in enumerate(shares):
        low, high, part = F.col(f"__l{i}"), F.col(f"__h{i}"), F.col(f"__f{i}")
        out.append(F.when(part > 0, low + part * (high - low)).otherwise(low).alias(name))
        missed.append(F.col(f"__m{i}"))
    return picked.select(*by, "__bounds", *out, F.array(*missed).alias("__missed"))


def _widened(missed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bounds of what has been missed: for each share the gap in which its rank is now known to lie (or the old bounds)."""
    low, high = F.col("__bounds.__low"), F.col("__bounds.__high")
    starts = F.transform("__missed", lambda g: F.when(g > 0, F.get(F.array_sort(high), g - 1)).when(g == 0, F.lit(BELOW)))
    start = lambda i, l: F.coalesce(F.get(starts, i), l)
    stop = lambda i, h: F.when(F.get(starts, i).isNull(), h).otherwise(F.coalesce(F.array_min(F.filter(low, lambda l: l > F.get(starts, i))), F.lit(ABOVE)))
    return missed.select(*by, F.col("__bounds.__n").alias("__n"), F.transform(low, lambda l, i: start(i, l)).alias("__low"), F.transform(high, lambda h, i: stop(i, h)).alias("__high"))


def exact_percentiles(df: DataFrame, value: Column, shares: Mapping[str, float], by: Sequence[str] = (), most: int = MOST, slack: float = SLACK) -> DataFrame:
    """Exact, interpolated percentiles (nulls left out), one column per name of `shares`, of the table or of each group.

    The built-in percentile holds all distinct values of a group in one task.
    Here a sketch brackets each wanted rank, and one more pass counts what lies
    between the brackets and keeps the values inside, from which the exact ones
    are picked.  Where so many rows lie inside that one task should not sort
    them, brackets are first narrowed by further sketches, some hundredfold
    each; a rank that a bracket has missed is looked for in the gap where the
    counts show it to be.  Each pass is a job; what is written is a few numbers
    for each group.  NaN is the largest value.  Groups without values are
    absent; without `by` there is one row in any case.
    """
    rows = df.select(*by, value.cast("double").alias("__v")).filter("__v is not null")
    parts = [*shares.values()]
    below, above = F.lit(BELOW), F.lit(ABOVE)
    first = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), _sketched(F.col("__v")).alias("__grid"))
    found = [_bracket(F.col("__grid"), F.lit(float(p)), slack, below, above) for p in parts]
    small = F.col("__n") <= 4 / slack if slack else F.lit(False)  # a position is then more than the slack
    bounds = cut(first.select(*by, "__n", F.array(*[F.when(small, below).otherwise(low) for low, _ in found]).alias("__low"), F.array(*[F.when(small, above).otherwise(high) for _, high in found]).alias("__high")))
    largest, groups = bounds.agg(F.max("__n"), F.count(F.lit(1))).first()
    largest, few, width, rounds = largest or 0, groups <= GROUPS, 2 * (slack + 1 / GRID), 0
    while len(parts) * largest * width ** (rounds + 1) > most and rounds < 8:
        rounds += 1
    done = None
    while True:
        for _ in range(rounds):
            bounds = cut(_narrowed(rows, bounds, parts, by, slack, few))
        picked = cut(_selected(rows, bounds, shares, by, few))
        missed = picked.filter(F.size(F.array_compact("__missed")) > 0)
        fine = picked.filter(F.size(F.array_compact("__missed")) == 0).select(*by, *shares)
        done = fine if done is None else done.unionByName(fine)
        if missed.isEmpty():
            return done
        bounds = _widened(missed, by)


def _between(v: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """2i below bounds[i] and above those before it, 2i + 1 at bounds[i]: a balanced tree of comparisons."""
    if not bounds:
        return F.lit(2 * first)
    mid = len(bounds) // 2
    at = F.lit(float(bounds[mid]))
    return F.when(v < at, _between(v, bounds[:mid], first)).when(v == at, 2 * (first + mid) + 1).otherwise(_between(v, bounds[mid + 1 :], first + mid + 1))


def percent_rank(df: DataFrame, value: str, into: str, ranges: int | None = None) -> DataFrame:
    """Add `into`: the share of rows that rank below the row's value (nulls rank last), as PERCENT_RANK over the whole table.

    A sketch names `ranges` values that part the table evenly; a count of the
    rows at and between them says how many precede each part.  Rows at one of
    these values (so every value that many rows share) and null ones have their
    rank from the counts; the others are ranked inside their part.  Rows are
    shuffled once, and no part is much larger than the others.
    """
    kind = df.schema[value].dataType
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{value} is no number")
    ranges = ranges or _partitions(df)
    v = F.col(value).cast("double")
    grid = df.agg(_sketched(v, ranges).alias("g")).first()["g"] or []
    exact = isinstance(kind, T.DoubleType | T.FloatType | T.IntegerType | T.ShortType | T.ByteType)  # its double says all
    bounds = [*sorted({x + 0.0 for x in grid if x < float("inf")}), *([float("inf"), float("nan")] if exact else [])]
    nulls = 2 * len(bounds) + 1
    part = F.when(v.isNull(), nulls).otherwise(_between(v, bounds))
    before, total = [0] * (nulls + 2), 0
    found = dict(df.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # two rows for each range
    for p in range(nulls + 1):
        before[p] = total
        total += found.get(p, 0)
    placed = df.withColumn("__part", part)
    level = (F.col("__part") == nulls) | ((F.col("__part") % 2 == 1) & F.lit(exact))
    spread = [c.name for c in df.schema.fields if not isinstance(c.dataType, T.MapType | T.VariantType)]
    placed = placed.withColumn("__at", F.get(F.array(*[F.lit(b).cast("long") for b in before]), F.col("__part"))).withColumn("__salt", F.when(level, F.pmod(F.xxhash64(*spread), F.lit(ranges))).otherwise(F.lit(0)))
    inside = F.rank().over(Window.partitionBy("__part", "__salt").orderBy(F.col(value).asc_nulls_last())) - 1
    below = F.col("__at") + F.when(level, F.lit(0)).otherwise(inside)
    return placed.withColumn(into, below / (total - 1) if total > 1 else F.lit(0.0)).drop("__part", "__at", "__salt")


def top(df: DataFrame, by: Column, key: str, k: int) -> DataFrame:
    """The k rows of the largest `by`; ties go by the key."""
    return df.orderBy(by.desc(), F.col(key).asc()).limit(k)
