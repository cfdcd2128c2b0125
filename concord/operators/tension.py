"""Error-normalised disagreement (tension) between two estimates of one quantity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import LN10, every, guarded_ratio, holds
from .checkpoints import cut
from .ranks import exact_percentiles, top


@dataclass(frozen=True)
class Pair:
    """A logarithmic estimate with a 68 % interval, a linear one with an error, and the systematic floor of their scatter."""

    name: str
    log_a: str
    low: str
    high: str
    b: str
    b_err: str
    floor: float


def deltas(pair: Pair) -> dict[str, Column]:
    """delta = log A - log10 B; the two sigmas in the logarithm; T = delta / sqrt(sigmas^2 + floor^2).

    T and the linear estimate's sigma are null where its error is missing or not positive.
    """
    b, err = F.col(pair.b), F.col(pair.b_err)
    delta = F.when(b > 0, F.col(pair.log_a) - F.log10(b))
    s_a = (F.col(pair.high) - F.col(pair.low)) / 2
    s_b = F.when((err > 0) & (b > 0), F.try_divide(err, b * LN10))
    t = F.try_divide(delta, F.sqrt(s_a * s_a + s_b * s_b + F.lit(pair.floor * pair.floor)))
    return {f"delta_{pair.name}": delta, f"sigma_a_{pair.name}": s_a, f"sigma_b_{pair.name}": s_b, f"t_{pair.name}": t}


def with_tension(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    out = df
    for p in pairs:
        out = out.withColumns(deltas(p))
    return out


def plausible(df: DataFrame, gates: Mapping[str, Column]) -> DataFrame:
    """The rows that pass every gate; null counts as failing."""
    return df.filter(every(holds(g) for g in gates.values()))


def attrition(df: DataFrame, gates: Mapping[str, Column]) -> DataFrame:
    """stage, n, pct: what is left after each gate on top of those before it.  One pass over the table."""
    sums, so_far = [F.count(F.lit(1)).alias("s0")], F.lit(True)
    for i, gate in enumerate(gates.values(), 1):
        so_far = so_far & holds(gate)
        sums.append(F.count_if(so_far).alias(f"s{i}"))
    names = ["total", *gates]
    stages = F.array(*[F.struct(F.lit(i).alias("stage_no"), F.lit(n).alias("stage"), F.col(f"s{i}").alias("n")) for i, n in enumerate(names)])
    one = df.agg(*sums)
    return one.select("s0", F.inline(stages)).select("stage_no", "stage", "n", (F.coalesce(guarded_ratio(F.col("n"), F.col("s0")), F.lit(0.0)) * 100).alias("pct"))


def pull_stats(df: DataFrame, columns: Sequence[str], limits: Sequence[float] = (2, 3, 5)) -> DataFrame:
    """One row per column: count, mean, median, sample sd, range, tail shares, skewness and excess kurtosis.

    The moments have the sample standard deviation in the denominator; they
    take a second pass.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("scalar"), F.col(c).alias("v")) for c in columns]))).filter("v is not null")
    long = cut(long)  # two numbers a row, read three times
    tails = [F.avg(F.when(F.abs("v") > x, 1.0).otherwise(0.0)).alias(f"frac_gt_{x:g}") for x in limits]
    first = long.groupBy("scalar").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"), *tails)
    centred = guarded_ratio(F.col("v") - F.col("mean"), F.col("sd"))
    moments = long.join(F.broadcast(first.select("scalar", "mean", "sd")), "scalar").groupBy("scalar").agg(F.avg(F.pow(centred, F.lit(3.0))).alias("skewness"), (F.avg(F.pow(centred, F.lit(4.0))) - 3).alias("kurtosis"))
    return first.join(moments, "scalar").join(exact_percentiles(long, F.col("v"), {"median": 0.5}, ["scalar"]), "scalar")


def correlations(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row: Pearson's correlation of each pair over the rows where both are given."""
    return df.agg(*[F.corr(F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)).alias(name) for name, (a, b) in pairs.items()])


def abs_percentiles(df: DataFrame, column: str, shares: Sequence[float] = (0.5, 0.9, 0.95, 0.99), limits: Sequence[float] = (0.1, 0.3)) -> DataFrame:
    """One row: exact percentiles and maximum of |column|, and count and percentage above each limit."""
    a = F.abs(F.col(column))
    above = [x for i, t in enumerate(limits) for x in (F.count_if(a > t).alias(f"n_gt_{i}"), (F.avg(F.when(a > t, 1.0).when(a.isNotNull(), 0.0)) * 100).alias(f"pct_gt_{i}"))]
    counts = df.agg(F.count(column).alias("n"), F.max(a).alias("max_abs"), *above).withColumn("__k", F.lit(1))
    marks = exact_percentiles(df, a, {f"p{round(p * 100)}": p for p in shares}).withColumn("__k", F.lit(1))
    return counts.join(marks, "__k").drop("__k")


def boolean_grid(df: DataFrame, x: str, y: str, value: Column) -> DataFrame:
    """The four cells of two booleans, empty ones included: count, percentage of all rows, median of `value`."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in (True, False) for b in (True, False)], f"{x} boolean, {y} boolean")
    cells = df.groupBy(x, y).agg(F.count(F.lit(1)).alias("n")).join(exact_percentiles(df, value, {"median": 0.5}, [x, y]), [x, y], "left")
    total = df.agg(F.count(F.lit(1)).alias("total")).withColumn("__k", F.lit(1))
    out = F.broadcast(grid).join(cells, [x, y], "left").withColumn("__k", F.lit(1)).join(F.broadcast(total), "__k")
    n = F.coalesce("n", F.lit(0))
    return out.select(x, y, n.alias("n"), F.coalesce(guarded_ratio(n, F.col("total")) * 100, F.lit(0.0)).alias("pct"), "median")


def not_shared(df: DataFrame, a: str, b: str, key: str, k: int) -> DataFrame:
    """Keys among the top k of |a| that are not among the top k of |b|."""
    first = top(df.filter(F.col(a).isNotNull()).select(key, a), F.abs(a), key, k)
    second = top(df.filter(F.col(b).isNotNull()).select(key, b), F.abs(b), key, k)
    return first.join(second, key, "left_anti")
