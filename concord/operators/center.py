"""Expected disagreement (center) and systematic scatter, fitted on development rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import holds
from .checkpoints import cut
from .ranks import exact_percentiles

MAD_TO_SIGMA = 1.4826


@dataclass(frozen=True)
class Edges:
    """Bin edges of the two covariates, a dozen numbers."""

    x: tuple[float, ...]
    y: tuple[float, ...]


def quantile_edges(df: DataFrame, x: str, y: str, bins: tuple[int, int]) -> Edges:
    """Exact quantile edges of both covariates; equal edges are merged."""
    found = []
    for c, n in zip((x, y), bins, strict=True):
        row = exact_percentiles(df, F.col(c), {f"q{i}": i / n for i in range(n + 1)}).first()
        found.append(tuple(sorted({v for v in row if v is not None})))
    return Edges(*found)


def bin_no(c: Column, edges: Sequence[float]) -> Column:
    """Number of the bin [edge, next) that holds c; null outside."""
    out = F.lit(None).cast("int")
    for i, (low, high) in enumerate(pairwise(edges)):
        out = F.when((c >= low) & (c < high), i).otherwise(out)
    return out


def fit_center(df: DataFrame, delta: str, x: str, y: str, edges: Edges) -> DataFrame:
    """level (cell, x, global), xb, yb, n, value: medians of delta by cell, by x bin, and over all."""
    rows = df.select(delta, bin_no(F.col(x), edges.x).alias("xb"), bin_no(F.col(y), edges.y).alias("yb")).filter(F.col(delta).isNotNull())
    none, cell, line = F.lit(None).cast("int"), F.col("xb").isNotNull() & F.col("yb").isNotNull(), F.col("xb").isNotNull()
    level = lambda name, xb, yb: F.struct(F.lit(name).alias("level"), xb.alias("xb"), yb.alias("yb"))
    levels = F.array_compact(F.array(F.when(cell, level("cell", F.col("xb"), F.col("yb"))), F.when(line, level("x", F.col("xb"), none)), level("global", none, none)))
    long = rows.select(F.col(delta).alias("d"), F.inline(levels))
    by = ["level", "xb", "yb"]
    n = long.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    m = exact_percentiles(long, F.col("d"), {"value": 0.5}, by).select(*[F.col(c).alias(f"__{c}") for c in by], "value")
    same = F.col("level") == F.col("__level")
    return n.join(m, same & F.col("xb").eqNullSafe(F.col("__xb")) & F.col("yb").eqNullSafe(F.col("__yb"))).select(*by, "n", "value")


def apply_center(df: DataFrame, fit: DataFrame, x: str, y: str, edges: Edges, support: int = 200) -> DataFrame:
    """Add expected and center_support (cell, z_fallback, global_fallback, out_of_hull) to every row.

    A cell counts with `support` rows or more, else its x bin does under the
    same rule, else the value over all; rows with a covariate that is missing or
    outside the edges get the value over all and are out_of_hull.  The fit has
    a few dozen rows and is broadcast.
    """
    ok = fit.filter(F.col("n") >= support)
    cells = ok.filter("level = 'cell'").select("xb", "yb", F.col("value").alias("__cell"))
    lines = ok.filter("level = 'x'").select("xb", F.col("value").alias("__line"))
    whole = fit.filter("level = 'global'").select(F.lit(1).alias("__k"), F.col("value").alias("__all"))
    rows = df.withColumn("xb", bin_no(F.col(x), edges.x)).withColumn("yb", bin_no(F.col(y), edges.y)).withColumn("__k", F.lit(1))
    out = rows.join(F.broadcast(cells), ["xb", "yb"], "left").join(F.broadcast(lines), "xb", "left").join(F.broadcast(whole), "__k", "left")
    hull = F.col("xb").isNotNull() & F.col("yb").isNotNull()
    support_ = F.when(~hull, "out_of_hull").when(F.col("__cell").isNotNull(), "cell").when(F.col("__line").isNotNull(), "z_fallback").otherwise("global_fallback")
    expected = F.when(~hull, F.col("__all")).otherwise(F.coalesce("__cell", "__line", "__all"))
    return out.withColumn("expected", expected).withColumn("center_support", support_).drop("xb", "yb", "__k", "__cell", "__line", "__all")


def spread_by_floor(df: DataFrame, residual: str, sigma_a: str, sigma_b: str, candidates: Sequence[float]) -> DataFrame:
    """floor, spread: 1.4826 MAD of residual / sqrt(sigmas^2 + floor^2) for every candidate floor, all in one pass of rows."""
    return _spreads(_pulls(df, residual, sigma_a, sigma_b), candidates)


def _pulls(df: DataFrame, residual: str, sigma_a: str, sigma_b: str) -> DataFrame:
    """d, s: the residual and the sum of the squared sigmas of all rows that have them, written once for all candidates."""
    rows = df.filter(F.col(residual).isNotNull() & F.col(sigma_a).isNotNull() & F.col(sigma_b).isNotNull())
    return cut(rows.select(F.col(residual).alias("d"), (F.col(sigma_a) ** 2 + F.col(sigma_b) ** 2).alias("s")))


def _scaled(pulls: DataFrame, candidates: Sequence[float]) -> DataFrame:
    """floor, v: the residuals in units of their error with every candidate floor."""
    rows = pulls.select("d", "s", F.explode(F.array(*map(F.lit, candidates))).alias("floor"))
    return rows.select("floor", F.try_divide(F.col("d"), F.sqrt(F.col("s") + F.col("floor") ** 2)).alias("v"))


def _spreads(pulls: DataFrame, candidates: Sequence[float]) -> DataFrame:
    rows = _scaled(pulls, candidates)
    middle = exact_percentiles(rows, F.col("v"), {"m": 0.5}, ["floor"])
    away = exact_percentiles(rows.join(F.broadcast(middle), "floor"), F.abs(F.col("v") - F.col("m")), {"mad": 0.5}, ["floor"])
    return away.select("floor", (F.col("mad") * MAD_TO_SIGMA).alias("spread"))


def _above_one(pulls: DataFrame, candidates: Sequence[float]) -> set[float]:
    """The candidates at which the spread is above 1.

    A count of the deviations on either side of 1 tells on which side their
    median lies; where the two in its middle lie on different sides, they are
    the largest below and the smallest above.
    """
    rows = _scaled(pulls, candidates)
    middle = exact_percentiles(rows, F.col("v"), {"m": 0.5}, ["floor"])
    away = rows.join(F.broadcast(middle), "floor").select("floor", F.abs(F.col("v") - F.col("m")).alias("w")).filter("w is not null")
    over = F.col("w") * MAD_TO_SIGMA > 1
    sides = away.groupBy("floor").agg(F.count(F.lit(1)).alias("n"), F.count_if(~over).alias("below"), F.max(F.when(~over, F.col("w"))).alias("last"), F.min(F.when(over, F.col("w"))).alias("next"))
    pos = (F.col("n") - 1) * F.lit(0.5)
    k = F.floor(pos)
    low, high = (F.when(F.col("below") > at, F.col("last")).otherwise(F.col("next")) for at in (k, k + 1))
    mad = F.when(pos > k, low + (pos - k) * (high - low)).otherwise(low)
    return {r["floor"] for r in sides.filter(mad * MAD_TO_SIGMA > 1).select("floor").collect()}  # a row for each candidate at most


def fit_floor(df: DataFrame, residual: str, sigma_a: str, sigma_b: str, low: float = 0.0, high: float = 2.0, steps: int = 16, rounds: int = 5) -> float:
    """The systematic floor at which the spread is 1: a bracket on a grid, refined `rounds` times.

    The spread falls as the floor rises.  If it is below 1 already at `low`, that is the answer.
    All rounds read the same residuals and sigmas, which are computed once, and
    three floors of the grid at a time are looked at until two neighbours are left.
    """
    pulls = _pulls(df, residual, sigma_a, sigma_b)
    above = _above_one(pulls, [low, high])
    if not above:
        return low
    if high in above:
        return high
    for _ in range(rounds):
        grid = [low + (high - low) * i / steps for i in range(steps + 1)]
        first, last = 0, steps  # above 1, and not
        while last - first > 1:
            between = sorted({first + (last - first) * i // 4 for i in (1, 2, 3)} - {first})
            above = _above_one(pulls, [grid[i] for i in between])
            first = max([first, *(i for i in between if grid[i] in above)])
            last = min([last, *(i for i in between if i > first)])
        low, high = grid[first], grid[last]
    return (low + high) / 2


def refused_fits(training: DataFrame, splits: DataFrame, request: str = "request", key: str = "id", split: str = "split", forbidden: Sequence[str] = ("validation", "holdout")) -> DataFrame:
    """request, key, reason of everything that forbids a fit: rows of forbidden splits, keys in two splits, repeated rows."""
    held = training.select(request, key).distinct().join(splits.filter(F.col(split).isin(*forbidden)).select(request, key).distinct(), [request, key]).withColumn("reason", F.lit("held_out_row"))
    two = splits.groupBy(request, key).agg(F.count_distinct(split).alias("n")).filter("n > 1").select(request, key, F.lit("in_two_partitions").alias("reason"))
    again = training.groupBy(request, key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(request, key, F.lit("duplicate_training_row").alias("reason"))
    return held.unionByName(two).unionByName(again)


def is_development(split: Column) -> Column:
    return holds(split == "development")
