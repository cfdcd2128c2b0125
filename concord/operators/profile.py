"""Column profiles: counts, extremes, most frequent values; sentinels; array shapes."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite, holds, sentinel_shaped
from .checkpoints import cut


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns])))


def _best(counts: DataFrame, by: Sequence[str], k: int = 3, keep_sum: bool = False) -> DataFrame:
    """top_1, n_1, ...: the values of the k largest counts n, ties by value; Spark keeps only k candidates of each task before it shuffles.
    With `keep_sum` also n_all, the sum of all counts."""
    pick = lambda rows: rows.groupBy(*by).agg(*[x for i in range(1, k + 1) for x in (F.max(F.when(F.col("rn") == i, F.col("value"))).alias(f"top_{i}"), F.max(F.when(F.col("rn") == i, F.col("n"))).alias(f"n_{i}"))])
    ranked = counts.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), F.asc("value")))).filter(F.col("rn") <= k)
    return pick(ranked).join(counts.groupBy(*by).agg(F.sum("n").alias("n_all")), [*by]) if keep_sum else pick(ranked)


def _top(values: DataFrame, by: Sequence[str], k: int = 3, keep_sum: bool = False) -> DataFrame:
    return _best(values.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n")), by, k, keep_sum)


#: Candidates for the most frequent values that a sketch names, and values that it keeps in sight of each column.
CANDIDATES, TRACKED = 16, 1000
#: Columns that one scan profiles: plans and the sketches of a task stay small; each scan reads its own columns.
BLOCK = 200


def _ceiling(n: int, candidates: Sequence[tuple[object, int]]) -> int:
    """The most rows that a value can have which is no candidate of a sketch over n rows.

    A sketch overstates no count by more than 3.5 n over its table's size, and
    leaves out what it cannot tell from nothing: at most twice that.
    """
    table = 1 << math.ceil(math.log2(TRACKED / 0.75))
    return max(math.floor(7 * n / table), candidates[-1][1] if len(candidates) == CANDIDATES else 0)


def _frequent(df: DataFrame, parts: Mapping[object, tuple[Column, int, Sequence[tuple[object, int]]]], key: str, k: int = 3) -> DataFrame:
    """key, top_1, n_1, ...: the k most frequent values of every part (its values, how many they are, a sketch's candidates and their counts).

    Only candidates are counted, so that little leaves a task.  They are proven
    to be the most frequent where the least of the k outnumbers what any other
    value can have, or where the candidates are all values there are.  Parts of
    which the sketch cannot promise that, or turns out not to hold it, are
    counted value by value.
    """
    few, other = {}, {}
    for name, (_, n, candidates) in parts.items():
        likely = len(candidates) < k or candidates[k - 1][1] > _ceiling(n, candidates)
        (few if likely else other)[name] = [v for v, _ in candidates] if likely else None

    def counted(chosen: Mapping[object, Sequence | None]) -> DataFrame:
        kept = lambda name: parts[name][0] if chosen[name] is None else F.when(parts[name][0].isin(*chosen[name]), parts[name][0])
        rows = df.select(F.inline(F.array(*[F.struct(F.lit(name).alias(key), kept(name).alias("value")) for name in chosen]))).filter("value is not null")
        return _top(rows, [key], k, keep_sum=True)

    found = cut(counted(few | other))
    by_name = {r[key]: r for r in found.select(key, "n_all", f"n_{k}").collect()}  # a row for each column
    open_ = {}
    for name in few:
        r, (_, n, candidates) = by_name.get(name), parts[name]
        if n and not (r and (r["n_all"] == n or (r[f"n_{k}"] or 0) > _ceiling(n, candidates))):
            open_[name] = None
    if open_:
        found = found.filter(~F.col(key).isin(*open_)).unionByName(cut(counted(open_)))
    return found.drop("n_all")


def _numeric(value: Column, present: Column | None = None) -> list[Column]:
    number = F.when(finite(value), value)
    rows, null = (F.count(F.lit(1)), F.count_if(value.isNull())) if present is None else (F.count_if(present), F.count_if(present & value.isNull()))
    return [rows.alias("n_rows"), null.alias("n_null"), F.count_if(holds(F.isnan(value))).alias("n_nan"), F.count_if(value.isNotNull() & ~F.isnan(value)).alias("n_valid"), (F.min(number) + 0.0).alias("lo"), (F.max(number) + 0.0).alias("hi")]


def _profiled(df: DataFrame, columns: Mapping[object, tuple[Column, Column | None]], key: str) -> DataFrame:
    """One row per part (its value, and whether it is there at all): _numeric of it and its most frequent values, in two scans for each BLOCK of parts."""
    out, names = None, [*columns]
    for at in range(0, len(names), BLOCK):
        part = {n: columns[n] for n in names[at : at + BLOCK]}
        plain = {n: F.when(~F.isnan(v.cast("double")), v.cast("double") + 0.0) for n, (v, _) in part.items()}
        sketch = lambda v: F.call_function("approx_top_k", v, F.lit(CANDIDATES), F.lit(TRACKED))
        stats = [F.struct(F.lit(n).alias(key), *_numeric(v.cast("double"), there), sketch(plain[n]).alias("candidates")) for n, (v, there) in part.items()]
        # a row for each column
        seen = cut(df.agg(F.array(*stats).alias("p")).select(F.inline("p")))
        facts = {r[key]: (r["n_valid"], [(c["item"], c["count"]) for c in r["candidates"] or []]) for r in seen.select(key, "n_valid", "candidates").collect()}
        top = _frequent(df, {n: (plain[n], *facts[n]) for n in part}, key)
        rows = seen.drop("candidates").join(F.broadcast(top), key, "left")
        out = rows if out is None else out.unionByName(rows)
    return out


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls, NaN, other values (infinities included), finite range, three most frequent values.  -0.0 counts as 0.0.

    Columns are profiled in two scans, which run at once: one wide aggregate
    with a sketch of frequent values, and an exact count of the sketch's
    candidates; what leaves the tasks does not grow with the rows, but for
    columns of which no value stands out.
    """
    return _profiled(df, {c: (F.col(c), None) for c in columns}, "column")


def profile_array(df: DataFrame, column: str) -> DataFrame:
    """One row per index of the array column, as profile_numeric has it for a column; a null array is a null at every index (n_absent of them)."""
    a = F.col(column)
    r = df.agg(F.max(F.size(a)).alias("longest"), F.count_if(a.isNull()).alias("n_absent")).first()
    found = _profiled(df, {i: (F.get(a, F.lit(i)), a.isNull() | (F.size(a) > i)) for i in range(max(r["longest"] or 0, 1))}, "index")
    return found.filter(F.lit((r["longest"] or 0) > 0)).withColumn("n_absent", F.lit(r["n_absent"]))


def profile_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per text (or boolean) column: rows, nulls, distinct values, lengths, three most frequent values."""
    # distinct values are counted exactly, and all the rest follows from their counts
    counts = _long(df, columns, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.groupBy("column").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"), F.count("value").alias("n_distinct"), F.min(F.length("value")).alias("min_length"), F.max(F.length("value")).alias("max_length"))
    return stats.join(_best(counts.filter("value is not null"), ["column"]), "column", "left")


def head_profile(df: DataFrame, ordinal: str, n: int, columns: Sequence[str], few: int = 20) -> DataFrame:
    """Profile of the first n rows by the persisted ordinal, with the distinct values of columns that have at most `few`."""
    head = df.filter(F.col(ordinal) < n)
    distinct = _long(head, columns, "string").distinct()
    counts = distinct.groupBy("column").agg(F.count("value").alias("n_distinct"))
    # values are gathered of columns only that have few
    sets = distinct.join(counts.filter(F.col("n_distinct") <= few).select("column"), "column", "left_semi").groupBy("column").agg(F.array_sort(F.collect_set("value")).alias("values"))
    return profile_numeric(head, columns).join(counts, "column").join(sets, "column", "left")


def profile_failures(profile: DataFrame) -> DataFrame:
    """One row: how many profile rows contradict themselves, by rule."""
    rules = {"counts": F.col("n_null") + F.col("n_nan") + F.col("n_valid") != F.col("n_rows"), "order": (F.col("n_1") < F.col("n_2")) | (F.col("n_2") < F.col("n_3")), "bound": F.col("n_1") > F.col("n_valid"), "range": F.col("lo") > F.col("hi")}
    return profile.agg(*[F.count_if(holds(c)).alias(f"bad_{n}") for n, c in rules.items()])


def candidate_sentinels(df: DataFrame, columns: Sequence[str], documented: Sequence[float] = (), least: int = 1000, share: int = 1000) -> DataFrame:
    """column, value, n of values of nines that occur `least` times and in one of `share` rows or more, and are not documented."""
    long = _long(df, columns, "double")
    total = long.groupBy("column").agg(F.count_if(F.col("value").isNotNull() & ~F.isnan("value")).alias("n_valid"))
    hits = long.filter(sentinel_shaped(F.col("value"))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    if documented:
        hits = hits.filter(~F.col("value").isin(*[float(x) for x in documented]))
    return hits.join(total, "column").filter((F.col("n") >= least) & (F.col("n") * share >= F.col("n_valid"))).select("column", "value", "n", "n_valid")


def null_counts(df: DataFrame, columns: Sequence[str], sentinels: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """column, n_null, share, n_sentinel (what is left of the listed sentinels), from one aggregate over the table."""
    parts = []
    for c in columns:
        left = F.count_if(F.col(c).isin(*(sentinels or {}).get(c, []))) if (sentinels or {}).get(c) else F.lit(0).cast("long")
        parts.append(F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_null"), F.coalesce(F.avg(F.col(c).isNull().cast("double")), F.lit(0.0)).alias("share"), left.alias("n_sentinel")))
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def array_shape(df: DataFrame, column: str, size: int, sentinels: Sequence[float] = ()) -> DataFrame:
    """One row: arrays, null arrays, arrays of another length, null elements, sentinel elements."""
    a = F.col(column)
    hits = F.size(F.filter(a, lambda x: x.isin(*sentinels))) if sentinels else F.lit(0)
    return df.agg(F.count(a).alias("n_arrays"), F.count_if(a.isNull()).alias("n_null"), F.count_if(holds(F.size(a) != size)).alias("n_wrong_size"), F.coalesce(F.sum(F.size(a) - F.size(F.array_compact(a))), F.lit(0)).alias("null_elements"), F.coalesce(F.sum(hits), F.lit(0)).cast("long").alias("sentinel_elements"))


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """bin (number), low, n of values in [bin * width, next); values that are not finite are left out."""
    b = F.floor(F.col(column) / width)
    return df.filter(finite(F.col(column))).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).withColumn("low", F.col("bin") * width)
