"""Keys, ordinals, orphans, ranges, expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import holds
from .ranks import exact_percentiles


class Violation(RuntimeError):
    """A check in strict mode found rows that it must not find."""


def strict(violations: DataFrame, what: str) -> None:
    """Raise if there is any row, naming the first one."""
    row = violations.take(1)
    if row:
        raise Violation(f"{what}: {row[0].asDict()}")


def key_unique(df: DataFrame, *key: str) -> DataFrame:
    """One row: rows, distinct keys, whether the key is unique."""
    out = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.struct(*key)).alias("n_keys"))
    return out.withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def ordinal_check(df: DataFrame, ordinal: str, base: int = 0) -> DataFrame:
    """One row: does the ordinal run from `base` to the number of rows without gap, repeat or null?"""
    out = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(ordinal).alias("n_distinct"), F.min(ordinal).alias("lo"), F.max(ordinal).alias("hi"), F.count_if(F.col(ordinal).isNull()).alias("n_null"))
    ok = (F.col("n_rows") == F.col("n_distinct")) & (F.col("lo") == base) & (F.col("hi") == F.col("n_rows") - 1 + base) & (F.col("n_null") == 0)
    return out.withColumn("ok", holds(ok) | (F.col("n_rows") == 0))


def orphans(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """direction, n_rows, n_keys of rows without a partner, both ways.  A null key has no partner."""
    a = left.join(right.select(F.col(right_key).alias(left_key)), left_key, "left_anti").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(left_key).alias("n_keys")).select(F.lit("left").alias("direction"), "n_rows", "n_keys")
    b = right.join(left.select(F.col(left_key).alias(right_key)), right_key, "left_anti").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(right_key).alias("n_keys")).select(F.lit("right").alias("direction"), "n_rows", "n_keys")
    return a.unionByName(b)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table, n of every table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), "n") for n, df in tables.items()])


def range_checks(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """column, lo, hi, mean, median, n_outside, status (PASS, FAIL, NO_DATA)."""
    parts = []
    for c, (low, high) in bounds.items():
        v = F.col(c).cast("double")
        outside = F.count_if(holds(~v.between(low, high)))
        status = F.when(F.count(v) == 0, "NO_DATA").when(outside == 0, "PASS").otherwise("FAIL")
        parts.append(F.struct(F.lit(c).alias("column"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), outside.alias("n_outside"), status.alias("status")))
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in bounds])))
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p")).join(exact_percentiles(long, F.col("v"), {"median": 0.5}, ["column"]), "column", "left")


def expectations(metrics: DataFrame, expected: DataFrame, warn: float = 0.05) -> DataFrame:
    """name, prior, observed, status: PASS if equal, WARN within the share `warn`, else FAIL; INFO without a prior, MISSING without an observation."""
    x = metrics.join(expected, "name", "full_outer")
    close = F.abs(F.col("observed") - F.col("prior")) <= warn * F.abs("prior")
    status = F.when(F.col("observed").isNull(), "MISSING").when(F.col("prior").isNull(), "INFO").when(F.col("observed") == F.col("prior"), "PASS").when(close, "WARN").otherwise("FAIL")
    return x.select("name", "prior", "observed", status.alias("status"))


def resolve(rows: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str], halt: bool = True) -> DataFrame:
    """Join the looked-up columns; with `halt`, a key that the lookup lacks raises."""
    if halt:
        strict(rows.select(key).filter(F.col(key).isNotNull()).join(lookup.select(key), key, "left_anti"), f"{key} not found")
    return rows.join(lookup.select(key, *columns), key, "left")


def separation_stats(df: DataFrame, sep: Column) -> DataFrame:
    """One row: n, min, median, p90, p99, max of the values given."""
    marks = exact_percentiles(df, sep, {"lo": 0.0, "median": 0.5, "p90": 0.9, "p99": 0.99, "hi": 1.0}).withColumn("__k", F.lit(1))
    return df.agg(F.count(sep).alias("n")).withColumn("__k", F.lit(1)).join(marks, "__k").drop("__k")


def row_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule, n_rows, n_failed, status of conditions across columns, from one aggregate; null is a failure."""
    parts = [F.struct(F.lit(n).alias("rule"), F.count(F.lit(1)).alias("n_rows"), F.count_if(~holds(c)).alias("n_failed")) for n, c in rules.items()]
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p")).withColumn("status", F.when(F.col("n_rows") == 0, "NO_DATA").when(F.col("n_failed") == 0, "PASS").otherwise("FAIL"))


def sums_to(columns: Sequence[str], total: float, tolerance: float = 1e-6) -> Column:
    """Do the columns (class probabilities, shares) sum to `total`?"""
    return F.abs(reduce(Column.__add__, [F.col(c) for c in columns]) - total) <= tolerance


def linkage_evidence(carriers: DataFrame, targets: DataFrame, carrier: str, link: str, target: str, sep: Column, other: Column, tolerance: float = 0.01) -> DataFrame:
    """metric, value: how the links from `carriers` (columns `carrier`, `link`) to `targets` (column `target`) stand.

    Counts of carriers, linked ones, links that resolve and that do not, targets
    used, used by several carriers, and unused; of links whose two ids are the
    same number, and carriers whose id names some target (the id spaces must be
    kept apart); and of resolved pairs that have a separation, and where a
    second formula (`other`) departs from it by more than the tolerance.
    """
    named = carriers.groupBy(F.col(link).alias("__t")).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(carrier) == F.col(link)).alias("__same"))
    ids = targets.select(F.col(target).alias("__t")).distinct().withColumn("__here", F.lit(True))
    x = named.filter("__t is not null").join(ids, "__t", "full_outer")
    used, here = F.col("__n").isNotNull(), F.col("__here").isNotNull()
    n = F.coalesce("__n", F.lit(0))
    counts = x.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("linked"), F.coalesce(F.sum(F.when(here, n)), F.lit(0)).alias("resolved"), F.coalesce(F.sum(F.when(~here, n)), F.lit(0)).alias("unresolved"), F.count_if(used & here).alias("targets_used"),
        F.count_if(here & (n > 1)).alias("targets_shared"), F.count_if(~used).alias("targets_unused"), F.coalesce(F.sum("__same"), F.lit(0)).alias("same_number"),
    )
    total = carriers.agg(F.count(F.lit(1)).alias("carriers"))
    clash = carriers.select(F.col(carrier).alias("__t")).join(ids, "__t", "left_semi").agg(F.count(F.lit(1)).alias("ids_in_both_spaces"))
    pairs = carriers.join(targets, carriers[link] == targets[target]).select(sep.alias("__s"), other.alias("__o"))
    geometry = pairs.agg(F.count("__s").alias("separations"), F.count_if(holds(F.abs(F.col("__s") - F.col("__o")) > tolerance)).alias("formulas_differ"))
    rows = [part.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in part.columns]))) for part in (total, counts, clash, geometry)]
    return reduce(DataFrame.unionByName, rows)


def surroundings(entities: DataFrame, cell: str, around: DataFrame, key: str, members: DataFrame, group: str, value: str) -> DataFrame:
    """Entities with density (rows of `around` in their cell), n_groups (distinct groups they are members of) and best (largest member value).

    `members` has the entities' key.  Both tables are aggregated before they are joined; entities without any get 0 and null.
    """
    density = around.groupBy(cell).agg(F.count(F.lit(1)).alias("density"))
    groups = members.groupBy(key).agg(F.count_distinct(group).alias("n_groups"), F.max(value).alias("best"))
    out = entities.join(density, cell, "left").join(groups, key, "left")
    return out.withColumns({"density": F.coalesce("density", F.lit(0)), "n_groups": F.coalesce("n_groups", F.lit(0))})


@dataclass(frozen=True)
class Expected:
    """What a table of a catalogue must be like; every part may be left out.

    rows, columns: counts.  key: the unique column.  links: (column, parent
    table, parent column).  bounds: allowed ranges.  nulls: columns and the
    largest share of nulls.  sentinels: values that must be gone.  units: ranges
    for a column's median, which tell a logarithmic column from a linear one.
    rules: conditions on rows.  groups: columns whose distribution is listed.
    coverage: conditions and the range of the share of rows that must meet them.
    differences: (column, column) and the largest median of their difference.
    """

    rows: int | None = None
    columns: int | None = None
    key: str | None = None
    links: Sequence[tuple[str, str, str]] = ()
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    nulls: Mapping[str, float] = field(default_factory=dict)
    sentinels: Mapping[str, Sequence[float]] = field(default_factory=dict)
    units: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    rules: Mapping[str, Column] = field(default_factory=dict)
    groups: Sequence[str] = ()
    coverage: Mapping[str, tuple[Column, float, float]] = field(default_factory=dict)
    differences: Mapping[tuple[str, str], float] = field(default_factory=dict)


def quality_suite(tables: Mapping[str, DataFrame], expected: Mapping[str, Expected]) -> DataFrame:
    """section, name, observed, status (PASS, WARN, FAIL, INFO) of a whole catalogue in one frame.

    Sections: rows, columns, range, null, sentinel, rule, coverage (these from
    one aggregate over each table), key, link, unit, distribution, difference.
    """
    parts = []
    for t, e in expected.items():
        df, checks = tables[t], []
        if e.columns is not None:
            checks.append(("columns", t, F.lit(float(len(df.columns))), F.lit("PASS" if len(df.columns) == e.columns else "FAIL")))
        n = F.count(F.lit(1)).cast("double")
        checks.append(("rows", t, n, F.lit("INFO") if e.rows is None else F.when(n == e.rows, "PASS").otherwise("FAIL")))
        failing = [("range", f"{t}.{c}", F.count_if(holds(~F.col(c).cast("double").between(*b)))) for c, b in e.bounds.items()]
        failing += [("sentinel", f"{t}.{c}", F.count_if(F.col(c).isin(*v))) for c, v in e.sentinels.items()]
        failing += [("rule", f"{t}.{name}", F.count_if(~holds(c))) for name, c in e.rules.items()]
        checks += [(s, name, k.cast("double"), F.when(k == 0, "PASS").otherwise("FAIL")) for s, name, k in failing]
        share = lambda c: F.coalesce(F.avg(holds(c).cast("double")), F.lit(0.0))
        checks += [("null", f"{t}.{c}", share(F.col(c).isNull()), F.when(share(F.col(c).isNull()) <= most, "PASS").otherwise("WARN")) for c, most in e.nulls.items()]
        checks += [("coverage", f"{t}.{name}", share(c), F.when(share(c).between(low, high), "PASS").otherwise("WARN")) for name, (c, low, high) in e.coverage.items()]
        parts.append(df.agg(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(name).alias("name"), v.alias("observed"), status.alias("status")) for s, name, v, status in checks]).alias("p")).select(F.inline("p")))
        one = lambda frame, section, name, observed, status: frame.select(F.lit(section).alias("section"), name.alias("name"), observed.cast("double").alias("observed"), status.alias("status"))
        if e.key:
            parts.append(one(key_unique(df, e.key), "key", F.lit(f"{t}.{e.key}"), F.col("n_rows") - F.col("n_keys"), F.when(F.col("is_unique"), "PASS").otherwise("FAIL")))
        for c, parent, pc in e.links:
            lost = df.filter(F.col(c).isNotNull()).join(tables[parent].select(F.col(pc).alias(c)), c, "left_anti").agg(F.count(F.lit(1)).alias("n"))
            parts.append(one(lost, "link", F.lit(f"{t}.{c}"), F.col("n"), F.when(F.col("n") == 0, "PASS").otherwise("FAIL")))
        for c in e.groups:
            counts = df.groupBy(F.coalesce(F.col(c).cast("string"), F.lit("-")).alias("g")).agg(F.count(F.lit(1)).alias("n"))
            parts.append(one(counts, "distribution", F.concat(F.lit(f"{t}.{c}="), "g"), F.col("n"), F.lit("INFO")))
        medians = [("unit", c, F.col(c).cast("double"), low, high, "FAIL") for c, (low, high) in e.units.items()]
        medians += [("difference", f"{a}-{b}", F.abs(F.col(a) - F.col(b)), 0.0, most, "WARN") for (a, b), most in e.differences.items()]
        if medians:
            rows = df.select(F.inline(F.array(*[F.struct(F.lit(f"{s}:{name}").alias("m"), v.alias("v")) for s, name, v, *_ in medians])))
            middle = exact_percentiles(rows, F.col("v"), {"median": 0.5}, ["m"])
            for s, name, _, low, high, bad in medians:
                parts.append(one(middle.filter(F.col("m") == f"{s}:{name}"), s, F.lit(f"{t}.{name}"), F.col("median"), F.when(F.col("median").between(low, high), "PASS").otherwise(bad)))
    return reduce(DataFrame.unionByName, parts)
