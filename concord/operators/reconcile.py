"""Is one table equal to another?  Keyed, as multisets, by schema, by distribution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import every, finite, holds, some
from .ranks import exact_percentiles


def same(a: Column, b: Column, kind: T.DataType | None = None) -> Column:
    """Equal, null and NaN included; 0.0 and -0.0 differ."""
    if isinstance(kind, T.DoubleType | T.FloatType):
        return a.eqNullSafe(b) & F.when(holds(a == 0), a.cast("string") == b.cast("string")).otherwise(F.lit(True))
    return a.eqNullSafe(b)


def _beside(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    s = source.select(key, *[F.col(c).alias(f"s_{c}") for c in columns], F.lit(True).alias("in_s"))
    t = target.select(key, *[F.col(c).alias(f"t_{c}") for c in columns], F.lit(True).alias("in_t"))
    return s.join(t, key, "full_outer").withColumns({"in_s": F.col("in_s").isNotNull(), "in_t": F.col("in_t").isNotNull()})


def _typed(source: DataFrame, columns: Sequence[str], declared: Mapping[str, str] | None) -> tuple[dict[str, Column], dict[str, Column], dict[str, T.DataType]]:
    """(value, fault of the cast, type) of the columns of the source, cast to the declared types."""
    values, faults, kinds = {c: F.col(c) for c in columns}, {}, {c: source.schema[c].dataType for c in columns}
    for c, target in (declared or {}).items():
        if c in values:
            values[c], faults[c] = exact_cast(F.col(c), source.schema[c].dataType, target)
    typed = source.select([v.alias(c) for c, v in values.items()]).schema if columns else T.StructType()
    return values, faults, kinds | {f.name: f.dataType for f in typed.fields}


def reconcile(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], declared: Mapping[str, str] | None = None) -> DataFrame:
    """key, column, index, kind of everything that differs: the ledger of a keyed comparison.

    Kinds: absent_in_target, absent_in_source, multiplicity (the key occurs
    several times on a side; nothing else of it is compared), mismatch (of a
    column, with no index: also of an array that is null on one side or has
    another length; of an element of arrays of one length, with its index).
    With `declared` types, the source's values are first cast to them exactly;
    those that do not fit are of kind cast, and are not compared.  A null key
    is a key.

    Both tables are gathered by key in one aggregation, which keeps one row of
    either side and counts the others: a key that repeats any number of times
    shrinks before the shuffle, and its rows never meet.
    """
    values, faults, kinds = _typed(source, columns, declared)
    cells = [F.struct(*[v.alias(f"c{i}") for i, v in enumerate(values.values())], *[faults[c].alias(f"f{i}") for i, c in enumerate(values) if c in faults], F.lit(1).alias("one"))]
    s = source.select(key, cells[0].alias("__s")).withColumn("__t", F.lit(None))
    t = target.select(key, F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.lit(1).alias("one")).alias("__t")).withColumn("__s", F.lit(None))
    rows = s.unionByName(t).groupBy(key).agg(F.count("__s").alias("__in_s"), F.count("__t").alias("__in_t"), F.first("__s", True).alias("__s"), F.first("__t", True).alias("__t"))
    in_s, in_t = F.col("__in_s"), F.col("__in_t")
    none = F.lit(None).cast("int")
    entry = lambda column, kind: F.array(F.struct(column.cast("string").alias("column"), none.alias("index"), kind.alias("kind")))
    whole = F.when(in_t == 0, "absent_in_target").when(in_s == 0, "absent_in_source").otherwise("multiplicity")
    found = [entry(F.lit(None), F.lit(None).cast("string"))]
    for i, c in enumerate(columns):
        fault = F.col(f"__s.f{i}") if c in faults else None
        hit = _cell_differences(c, F.col(f"__s.c{i}"), F.col(f"__t.c{i}"), kinds[c])
        found.append(hit if fault is None else F.when(fault, entry(F.lit(c), F.lit("cast"))).otherwise(hit))
    ledger = F.when((in_s == 1) & (in_t == 1), F.flatten(F.array_compact(F.array(*found)))).otherwise(entry(F.lit(None), whole))
    return rows.select(key, F.inline(ledger)).filter("kind is not null").select(key, "column", "index", "kind")


def _marks(c: Column, kind: T.DataType) -> list[Column]:
    """What to hash of a cell, so that cells that differ by `same` hash differently: hashes skip nulls and know no sign of zero."""
    sign = lambda x: F.when(holds(x == 0), x.cast("string"))
    floating = T.DoubleType | T.FloatType
    if isinstance(kind, T.ArrayType):
        return [c.isNull(), F.size(c), F.transform(c, lambda e: F.struct(e.isNull().alias("n"), e.alias("e"), *([sign(e).alias("s")] if isinstance(kind.elementType, floating) else [])))]
    return [c.isNull(), c, *([sign(c)] if isinstance(kind, floating) else [])]


def _digests(df: DataFrame, position: Column, marks: Sequence[Column], low: int, width: int) -> DataFrame:
    """leaf, n, sum_1, sum_2: how many rows lie in each leaf of the key space, and two order-free sums of their hashes."""
    whole_number = lambda x: x.cast("decimal(38,0)")  # noqa: E731  # differences of longs need not be longs
    leaf = F.call_function("div", whole_number(position) - whole_number(F.lit(low)), whole_number(F.lit(width)))
    whole = lambda seed: F.sum(F.xxhash64(F.lit(seed), *marks).cast("decimal(38,0)"))
    return df.groupBy(leaf.alias("leaf")).agg(F.count(F.lit(1)).alias("n"), whole(1).alias("sum_1"), whole(2).alias("sum_2"))


#: Leaves into which a level of the tree parts what is left to compare, and rows that are compared cell by cell without going down further.
FANOUT, FEW_ROWS = 1024, 1 << 20
#: Ranges of keys that a filter names one by one; further ones are merged with their neighbours.
MOST_RANGES = 64


class Differences(NamedTuple):
    """Ranges [low, high) of the positions of keys, and rows without a key, that hold everything in which two tables differ."""

    ranges: list[tuple[int, int]]
    nulls: bool


def differences(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], declared: Mapping[str, str] | None = None, fanout: int = FANOUT, few: int = FEW_ROWS) -> Differences | None:
    """Where two tables differ; no range and no nulls prove them equal, as multisets of rows.

    A tree over the keys, compared top down: each level parts the ranges still
    in question into leaves, sums up hashes of the rows in each leaf of either
    table, and keeps the leaves whose digests differ; the next level reads
    those alone.  It ends when few rows are left, or where most of what was
    compared differs.  Whole-number keys are their own positions, so that
    filters on them reach the files; other keys are placed by their hash.  None
    if columns have unlike types on the two sides, which hashes cannot compare.
    """
    values, faults, kinds = _typed(source, columns, declared)
    other = {c: target.schema[c].dataType for c in columns}
    if any(kinds[c].simpleString() != other[c].simpleString() for c in columns) or source.schema[key].dataType != target.schema[key].dataType:
        return None
    position = _position(source, key)
    rest = lambda table: [F.col(key), F.col(key).isNull(), *[x for c in columns for x in _marks(table[c], kinds[c])]]
    of_s = [*rest(values), *[F.coalesce(faults[c], F.lit(False)) for c in faults]]
    of_t = [*rest({c: F.col(c) for c in columns}), *[F.lit(False) for _ in faults]]
    ends = [x for df in (source, target) for x in df.agg(F.min(position), F.max(position)).first() if x is not None]
    ranges, nulls, inside = [(min(ends, default=0), max(ends, default=0) + 1)], False, F.lit(True)
    while True:
        low, high = ranges[0][0], ranges[-1][1]
        width = max(1, -(-sum(b - a for a, b in ranges) // fanout))
        a, b = (_digests(df.filter(inside), position, marks, low, width) for df, marks in ((source, of_s), (target, of_t)))
        named = b.withColumnsRenamed({c: f"t_{c}" for c in b.columns})
        equal = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ("n", "sum_1", "sum_2")]
        both = a.join(named, F.col("leaf").eqNullSafe(F.col("t_leaf")), "full_outer").filter(~every(equal))
        # leaves of one level: a few times the fanout at most
        found = both.select(F.coalesce("leaf", "t_leaf").alias("leaf"), F.coalesce(F.greatest("n", "t_n"), F.lit(0)).alias("n")).collect()
        nulls = nulls or any(r["leaf"] is None for r in found)
        leaves = sorted((r["leaf"], r["n"]) for r in found if r["leaf"] is not None)
        left = _merged([(low + leaf * width, min(low + (leaf + 1) * width, high)) for leaf, _ in leaves])
        if sum(n for _, n in leaves) <= few or width == 1 or 2 * sum(y - x for x, y in left) > sum(y - x for x, y in ranges):
            return Differences(left, nulls)
        ranges, inside = left, _within(position, left)


def _position(df: DataFrame, key: str) -> Column:
    return F.col(key).cast("long") if isinstance(df.schema[key].dataType, T.IntegralType) else F.when(F.col(key).isNotNull(), F.xxhash64(key))


def _merged(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Adjacent ranges as one; of too many, those with the least gaps between them too."""
    out = [list(ranges[0])] if ranges else []
    for low, high in ranges[1:]:
        if low <= out[-1][1]:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    while len(out) > MOST_RANGES:
        at = min(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1])
        out[at - 1 : at + 1] = [[out[at - 1][0], out[at][1]]]
    return [(a, b) for a, b in out]


def _within(position: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    return some((position >= F.lit(a)) & (position < F.lit(b)) if b < 1 << 63 else position >= F.lit(a) for a, b in ranges)


def tree_reconcile(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], declared: Mapping[str, str] | None = None, fanout: int = FANOUT, few: int = FEW_ROWS) -> DataFrame:
    """The ledger of reconcile(), for tables that are equal nearly everywhere: only what a tree of digests finds to differ is compared cell by cell.

    Where the digests agree the rows agree, and only a key that repeats on both
    sides alike is left to be found: one count of the source's keys.  The tree
    is walked when this is called (a job for each level); the ledger is lazy.
    """
    found = differences(source, target, key, columns, declared, fanout, few)
    if found is None:
        return reconcile(source, target, key, columns, declared)
    position = _position(source, key)
    inside = F.when(position.isNull(), F.lit(found.nulls)).otherwise(_within(position, found.ranges))
    again = source.filter(~inside).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = again.select(key, F.lit(None).cast("string").alias("column"), F.lit(None).cast("int").alias("index"), F.lit("multiplicity").alias("kind"))
    return again if found == ([], False) else reconcile(source.filter(inside), target.filter(inside), key, columns, declared).unionByName(again)


def _cell_differences(name: str, a: Column, b: Column, kind: T.DataType) -> Column:
    """Array of (column, index, kind) of a cell of the source and one of the target; kind is null where they are equal."""
    row = lambda index, differs: F.struct(F.lit(name).alias("column"), index.cast("int").alias("index"), F.when(differs, "mismatch").alias("kind"))
    if not isinstance(kind, T.ArrayType):
        return F.array(row(F.lit(None), ~same(a, b, kind)))
    whole = (a.isNull() != b.isNull()) | (F.size(a) != F.size(b))
    elements = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda e, i: row(i, ~same(e["a"], e["b"], kind.elementType)))
    return F.when(holds(whole), F.array(row(F.lit(None), F.lit(True)))).otherwise(F.filter(elements, lambda e: e["kind"].isNotNull()))


#: The ranges of the integer types.
INTEGERS = {"smallint": (-(2**15), 2**15 - 1), "integer": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}


def exact_cast(c: Column, kind: T.DataType, target: str, size: int | None = None) -> tuple[Column, Column]:
    """(value in the declared type, does it fail to fit?) of a source column of the given type.

    Declared types: smallint, integer, bigint, boolean, text, real, double
    precision, and arrays of these (`real[]`; with `size`, of that length).
    Integers must come from whole numbers and lie in the range, floating-point
    ones from numbers; NaN counts as null.  A source type that can't be meant
    raises at once.
    """
    if target.endswith("[]"):
        if not isinstance(kind, T.ArrayType):
            raise TypeError(f"{kind.simpleString()} is no {target}")
        one = lambda e: exact_cast(e, kind.elementType, target[:-2])
        fault = F.exists(c, lambda e: one(e)[1])
        return F.transform(c, lambda e: one(e)[0]), holds(fault | (F.size(c) != size) if size is not None else fault)
    if target in INTEGERS:
        if not isinstance(kind, T.IntegralType):
            raise TypeError(f"{kind.simpleString()} is no {target}")
        low, high = INTEGERS[target]
        inside = c.cast("long").between(F.lit(low), F.lit(high))
        return F.when(inside, c.cast({"smallint": "short", "integer": "int", "bigint": "long"}[target])), holds(~inside)
    fits = {"boolean": T.BooleanType, "text": T.StringType | T.BinaryType, "real": T.NumericType, "double precision": T.NumericType}
    if target not in fits or not isinstance(kind, fits[target]):
        raise TypeError(f"{kind.simpleString()} is no {target}")
    if target == "text":
        return (F.decode(c, "UTF-8") if isinstance(kind, T.BinaryType) else c), F.lit(False)
    if target == "boolean":
        return c, F.lit(False)
    number = F.when(F.isnan(c.cast("double")), None).otherwise(c)
    return number.cast("float" if target == "real" else "double"), F.lit(False)


def multiset_difference(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: distinct tuples, equal ones, tuples and rows in excess on either side.  For tables without a key; one shuffle."""
    signed = source.select(*columns, F.lit(1).alias("__s"), F.lit(0).alias("__t")).unionByName(target.select(*columns, F.lit(0).alias("__s"), F.lit(1).alias("__t")))
    n = signed.groupBy(*columns).agg(F.sum("__s").alias("__in_s"), F.sum("__t").alias("__in_t")).select(F.col("__in_s").alias("s"), F.col("__in_t").alias("t"))
    more, fewer = F.col("s") > F.col("t"), F.col("s") < F.col("t")
    return n.agg(F.count(F.lit(1)).alias("n_tuples"), F.count_if(F.col("s") == F.col("t")).alias("n_equal"), F.count_if(more).alias("n_more_in_source"), F.count_if(fewer).alias("n_more_in_target"), F.coalesce(F.sum(F.when(more, F.col("s") - F.col("t"))), F.lit(0)).alias("rows_more_in_source"), F.coalesce(F.sum(F.when(fewer, F.col("t") - F.col("s"))), F.lit(0)).alias("rows_more_in_target"))


def column_equality(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """column, n_common, n_equal, n_null_mismatch, n_nan_mismatch, n_value_mismatch over the keys of both tables: three exclusive kinds of difference."""
    kinds = {f.name: f.dataType for f in source.schema.fields}
    parts = []
    for c in columns:
        a, b = F.col(f"s_{c}"), F.col(f"t_{c}")
        nan = holds(F.isnan(a)) != holds(F.isnan(b)) if isinstance(kinds[c], T.DoubleType | T.FloatType) else F.lit(False)
        null, eq = a.isNull() != b.isNull(), same(a, b, kinds[c])
        parts.append(F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_common"), F.count_if(eq).alias("n_equal"), F.count_if(null).alias("n_null_mismatch"), F.count_if(~null & nan).alias("n_nan_mismatch"), F.count_if(~null & ~nan & ~eq).alias("n_value_mismatch")))
    return _beside(source, target, key, columns).filter("in_s and in_t").agg(F.array(*parts).alias("p")).select(F.inline("p"))


def compare_pairs(source: DataFrame, target: DataFrame, key: str, column: str, relative: float = 1e-9) -> DataFrame:
    """One row: common keys, keys of one side, exact values, values within the relative tolerance."""
    x, a, b = _beside(source, target, key, [column]), F.col(f"s_{column}"), F.col(f"t_{column}")
    both = F.col("in_s") & F.col("in_t")
    return x.agg(F.count_if(both).alias("n_common"), F.count_if(F.col("in_s") & ~F.col("in_t")).alias("n_left_only"), F.count_if(F.col("in_t") & ~F.col("in_s")).alias("n_right_only"), F.count_if(both & holds(a == b)).alias("n_exact"), F.count_if(both & holds(F.abs(a - b) <= relative * F.greatest(F.abs(a), F.abs(b)))).alias("n_within"))


def value_drift(source: DataFrame, target: DataFrame, key: str, column: str, group: str, limits: Sequence[float] = (0.001, 0.1), logarithmic: bool = False) -> DataFrame:
    """Per group: valid pairs, exact ones and their share, percentiles of the change and of the relative change, shares above limits.

    A logarithmic column's change is its own relative measure; a linear one's is divided by the old value.
    """
    x = source.select(key, group, F.col(column).alias("a")).join(target.select(key, F.col(column).alias("b")), key)
    valid = finite(F.col("a")) & finite(F.col("b"))
    delta = F.col("b") - F.col("a")
    relative = delta if logarithmic else F.try_divide(delta, F.abs("a"))
    x = x.filter(valid).select(group, delta.alias("d"), relative.alias("r"))
    both = x.select(group, F.inline(F.array(F.struct(F.lit("d").alias("__of"), F.col("d").alias("__v")), F.struct(F.lit("r").alias("__of"), F.col("r").alias("__v")))))
    found = exact_percentiles(both, F.col("__v"), {f"d_p{m}": m / 100 for m in (1, 16, 50, 84, 99)}, [group, "__of"])
    marks, middle = found.filter("__of = 'd'").drop("__of"), found.filter("__of = 'r'").select(group, F.col("d_p50").alias("r_median"))
    counts = x.groupBy(group).agg(F.count(F.lit(1)).alias("n_valid"), F.count_if(F.col("d") == 0).alias("n_exact"), F.avg((F.col("d") == 0).cast("double")).alias("match"), F.max(F.abs("r")).alias("r_max"), *[F.avg((F.abs("r") > t).cast("double")).alias(f"above_{i}") for i, t in enumerate(limits)])
    return counts.join(marks, group, "left").join(middle, group, "left")


def id_space(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row: keys retained, dropped and new, and whether the new ones are a subset.  One shuffle."""
    x = old.select(key).distinct().withColumn("o", F.lit(1)).join(new.select(key).distinct().withColumn("n", F.lit(1)), key, "full_outer")
    out = x.agg(F.count_if(F.col("o").isNotNull() & F.col("n").isNotNull()).alias("retained"), F.count_if(F.col("n").isNull()).alias("dropped"), F.count_if(F.col("o").isNull()).alias("added"))
    return out.withColumn("new_is_subset", F.col("added") == 0)


def agreement(product: DataFrame, restated: DataFrame, key: str, invariants: Mapping[str, Column]) -> DataFrame:
    """invariant, n_failed: rows where the product and its independent restatement disagree.

    Invariants are conditions on the columns p_* and r_* of the two; a row that
    is missing on a side fails the invariant `present` alone.
    """
    p = product.select(key, *[F.col(c).alias(f"p_{c}") for c in product.columns if c != key], F.lit(1).alias("__p"))
    r = restated.select(key, *[F.col(c).alias(f"r_{c}") for c in restated.columns if c != key], F.lit(1).alias("__r"))
    x, both = p.join(r, key, "full_outer"), F.col("__p").isNotNull() & F.col("__r").isNotNull()
    parts = [F.struct(F.lit("present").alias("invariant"), F.count_if(~both).alias("n_failed")), *[F.struct(F.lit(n).alias("invariant"), F.count_if(both & ~holds(c)).alias("n_failed")) for n, c in invariants.items()]]
    return x.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def schema_frame(df: DataFrame) -> DataFrame:
    """position, column, type of a table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """column, status (unchanged, removed, added, type_changed, moved), types of two schema frames."""
    a, b = old.select("column", F.col("position").alias("p1"), F.col("type").alias("old_type")), new.select("column", F.col("position").alias("p2"), F.col("type").alias("new_type"))
    status = F.when(F.col("p2").isNull(), "removed").when(F.col("p1").isNull(), "added").when(F.col("old_type") != F.col("new_type"), "type_changed").when(F.col("p1") != F.col("p2"), "moved").otherwise("unchanged")
    return a.join(b, "column", "full_outer").select("column", status.alias("status"), "old_type", "new_type")


def conformance(df: DataFrame, contract: DataFrame) -> DataFrame:
    """column, diagnostic of everything in which a table departs from its contract (position, column, type, array_length).

    Diagnostics: missing, unexpected, type_differs, moved, and wrong_length with
    the number of arrays (n) that are not as long as the contract says.
    """
    seen = schema_frame(df)
    x = seen.select("column", F.col("position").alias("p1"), F.col("type").alias("t1")).join(contract.select("column", F.col("position").alias("p2"), F.col("type").alias("t2")), "column", "full_outer")
    found = F.array_compact(F.array(F.when(F.col("p1").isNull(), "missing"), F.when(F.col("p2").isNull(), "unexpected"), F.when(F.col("t1") != F.col("t2"), "type_differs"), F.when(F.col("p1") != F.col("p2"), "moved")))
    out = x.select("column", F.explode(found).alias("diagnostic")).withColumn("n", F.lit(1).cast("long"))
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if arrays:
        # lengths are counted, so that a table is read once whatever its contract says
        sizes = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.size(c).alias("size"), F.col(c).isNull().alias("none")) for c in arrays]))).filter("not none").groupBy("column", "size").agg(F.count(F.lit(1)).alias("n"))
        wrong = sizes.join(contract.filter("array_length is not null").select("column", "array_length"), "column").filter("size != array_length")
        out = out.unionByName(wrong.groupBy("column").agg(F.sum("n").alias("n")).select("column", F.lit("wrong_length").alias("diagnostic"), "n"))
    return out


def manifest_diff(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """path, diagnostic: missing, extra, size_differs, hash_differs, time_differs, duplicate_declared of two frames (path, bytes, sha256, modified).

    Times are compared to the second; without the column `modified` on both sides they are not.
    """
    timed = "modified" in declared.columns and "modified" in observed.columns
    when = F.date_trunc("second", F.col("modified")) if timed else F.lit(None).cast("timestamp")
    d = declared.withColumn("__t", when).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("bytes").alias("b1"), F.min("sha256").alias("h1"), F.min("__t").alias("t1"))
    x = d.join(observed.select("path", F.col("bytes").alias("b2"), F.col("sha256").alias("h2"), when.alias("t2"), F.lit(1).alias("o")), "path", "full_outer")
    here, there = F.col("n").isNotNull(), F.col("o").isNotNull()
    differs = lambda c, name: F.when(here & there & (F.col(f"{c}1") != F.col(f"{c}2")), name)
    found = F.array_compact(F.array(F.when(here & ~there, "missing"), F.when(there & ~here, "extra"), differs("b", "size_differs"), differs("h", "hash_differs"), differs("t", "time_differs"), F.when(F.col("n") > 1, "duplicate_declared")))
    return x.select("path", F.explode(found).alias("diagnostic"))


def sampled_reconciliation(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], n: int, seed: str) -> DataFrame:
    """The ledger of a keyed comparison on the source's n rows of the least seeded hash, and on what the target has for them."""
    from .splits import ranked_sample

    keys = ranked_sample(source.select(key), key, n, seed).select(key)
    return reconcile(source.join(keys, key, "left_semi"), target.join(keys, key, "left_semi"), key, columns)


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """kind, column, n of a ledger."""
    return ledger.groupBy("kind", F.coalesce("column", F.lit("-")).alias("column")).agg(F.count(F.lit(1)).alias("n"))


def fidelity(standalone: DataFrame, combined: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """check, column, n_failed: is a standalone table what a combined one holds of it?  First its structure, then the values of a shared sample."""
    from .splits import ranked_sample

    schema = schema_diff(schema_frame(standalone), schema_frame(combined)).filter(F.col("status").isin("removed", "type_changed")).select(F.lit("structure").alias("check"), "column", F.lit(1).cast("long").alias("n_failed"))
    shared = [c for c in standalone.columns if c in combined.columns and c != key]
    keys = ranked_sample(standalone.select(key), key, n, seed).select(key)
    values = column_equality(standalone.join(keys, key, "left_semi"), combined.join(keys, key, "left_semi"), key, shared)
    return schema.unionByName(values.select(F.lit("values").alias("check"), "column", (F.col("n_common") - F.col("n_equal")).alias("n_failed")).filter("n_failed > 0"))
