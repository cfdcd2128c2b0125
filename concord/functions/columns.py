"""Predicates, guards and normalisation rules as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

LN10 = 2.302585  # fixed value: the first version of the tension formula uses these digits


def r6(c: Column) -> Column:
    """Round to six places, as results are reported; -0.0 becomes 0.0."""
    return F.round(c, 6) + F.lit(0.0)


def every(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def some(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def finite(c: Column) -> Column:
    """True for numbers, false for NaN, infinities and null."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def holds(c: Column) -> Column:
    """A condition with null as false."""
    return F.coalesce(c, F.lit(False))


def null_sentinels(c: Column, sentinels: Sequence[float], relative: float = 1e-5, absolute: float = 1e-8) -> Column:
    """Null where the value is close to a sentinel: |c - s| <= absolute + relative |s|.  NaN stays."""
    hit = some(F.abs(c - F.lit(float(s))) <= absolute + relative * abs(s) for s in sentinels)
    return F.when(holds(hit & ~F.isnan(c)), F.lit(None)).otherwise(c)


def null_integers(c: Column, sentinels: Sequence[int]) -> Column:
    """Null where the integer equals a sentinel."""
    return F.when(c.isin(*sentinels), F.lit(None)).otherwise(c)


def null_minus_infinity(c: Column) -> Column:
    return F.when(c == F.lit(float("-inf")), F.lit(None)).otherwise(c)


def null_nan(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def ascii_text(c: Column) -> Column:
    """Bytes as trimmed ASCII text."""
    return F.trim(F.decode(c, "US-ASCII"))


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom; null where either is null or the bottom is 0."""
    return F.when(bottom != 0, F.try_divide(top, bottom))


def numeric_reason(c: Column, name: str = "z") -> Column:
    """Why a value is no positive number: missing, non-finite or non-positive; null if it is one."""
    return F.when(c.isNull(), f"{name}_missing").when(~finite(c), f"{name}_non_finite").when(~(c > 0), f"{name}_non_positive")


def category(c: Column, groups: Mapping[str, Sequence[int]], missing: str, other: str) -> Column:
    """The name of the group that holds the value."""
    out = F.when(c.isNull(), missing)
    for name, members in groups.items():
        out = out.when(c.isin(*members), name)
    return out.otherwise(other)


def in_domain(c: Column, low: float, high: float) -> Column:
    """low <= c <= high, null as false."""
    return holds(c.between(low, high))


def mapped(c: Column, values: Mapping[int, int], offset: int | None = None) -> Column:
    """The value that the mapping gives for c, or for c - offset where c has none; null without either."""
    def look(x: Column) -> Column:
        out = F.lit(None).cast("long")
        for k, v in values.items():
            out = F.when(x == k, F.lit(v).cast("long")).otherwise(out)
        return out

    return look(c) if offset is None else F.coalesce(look(c), look(c - offset))


def failed(conjuncts: Mapping[str, Column]) -> Column:
    """The names of all conditions that hold, as an array in the given order."""
    return F.array_compact(F.array(*[F.when(holds(c), F.lit(name)) for name, c in conjuncts.items()]))


def reasons(conditions: Mapping[str, Column]) -> Column:
    """The names of all conditions that hold, sorted and distinct."""
    return F.array_sort(F.array_distinct(failed(conditions)))


def sentinel_shaped(c: Column) -> Column:
    """Is |c| a whole number of two or more nines?"""
    whole = F.expr("1 = 1") & (F.abs(c) < F.lit(1e37)) & (c == F.floor(c))
    digits = F.abs(c).try_cast("decimal(38,0)").cast("string")
    return holds(F.when(finite(c), whole & digits.rlike("^9{2,}$")))


def binned(c: Column, edges: Sequence[float], names: Sequence[str], outside: str = "unbinned") -> Column:
    """The name of the bin [edge, next edge) that holds c; values in no bin, NaN included, are `outside`."""
    out = F.lit(outside)
    for low, high, name in reversed(list(zip(edges, edges[1:], names, strict=False))):
        inside = (F.lit(True) if low == float("-inf") else c >= F.lit(float(low))) & (F.lit(True) if high == float("inf") else c < F.lit(float(high)))
        out = F.when(holds(inside & ~F.isnan(c)), name).otherwise(out)
    return out


def edge_names(edges: Sequence[float]) -> list[str]:
    def show(x: float) -> str:
        return "underflow" if x == float("-inf") else "overflow" if x == float("inf") else f"{x:g}"

    return [f"[{show(a)},{show(b)})" for a, b in zip(edges, edges[1:], strict=False)]


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation by haversine, in arcseconds."""
    d, a = F.radians(dec2) - F.radians(dec1), F.radians(ra2) - F.radians(ra1)
    h = F.pow(F.sin(d / 2), F.lit(2.0)) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(a / 2), F.lit(2.0))
    return F.degrees(F.lit(2.0) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))) * 3600


def separation_by_cosines(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """The same by the law of cosines, clamped: a cross-check by another formula."""
    c = F.sin(F.radians(dec1)) * F.sin(F.radians(dec2)) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.cos(F.radians(ra1 - ra2))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))) * 3600
