"""Choosing, naming, casting and cleaning the columns of catalogue tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import null_integers, null_minus_infinity, null_sentinels

RESERVED = frozenset("all and as by case desc end from group in is join limit not null on or order select table then to union user when where with".split())
#: Spark types of the column codes of binary tables.
CODES = {"D": T.DoubleType(), "E": T.FloatType(), "K": T.LongType(), "J": T.IntegerType(), "I": T.ShortType(), "L": T.BooleanType()}


def select_by_name(df: DataFrame, prefixes: Sequence[str] = (), suffixes: Sequence[str] = (), keep: Sequence[str] = (), arrays: bool = False) -> DataFrame:
    """The columns that begin or end so, and those to keep, in the table's order; arrays only if asked for."""
    ok = [f.name for f in df.schema.fields if f.name in keep or (arrays or not isinstance(f.dataType, T.ArrayType)) and (f.name.startswith(tuple(prefixes)) or f.name.endswith(tuple(suffixes)))]
    return df.select(*ok)


def sanitise(df: DataFrame) -> DataFrame:
    """Lower-case names with punctuation as `_`; reserved words get `c_` before them; two names that become one raise."""
    names = []
    for c in df.columns:
        n = re.sub(r"[^0-9a-z]+", "_", c.strip().lower()).strip("_")
        names.append(f"c_{n}" if n in RESERVED or not n or n[0].isdigit() else n)
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"names collide: {', '.join(twice)}")
    return df.toDF(*names)


def column_type(code: str) -> T.DataType:
    """Spark type of a column code: D, E, K, J, I, L, nA (text), nD and nE (arrays).  Other vectors are refused."""
    m = re.fullmatch(r"(\d*)([A-Z])", code)
    if not m or (m[2] != "A" and m[2] not in CODES):
        raise ValueError(f"unknown column code {code}")
    if m[2] == "A":
        return T.StringType()
    if m[1] in ("", "1"):
        return CODES[m[2]]
    if m[2] not in "DE":
        raise ValueError(f"vectors of {m[2]} are not supported")
    return T.ArrayType(CODES[m[2]])


def cast_by(df: DataFrame, codes: Mapping[str, str]) -> DataFrame:
    """Cast the named columns by their codes.  Values out of range raise."""
    return df.select(*[F.trim(F.col(c).cast("string")).alias(c) if codes.get(c, "").endswith("A") else F.col(c).cast(column_type(codes[c])).alias(c) if c in codes else F.col(c) for c in df.columns])


def clean(df: DataFrame, floats: Mapping[str, Sequence[float]], integers: Mapping[str, Sequence[int]] | None = None, minus_infinity: Sequence[str] = ()) -> DataFrame:
    """Null the listed sentinels (floats with tolerance, integers exactly) and -inf."""
    new: dict[str, Column] = {c: null_sentinels(F.col(c), s) for c, s in floats.items()}
    new |= {c: null_integers(F.col(c), s) for c, s in (integers or {}).items()}
    new |= {c: null_minus_infinity(new.get(c, F.col(c))) for c in minus_infinity}
    return df.withColumns(new)


def join_aligned(left: DataFrame, right: DataFrame, ordinal: str, columns: Sequence[str]) -> DataFrame:
    """Give `left` columns of its row-aligned partner, by the persisted ordinal."""
    return left.join(right.select(ordinal, *columns), ordinal)


def infer_text_types(df: DataFrame) -> DataFrame:
    """column, type (integer, decimal, string): the narrowest type that all tokens of a text column have.  One aggregate; all-null columns are strings."""
    parts = []
    for c in df.columns:
        token = F.trim(F.col(c))
        whole, number = F.min(token.rlike(r"^[+-]?[0-9]+$")), F.min(token.try_cast("double").isNotNull())
        parts.append(F.struct(F.lit(c).alias("column"), F.when(whole, "integer").when(number, "decimal").otherwise("string").alias("type")))
    return df.agg(F.array(*parts).alias("t")).select(F.inline("t"))


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns of the target schema in its order and types; extra ones go, a missing one raises."""
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.to(target)
