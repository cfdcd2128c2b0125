"""Nearest neighbours on the sphere, by a tree of cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite, separation_arcsec
from .checkpoints import cut


def valid_coordinates(ra: Column, dec: Column, floor: float = -900.0) -> Column:
    """Both finite and above the floor that marks missing ones."""
    return finite(ra) & finite(dec) & (ra > floor) & (dec > floor)


#: The cube around the sphere is halved this many times a side at each level of the tree; at the last, cells are some 0.4 arcseconds wide.
LEVELS = range(2, 21, 2)
_BITS = 21
#: What rounding may add to a bound (of a chord of the unit sphere).
_SLACK = 1e-12


def _unit(ra: Column, dec: Column) -> list[Column]:
    """The point on the unit sphere."""
    a, d = F.radians(ra), F.radians(dec)
    return [F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)]


def _key(xyz: Sequence[Column], level: int) -> Column:
    """The cell of the cube that holds the point, its three numbers in one."""
    x, y, z = (F.least(F.greatest(F.floor((c + 1) / 2 * (1 << level)), F.lit(0)), F.lit((1 << level) - 1)).cast("long") for c in xyz)
    return F.shiftleft(x, 2 * _BITS).bitwiseOR(F.shiftleft(y, _BITS)).bitwiseOR(z)


def _numbers(key: Column) -> list[Column]:
    return [F.shiftright(key, n * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)) for n in (2, 1, 0)]


def _parent(key: Column) -> Column:
    x, y, z = (F.shiftright(n, LEVELS.step) for n in _numbers(key))
    return F.shiftleft(x, 2 * _BITS).bitwiseOR(F.shiftleft(y, _BITS)).bitwiseOR(z)


def _bounds(xyz: Sequence[Column], key: Column, level: int) -> tuple[Column, Column]:
    """(least, largest) squared chord from the point to anything in the cell."""
    side = 2.0 / (1 << level)
    near, far = F.lit(0.0), F.lit(0.0)
    for c, n in zip(xyz, _numbers(key), strict=True):
        low = n * side - 1
        gap = F.greatest(low - c, c - low - side, F.lit(0.0))
        reach = F.greatest(F.abs(c - low), F.abs(c - low - side))
        near, far = near + gap * gap, far + reach * reach
    return near - _SLACK, far + _SLACK


def nearest(entries: DataFrame, targets: DataFrame, leaf: int = 64) -> DataFrame:
    """e_id, t_id, sep (arcseconds) of the nearest target of every entry (columns e_id, e_ra, e_dec; t_id, t_ra, t_dec); ties by t_id.

    Targets lie in a tree of cells, cubes around the unit sphere, which are cut
    again while they hold more than `leaf` positions; so a dense field has small
    cells and an empty one large ones, and poles and the meridian are like any
    other place.  Entries go down the tree together, a level at a time: of the
    occupied cells below those an entry looks into, it keeps the ones that can
    hold something nearer than what some cell is known to hold.  At the end it
    is compared with the targets of a few leaves.  The search has no limit, and
    nothing is paired but entries with cells and with a few leaves' targets.
    Each level is a job or two, with the entries' cells written between them.

    Targets at one position count once, with the least t_id.  Invalid
    coordinates match nothing, and their entries have a null match; so has every
    entry where there are no targets.  Rows that share e_id and coordinates are
    one entry.
    """
    goal = targets.filter(valid_coordinates(F.col("t_ra"), F.col("t_dec"))).groupBy("t_ra", "t_dec").agg(F.min("t_id").alias("t_id"))
    goal = goal.withColumns(dict(zip("xyz", _unit(F.col("t_ra"), F.col("t_dec")), strict=True)))
    here = [F.col(c) for c in "xyz"]
    cells, leaves, left = [], None, goal
    for level in LEVELS:
        # a cell each: at most as many as there are positions, and far fewer on the levels above
        found = cut(left.groupBy(_key(here, level).alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("leaf", (F.col("n") <= leaf) | F.lit(level == LEVELS[-1])).drop("n"))
        cells.append(found)
        placed = left.withColumn("key", _key(here, level))
        small = placed.join(found.filter("leaf").select("key"), "key", "left_semi").select(F.lit(level).alias("level"), "key", "t_id", "t_ra", "t_dec")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = found.filter("not leaf").select("key")
        if large.isEmpty():
            break
        left = placed.join(large, "key", "left_semi").drop("key")

    good = valid_coordinates(F.col("e_ra"), F.col("e_dec"))
    none = [F.lit(None).cast(targets.schema["t_id"].dataType).alias("t_id"), F.lit(None).cast("double").alias("sep")]
    nothing = entries.filter(~F.coalesce(good, F.lit(False))).select("e_id", *none)
    who = ["e_id", "e_ra", "e_dec"]
    asked = entries.filter(good).select(*who).distinct()
    first = [(r["key"], r["leaf"]) for r in cells[0].collect()]  # of the first level: 64 at most
    if not first:
        return nothing.unionByName(asked.select("e_id", *none))
    kept = Window.partitionBy(*who)
    start = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("key"), F.lit(is_leaf).alias("leaf")) for k, is_leaf in first]))
    state = asked.withColumns(dict(zip("xyz", _unit(F.col("e_ra"), F.col("e_dec")), strict=True))).withColumn("c", start).select(*who, *"xyz", F.lit(LEVELS[0]).alias("level"), "c.key", "c.leaf")
    near, far = _bounds(here, F.col("key"), LEVELS[0])
    state = state.withColumns({"near": near, "far": far})
    for i, level in enumerate(LEVELS[: len(cells)]):
        if i:
            below = cells[i].select("key", "leaf", _parent(F.col("key")).alias("above"))
            near, far = _bounds(here, F.col("key"), level)
            opened = state.filter("not leaf").select(*who, *"xyz", F.col("key").alias("above")).join(below, "above").select(*who, *"xyz", F.lit(level).alias("level"), "key", "leaf", near.alias("near"), far.alias("far"))
            state = state.filter("leaf").unionByName(opened)
        state = cut(state.withColumn("reach", F.min("far").over(kept)).filter(F.col("near") <= F.col("reach")).drop("reach"))
    pairs = state.select(*who, "level", "key").join(leaves, ["level", "key"]).withColumn("sep", separation_arcsec(F.col("e_ra"), F.col("e_dec"), F.col("t_ra"), F.col("t_dec")))
    best = pairs.groupBy(*who).agg(F.min(F.struct("sep", "t_id")).alias("m")).select("e_id", "m.t_id", "m.sep")
    return nothing.unionByName(best)


def match_classes(found: DataFrame, expected: str, radii: Sequence[float]) -> DataFrame:
    """radius, same, other, none, total: does the nearest target within each radius equal the expected one?"""
    parts = []
    for r in radii:
        hit = F.coalesce(F.col("sep") <= r, F.lit(False))
        equal = hit & F.coalesce(F.col("t_id") == F.col(expected), F.lit(False))
        parts.append(F.struct(F.lit(float(r)).alias("radius"), F.count_if(equal).alias("same"), F.count_if(hit & ~equal).alias("other"), F.count_if(~hit).alias("none"), F.count(F.lit(1)).alias("total")))
    return found.agg(F.array(*parts).alias("p")).select(F.inline("p"))
