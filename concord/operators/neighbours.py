"""Nearest neighbours in feature space, by cells around reference points and the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import holds
from .checkpoints import cut

#: Bytes of vectors that a unit of work holds of either side.
UNIT_BYTES = 16 << 20
#: Units that either side is cut into at least, if they have LEAST rows.
UNITS, LEAST = 8, 1024
#: Bytes of reference points that go out with the tasks.
PIVOT_BYTES = 4 << 20


def _nearest(queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, others: np.ndarray, k: int, tile: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, other, distance) of the k nearest rows of another id for each query, ties by id.

    Single precision picks, with a margin for its error, and double precision
    where too many rows are alike for that; what is picked is measured again,
    component by component.
    """
    out = []
    norms = (rows**2).sum(axis=1)
    most = norms.max(initial=0.0)
    right = np.column_stack([rows, norms])
    kinds = [(kind, error, right.astype(kind)) for kind, error in ((np.float32, 2e-7), (np.float64, 4e-16)) if most < 1e30 or kind is np.float64]
    for lo in range(0, len(queries), tile):
        x, own = queries[lo : lo + tile], ids[lo : lo + tile]
        square = (x**2).sum(axis=1)
        left = np.column_stack([-2 * x, np.ones(len(x))])
        limit = np.full(len(x), np.inf)
        who, what, far = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        at, wide = 0, 256  # a short tile first, for a limit
        while at < len(rows):
            upto = min(at + wide, len(rows))
            for kind, error, side in kinds if square.max() < 1e30 else kinds[-1:]:
                margin = error * (rows.shape[1] + 8) * (square + most)
                d = left.astype(kind) @ side[at:upto].T  # the squared distance less the query's square
                here = limit - square + margin
                free = np.flatnonzero(np.isinf(limit) | (kind is np.float64))
                if len(free) and upto - at >= k:
                    e = d[free]
                    e[own[free, None] == others[at:upto]] = np.inf
                    here[free] = np.minimum(here[free], np.partition(e, k - 1, axis=1)[:, k - 1] + 2 * margin[free])
                i, j = np.divmod(np.flatnonzero(d <= np.nextafter(here.astype(kind), kind(np.inf))[:, None]), upto - at)
                if len(i) <= 16 * max(k, 8) * len(x):
                    break
            j += at
            other = own[i] != others[j]
            i, j = i[other], j[other]
            exact = np.concatenate([((x[i[c : c + 65536]] - rows[j[c : c + 65536]]) ** 2).sum(axis=1) for c in range(0, max(1, len(i)), 65536)])
            who, what, far = np.r_[who, i], np.r_[what, j], np.r_[far, exact]
            order = np.lexsort((others[what], far, who))
            who, what, far = who[order], what[order], far[order]
            place = np.arange(len(who)) - np.searchsorted(who, who)  # among those of the same query
            best = place < k
            limit[who[place == k - 1]] = far[place == k - 1]
            who, what, far = who[best], what[best], far[best]
            at, wide = upto, min(2 * upto, 2 * tile)
        out.append((own[who], others[what], np.sqrt(far)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (ids[:0], others[:0], np.empty(0))


def _few_copies(rows: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the rows, of equal ones of the k + 1 least ids alone: no other can be among the k nearest of another id."""
    same = np.unique(np.ascontiguousarray(rows + 0.0).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel(), return_inverse=True)[1]
    order = np.lexsort((ids, same))
    order = order[np.r_[True, (np.diff(same[order]) != 0) | (np.diff(ids[order]) != 0)]]
    place = np.arange(len(order)) - np.searchsorted(same[order], same[order])
    return np.sort(order[place <= k])


def _matrix(batch: pa.RecordBatch | pa.Table, dim: int) -> np.ndarray:
    return _flat(batch, "v").astype(np.float64).reshape(-1, dim)


def _flat(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    """A column of numbers, or all numbers of a column of lists."""
    column = batch.column(batch.schema.get_field_index(name))
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [(c.flatten() if pa.types.is_list(c.type) or pa.types.is_large_list(c.type) else c).to_numpy(zero_copy_only=False) for c in chunks]
    return np.concatenate(parts) if parts else np.empty(0)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every row to every pivot, added up component by component, without cancellation."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _in_cells(rows: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """The rows with the number of their nearest pivot and the distance to it."""
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                far = _distances(_matrix(part, dim), pivots)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell])], names=[*part.schema.names, "cell", "r"])

    return rows.mapInArrow(run, f"k long, v array<{kind}>, asks boolean, cell int, r double")


def _in_order(queries: DataFrame, pivots: np.ndarray, numbers: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, kind: str) -> DataFrame:
    """k, v, cells: the cells (by their least possible distance, and with it) that a query must look into, nearest first.

    No row of a cell is nearer than the query's distance to the cell's pivot
    less the cell's radius; none is nearer than the plane half-way between that
    pivot and any other, if the query lies beyond it.
    """
    dim = pivots.shape[1]
    apart = _distances(pivots, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                far = _distances(_matrix(part, dim), pivots)
                own = far.argmin(axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (far**2 - far[np.arange(len(own)), own][:, None] ** 2) / (2 * apart[own])
                plane[~np.isfinite(plane)] = 0.0
                least = np.maximum(plane[:, numbers], np.maximum(far[:, numbers] - farthest, nearest - far[:, numbers]))
                least = np.maximum(least - 1e-9 * (1 + far[:, numbers]), 0.0)  # what rounding may have added
                order = np.lexsort((far[:, numbers], least), axis=1)
                low = np.take_along_axis(least, order, axis=1)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * len(numbers), pa.int32()), pa.StructArray.from_arrays([pa.array(low.ravel()), pa.array(numbers[order].ravel(), pa.int32())], names=["low", "cell"]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), cells], names=["k", "v", "cells"])

    return queries.select("k", "v").mapInArrow(run, f"k long, v array<{kind}>, cells array<struct<low:double,cell:int>>")


def _bundles(points: np.ndarray, numbers: np.ndarray, count: np.ndarray, unit: int) -> list[int]:
    """Of each pivot its cell's bundle: cells that follow each other on a way from pivot to nearest pivot, `unit` rows together at most; -1 if it has no cell."""
    apart, rows = _distances(points, points), dict(zip(numbers.tolist(), count.tolist(), strict=True))
    out, left, at = [-1] * len(points), sorted(rows), int(numbers[0])
    bundle, held = 0, 0
    while left:
        at = min(left, key=lambda c: (apart[at, c], c))
        left.remove(at)
        if held and held + rows[at] > unit:
            bundle, held = bundle + 1, 0
        out[at], held = bundle, held + rows[at]
    return out


def nearest_in_features(df: DataFrame, key: str, features: str, k: int = 5, queries: Column | None = None, pivots: int = 64, steps: Sequence[int] = (1, 5, 21)) -> DataFrame:
    """key, neighbour, distance, rank: the k nearest rows by Euclidean distance of every row, or of those that `queries` holds for (exact; ties by key).

    Rows lie in cells around `pivots` reference points (the rows of the least
    hash, 4 MB of them at most).  A query looks into its nearest cell first, and
    then only into cells that can hold something nearer than its k-th best so
    far: up to steps[1] cells, up to steps[2], and last into all that are left,
    so there are four rounds at most, each a job with the queries still open.
    If half of all pairs are still to be formed, the next round is the last.
    Cells near each other make a bundle, and a query goes to a bundle once, with
    the cells that it looks into.  Bundles are of 16 MB at most, larger cells and
    the queries of a bundle are cut into such units, and two units are a task's
    work.  How many cells fall away depends on the data: where all distances are
    alike, as of random vectors in many dimensions, none does, and every query is
    compared with every row; each row is then sent once for each unit of queries,
    and each query once for each unit of rows.

    Rows without a key, without features, with a null or non-finite component,
    or of another length than the first pivot have no neighbours and are none.
    Keys are whole numbers, and rows of one key are no neighbours; of a key that
    repeats, the least vector asks, and each of its distances may be a neighbour.
    """
    asks = F.lit(True) if queries is None else holds(queries)
    kind = "float" if dict(df.select(features).dtypes)[features] == "array<float>" else "double"
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(features).cast(f"array<{kind}>").alias("v"), asks.alias("asks"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter(F.col("k").isNotNull() & F.coalesce(F.forall("v", number) & (F.size("v") > 0), F.lit(False)))
    first = [r["v"] for r in rows.orderBy(F.xxhash64("k"), "k", "v").limit(pivots).collect()]
    named = [F.col("k").alias(key), F.col("neighbour"), F.col("distance"), F.col("rank")]
    if not first:
        return df.sparkSession.createDataFrame([], "k long, neighbour long, distance double, rank int").select(*named)
    dim = len(first[0])
    points = np.unique(np.array([p for p in first if len(p) == dim][: max(1, PIVOT_BYTES // (8 * dim))]), axis=0)
    placed = cut(_in_cells(rows.filter(F.size("v") == dim), points, kind))
    seen = sorted(map(tuple, placed.groupBy("cell").agg(F.count(F.lit(1)), F.min("r"), F.max("r"), F.count_if("asks")).collect()))  # a row for each pivot
    numbers, count, nearest, farthest, asking = (np.array(c) for c in zip(*seen, strict=True))
    unit = max(1, min(UNIT_BYTES // (8 * dim), max(LEAST, -(-int(count.sum()) // UNITS))))
    bundle_of = _bundles(points, numbers, count, unit)
    held = np.bincount([bundle_of[c] for c in numbers], count)
    of_cell = lambda values: lambda c: F.get(F.array(*map(F.lit, values)), c)
    bundle, size = of_cell(bundle_of), of_cell([int(x) for x in np.bincount(numbers, count, len(points))])
    state = _in_order(placed.filter("asks").groupBy("k").agg(F.min("v").alias("v")), points, numbers, nearest, farthest, kind)
    state = state.withColumn("best", F.array().cast("array<struct<distance:double,neighbour:long>>"))
    done, begun, last = None, 0, len(numbers)
    stops = iter((*steps, last))
    while begun < last:
        kth = F.when(F.size("best") < k, float("inf")).otherwise(F.get("best", F.lit(k - 1))["distance"])
        state = state.withColumn("limit", kth)
        upto = max(next(stops), begun + 1)
        if begun:
            wanted = F.filter(F.slice("cells", begun + 1, last), lambda c: c["low"] <= F.col("limit"))
            finished = state.filter(F.size(wanted) == 0).select("k", "best")
            done = finished if done is None else done.unionByName(finished)
            state = state.filter(F.size(wanted) > 0)
            need = state.agg(F.sum(F.aggregate(F.transform(wanted, lambda c: size(c["cell"])), F.lit(0).cast("long"), lambda a, n: a + n))).first()[0]
            if (need or 0) >= int(asking.sum()) * int(count.sum()) / 2:
                upto = last
        look = F.transform(F.filter(F.slice("cells", begun + 1, max(1, upto - begun)), lambda c: c["low"] <= F.col("limit")), lambda c: c["cell"])
        visits = state.withColumn("look", look).withColumn("bundle", F.explode(F.array_distinct(F.transform("look", bundle))))
        asked = {r["bundle"]: r["n"] for r in visits.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each pivot at most
        if not asked:  # no query is open
            done = state.select("k", "best") if done is None else done
            break
        facts = [(b, -(-int(held[b]) // unit), -(-n // unit)) for b, n in asked.items()]
        units = F.broadcast(df.sparkSession.createDataFrame(facts, "bundle int, parts int, sides int"))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        of = lambda n: F.pmod(F.xxhash64("k"), F.col(n)).cast("int")
        here = F.filter("look", lambda c: bundle(c) == F.col("bundle"))
        left = visits.join(units, "bundle").withColumns({"side": of("sides"), "look": here}).withColumn("part", every("parts")).select("bundle", "part", "side", "k", "v", "limit", "look")
        right = placed.withColumn("bundle", bundle(F.col("cell"))).join(units, "bundle").withColumns({"part": of("parts")}).withColumn("side", every("sides")).select("bundle", "part", "side", "k", "v", "cell")

        def compare(a: pa.Table, b: pa.Table) -> pa.Table:
            found = []
            if a.num_rows and b.num_rows:
                x, ids, y, others, at = _matrix(a, dim), _flat(a, "k"), _matrix(b, dim), _flat(b, "k"), _flat(b, "cell")
                few = _few_copies(y, others, k)
                y, others, at = y[few], others[few], at[few]
                looks = np.zeros((len(x), len(points)), bool)
                looks[np.repeat(np.arange(len(x)), a.column("look").combine_chunks().value_lengths().to_numpy()), _flat(a, "look")] = True
                if 2 * (looks @ np.bincount(at, minlength=len(points)).astype(float)).sum() >= len(x) * len(y):
                    found = [_nearest(x, ids, y, others, k)]
                else:
                    for c in np.unique(at):
                        who, what = looks[:, c], at == c
                        found.append(_nearest(x[who], ids[who], y[what], others[what], k))
            who, what, far = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            if len(who):
                order = np.argsort(ids, kind="stable")
                near = far <= _flat(a, "limit")[order[np.searchsorted(ids[order], who)]]
                who, what, far = who[near], what[near], far[near]
            return pa.table({"k": pa.array(who, pa.int64()), "neighbour": pa.array(what, pa.int64()), "distance": pa.array(far, pa.float64())})

        keys = ["bundle", "part", "side"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "k long, neighbour long, distance double").distinct()
        nth = F.row_number().over(Window.partitionBy("k").orderBy("distance", "neighbour"))
        found = found.withColumn("n", nth).filter(F.col("n") <= k).groupBy("k").agg(F.collect_list(F.struct("distance", "neighbour")).alias("new"))
        begun = upto
        state = (state.select("k", "v", "cells", "best") if begun < last else state.select("k", "best")).join(found, "k", "left")
        best = F.slice(F.array_sort(F.array_union("best", F.coalesce("new", F.array().cast("array<struct<distance:double,neighbour:long>>")))), 1, k)
        state = cut(state.withColumn("best", best).drop("new"))
        if begun >= last:
            done = state if done is None else done.unionByName(state)
    return done.select("k", F.posexplode("best").alias("at", "b")).select("k", F.col("b.neighbour").alias("neighbour"), F.col("b.distance").alias("distance"), (F.col("at") + 1).alias("rank")).select(*named)
