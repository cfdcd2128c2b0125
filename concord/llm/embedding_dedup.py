"""Near-duplicate embeddings through a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order.
Inverted lists hold the vectors of one label that have a given pair of pivots
among their nearest: two vectors meet in a list when they share two pivots or
more.  In a list, shared-pivot counts pick the pairs whose smallest shared
pivots are the list's own, so that a pair counts once, and these are verified
by their cosine in double precision.  Lists are cut into blocks, and every pair
of blocks is a unit of work of its own; a unit returns, for each vector, the
number of its links and one member of its component, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_key, shuffle_partitions
from .components import connected_components
from .minhash import _forest

#: Most pivots, and fewest: as many as the root of the number of distinct vectors, within these bounds.  Beyond a
#: thousand million vectors, lists grow with the table; the pivots sent to each task stay below 17 MB in 64 dimensions.
MOST_PIVOTS, FEWEST_PIVOTS = 32768, 64
#: Bytes of pivots that go out with the tasks; the sample in the driver holds four times as many numbers.
PIVOT_BYTES = 16 << 20
_BATCH = 2048
#: Pivots up to which each takes a column.
DENSE = 4096


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the list column in double precision (zero-padded to one length), and their lengths; null rows and components become NaN."""
    size = np.array([len(x) if x is not None else 0 for x in column.to_pylist()]) if column.null_count else np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(size.max(initial=0)) or 1))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    out[size == 0] = np.nan
    return out, size


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows without a direction (zero, or not finite) become NaN."""
    top = np.abs(m).max(axis=1, keepdims=True)
    with np.errstate(all="ignore"):
        m = m / top  # so that neither huge nor tiny components overflow
        return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            yield batch.slice(at, _BATCH)


def usable(vectors: DataFrame) -> DataFrame:
    """id, label, v -> also `ok`: the vector has a direction and a label."""

    def run(batches):
        for b in _slices(batches):
            good = np.isfinite(unit_rows(matrix(b.column(2))[0])).all(axis=1)
            label = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(good & label)], names=[*b.schema.names, "ok"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(run, f"{schema}, ok boolean")


def permutations(vectors: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """Add `near`: the numbers of the `k` pivots of the largest cosine, nearest first."""

    def run(batches):
        for b in _slices(batches):
            m = unit_rows(matrix(b.column(b.schema.get_field_index("v")))[0])
            width = max(m.shape[1], pivots.shape[1])
            m, p = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (m, pivots))
            near = np.argsort(-(m @ p.T), axis=1, kind="stable")[:, :k].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(near), pa.list_(pa.int32()))], names=[*b.schema.names, "near"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(run, f"{schema}, near array<int>")


def owned(near: np.ndarray, own: np.ndarray, within: bool, first: int, second: int) -> np.ndarray:
    """Pairs of one list (or of two blocks of it) that belong to it: `first` < `second` are the pair's smallest shared pivots.

    Counts the pivots below `second` that both share.  Where these are many,
    only those that several of the list's vectors have take a column.
    """
    n = len(near)
    row, at = np.nonzero(near < second)
    column, width = near[row, at].astype(np.int64), second
    column[column == first] = second
    if second > DENSE:
        seen, column, times = np.unique(np.append(column, second), return_inverse=True, return_counts=True)
        place = np.cumsum(times > 1) - 1
        width = int((times[:-1] > 1).sum())
        column = np.where(times[column] > 1, place[column], width)[:-1]
    shared = np.zeros((n, width + 1), dtype=np.float32)
    shared[row, column] = 1
    shared = shared[:, :width]
    mine = (shared @ shared.T) == 0  # of the pivots below `second`, only `first` is shared
    np.fill_diagonal(mine, False)
    if not within:
        mine &= own[:, None] != own
    return mine


def linked(m: np.ndarray, mine: np.ndarray, threshold: float) -> np.ndarray:
    """Those of the pairs `mine` whose cosine, in double precision, reaches the threshold."""
    some = np.flatnonzero(mine.any(axis=1))
    if 2 * len(some) > len(m):
        u = unit_rows(m)
        return mine & (u @ u.T >= threshold)
    u, at = unit_rows(m[some]), np.ix_(some, some)  # the others need no product
    link = np.zeros(mine.shape, dtype=bool)
    link[at] = mine[at] & (u @ u.T >= threshold)
    return link


def fit_pivots(vectors: DataFrame, n: int, longest: int, pivots: int | None, apart: float = 0.6) -> np.ndarray:
    """The pivots: as many as the root of `n` says (MOST_PIVOTS and, of `longest` components, PIVOT_BYTES at most), no two with a cosine of `apart` or more.

    Taken in turn from a sample of four times as many, those of the least hash
    of their id.  Without this distance a dense group would hold many pivots,
    whose order says nothing.  If the sample has too few, directions drawn from
    a fixed seed fill up.
    """
    want = min(pivots or min(MOST_PIVOTS, max(FEWEST_PIVOTS, isqrt(n))), max(FEWEST_PIVOTS, PIVOT_BYTES // (8 * max(1, longest))))
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(4 * want).select("v").toArrow()
    if not rows.num_rows:
        return np.zeros((0, 1))
    sample = unit_rows(matrix(rows.column("v").combine_chunks())[0])
    drawn = unit_rows(np.random.default_rng(7).normal(size=(want, sample.shape[1])))
    out, n_out = np.zeros((want, sample.shape[1])), 0
    for v in (*sample, *drawn):
        if n_out == want:
            break
        if (out[:n_out] @ v < apart).all():
            out[n_out] = v
            n_out += 1
    return out[:n_out]


def embedding_classes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.93, k: int = 6, pivots: int | None = None, block: int = 256) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    Vectors link when their labels are equal and not null and their cosine is
    at least `threshold`.  Equal vectors are brought together first and link
    with each other in any case; the index finds the others: all those that
    share two of their `k` nearest pivots (at a cosine of 0.935, 99 % of random
    pairs in 64 dimensions).  Vectors that are null, empty, zero or hold null or
    non-finite components, and those without a label, link with nothing.
    Vectors of different length are compared as if padded with zeros.  Ids are
    whole numbers; rows that share an id are vectors of their own in counts and
    share a component.  A row without an id is a vector too: its component may
    be null, and it is kept.  An empty table gives an empty table; other columns
    are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(vectors[vec_id].cast("long").alias("id"), vectors[label].cast("string").alias("label"), vectors[embedding].alias("v"))
    rows = cut(usable(rows).withColumn("k1", F.xxhash64("v")).withColumn("k2", F.md5(F.to_json(F.struct("label", "v")))))
    alike = rows.filter("ok").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min_by("v", "id").alias("v"), F.min("label").alias("label"))
    reps = cut(alike)
    facts = reps.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("longest")).first()
    chosen = fit_pivots(reps.select(F.col("rep").alias("id"), "v"), facts["n"], facts["longest"], pivots)
    n = shuffle_partitions(spark)
    near = cut(permutations(reps.select("rep", "copies", "label", "v"), chosen, k))
    # lists are dealt out without the vectors, which are fetched last
    postings = near.select("rep", "label", F.explode("near").alias("p"), "near").select("rep", "label", "p", F.explode("near").alias("q")).filter("p < q").withColumn("list", F.xxhash64("label", "p", "q"))
    lists = postings.groupBy("list").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select(fresh_key("list"), F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    placed = postings.join(lists, "list")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    part = F.pmod(F.col("list") % F.lit(n) + F.col("i") * F.col("blocks") + F.col("j"), F.lit(n)).cast("int")
    placed = placed.select("list", "p", "q", "i", "j", "own", "rep", part.alias("part")).join(near, "rep")
    placed = placed.select("list", "p", "q", "i", "j", "label", "own", "rep", "copies", "near", "v", "part").repartitionById(n, F.col("part")).drop("part").sortWithinPartitions("list", "label", "p", "q", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            key, held = None, []
            for b in batches:
                names = ["list", "label", "p", "q", "i", "j"]
                keys = list(zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in names), strict=True))
                start = 0
                for at in range(1, len(keys) + 1):
                    if at == len(keys) or keys[at] != keys[start]:
                        if keys[start] != key and held:
                            yield key, held
                            held = []
                        key = keys[start]
                        held.append(b.slice(start, at - start))
                        start = at
            if held:
                yield key, held

        out: list[np.ndarray] = []
        for (_, _, p, q, i, j), held in groups():
            t = pa.Table.from_batches(held).combine_chunks()
            if t.num_rows < 2:
                continue
            near_, _ = matrix(t.column("near").chunk(0))
            mine = owned(near_, t.column("own").to_numpy(), i == j, p, q)
            if not mine.any():  # in a dense group, other lists own the pairs
                continue
            m, _ = matrix(t.column("v").chunk(0))
            rep, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
            link = linked(m, mine, threshold)
            has = np.flatnonzero(link.any(axis=1))
            if len(has):
                root = np.arange(len(rep))
                for x, r in _forest(link):
                    root[x] = r
                out.append(np.stack([rep[has], link[has] @ copies, rep[root[has]]], axis=1))
            if sum(map(len, out)) > 50_000:
                yield as_batch(out)
                out = []
        if out:
            yield as_batch(out)

    def as_batch(parts):
        m = np.concatenate(parts)
        return pa.RecordBatch.from_arrays([pa.array(m[:, c], pa.int64()) for c in range(3)], names=["rep", "links", "root"])

    found = cut(placed.mapInArrow(run, "rep long, links long, root long"))
    degree = found.groupBy("rep").agg(F.sum("links").alias("links")).select(F.col("rep").alias("d_rep"), "links")
    classes = connected_components(found, "rep", "root", "c_rep", "component")
    of_rep = reps.join(degree, reps["rep"] == degree["d_rep"], "left").join(classes, reps["rep"] == classes["c_rep"], "left")
    of_rep = of_rep.select(fresh_key("k1"), "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = rows.withColumn("k2", F.when(F.col("ok"), F.col("k2"))).join(of_rep, ["k1", "k2"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


#: What the index has to find, in DuckDB, by comparing all pairs.
EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
c AS (SELECT vec_id AS id, vec_id AS reached FROM embeddings UNION SELECT c.id, l.b FROM c JOIN l ON l.a = c.reached),
m AS (SELECT id, min(reached) AS component_id FROM c GROUP BY id), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN m ON id = vec_id LEFT JOIN n ON a = vec_id
"""
