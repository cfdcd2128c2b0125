"""Clustering around centroids by a tournament of bisectors, in whole numbers.

The points nearer to centroid b than to centroid a lie beyond a plane, the
bisector: with the normal 2 (b - a) and the threshold |b|^2 - |a|^2, a vector
is nearer to b exactly if its product with the normal exceeds the threshold.
So the nearest of k centroids is what is left after k - 1 tests of a sign, each
of which eliminates a loser; on the plane itself the smaller number stays.
Only the winner's distance is worked out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Vectors that one step of a task works on.
BLOCK = 4096
#: A component lies within this bound, so that squared distances of 64 components (and products with normals) fit in 64 bits.
LARGEST = 1 << 27


def whole_vectors(df: DataFrame, key: str, features: str, dim: int, scale: float) -> DataFrame:
    """vec_id, v (array<long>): floor(scale * x) of every component of the vectors with exactly `dim` components, none null or not finite.

    A component beyond LARGEST raises: its distances would not fit in a long.
    """
    x = F.col(features)
    fit = (F.size(x) == dim) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    bound = lambda c: F.when(F.abs(c) <= LARGEST, c.cast("long")).otherwise(F.raise_error(F.lit("a component is too large for whole-number distances")).cast("long"))
    return df.filter(F.coalesce(fit, F.lit(False))).select(F.col(key).alias("vec_id"), F.transform(x, lambda c: bound(F.floor(c.cast("double") * scale).cast("double"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of the least SHA-256 of `salt:vec_id` (ties: of the least components), fewer if there are not as many; null ids come last."""
    rows = vectors.withColumn("h", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["v"] for r in rows.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).select("v").collect()], dtype=np.int64)


class Bisectors:
    """The planes between every two of k centroids: k (k - 1) / 2 normals and thresholds."""

    def __init__(self, centroids: np.ndarray):
        self.k = len(centroids)
        square = (centroids * centroids).sum(axis=1)
        low, high = np.triu_indices(self.k, 1)
        self.normal, self.threshold = 2 * (centroids[high] - centroids[low]), square[high] - square[low]
        self.centroids = centroids
        self.row = np.zeros((self.k, self.k), dtype=np.int64)
        self.row[low, high] = np.arange(len(low))

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of each vector's nearest centroid; ties go to the smaller number."""
        best = np.zeros(len(x), dtype=np.int64)
        for challenger in range(1, self.k):
            plane = self.row[best, challenger]
            beyond = np.einsum("ij,ij->i", x, self.normal[plane]) > self.threshold[plane]
            best[beyond] = challenger
        return best

    def distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        gap = x - self.centroids[at]
        return np.einsum("ij,ij->i", gap, gap)


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            v = part.column(part.schema.get_field_index("v"))
            yield part, v.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared) of every vector."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        for part, x in _blocks(batches, dim):
            at = planes.nearest(x)
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("vec_id")), pa.array(at, pa.int32()), pa.array(planes.distance(x, at))], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid after one round: floor(sum / count) of its vectors' components; one without vectors stays.

    A task adds up its vectors and sends a row for each centroid at most; these
    are added by cluster, and what comes to the driver is k rows.
    """
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, total, count = Bisectors(centroids), np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, x in _blocks(batches, dim):
            at = planes.nearest(x)
            order = np.argsort(at, kind="stable")
            there, starts = np.unique(at[order], return_index=True)
            total[there] += np.add.reduceat(x[order], starts, axis=0)
            count += np.bincount(at, minlength=k)
        there = np.flatnonzero(count)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(there) + 1) * dim, pa.int32()), pa.array(total[there].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(count[there]), sums], names=["cluster", "n", "total"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(dim)])
    out = centroids.copy()
    for r in sums.collect():
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
    return out


def centroid_clusters(df: DataFrame, key: str = "vec_id", features: str = "embedding", k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, salt: str = "2") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector with `dim` numbers, in whole numbers and the same on every run.

    Vectors of another length, null ones and those with a null or non-finite
    component are left out, as they have no distance.  A null id is a vector as
    any other, but begins no centroid unless there are fewer than k others;
    repeated rows count each.  With fewer than k vectors there are as many
    centroids; an empty table gives an empty table.  Other columns are ignored.
    The vectors are read once a round and never shuffled; the centroids
    (k x dim numbers) go out with the tasks, which work out k (k - 1) / 2
    normals from them, so k is meant to be some hundreds at most.
    """
    vectors = whole_vectors(df, key, features, dim, scale)
    centroids = first_centroids(vectors, k, salt)
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    rows = cut(assigned(vectors, centroids))
    inertia = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    names = [",".join(map(str, c)) for c in centroids.tolist()]
    facts = spark.createDataFrame([(i, d, sum(inertia.values()), names[i]) for i, d in inertia.items()], "cluster int, cluster_inertia long, inertia long, name string")
    facts = facts.withColumn("centroid_sha256", F.sha2("name", 256)).drop("name")
    # k rows
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clusters_sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2") -> str:
    """The same in DuckDB: every distance to every centroid, round by round."""
    sql = [
        f"x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS v FROM embeddings"
        f" WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS c, v FROM x ORDER BY sha256('{salt}:' || vec_id) LIMIT {k})",
    ]
    for n in range(rounds + 1):
        near = "list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))::BIGINT"
        sql.append(f"a{n} AS MATERIALIZED (SELECT r, min(struct_pack(d := {near}, c := c.c)) AS m FROM x CROSS JOIN c{n} c GROUP BY r)")
        if n < rounds:
            sums = f"SELECT m.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{n} JOIN x USING (r), range(1, {dim + 1}) t(i) GROUP BY ALL"
            # the floor of a quotient of whole numbers
            sql.append(f"s{n} AS (SELECT c, list((s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY i) AS v FROM ({sums}) GROUP BY c)")
            sql.append(f"c{n + 1} AS MATERIALIZED (SELECT o.c, coalesce(s.v, o.v) AS v FROM c{n} o LEFT JOIN s{n} s USING (c))")
    return (
        "WITH " + ",\n".join(sql) + f"\nSELECT vec_id, m.c::INTEGER AS cluster, m.d AS distance, sum(m.d) OVER (PARTITION BY m.c)::BIGINT AS cluster_inertia, sum(m.d) OVER ()::BIGINT AS inertia,"
        f" sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} JOIN x USING (r) JOIN c{rounds} c ON c.c = m.c"
    )
