"""Connected components of a link table: forests inside partitions, and jumps to the parents' parents between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_key

#: Links that a task gathers before it replaces them by the forest of what it has.
GATHERED = 1 << 21


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node of the links u - v that is not the least of its component."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while len(a):
        # the greater root of a link hooks on to the lesser one, then every node learns its new root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        live = a != b
        a, b = a[live], b[live]
    below = np.flatnonzero(root != np.arange(len(ids)))
    return ids[below], ids[root[below]]


def _checksum(u: np.ndarray, v: np.ndarray) -> int:
    mixed = (u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (v.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return int(((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)).sum(dtype=np.uint64))


def _forests(links: DataFrame) -> DataFrame:
    """u, v (a node and the least node it reaches by the links of its partition), moved: the partition's links were not such a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new, n, total = [np.empty((2, 0), np.int64)], 0, 0, 0
        for batch in batches:
            u, v = (batch.column(c).to_numpy().astype(np.int64) for c in (0, 1))
            held.append(np.stack([u, v]))
            new, n, total = new + len(u), n + len(u), total + _checksum(u, v)
            if new > GATHERED:
                held, new = [np.stack(forest(*np.concatenate(held, axis=1)))], 0
        u, v = forest(*np.concatenate(held, axis=1))
        moved = n != len(u) or total % (1 << 64) != _checksum(u, v)
        for at in range(0, len(u), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(u[part]), pa.array(v[part]), pa.array(np.full(len(u[part]), moved))], names=["u", "v", "moved"])

    return links.select("u", "v").mapInArrow(run, "u long, v long, moved boolean")


def connected_components(links: DataFrame, a: str, b: str, node: str = "node", component: str = "component", rounds: int = 60) -> DataFrame:
    """One row per node of `links` (columns `a`, `b`: long ids) with the least id that links reach from it.

    A round brings the links of each greater node together, puts the forest of
    a partition in the place of its links, and lets every node jump to its
    root's root.  A node with a third of all links is no hot key: before the
    first round each task has left one link of it for each of its neighbours
    that is greater, and these lie by the neighbour; the jump is a join that
    can be split.  A round is one checkpoint in the shared folder and one look
    whether anything moved; nothing else reaches the driver.  Nulls and
    self-links are ignored; an empty table gives no rows.
    """
    cur = cut(_forests(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u != v")))
    for _ in range(rounds):
        grown = _forests(cur.repartition("u"))
        parent = grown.groupBy("u").agg(F.min("v").alias("above")).select(fresh_key("u").alias("v"), "above")
        cur = cut(grown.join(parent, "v", "left").select("u", F.coalesce("above", "v").alias("v"), (F.col("moved") | F.col("above").isNotNull()).alias("moved")))
        if not cur.agg(F.bool_or("moved")).first()[0]:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = cur.select(F.col("v").alias("u")).distinct()
    return cur.select("u", "v").unionByName(roots.select("u", F.col("u").alias("v"))).select(F.col("u").alias(node), F.col("v").alias(component))
