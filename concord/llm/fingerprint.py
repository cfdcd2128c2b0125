"""Quartile bucket digests of texts, compared by a bounded difference score.

Byte triplets of a sliding window are hashed into 128 buckets.  A digest holds
the length (logarithmic), the ratios of the bucket quartiles, and for every
bucket the quartile that its count falls in.  Digests of like texts differ in
few buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, shuffle_partitions

BUCKETS = 128
#: Window offsets of the triplets that are counted.  Spread ones tell texts of one language apart better than adjacent bytes do.
TRIPLETS = ((0, 1, 3), (0, 2, 4))
#: Mean difference of two digests whose buckets have nothing to do with each other: likeness 0.
UNRELATED = 1.625 * BUCKETS


def digests(texts: list[bytes]) -> np.ndarray:
    """One row per text: length code, two quartile ratios, then the quartile (0 to 3) of each bucket."""
    n = len(texts)
    out = np.zeros((n, 3 + BUCKETS), dtype=np.uint8)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    # five zero bytes between texts; windows that reach beyond their text are left out
    flat = np.frombuffer(b"\0\0\0\0\0".join(texts) + b"\0" * 5, dtype=np.uint8).astype(np.uint32)
    begin = np.r_[0, np.cumsum(size + 5)[:-1]] if n else np.empty(0, np.int64)
    owner = np.repeat(np.arange(n, dtype=np.int64), size + 5)
    place = np.arange(len(flat)) - np.repeat(begin, size + 5)
    left = np.repeat(size, size + 5) - place
    count = np.zeros(n * BUCKETS, dtype=np.int64)
    base = owner * BUCKETS
    for k, (a, b, c) in enumerate(TRIPLETS):
        m = len(flat) - 4
        h = (flat[a : m + a] * np.uint32(0x9E3779B1)) ^ (flat[b : m + b] * np.uint32(0x85EBCA77) + np.uint32(k * 0x27D4EB2F))
        h = (h ^ (flat[c : m + c] * np.uint32(0xC2B2AE3D))) * np.uint32(0x2545F491)
        inside = left[:m] > c
        count += np.bincount(base[:m][inside] + (h[inside] >> 25), minlength=n * BUCKETS)
    count = count.reshape(n, BUCKETS)
    ranked = np.sort(count, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    out[:, 3:] = (count > q1).astype(np.uint8) + (count > q2) + (count > q3)
    out[:, 0] = np.minimum(255, np.round(np.log1p(size) / np.log(1.1)))
    top = np.maximum(q3[:, 0], 1)
    out[:, 1], out[:, 2] = np.minimum(15, 16 * q1[:, 0] // top), np.minimum(15, 16 * q2[:, 0] // top)
    return out


def as_hex(digest: np.ndarray) -> list[str]:
    """Length code (2 hex digits), ratios (1 each), then two bits for each bucket."""
    body = digest[:, 3:].reshape(len(digest), -1, 4)
    packed = (body * np.array([64, 16, 4, 1], dtype=np.uint8)).sum(axis=2, dtype=np.int64).astype(np.uint8)
    return [f"{a:02x}{b:x}{c:x}{row.tobytes().hex()}" for (a, b, c), row in zip(digest[:, :3].tolist(), packed, strict=True)]


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 for those that differ as unrelated ones do, or more."""
    gap = np.abs(x.astype(np.int16) - y)
    body = gap[:, 3:]
    score = (body + 3 * (body == 3)).sum(axis=1) + gap[:, 1] + gap[:, 2] + np.minimum(gap[:, 0], 40)
    return np.maximum(0.0, 1.0 - score / UNRELATED)


def _placed(docs: DataFrame, n: int) -> DataFrame:
    """part, extra, doc_id, text: about `n` ranges of the order of documents, each ending with the first of the next (`extra` > 0).

    Documents go by id; those without one come first, by a hash of their text.
    """
    found = docs.agg(F.count_if(F.col("doc_id").isNull()).alias("none"), F.count(F.lit(1)).alias("n")).first()
    none = F.col("doc_id").isNull()
    keyed = docs.withColumn("k", F.when(none, F.xxhash64("text")).otherwise(F.col("doc_id")) if found["none"] else F.col("doc_id"))
    share = [i / n for i in range(1, n)]
    # quantiles are doubles, which leave gaps between ids above 2^53: they only cut the ids, and the least id of each cut is its bound
    marks = docs.select("doc_id", F.lit(1)).approxQuantile("doc_id", share, 1 / (8 * n)) if share else []
    cuts = np.unique(np.array([min(int(x), (1 << 63) - 1) for x in marks], dtype=np.int64))
    wide = max(1, round(n * found["none"] / max(1, found["n"])))
    hash_cuts = np.array([-(1 << 63) + (1 << 64) * i // wide for i in range(1, wide)], dtype=np.int64)

    def ranges(missing: np.ndarray, k: np.ndarray) -> np.ndarray:
        return np.where(missing, np.searchsorted(hash_cuts, k, side="right"), wide + np.searchsorted(cuts, k, side="right"))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(1).to_numpy()
            at = ranges(batch.column(0).to_numpy(zero_copy_only=False), k)
            low = np.full(wide + len(cuts) + 1, (1 << 63) - 1, dtype=np.int64)
            np.minimum.at(low, at, k)
            used = np.unique(at)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(low[used])], names=["part", "least"])

    lows = keyed.select(none.alias("none"), "k").mapInArrow(least, "part int, least long").groupBy("part").agg(F.min("least").alias("least")).orderBy("part").collect()  # a row for each range
    number = np.zeros(wide + len(cuts) + 1, dtype=np.int64)
    number[[r["part"] for r in lows]] = np.arange(len(lows))
    first_of = np.array([r["least"] for r in lows], dtype=np.int64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 1 << 20):
            k = piece.column(2).to_numpy()
            part = number[ranges(piece.column(0).is_null().to_numpy(zero_copy_only=False), k)]
            begins = k == first_of[part]  # the first document of its range, which is the next one of the range before, too
            row = np.concatenate([np.arange(len(part)), np.flatnonzero(begins)])
            to = np.concatenate([part, (part[begins] - 1) % len(first_of)])
            extra = np.repeat([0, 1], [len(part), int(begins.sum())])
            yield pa.RecordBatch.from_arrays([*piece.take(pa.array(row)).columns, pa.array(to, pa.int32()), pa.array(extra, pa.int32())], names=["doc_id", "text", "k", "part", "extra"])

    rows = keyed.select("doc_id", "text", "k").mapInArrow(dealt, "doc_id long, text string, k long, part int, extra int")
    placed = rows.repartitionById(max(1, len(lows)), F.col("part")).sortWithinPartitions("part", "extra", "k", "text")
    return placed.select("doc_id", "text", "part", "extra")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how like they are.

    The edited text: the last floor(n/4) code points replaced by the first as
    many of the next document by id (of the first, after the last).  A null
    text counts as empty, and texts of any length are read whole.  Rows of one
    id follow each other by text, and lie in one task; null ids come first, by a
    hash of their text.  Texts without a triplet
    have the digest of no counts.  The ids must be whole numbers.  An empty
    table gives an empty table; other columns are ignored.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    placed = _placed(rows, partitions or shuffle_partitions(docs.sparkSession))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None

        def finish(ids: list, texts: list[str], extra: list[int]):
            """Rows of all documents but the last one, which only is the next of the one before."""
            here, following = texts[:-1], texts[1:]
            cuts = [len(t) - len(t) // 4 for t in here]
            edited = [(t[:c] + f[: len(t) - c]).encode() for t, f, c in zip(here, following, cuts, strict=True)]
            own, new = digests([t.encode() for t in texts]), digests(edited)
            keep = np.flatnonzero(np.array(extra[:-1]) == 0)
            names, new_names = as_hex(own[:-1]), as_hex(new)
            a, b = likeness(own[:-1], new), likeness(own[:-1], own[1:])
            cols = [[ids[i] for i in keep], [len(here[i]) for i in keep], [hashlib.sha256(edited[i]).hexdigest() for i in keep], [names[i] for i in keep], [new_names[i] for i in keep], a[keep], b[keep]]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)], names=heads)

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        heads = [f.split(" ")[0] for f in schema.split(", ")]
        for piece in pieces(batches, "text", 1 << 20):
            ids, texts, extra = piece.column(0).to_pylist(), piece.column(1).to_pylist(), piece.column(3).to_pylist()
            if held:
                ids, texts, extra = [held[0], *ids], [held[1], *texts], [held[2], *extra]
            if len(ids) > 1:
                yield finish(ids, texts, extra)
            held = ids[-1], texts[-1], extra[-1]

    return placed.mapInArrow(run, schema)
