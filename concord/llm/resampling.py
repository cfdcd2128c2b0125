"""Importance resampling towards a target distribution, over hashed word runs.

The words of a slice of texts are found in one pass: the texts are joined with
a separator that no word can hold, one regex runs over all of it, and binary
search over the documents' offsets tells each word's document.  A run of words
that crosses from one document to the next is masked out before counting.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, pieces, shuffle_partitions, strings

#: A word over UTF-8: ASCII digits, small letters (the text has been lower-cased) and all characters beyond ASCII.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Words that a task holds as Python objects at a time, so that a text of any length takes little more than itself.
STEP_WORDS = 1 << 16
#: Stands between the texts of a slice; no word holds it.
SENTINEL = b"\x00"


def hashed_runs(texts: Sequence[str], runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, document of every feature, words of each document) of the texts of a slice.

    Features are all runs of 1 to `runs` consecutive words of a document,
    joined by one space; the CRC of a run goes on from that of the run without
    its last word.
    """
    raw = [t.encode().translate(LOWER) for t in texts]
    offsets = np.cumsum([0, *[len(t) + len(SENTINEL) for t in raw]], dtype=np.int64)
    matches = WORDS.finditer(SENTINEL.join(raw))
    found, owner, n_words = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(len(texts), np.int64)
    held: list[re.Match] = []  # the last words before a step, with which runs go on
    while step := [*islice(matches, STEP_WORDS)]:
        block = held + step
        words = [m.group() for m in block]
        document = np.searchsorted(offsets, np.array([m.start() for m in block], np.int64), side="right") - 1
        n_words += np.bincount(document[len(held) :], minlength=len(texts))
        crc, spaced = [*map(crc32, words)], [b" " + w for w in words]
        for n in range(runs):
            if n:
                crc = [*map(crc32, spaced[n:], crc)]
            last = document[n:]
            inside = last == document[: len(document) - n]
            inside[: max(0, len(held) - n)] = False  # counted in the step before
            found.append(np.array(crc, np.int64)[inside])
            owner.append(last[inside])
        held = block[len(block) - min(len(block), runs - 1) :]
    return np.concatenate(found) % buckets, np.concatenate(owner), n_words


def bucket_counts(df: DataFrame, text: str, runs: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket.  A task adds up its own and sends a row for each of its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in pieces(batches, "text"):
            total += np.bincount(hashed_runs(strings(piece), runs, buckets)[0], minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], names=["bucket", "n"])

    rows = df.select(F.col(text).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of how much likelier each bucket is in the target), with one more feature in every bucket of both."""
    s, t, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, text: str, runs: int) -> DataFrame:
    """The table with n_features, n_words and weight (floored mean of the gains of a text's features; without any: 0)."""
    from pyspark.sql.types import LongType, StructType

    new = ["n_features", "n_words", "weight"]
    base = docs.drop(*new)
    schema = StructType([*base.schema.fields])
    for name in new:
        schema = schema.add(name, LongType(), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            n = piece.num_rows
            bucket, owner, words = hashed_runs(strings(piece, text), runs, len(gain))
            features = np.bincount(owner, minlength=n)
            # sums of whole numbers, exact in doubles up to 2^53
            total = np.bincount(owner, gain[bucket].astype(np.float64), minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*piece.columns, *[pa.array(x, pa.int64()) for x in (features, words, total // np.maximum(features, 1))]], names=[*piece.schema.names, *new])

    return base.mapInArrow(run, schema)


def drawn_score(weight: Column, doc_id: Column, seed: str) -> Column:
    """The weight with Gumbel noise from the document's id: the highest scores are a draw without replacement by weight (null id: as an empty one)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", runs: int = 2, buckets: int = 10_000, seed: str = "7") -> DataFrame:
    """The table with n_features, n_words, weight, score (columns of these names are replaced): how much likelier each text is in the target.

    Counts cover all texts of both tables.  A null or empty text has no
    features and the weight 0.  What leaves the tasks is a row for each bucket;
    what goes out again is a number for each bucket.
    """
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, text, runs, buckets))
    out = weighed(docs.drop("score"), gain, text, runs)
    return out.withColumn("score", drawn_score(F.col("weight"), F.col(doc_id), seed))


def ranked(scores: DataFrame, doc_id: str, share: int, min_words: int) -> DataFrame:
    """scores with `rank`: 1, 2, ... for the `share` percent (floored) of the texts of `min_words` words or more that score highest, ties to the smaller id; else null.

    Rows are cut into ranges of the order, counted, and numbered inside a range
    on from the counts of those before it.
    """
    fit = F.col("n_words") >= min_words
    order = [fit.desc(), F.col("score").desc(), F.col(doc_id).asc_nulls_last(), F.col("n_features"), F.col("weight")]
    parts = cut(scores.repartitionByRange(shuffle_partitions(scores.sparkSession), *order).withColumn("__part", F.spark_partition_id()))
    # one row a range
    totals = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.count_if(fit).alias("__fit"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select("__part", before.alias("__before"), F.floor(F.sum("__fit").over(Window.partitionBy()) * share / 100).alias("__drawn"))
    at = F.col("__before") + F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    placed = parts.join(F.broadcast(totals), "__part").withColumn("__at", at)
    return placed.withColumn("rank", F.when(fit & (F.col("__at") <= F.col("__drawn")), F.col("__at"))).drop("__part", "__before", "__drawn", "__at")


def resampled(docs: DataFrame, target: DataFrame, share: int = 25, min_words: int = 20, text: str = "text", doc_id: str = "doc_id", **features) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document: an importance sample of `share` percent towards the target's words.

    Repeated rows are documents each; equal ones take ranks beside each other.
    A null id is drawn as an empty one and comes last among equal scores.  An
    empty table gives an empty table; an empty target has equal buckets.
    """
    rows = importance(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), target.select(F.col(text).alias("text")), **features)
    # a few numbers for each text, kept, as the ranges are drawn from them first
    scores = cut(rows.select("doc_id", "n_features", "n_words", "weight", "score"))
    return ranked(scores, "doc_id", share, min_words).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, share: int = 25, min_words: int = 20, text: str = "text", doc_id: str = "doc_id", **features) -> DataFrame:
    """The drawn documents with all their columns and n_features, n_words, weight, score (replaced): texts are scored again in place of a shuffle.

    Rows that share the last drawn row's score and id are drawn with it.
    """
    last = resampled(docs, target, share, min_words, text, doc_id, **features).filter("rank is not null").orderBy(F.col("rank").desc()).limit(1).collect()
    rows = importance(docs, target, text, doc_id, **features)
    if not last:
        return rows.filter(F.lit(False))
    score, least = F.col("score"), F.lit(last[0]["doc_id"])
    upto = F.lit(True) if last[0]["doc_id"] is None else F.coalesce(F.col(doc_id) <= least, F.lit(False))
    return rows.filter((F.col("n_words") >= min_words) & ((score > last[0]["score"]) | ((score == last[0]["score"]) & upto)))


#: The same in DuckDB for the default parameters; CRC-32 byte by byte from its table, which follows from the polynomial.
RESAMPLING_SQL = r"""
WITH RECURSIVE steps AS (SELECT n, n AS c, 0 AS k FROM range(256) t(n) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8),
texts AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 't', -row_number() OVER (), NULL, text FROM benchmark),
w AS MATERIALIZED (SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS MATERIALIZED (SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM w),
h AS (SELECT x, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM f)),
b AS MATERIALIZED (SELECT x, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) % 10000 AS b FROM h, crc),
n AS (SELECT b, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM f JOIN b USING (x) GROUP BY b),
g AS MATERIALIZED (SELECT b, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS g FROM n),
m AS (SELECT r, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN b USING (x) JOIN g USING (b) WHERE side = 'd' GROUP BY r),
z AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM w LEFT JOIN m USING (r) WHERE side = 'd'),
y AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM z),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM o
"""
