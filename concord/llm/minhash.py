"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

Word shingles weigh 1 + ln(count), and in a second signature of texts that
repeat some, 1 each.  Each sends exponential arrivals, at a rate
equal to its weight, to random components of the signature; a component keeps
the shingle that arrives first.  A document stops once its next arrivals come
later than the last of its components was reached (early termination).  The
share of equal components estimates the probability Jaccard similarity; with
weights of 1 that is the Jaccard similarity of the sets, on which links are set.

Documents of equal words form one class first, and the rest works on one
document of each.  Two that share a band are candidates, and every such pair is
decided on whole shingle sets: each document against the least one of each of
its bands first.  Pairs whose ends are then in one class can change nothing, so
a group of near copies of any size is not compared with itself.  The other pairs
of a band are compared in blocks of documents; links inside a block are returned
as a spanning forest, so no group's pairs are ever listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_key, pieces, shuffle_partitions, strings, values
from .components import connected_components

U = np.uint64
_BASE, _BASE2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so they have inverses modulo 2^64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    """Mix the bits of uint64 values."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts (words: runs of other than ASCII white space), and the number of words of each text."""
    flat = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[flat]
    start = np.flatnonzero(~space & np.r_[True, space[:-1]])
    stop = np.flatnonzero(space & np.r_[False, ~space[:-1]])
    total = np.r_[U(0), np.cumsum((flat.astype(U) + U(1)) * _powers(_BASE, len(flat)), dtype=U)]
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(flat))
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    count = np.diff(np.r_[0, np.searchsorted(start, ends)])
    return scramble((total[stop] - total[start]) * inverse[start] + (stop - start).astype(U)), count


def shingle_sets(words: np.ndarray, count: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times) of every distinct shingle of `k` words, ordered; a text of fewer words is one shingle."""
    doc = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count)
    left = np.repeat(count, count) - nth
    h = np.zeros(len(words), dtype=U)
    for j in range(k):
        part = np.zeros(len(words), dtype=U)
        part[: len(words) - j] = words[j:]
        part[left <= j] = 0
        h += part * U(_powers(_BASE2, k)[j]) + U(j)
    own = (left >= k) | (nth == 0)
    doc, h = doc[own], scramble(h[own])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.empty(0, np.int64)
    return doc[new], h[new], np.diff(np.r_[new, len(h)])


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """ProbMinHash signature (n x m shingles) of `n` texts; texts without shingles get zeros."""
    first = np.full(n * m, np.inf)
    who = np.zeros(n * m, dtype=U)
    size = np.bincount(doc, minlength=n)
    alone = size[doc] == 1  # a single shingle reaches every component
    who.reshape(n, m)[doc[alone]] = shingle[alone][:, None]
    live = np.flatnonzero(~alone)
    state, at = shingle[live], np.zeros(len(live))
    while len(live):
        steps = 1 if len(live) > 20_000 else 8  # few are left: several arrivals at a time
        for _ in range(steps):
            state = scramble(state + U(0x9E3779B97F4A7C15))
            at = at - np.log1p(-((state >> U(11)).astype(np.float64) * 2.0**-53)) / weight[live]
            slot = doc[live] * m + ((scramble(state ^ U(0xA5A5A5A5)) >> U(32)) * U(m) >> U(32)).astype(np.int64)
            sooner = np.flatnonzero(at < first[slot])
            if len(sooner):
                np.minimum.at(first, slot[sooner], at[sooner])
                won = sooner[first[slot[sooner]] == at[sooner]]
                who[slot[won]] = shingle[live[won]]
        last = first.reshape(n, m).max(axis=1)
        on = np.flatnonzero(at < last[doc[live]])
        live, state, at = live[on], state[on], at[on]
    return who.reshape(n, m)


def bands(signature: np.ndarray, b: int, r: int) -> np.ndarray:
    """One hash for each band of `r` components (n x b, signed)."""
    part = signature.reshape(len(signature), b, r)
    h = np.arange(1, b + 1, dtype=U) * U(_BASE)
    h = np.broadcast_to(h, part.shape[:2])
    for j in range(r):
        h = scramble(h * U(_BASE2) + part[:, :, j])
    return h.view(np.int64)


def describe(docs: DataFrame, k: int, b: int, r: int) -> DataFrame:
    """doc_id, words, k1, k2 (key of the word sequence), bands of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 1 << 20):
            words, count = word_hashes([t.encode() for t in strings(piece)])
            n = len(count)
            nth = np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count)
            top = int(count.max(initial=0))
            ends = np.r_[0, np.cumsum(count)]
            keys = []
            for base in (_BASE, _BASE2):
                run_sum = np.r_[U(0), np.cumsum(words * _powers(base, top)[nth], dtype=U)]
                keys.append(scramble(run_sum[ends[1:]] - run_sum[ends[:-1]] + count.astype(U)).view(np.int64))
            doc, shingle, times = shingle_sets(words, count, k)
            rows = [x if c else None for x, c in zip(bands(signatures(doc, shingle, np.ones(len(doc)), n, b * r), b, r), count.tolist(), strict=True)]
            again = np.unique(doc[times > 1])  # in all other texts the weights are equal, and the signatures too
            own = np.isin(doc, again)
            weighted = bands(signatures(np.searchsorted(again, doc[own]), shingle[own], 1 + np.log(times[own]), len(again), b * r), b, r)
            for i, x in zip(again.tolist(), weighted, strict=True):
                rows[i] = np.unique(np.r_[rows[i], x])
            yield pa.RecordBatch.from_arrays([values(piece, "doc_id"), pa.array(count, pa.int64()), pa.array(keys[0]), pa.array(keys[1]), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "words", "k1", "k2", "bands"])

    return docs.mapInArrow(run, "doc_id long, words long, k1 long, k2 long, bands array<long>")


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """(node, root) for the components of a boolean link matrix."""
    n, seen, out = len(link), np.zeros(len(link), dtype=bool), []
    for root in np.flatnonzero(link.any(axis=1)).tolist():
        if seen[root]:
            continue
        group = np.zeros(n, dtype=bool)
        group[root] = True
        edge = group
        while edge.any():
            edge = link[edge].any(axis=0) & ~group
            group = group | edge
        seen |= group
        out += [(x, root) for x in np.flatnonzero(group).tolist() if x != root]
    return out


def verified(sets: list[np.ndarray], side: np.ndarray, within: bool, threshold: float) -> list[tuple[int, int]]:
    """Spanning forest of the pairs (of one side each, or `within` one block) whose shingle sets have Jaccard >= threshold."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.float64)
    owner, flat = np.repeat(np.arange(n), size.astype(np.int64)), np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(new) - 1
    common = np.bincount(column)[column] > 1
    owner, column = owner[common], np.unique(column[common], return_inverse=True)[1]
    inter = np.zeros((n, n), dtype=np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):  # so many shingles at a time
        a, z = np.searchsorted(column, [lo, lo + width])
        m = np.zeros((n, width), dtype=np.float32)
        m[owner[a:z], column[a:z] - lo] = 1
        inter += m @ m.T
    link = inter >= threshold * (size[:, None] + size - inter) - 1e-9
    link &= (inter > 0) & ~np.eye(n, dtype=bool)
    if not within:
        link &= side[:, None] != side
    return _forest(link)


def near_duplicate_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, threshold: float = 0.8, b: int = 24, r: int = 7, block: int = 128) -> DataFrame:
    """doc_id, words, class_id (least id of the class), kept (doc_id = class_id) of every document.

    A class holds the documents that links reach from each other; a link is a
    Jaccard similarity of `threshold` or more of the sets of `k`-word shingles
    (fewer words: the whole text is one shingle).  Candidates share one of `b`
    bands of `r` signature components, of the sets or of the weighted shingles;
    with 24 x 7, a pair at 0.8 is one with probability 0.996 by the sets alone.
    Nothing is capped, and texts of any length are read whole.  Texts that are
    null or without words are alone in their class.  Ids are whole numbers;
    rows that share an id count as one document and get the same class; null
    ids are left out.  An empty table gives an empty table, and other columns
    of `docs` are ignored, whatever their names.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).filter("doc_id is not null")
    n = shuffle_partitions(docs.sparkSession)
    seen = cut(describe(rows, k, b, r))
    same = seen.filter("words > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"))
    reps = cut(same)
    # the documents of each band that has several, beside the least of them
    banded = reps.select("rep", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(fresh_key("band"), "least")
    members = cut(banded.join(least, "band").select("band", "rep", "least"))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had: set[tuple[int, int]] = set()  # a row that is repeated gives one set

        def fresh(key) -> bool:
            return not (key in had or had.add(key))

        for piece in pieces(batches, "text", 1 << 20):
            piece = piece.filter(pa.array([fresh(x) for x in zip(values(piece, "rep").to_pylist(), map(hash, strings(piece)), strict=True)], pa.bool_()))
            if not piece.num_rows:
                continue
            words, count = word_hashes([t.encode() for t in strings(piece)])
            doc, h, _ = shingle_sets(words, count, k)
            parts = np.split(h.view(np.int64), np.cumsum(np.bincount(doc, minlength=len(count)))[:-1])
            yield pa.RecordBatch.from_arrays([values(piece, "rep"), pa.array(parts, pa.list_(pa.int64()))], names=["rep", "sets"])

    wanted = members.select("rep").distinct().select(fresh_key("rep"))
    sets = cut(rows.join(wanted, rows["doc_id"] == wanted["rep"]).select("rep", "text").mapInArrow(shingled, "rep long, sets array<long>"))
    # each document against the least one of each of its bands
    pairs = members.filter("rep != least").select("rep", "least").distinct()
    lead = sets.select(fresh_key("rep").alias("least"), F.col("sets").alias("lead"))
    shared = F.size(F.array_intersect("sets", "lead"))
    alike = shared >= threshold * (F.size("sets") + F.size("lead") - shared) - 1e-9
    judged = cut(pairs.join(sets, "rep").join(lead, "least").select("rep", "least", alike.alias("alike")))
    linked = judged.filter("alike").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    classes = cut(connected_components(linked, "a", "b", "c_rep", "class"))
    # what is left: pairs that share a band, neither of them its least, and are in different classes.  A band's core are
    # those in the class of its least, within which nothing is left to compare; the others go against all, in blocks
    class_of = classes.select(fresh_key("c_rep"), "class")
    of_least = class_of.select(F.col("c_rep").alias("least"), F.col("class").alias("least_class"))
    others = members.filter("rep != least").join(class_of, F.col("rep") == F.col("c_rep"), "left").drop("c_rep").join(of_least, "least", "left")
    others = others.select("band", "rep", F.coalesce("class", "rep").alias("class"), F.coalesce("least_class", "least").alias("least_class")).withColumn("core", F.col("class") == F.col("least_class"))
    n_core, n_rest = F.count_if("core"), F.count_if(~F.col("core"))
    blocks_of = lambda c: F.ceil(c / block).cast("int")
    counts = others.groupBy("band").agg(blocks_of(n_core).alias("cores"), blocks_of(n_rest).alias("rests"), (F.min("class") != F.max("class")).alias("several"))
    counts = counts.filter("rests > 0 and several").select(fresh_key("band"), "cores", "rests")
    h, blocks = F.xxhash64("rep"), F.col("cores") + F.col("rests")
    placed = others.join(counts, "band").withColumn("own", F.when(F.col("core"), F.pmod(h, F.col("cores"))).otherwise(F.col("cores") + F.pmod(h, F.col("rests"))).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.when(F.col("core"), F.col("cores")).otherwise(F.lit(0)), blocks - 1)))
    placed = placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    placed = placed.join(sets.select(fresh_key("rep"), "sets"), "rep")
    part = F.pmod(F.xxhash64("band", "i", "j"), F.lit(n)).cast("int")
    placed = placed.select("band", "i", "j", "own", "rep", "class", "sets").repartitionById(n, part).sortWithinPartitions("band", "i", "j")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            key, held = None, []
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
                cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                for a, z in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                    if tuple(keys[a]) != key and held:
                        yield key, held
                        held = []
                    if z > a:
                        key = tuple(keys[a])
                        held.append(batch.slice(a, z - a))
            if held:
                yield key, held

        out: list[tuple[int, int]] = []
        for key, held in groups():
            table = pa.Table.from_batches(held).combine_chunks()
            if table.num_rows < 2:
                continue
            rep, own, group = (table.column(c).to_numpy() for c in ("rep", "own", "class"))
            if (group == group[0]).all():
                continue
            lists = table.column("sets").chunk(0)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            each = [flat[a:z] for a, z in zip(offsets, offsets[1:], strict=False)]
            out += [(int(rep[x]), int(rep[y])) for x, y in verified(each, own, key[1] == key[2], threshold)]
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array([p[s] for p in out], pa.int64()) for s in (0, 1)], names=["a", "b"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([p[s] for p in out], pa.int64()) for s in (0, 1)], names=["a", "b"])

    more = cut(placed.mapInArrow(links, "a long, b long"))
    if not more.isEmpty():
        classes = connected_components(more.unionByName(classes.select(F.col("c_rep").alias("a"), F.col("class").alias("b"))), "a", "b", "c_rep", "class")
    exact = reps.select(fresh_key("k1"), "k2", "rep")
    out = seen.select("doc_id", "words", "k1", "k2").join(exact.withColumn("some", F.lit(True)), ["k1", "k2"], "left")
    out = out.withColumn("rep", F.when(F.col("words") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")))
    out = out.join(classes, out["rep"] == classes["c_rep"], "left").withColumn("class_id", F.coalesce("class", "rep"))
    return out.select("doc_id", "words", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **parameters) -> DataFrame:
    """The documents without those that have an earlier near duplicate: one of each class stays.  Null ids stay.

    Different texts of one id are documents of their own, the one of the least digest first.
    """
    number, digest = docs[doc_id].cast("long"), F.md5(F.coalesce(docs[text], F.lit("")))
    texts = docs.select(number.alias("__id"), digest.alias("__digest")).filter("__id is not null")
    if texts.groupBy("__id").agg((F.min("__digest") != F.max("__digest")).alias("several")).filter("several").isEmpty():
        classes = near_duplicate_classes(docs, text, doc_id, **parameters)
        gone = cut(classes.filter("not kept").select(F.col("doc_id").alias("__gone")))
        # null ids are dealt out by their texts; they match nothing
        return docs.join(gone, (F.coalesce(number, F.xxhash64(docs[text])) == F.col("__gone")) & number.isNotNull(), "left_anti")
    # numbers in the order of the ids, one for each text of an id
    order = texts.distinct().repartitionByRange(shuffle_partitions(docs.sparkSession), "__id", "__digest").sortWithinPartitions("__id", "__digest")
    order = cut(order.withColumn("__no", F.monotonically_increasing_id()))
    rows = docs.join(order, (number == F.col("__id")) & (digest == F.col("__digest"))).select("__no", docs[text].alias("__text"))
    classes = near_duplicate_classes(rows, "__text", "__no", **parameters)
    gone = cut(classes.filter("not kept").select("doc_id").distinct().join(order, F.col("doc_id") == F.col("__no")).select("__id", "__digest"))
    return docs.join(gone, (number == F.col("__id")) & (digest == F.col("__digest")), "left_anti")


#: What the bands have to find, in DuckDB, from all pairs of documents that share a shingle (equal word sequences once).
CLASSES_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\r\f\v]+'), lambda w: w <> '') AS w FROM documents),
e AS (SELECT w, min(doc_id) AS rep FROM d WHERE len(w) > 0 GROUP BY w),
s AS (SELECT DISTINCT rep, array_to_string(w[i:i + 4], ' ') AS h FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM e)),
n AS (SELECT rep, count(*) AS n FROM s GROUP BY rep),
x AS (SELECT a.rep AS a, b.rep AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.rep < b.rep GROUP BY a.rep, b.rep),
k AS (SELECT a, b FROM x JOIN n p ON p.rep = a JOIN n q ON q.rep = b WHERE c >= 0.8 * (p.n + q.n - c)),
l AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
r AS (SELECT rep AS id, rep AS reached FROM e UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reached),
m AS (SELECT id, min(reached) AS class FROM r GROUP BY id)
SELECT doc_id, len(d.w)::BIGINT AS words, coalesce(class, doc_id) AS class_id, doc_id = coalesce(class, doc_id) AS kept FROM d LEFT JOIN e ON e.w = d.w LEFT JOIN m ON m.id = e.rep
"""
