"""Line dedup by a log-template tree of fixed depth.

A line is parsed down a tree: token count, its leading tokens, then the rest of
its tokens in a fixed number of segments.  Tokens that hold a digit are
variable fields; and at the last level each segment has, beside its own branch,
a branch that takes any tokens, so a line follows one path as it stands and one
for every segment left variable.  The end of a path is a template, if enough of
it is constant words: what is mostly numbers, signs or a word or two is no
template.  Lines that differ in one variable stretch meet at the template that
leaves it open.  Counting documents at templates is a plain aggregation, so no
group of lines has to be brought together.  Templates of many words recur once
they are in some documents, those of few words only if they are in a share of
all; of what is in fewer, only long passages recur, as they stand, and only in
documents that are no copies.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_key, pieces, strings, values

FIELD = "<*>"
#: A token with a digit is variable, one with a letter and no digit is a word; what has neither is a sign.
DIGIT, LETTER = re.compile(r"\d"), re.compile(r"[^\W\d_]")
SIGNS = re.compile(r"(?<!\S)(?:[^\w\s]|_)+(?!\S)")


class Rules(NamedTuple):
    """What makes lines recur.

    A template has `min_words` constant words or more, and they are `constant`
    of its tokens or more.  It recurs in `min_docs` documents or more if it has
    `sure_words` of them; else `share` of all documents must have it too.
    Lines of `segmented` tokens or more have variable segments.  A line of
    `long_words` tokens is a passage, which recurs as it stands in `long_docs`
    documents or more, unless other documents' lines hold the share `copied` of
    its document's words.
    """

    min_docs: int = 10
    share: float = 0.001
    min_words: int = 3
    constant: float = 0.5
    sure_words: int = 12
    leading: int = 3
    segments: int = 4
    segmented: int = 5
    long_words: int = 50
    long_docs: int = 2
    copied: float = 0.25


def templates(line: str, rules: Rules = Rules()) -> list[tuple[int, int, bool]]:
    """The templates on the line's paths, the line as it stands first: (key, tokens of the line if this is the line as it stands and else 0, does it recur in few documents?)."""
    tokens = line.split()
    n = len(tokens)
    if n < rules.min_words:
        return []
    digits = DIGIT.search(line) is not None
    # most lines hold words alone: then no token is looked at
    word = [LETTER.search(t) is not None and DIGIT.search(t) is None for t in tokens] if digits or SIGNS.search(line) else None
    words = n if word is None else sum(word)
    least = max(rules.min_words, rules.constant * n)
    passage = n >= rules.long_words
    if words < least and not passage:
        return []
    key = xxhash.xxh3_64_intdigest
    whole = " ".join(tokens)
    found = [(key(f"{n} = {whole}"), n, passage or words >= rules.sure_words)]
    if words < least:
        return found
    if digits:
        tokens = [FIELD if DIGIT.search(t) else t for t in tokens]
        whole = " ".join(tokens)
        found.append((key(f"{n} * {whole}"), 0, words >= rules.sure_words))
    if n >= rules.segmented:
        lead = min(rules.leading, n - 1)
        size = -(-(n - lead) // rules.segments)
        at = [0, *accumulate([len(t) + 1 for t in tokens])]
        before = range(n + 1) if word is None else [0, *accumulate(word)]
        for start in range(lead, n, size):
            stop = min(start + size, n)
            left = words - before[stop] + before[start]
            if left >= least:
                found.append((key(f"{n} {start} {whole[: at[start]]}{FIELD} {whole[at[stop] :]}"), 0, left >= rules.sure_words))
    return found


def line_templates(docs: DataFrame, rules: Rules) -> DataFrame:
    """A row for every template of every line of every text: doc_id, line (number from 0), template, first (of the
    text's lines at this template), words, sure (see templates), total (words of the text's lines that have a template)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            ids, lines, keys, first, words, sure, total = [], [], [], [], [], [], []
            for doc, text in zip(values(piece, "doc_id").to_pylist(), strings(piece), strict=True):
                seen: set[int] = set()
                begun = len(keys)
                for no, line in enumerate(text.split("\n")):
                    for key, size, often in templates(line, rules):
                        lines.append(no)
                        keys.append(key)
                        words.append(size)
                        sure.append(often)
                        first.append(key not in seen)
                        seen.add(key)
                ids += [doc] * (len(keys) - begun)
                total += [sum(words[begun:])] * (len(keys) - begun)
            cols = [pa.array(ids, pa.int64()), pa.array(lines, pa.int32()), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(first, pa.bool_()), pa.array(words, pa.int32()), pa.array(sure, pa.bool_()), pa.array(total, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "line", "template", "first", "words", "sure", "total"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, line int, template long, first boolean, words int, sure boolean, total int")


def recurring_lines(docs: DataFrame, rules: Rules = Rules(), keep_first: bool = True) -> DataFrame:
    """doc_id, lines (sorted array of line numbers) of the recurring lines.

    With `keep_first` a line stays in the document of the least id among those
    of its template.
    """
    few = rules.min_docs
    rows = cut(line_templates(docs, rules))
    many = max(few, math.ceil(rules.share * docs.count()))
    # a text's lines come from one task, which knows the first of them at a template: documents are counted without a distinct
    counted = rows.groupBy("template").agg(F.count_if("first").alias("n"), F.min("doc_id").alias("least"), F.max("words").alias("whole"), F.bool_or("sure").alias("often"))
    counted = counted.withColumn("often", (F.col("n") >= many) | (F.col("often") & (F.col("n") >= few)))
    counted = counted.filter(F.col("often") | ((F.col("n") >= rules.long_docs) & (F.col("n") < few) & (F.col("whole") > 0))).select(fresh_key("template"), "often", "least")
    hit = rows.join(counted, "template")
    if keep_first:
        hit = hit.filter("doc_id != least")
    shared = ~F.col("often") & (F.col("words") > 0)
    found = hit.groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("often"), F.col("line"))).alias("often"),
        F.collect_set(F.when(shared & (F.col("words") >= rules.long_words), F.col("line"))).alias("passages"),
        (F.sum(F.when(shared, F.col("words"))) < F.lit(rules.copied) * F.max("total")).alias("own"),
    )
    lines = F.array_union("often", F.when(F.col("own"), F.col("passages")).otherwise(F.array().cast("array<int>")))
    return found.select("doc_id", F.sort_array(lines).alias("lines")).filter(F.size("lines") > 0)


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", into: str = "text", rules: Rules = Rules(), keep_first: bool = True) -> DataFrame:
    """The table with recurring lines dropped from its texts, and columns n_lines, n_dropped before what was there
    (columns of these names are replaced).

    A null text stays null and has no lines; an empty text is one empty line.
    Rows that share an id count as a document each; what recurs in one of them
    is dropped from all of them at the same line number.  Blank lines stay.
    Ids are whole numbers; rows with a null id are left as they are.  Texts of
    any number of lines take time in proportion to it.  An empty table gives an
    empty table.
    """
    docs = docs.drop("n_lines", "n_dropped")
    key = docs[doc_id].cast("long")
    plain = docs.select(key.alias("doc_id"), docs[text].alias("text")).filter("doc_id is not null")
    drop = recurring_lines(plain, rules, keep_first).withColumnRenamed("doc_id", "__doc").withColumnRenamed("lines", "__drop")
    # null ids are dealt out by their texts; they match nothing
    rows = docs.join(drop, (F.coalesce(key, F.xxhash64(docs[text])) == F.col("__doc")) & key.isNotNull(), "left")
    all_lines = F.split(F.col(text), "\n", -1)
    gone = F.coalesce("__drop", F.array().cast("array<int>"))

    def without(lines):
        staying = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(staying, lambda i: F.get(lines, i)), "\n")

    # the text is split once: inside the lambda its lines are a variable
    kept = F.when(F.col("__drop").isNull() | F.col(text).isNull(), F.col(text)).otherwise(F.get(F.transform(F.array(all_lines), without), F.lit(0)))
    counts = [F.coalesce(F.size(all_lines), F.lit(0)).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped")]
    rest = [kept.alias(into) if c == into else rows[c] for c in docs.columns]
    return rows.select(*counts, *rest, *([] if into in docs.columns else [kept.alias(into)]))


#: The same in DuckDB for the default rules, with templates as text in place of hashes.  White space and digits are taken as ASCII.
LINES_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
t AS (SELECT doc_id, line, list_filter(string_split_regex(x, '\s+'), lambda w: w <> '') AS w FROM l),
k AS (SELECT *, len(w) AS n, list_transform(w, lambda y: CASE WHEN regexp_matches(y, '[0-9]') THEN '<*>' ELSE y END) AS g,
  list_transform(w, lambda y: (regexp_matches(y, '\p{L}') AND NOT regexp_matches(y, '[0-9]'))::INT) AS c FROM t WHERE len(w) > 0),
u AS (SELECT *, coalesce(list_sum(c), 0) AS words, greatest(3, n / 2.0) AS least, least(3, n - 1) AS lead, ceil((n - least(3, n - 1)) / 4.0)::BIGINT AS size FROM k),
v AS (SELECT *, unnest(range(lead, n, size)) AS s FROM u WHERE n >= 5 AND words >= least),
z AS (SELECT *, words - coalesce(list_sum(c[s + 1:s + size]), 0) AS kept FROM v),
p AS (SELECT doc_id, line, n AS whole, '=' || n || ' ' || array_to_string(w, ' ') AS key, words >= 12 OR n >= 50 AS sure FROM u WHERE words >= least OR n >= 50
  UNION ALL SELECT doc_id, line, 0, '*' || n || ' ' || array_to_string(g, ' '), words >= 12 FROM u WHERE words >= least AND list_contains(g, '<*>')
  UNION ALL SELECT doc_id, line, 0, s || '/' || n || ' ' || array_to_string(list_concat(g[1:s], ['<*>'], g[s + size + 1:]), ' '), kept >= 12 FROM z WHERE kept >= least),
m AS (SELECT greatest(10, ceil(0.001 * count(*))) AS many FROM documents),
c AS (SELECT key, min(doc_id) AS first, count(DISTINCT doc_id) AS docs, max(whole) AS whole, bool_or(sure) AS sure FROM p GROUP BY key),
r AS (SELECT key, first, docs >= many OR docs >= 10 AND sure AS often FROM c, m WHERE docs >= many OR docs >= 10 AND sure OR docs BETWEEN 2 AND 9 AND whole > 0),
h AS (SELECT doc_id, line, p.whole AS words, often FROM p JOIN r USING (key) WHERE doc_id <> first),
y AS (SELECT doc_id, sum(whole) AS total FROM p GROUP BY doc_id),
q AS (SELECT doc_id, sum(words) AS held FROM h WHERE NOT often GROUP BY doc_id),
d AS (SELECT doc_id, line FROM h WHERE often UNION SELECT doc_id, line FROM h JOIN y USING (doc_id) JOIN q USING (doc_id) WHERE NOT often AND words >= 50 AND held < 0.25 * total),
e AS (SELECT l.doc_id, count(*) AS n_lines, count(d.line) AS n_dropped, string_agg(x, chr(10) ORDER BY l.line) FILTER (d.line IS NULL) AS kept FROM l LEFT JOIN d ON d.doc_id = l.doc_id AND d.line = l.line GROUP BY l.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(kept, '')) AS text_sha256 FROM documents LEFT JOIN e USING (doc_id)
"""
