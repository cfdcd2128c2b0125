"""Secret scanning through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must contain (in lower case).  An inverted index over the texts of a
batch maps every trigram that some query asks for to the texts that hold it.
Queries are answered by intersecting and uniting postings; the rules then verify
the candidate texts only.  Rules that have no mandatory trigram scan every text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text, strings, values

#: A query is None (no mandatory trigram), a trigram, or ("and" | "or", queries).
MOST = 16  # strings that are followed exactly through a regex before they are turned into trigrams


@dataclass(frozen=True)
class Rule:
    """`kind` of a span, its regex, the group whose length counts, and that length's minimum. `base`: one of the fixed rules."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The three base rules, then the formats of well-known credentials.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"\bgh[pousr]_[A-Za-z0-9]{36}\b"),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"\b[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"://[^\s/:@]++:[^\s/:@]{3,}+@"),
)


def both(a, b):
    return b if a is None else a if b is None else a if a == b else ("and", (a, b))


def trigrams_of(text: str):
    q = None
    for i in range(len(text) - 2):
        q = both(q, text[i : i + 3])
    return q


def any_of(texts: set[str]):
    found = [trigrams_of(t) for t in sorted(texts)]
    return None if any(q is None for q in found) or not found else found[0] if len(found) == 1 else ("or", tuple(found))


def derive(pattern: str):
    """The Boolean trigram query that each match of `pattern` satisfies, over text in lower case."""

    def sequence(items) -> tuple[set[str] | None, object]:
        """(all strings the items match, or None if they are too many; query)."""
        exact, query = {""}, None
        for item in items:
            strings_, q = one(item)
            query = both(query, q)
            joined = {a + b for a in exact for b in strings_} if strings_ is not None and exact is not None else None
            if joined is None or len(joined) > MOST:
                query = both(query, any_of(exact)) if exact else query
                exact = strings_ if strings_ is not None and len(strings_) <= MOST else {""}
                broken[0] = True
            else:
                exact = joined
        return exact, query

    broken = [False]

    def group(items):
        was, broken[0] = broken[0], False
        exact, query = sequence(items)
        cut_off, broken[0] = broken[0], was
        return (None, both(query, any_of(exact))) if cut_off else (exact, query)

    def one(item):
        op, arg = item
        if op is C.LITERAL:
            return {chr(arg).lower()}, None
        if op is C.IN and all(o is C.LITERAL for o, _ in arg):
            return {chr(x).lower() for _, x in arg}, None
        if op is C.SUBPATTERN:
            return group(arg[3])
        if op is C.BRANCH:
            parts = [group(x) for x in arg[1]]
            if all(s is not None for s, _ in parts):
                return set().union(*(s for s, _ in parts)), None
            each = [both(q, any_of(s) if s is not None else None) for s, q in parts]
            return None, None if None in each else ("or", tuple(each))
        if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, body = arg
            exact, query = group(body)
            if low == 0:
                return ({"", *exact}, None) if high == 1 and exact is not None else (None, None)
            if low == high == 1:
                return exact, query
            return None, both(query, any_of(exact) if exact is not None else None)
        if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            return {""}, None
        return None, None

    exact, query = sequence(_parser.parse(pattern))
    return both(query, any_of(exact)) if exact else query


def leaves(query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else set().union(*map(leaves, query[1]))


class TrigramIndex:
    """Postings of the asked-for trigrams over the texts of one batch.  A posting is a text's number."""

    def __init__(self, texts: list[str], asked: list[str]):
        raw = [t.encode() for t in texts]
        flat = np.frombuffer(b"\n".join(raw) + b"\n\n\n", dtype=np.uint8)
        low = flat + ((flat >= 65) & (flat <= 90)).astype(np.uint8) * np.uint8(32)
        ends = np.cumsum([len(r) + 1 for r in raw])
        code = low[:-2].astype(np.uint32) << 16
        code |= low[1:-1].astype(np.uint32) << 8
        code |= low[2:]
        slot = _slots(tuple(asked))[code]
        at = np.flatnonzero(slot)
        term, doc = slot[at], np.searchsorted(ends, at, side="right")
        pairs = np.unique(term.astype(np.int64) * (len(texts) + 1) + doc)
        term, doc = np.divmod(pairs, len(texts) + 1)
        cuts = np.searchsorted(term, np.arange(1, len(asked) + 2))
        self.postings = {t: doc[cuts[i] : cuts[i + 1]] for i, t in enumerate(asked)}
        self.every = np.arange(len(texts))

    def find(self, query) -> np.ndarray:
        if query is None:
            return self.every
        if isinstance(query, str):
            return self.postings[query]
        parts = [self.find(q) for q in query[1]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out


@lru_cache(maxsize=4)
def _slots(asked: tuple[str, ...]) -> np.ndarray:
    """1 + the number of the asked trigram, for each code of three bytes; 0 for the others."""
    out = np.zeros(1 << 24, dtype=np.uint8 if len(asked) < 255 else np.uint16)
    for i, t in enumerate(asked):
        a, b, c = t.encode()
        out[a << 16 | b << 8 | c] = i + 1
    return out


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]):
    """(rule, compiled regex, query) of each rule, and all trigrams asked for."""
    out = [(r, re.compile(r.pattern, re.ASCII), derive(r.pattern)) for r in rules]
    return out, sorted(set().union(*(leaves(q) for _, _, q in out)))


def scan(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """(start, stop, number of the rule) of the spans of every text, in code points, ordered."""
    known, asked = compiled(rules)
    index = TrigramIndex(texts, asked)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for no, (rule, pattern, query) in enumerate(known):
        for i in index.find(query).tolist():
            for m in pattern.finditer(texts[i]):
                if len(m[rule.group]) >= rule.least:
                    out[i].append((m.start(), m.end(), no))
    for spans in out:
        spans.sort(key=lambda s: (s[0], s[2], s[1]))
    return out


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, spans (array of kind, start, stop in code points, base) of every text.

    Matches of one rule do not overlap, those of different rules may.  Null and
    empty texts have no spans, texts of any length are read whole.  Repeated and
    null ids give a row each; an empty table gives an empty table; other columns
    are ignored, whatever their names.
    """

    def run(batch: pa.RecordBatch) -> dict:
        spans = [[{"kind": rules[no].kind, "start": a, "stop": z, "base": rules[no].base} for a, z, no in s] for s in scan(strings(batch), rules)]
        return {"doc_id": values(batch, "doc_id"), "spans": spans}

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return map_text(rows, run, f"doc_id {kind}, spans array<struct<kind:string,start:int,stop:int,base:boolean>>")


def span_digest(spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{z}" for a, z, k in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
