"""Personal data: overlapping candidate spans judged by gradient-boosted trees.

High-recall generators propose spans, which may overlap: runs of digits with
their separators, with and without what stands around them, words joined by an
at sign or a spelled-out one, dotted and coloned number groups.  Boosted trees,
written and trained here in numpy on generated examples, judge each from its
format and its context; thresholds calibrated on held-out examples select
redactions.  Spans of the exact base rules are always kept.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text, strings, values

KINDS = ("email", "ip", "card", "phone")

# ---- the base rules, each linear in the text --------------------------------
# Their patterns.  A run that fails from its first character also
# fails from every later one, so runs are only tried at their beginning.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, stop, number of the kind), ordered."""
    out = [(a, z, 0) for a, z in base_emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(only_digits(m[0])) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


# ---- candidates --------------------------------------------------------------
# Runs of any length are taken whole, and each is tried at its beginning only.
_NUMBER = re.compile(r"[(+]?[0-9](?:[0-9]|[ ./()-]{1,2}(?=[0-9(])){6,}+")
_GROUP = re.compile(r"[0-9]+")
_NAME, _HOST, _TOP = r"(?<![A-Za-z0-9._%+-])[._%+-]*+(?P<name>[A-Za-z0-9][A-Za-z0-9._%+-]*+", r"[A-Za-z0-9-]++", r"[A-Za-z0-9-]{2,}+"
_IN_AT, _IN_DOT = r" ?[\[({] ?(?:at|AT) ?[\])}] ?", r" ?[\[({] ?(?:dot|DOT) ?[\])}] ?"
_SPELLED = re.compile(
    rf"{_NAME}(?:{_IN_AT}{_HOST}(?:(?:\.|{_IN_DOT}| (?:dot|DOT) ){_TOP})++"  # name [at] host [dot] com
    rf"| (?:at|AT) {_HOST}(?: (?:dot|DOT) {_TOP})++"  # name at host dot com
    rf"| ?@ ?{_HOST}(?:(?:\.| \. |{_IN_DOT}| (?:dot|DOT) ){_TOP})++))"  # name @ host . com
)
_SPELLED_HINT = re.compile(rf"@|{_IN_AT}| (?:at|AT) {_HOST} (?:dot|DOT) ")
_COLONS = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:{1,2}){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
#: No kind of number has more digits, or is written in more groups of them.
MOST_DIGITS, MOST_GROUPS = 19, 6


def number_parts(text: str, a: int, z: int) -> list[tuple[int, int, int]]:
    """(start, stop, digits) of every stretch of a run of numbers from the beginning of a group of digits to the end of one,
    up to MOST_GROUPS groups and MOST_DIGITS digits; also with the sign or bracket before it."""
    groups = [m.span() for m in _GROUP.finditer(text, a, z)]
    found = []
    for i, (start, _) in enumerate(groups):
        digits = 0
        for begin, stop in groups[i : i + MOST_GROUPS]:
            digits += stop - begin
            if digits > MOST_DIGITS:
                break
            found.append((start, stop, digits))
            if start > a and text[start - 1] in "(+":
                found.append((start - 1, stop, digits))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Proposed (start, stop, kind), overlapping and of every kind that the format could be."""
    out = []
    for m in _NUMBER.finditer(text):
        for s, e, n in number_parts(text, *m.span()):
            if n >= 12:
                out.append((s, e, 2))
            if 7 <= n <= 15:
                out.append((s, e, 3))
            if n <= 12 and text.count(".", s, e) >= 3:
                out.append((s, e, 1))
    if _SPELLED_HINT.search(text):
        out += [(*m.span("name"), 0) for m in _SPELLED.finditer(text)]
    if text.count(":") > 2:
        out += [(m.start(), m.end(), 1) for m in _COLONS.finditer(text)]
    return out


#: Words near a span that speak for or against a kind.
CUES = (
    ("mail", "email", "e-mail", "contact", "write", "correo", "courriel"),
    ("ip", "host", "server", "address", "addr", "client", "peer"),
    ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"),
    ("phone", "tel", "call", "mobile", "fax", "telefon", "handy", "cell", "whatsapp"),
    ("order", "invoice", "version", "isbn", "id", "no", "ref", "page", "serial", "build", "sku", "date", "on", "ticket"),
)
_WORD = re.compile(r"[a-z-]+")
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Does a run of numbers go on beside the span?
_DIGIT_BEFORE, _DIGIT_AFTER = re.compile(r"[0-9][ ./()-]{1,2}$"), re.compile(r"[ ./()-]{1,2}[0-9]")


def _code(c: str) -> float:
    return 0.0 if not c or c.isspace() else 1.0 if c.isdigit() else 2.0 if c.isalpha() else 3.0


def before(text: str, a: int) -> tuple[float, ...]:
    """Features of what stands before a span."""
    words = set(_WORD.findall(text[max(0, a - 32) : a].lower()))
    last = text[a - 1 : a]
    return (_code(last), float(last == "+"), float(bool(_DIGIT_BEFORE.search(text[max(0, a - 3) : a]))), *[float(not words.isdisjoint(c)) for c in CUES])


def features(text: str, a: int, z: int, context: tuple[float, ...] | None = None) -> list[float]:
    """Format of the span and context around it."""
    s = text[a:z]
    groups = _GROUP.findall(s)
    digits = "".join(groups)
    sizes = [*map(len, groups)]
    count = s.count
    opened, closed = count("("), count(")")
    tail = s if s.isalpha() else s[len(s.rstrip(_LETTERS)) :]
    return [
        float(z - a), float(len(digits)), float(sum(map(str.isalpha, s))), float(count(".")), float(count("-")), float(count(" ")), float(count("/")),
        float(opened + closed), float(count(":")), float(s[:1] == "+"), float(opened and closed), float(opened != closed),
        float(len(digits) >= 12 and luhn(digits)), float(len(groups)), float(max(sizes, default=0)), float(sizes[0] if sizes else 0), float(sizes[-1] if sizes else 0),
        float(len(set(sizes))), float(max([int(g[:9]) for g in groups], default=0) <= 255), float(int(digits[:4] or 0)), float(len(set(digits))), float(len(tail)),
        float("@" in s), float("::" in s), _code(text[z : z + 1]), float(bool(_DIGIT_AFTER.match(text[z : z + 3]))), *(context or before(text, a)),
    ]


# ---- boosted trees -----------------------------------------------------------
@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: per tree and inner node a feature and a limit, per leaf a value."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        row = np.arange(len(x))
        for f, t, v in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[row, f[node]] > t[node])
            total += v[node - inner]
        return total


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Logistic gradient boosting on binned features, with Newton steps."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], axis=1)
    n, width = x.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    raw = np.full(n, start)
    inner = 2**depth - 1
    feature, limit, leaf = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, inner + 1))
    for k in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            best, gain = [(0, np.inf)] * many, np.full(many, 1e-6)
            for f in range(width):
                slot = (node - first) * bins + binned[:, f]
                gl = np.cumsum(np.bincount(slot, g, many * bins).reshape(many, bins), axis=1)
                hl = np.cumsum(np.bincount(slot, h, many * bins).reshape(many, bins), axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                won = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                at = won.argmax(axis=1)
                for j in range(many):
                    if won[j, at[j]] > gain[j] and at[j] < len(edges[f]):
                        gain[j], best[j] = won[j, at[j]], (f, edges[f][at[j]])
            for j, (f, t) in enumerate(best):
                feature[k, first + j], limit[k, first + j] = f, t
            node = 2 * node + 1 + (x[np.arange(n), feature[k, node]] > limit[k, node])
        spot = node - inner
        leaf[k] = rate * np.bincount(spot, g, inner + 1) / (np.bincount(spot, h, inner + 1) + ridge)
        raw += leaf[k][spot]
    return Trees(feature, limit, leaf, start)


# ---- generated examples ------------------------------------------------------
def _with_check_digit(digits: str) -> str:
    return next(digits + str(d) for d in range(10) if luhn(digits + str(d)))


def examples(n: int, seed: int):
    """`n` generated (text, its spans): personal data and look-alikes in sentences, with and without cues, and numbers side by side."""
    rng = np.random.default_rng(seed)
    pick = lambda seq: seq[int(rng.integers(len(seq)))]
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    name = lambda k: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, k))

    def grouped(digits: str, sizes, sep: str) -> str:
        out, at = [], 0
        for s in sizes:
            out.append(digits[at : at + s])
            at += s
        return sep.join(out)

    def email():
        user, host, top = name(int(rng.integers(3, 9))), name(int(rng.integers(3, 9))), pick(["com", "org", "net", "io", "de", "fr"])
        at, dot = pick([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", "."), (" @ ", " . "), ("@", ".")])
        return f"{user}{at}{host}{dot}{top}"

    def ip():
        return pick([":".join(f"{int(v):x}" for v in rng.integers(1, 65536, 8)), f"fe80::{int(rng.integers(1, 65536)):x}:{int(rng.integers(1, 65536)):x}", ".".join(map(str, rng.integers(0, 256, 4)))])

    def card():
        sep = pick(["", " ", "-", ".", " - "])
        return pick([lambda: grouped(_with_check_digit(pick(["4", "51", "52", "60"])[:1] + num(14)), (4, 4, 4, 4), sep), lambda: grouped(_with_check_digit("37" + num(12)), (4, 6, 5), sep), lambda: _with_check_digit("4" + num(11))])()

    def phone():
        return pick([
            lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"{num(3)}.{num(3)}.{num(4)}",
            lambda: "0" + grouped(num(9), (1, 2, 2, 2, 2), pick([" ", ".", "-"])), lambda: f"+{pick(['1', '33', '44', '49'])} {num(3)} {num(3)} {num(4)}",
            lambda: f"00{pick(['33', '44', '49'])} {num(3)} {num(7)}", lambda: f"0{num(3)}/{num(7)}",
        ])()

    def other():
        return pick([
            lambda: num(int(rng.integers(8, 20))), lambda: f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}", lambda: f"{rng.integers(1, 29):02d}.{rng.integers(1, 13):02d}.{rng.integers(1900, 2100)}",
            lambda: f"{num(4)}-{num(4)}-{num(4)}-{num(4)}", lambda: grouped(num(16), (4, 4, 4, 4), " "), lambda: f"{num(2)}.{num(3)}.{num(4)}.{num(1)}", lambda: f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}",
            lambda: f"{num(5)}.{num(8)}", lambda: f"{rng.integers(0, 24):02d}:{rng.integers(0, 60):02d}:{rng.integers(0, 60):02d}", lambda: f"{num(3)} {num(3)} {num(3)} {num(3)}", lambda: f"{name(5)} at {name(4)}. {name(6)}",
            lambda: f"{num(8)}-{num(4)}-{num(4)}", lambda: f"{rng.integers(1, 13)}/{rng.integers(1, 29)}/{rng.integers(1900, 2100)} {num(4)}", lambda: f"{rng.integers(1, 30)}.{rng.integers(0, 30)}.{rng.integers(0, 400)}.{rng.integers(0, 9000)}",
        ])()

    makers = (email, ip, card, phone)
    for i in range(n):
        kind = i % 8 if i % 8 < 4 else None
        s = makers[kind]() if kind is not None else other()
        cue = CUES[kind] if kind is not None and rng.random() < 0.7 else CUES[4] if kind is None and rng.random() < 0.5 else ("",)
        lead = f"{name(int(rng.integers(2, 7)))} {name(int(rng.integers(2, 7)))} {pick(cue)}{pick([' ', ': ', ' ', ' = '])}"
        spans = [(len(lead), len(lead) + len(s), kind)] if kind is not None else []
        if kind in (2, 3) and rng.random() < 0.3:  # two numbers side by side
            gap, second = pick([" ", ", ", " / ", "  ", "; "]), makers[kind]()
            spans.append((len(lead) + len(s) + len(gap), len(lead) + len(s) + len(gap) + len(second), kind))
            s = f"{s}{gap}{second}"
        yield f"{lead}{s}{pick([' ', '. ', ', ', chr(10), ''])}{name(5)} {name(4)}.", spans


@dataclass(frozen=True)
class Judge:
    """For each kind its trees and the least score of a redaction."""

    trees: tuple[Trees, ...]
    least: tuple[float, ...]


@lru_cache(maxsize=1)
def fit(n: int = 6000, precision: float = 0.995, seed: int = 11) -> Judge:
    """Train on `n` generated examples; thresholds reach `precision` on a third that training never sees."""
    rows: list[list[tuple[list[float], bool, bool]]] = [[] for _ in KINDS]
    for no, (text, spans) in enumerate(examples(n, seed)):
        for s in candidates(text):
            rows[s[2]].append((features(text, s[0], s[1]), s in spans, no % 3 == 0))
    trees, least = [], []
    for found in rows:
        x, y, test = np.array([r[0] for r in found]), np.array([float(r[1]) for r in found]), np.array([r[2] for r in found])
        t = boost(x[~test], y[~test])
        s, hit = t.score(x[test]), y[test]
        order = np.argsort(-s)
        exact = np.cumsum(hit[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(exact >= precision)
        trees.append(t)
        # never under even odds, so that a lucky tail of the held-out examples can't lower it
        least.append(max(0.0, float(s[order][good[-1]])) if len(good) else np.inf)
    return Judge(tuple(trees), tuple(least))


class Covered:
    """Stretches of a text; those that touch or overlap are one."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.stops: list[int] = []
        for a, z in sorted(spans):
            if self.stops and a < self.stops[-1]:
                self.stops[-1] = max(self.stops[-1], z)
            else:
                self.starts.append(a)
                self.stops.append(z)

    def meets(self, a: int, z: int) -> bool:
        i = bisect_right(self.stops, a)
        return i < len(self.starts) and self.starts[i] < z

    def add(self, a: int, z: int) -> None:
        """A stretch that meets no other."""
        i = bisect_right(self.starts, a)
        self.starts.insert(i, a)
        self.stops.insert(i, z)


def judged(texts: list[str], judge: Judge) -> list[list[tuple[int, int, int, bool, float]]]:
    """(start, stop, kind, base, score) of the spans of every text: base spans, and added ones that overlap no other."""
    out, rows, where = [], [[] for _ in KINDS], [[] for _ in KINDS]
    for i, text in enumerate(texts):
        base = base_spans(text)
        out.append([(a, z, k, True, 1.0) for a, z, k in base])
        kept = Covered((a, z) for a, z, _ in base)
        at, context, stop, found = -1, None, -1, None
        for s in candidates(text):  # those of one stretch, and of one beginning, come one after another
            if kept.meets(s[0], s[1]):
                continue
            if s[0] != at:
                at, context, stop = s[0], before(text, s[0]), -1
            if s[1] != stop:
                stop, found = s[1], features(text, s[0], s[1], context)
            rows[s[2]].append(found)
            where[s[2]].append((i, s))
    chosen: dict[int, list[tuple[float, tuple[int, int, int]]]] = {}
    for k in range(len(KINDS)):
        if rows[k]:
            for (i, s), v in zip(where[k], judge.trees[k].score(np.array(rows[k])).tolist(), strict=True):
                if v >= judge.least[k]:
                    chosen.setdefault(i, []).append((v, s))
    for i, found in chosen.items():
        taken = Covered()
        for v, (a, z, k) in sorted(found, key=lambda f: (-f[0], f[1])):
            if not taken.meets(a, z):
                taken.add(a, z)
                out[i].append((a, z, k, False, float(1 / (1 + np.exp(-v)))))
        out[i].sort(key=lambda s: (s[0], s[2]))
    return out


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", judge: Judge | None = None) -> DataFrame:
    """doc_id, spans (array of kind, start, stop in code points, base, score) of every text, ordered by start, then kind.

    Null and empty texts have no spans, texts of any length are read whole, in
    time that grows in proportion.  Repeated and null ids give a row each; an
    empty table gives an empty table; other columns are ignored, whatever their
    names.
    """
    model = judge or fit()

    def run(batch: pa.RecordBatch) -> dict:
        spans = [[{"kind": KINDS[k], "start": a, "stop": z, "base": b, "score": v} for a, z, k, b, v in s] for s in judged(strings(batch), model)]
        return {"doc_id": values(batch, "doc_id"), "spans": spans}

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return map_text(rows, run, f"doc_id {kind}, spans array<struct<kind:string,start:int,stop:int,base:boolean,score:double>>")


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", into: str = "redacted") -> DataFrame:
    """doc_id and the text with every span replaced by its kind in brackets (null stays null)."""

    def run(batch: pa.RecordBatch) -> dict:
        out = []
        for t, spans in zip(strings(batch), judged(strings(batch), model), strict=True):
            parts, at = [], 0
            for a, z, k, _, _ in spans:
                if a >= at:
                    parts += [t[at:a], f"[{KINDS[k]}]"]
                    at = z
            out.append("".join([*parts, t[at:]]))
        return {"doc_id": values(batch, "doc_id"), into: pa.array(out, mask=values(batch, "text").is_null().to_numpy(zero_copy_only=False))}

    model = fit()
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_text(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), run, f"doc_id {kind}, {into} string")
