"""Byte-level BPE encoding and decoding by batched merge rounds in numpy.

The distinct words of many texts lie in one flat array of symbols.  Each round
looks up the rank of every adjacent pair by binary search over the sorted pair
keys, and merges, in every word at once, all occurrences of its lowest-ranked
pair.  A merged symbol only occurs in pairs of a higher rank than its own, so
merging all occurrences at once gives what one-by-one merging gives.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_text, pieces, strings, values

#: The byte-level pre-tokenizer's word pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int32).max
#: Words kept encoded between batches of one worker; the store is emptied when full.
CACHE_WORDS = 120_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class ByteBPE:
    """A byte-level BPE vocabulary read from a tokenizers .json file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.first = np.array([vocab[c] for c in symbols], dtype=np.int32)
        self.n = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.n + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.into = keys[order], order.astype(np.int32), into[order].astype(np.int32)
        self.bytes = [b""] * self.n
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        self.names = [str(i) for i in range(self.n)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self.words = regex.compile(WORDS)
        self.splitter = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.as_ids: dict[str, str] = {}
        self.as_text: dict[str, str] = {}
        self.forget()

    def _lookup(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the pairs that begin at the positions `at` (none: the rank NONE)."""
        key = ids[at].astype(np.int64) * self.n + ids[at + 1]
        spot = np.searchsorted(self.keys, key)
        spot[spot == len(self.keys)] = 0
        hit = (self.keys[spot] == key) & (word[at] == word[at + 1])
        return np.where(hit, self.rank[spot], NONE), self.into[spot]

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of the words one after another, and where each word's begin (and the last one's end)."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        ids = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        rank, into = np.full(len(ids), NONE, dtype=np.int32), np.zeros(len(ids), dtype=np.int32)
        if len(ids) > 1:
            rank[:-1], into[:-1] = self._lookup(ids, word, np.arange(len(ids) - 1))
        done_ids, done_word = [], []
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            length = np.diff(np.r_[starts, len(word)])
            best = np.minimum.reduceat(rank, starts)
            keep = np.repeat(best != NONE, length)
            if not keep.all():  # words without a pair to merge are finished
                done_ids.append(ids[~keep])
                done_word.append(word[~keep])
                ids, word, rank, into = ids[keep], word[keep], rank[keep], into[keep]
                length, best = length[best != NONE], best[best != NONE]
                if not len(ids):
                    break
                keep = np.ones(len(ids), dtype=bool)
            run = np.flatnonzero(rank == np.repeat(best, length))
            fresh = np.r_[True, run[1:] != run[:-1] + 1]
            if not fresh.all():  # of overlapping occurrences (aaa), every other one from the left
                began = np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))
                run = run[(np.arange(len(run)) - began) % 2 == 0]
            ids[run] = into[run]
            keep[run + 1] = False
            run = run - np.arange(len(run))  # where they stand after the removal: one symbol went for each before
            ids, word, rank, into = ids[keep], word[keep], rank[keep], into[keep]
            last = len(ids) - 1
            if run[-1] == last:
                rank[last], run = NONE, run[:-1]
            at = np.concatenate([run, run[run > 0] - 1]) if len(run) else run
            if last and not len(run) or last and rank[last] == NONE:
                at = np.append(at, last - 1)
            if len(at):
                rank[at], into[at] = self._lookup(ids, word, at)
        done_ids.append(ids)
        done_word.append(word)
        ids, word = np.concatenate(done_ids), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return ids[order], np.r_[0, np.cumsum(np.bincount(word, minlength=len(words)))]

    def forget(self) -> None:
        """Empty the store of encoded words: the word's number, and the ids of all of them one after another."""
        self.number: dict[str, int] = {}
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not stored yet."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > CACHE_WORDS:
            self.forget()
            new = list(words)
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            flat, ends = self.merge_words([w.encode() for w in part])
            self.number.update(zip(part, range(len(self.number), len(self.number) + len(part)), strict=True))
            self.flat, self.ends = np.concatenate([self.flat, flat]), np.concatenate([self.ends, ends[1:] + self.ends[-1]])

    def spell(self, words: set[str]) -> None:
        """Store the words' ids as text and their decoded form."""
        new = [w for w in words if w not in self.as_ids]
        if len(self.as_ids) + len(new) > CACHE_WORDS:
            self.as_ids.clear()
            self.as_text.clear()
            new = list(words)
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            flat, ends = self.merge_words([w.encode() for w in part])
            flat, ends = flat.tolist(), ends.tolist()
            names, raw = [*map(self.names.__getitem__, flat)], [*map(self.bytes.__getitem__, flat)]
            for w, a, b in zip(part, ends, ends[1:], strict=False):
                self.as_ids[w] = ",".join(names[a:b])
                self.as_text[w] = b"".join(raw[a:b]).decode("utf-8", "replace")

    def split(self, text: str) -> list[str]:
        """Words of the text; special tokens stand alone."""
        if self.splitter is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        out = []
        for part in self.splitter.split(text):
            out += [part] if part in self.special else self.words.findall(part)
        return out

    def spell_all(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """(comma-joined ids, decoded text) of each text."""
        split = [self.split(t) for t in texts]
        self.spell(set().union(*split) - self.special.keys())
        for content, i in self.special.items():
            self.as_ids[content], self.as_text[content] = str(i), content
        return [",".join(map(self.as_ids.__getitem__, w)) for w in split], ["".join(map(self.as_text.__getitem__, w)) for w in split]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (and the last one's end)."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split) - self.special.keys())
        of_special = {w: -1 - i for w, i in self.special.items()}
        number = (self.number | of_special if len(of_special) and any(not of_special.keys().isdisjoint(w) for w in split) else self.number).__getitem__
        words = np.fromiter((number(w) for text in split for w in text), dtype=np.int64)
        special = words < 0
        begin = self.ends[np.where(special, 0, words)]
        size = np.where(special, 1, self.ends[np.where(special, 0, words) + 1] - begin)
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - begin, size)
        out = self.flat[at] if len(self.flat) else np.empty(len(at), np.int32)
        out[(ends - 1)[special]] = -1 - words[special]
        return out, np.r_[0, ends][np.r_[0, np.cumsum([len(w) for w in split], dtype=np.int64)]]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def bpe_digests(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again.

    A null or empty text has no tokens; its digests are those of the empty
    string.  Texts of any length are encoded whole.  Repeated and null ids give
    a row each, an empty table gives an empty table, other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> dict:
        ids, back = load(vocabulary).spell_all(strings(batch, "text"))
        return {"doc_id": values(batch, "doc_id"), "n_tokens": [x.count(",") + 1 if x else 0 for x in ids], "ids_sha256": [*map(sha, ids)], "decoded_sha256": [*map(sha, back)]}

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return map_text(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", into: str = "token_ids") -> DataFrame:
    """The table with a further column array<int> `into`: the token ids of each text (null and empty: none).

    A column of that name is replaced; all other columns stay as they are, and
    so do repeated rows.  Texts of any length are encoded whole.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StructType

    base = docs.drop(into)
    schema = StructType([*base.schema.fields]).add(into, ArrayType(IntegerType()), False)

    def run(batches):
        for batch in pieces(batches, text):
            flat, ends = load(vocabulary).encode_all(strings(batch, text))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, into])

    return base.mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, vocabulary: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """The table with a further column `into`: the text of the token ids (null ids: null; ids outside the vocabulary raise)."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def back(col):
        bpe = load(vocabulary)
        return col.map(lambda x: None if x is None else bpe.decode(x))

    return encoded.withColumn(into, back(ids))
