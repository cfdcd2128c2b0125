"""Byte-level BPE by the tokenizers library, from a file of ranks.

A file of ranks (bytes in base64, then the rank) says which byte strings are
tokens; two neighbours merge if their joined bytes are one, the lowest rank
first, the leftmost among equals.  The library knows merges of pairs of
character strings instead, so each byte is written as a printable character of
its own, and a token's every cut into two other tokens becomes a merge with
the token's rank.  The library merges the words of a batch that a task has not
met before; the others' ids are looked up.  The ids that come back are ranks; reversing the character
table gives bytes, and counting the bytes that begin a character turns byte
positions into character positions, also where a token ends inside one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols, sha
from .common import map_text, pieces, strings, values

#: Characters of a text that go to the library at once; a text is only cut where its words are.
PART_CHARS = 1 << 17
#: No word of the pattern goes on from what is no white space to white space, or from a letter to an ASCII sign or digit.
SEAM = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[!-@])")
#: Characters of words, and distinct words, whose ids a task keeps before it starts afresh.
KEPT_CHARS, KEPT_WORDS = 1 << 23, 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def halves(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Where the token can be cut into two tokens, in the order in which the library must try the cuts.

    Three neighbours x, y, x' with xy = yx' = token offer two overlapping
    merges; the left one comes first, so the cut after x precedes that after y.
    """
    cuts = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    n = len(token)
    for i in cuts.copy():
        j = n - i
        if i != j and j in cuts and token[:j] == token[i:] and token[:i] != token[j:] and cuts.index(i) > cuts.index(j):
            cuts.remove(i)
            cuts.insert(cuts.index(j), i)
    return cuts


class RankedBPE:
    """A vocabulary of ranked byte strings inside the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks, symbols = read_ranks(path), byte_symbols()
        written = lambda token: "".join([symbols[b] for b in token])
        merges = [(written(token[:i]), written(token[i:])) for token in sorted(ranks, key=ranks.__getitem__) for i in halves(token, ranks)]
        # a word that is a token as a whole is not merged, as in the library of the ranks
        model = models.BPE({written(token): rank for token, rank in ranks.items()}, merges, cache_capacity=0, ignore_merges=True)
        self.library = Tokenizer(model)
        self.library.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words = Tokenizer(model)  # takes words as they are written
        self.split = regex.compile(pattern).findall
        self.symbols = dict(enumerate(symbols))
        self.forget()
        byte_of = {c: b for b, c in enumerate(symbols)}
        size = max(ranks.values()) + 1
        self.bytes = [b""] * size
        for written_token, rank in self.library.get_vocab().items():
            self.bytes[rank] = bytes([byte_of[c] for c in written_token])
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int32)
        self.names = [str(i) for i in range(size)]

    def forget(self) -> None:
        """Words that are known: their numbers, their ids one after another, and where each one's begin (and the last one's end)."""
        self.number: dict[str, int] = {}
        self.known, self.at, self.chars = np.empty(0, np.int32), np.zeros(1, np.int64), 0

    def learn(self, words: list[str]) -> None:
        """Let the library merge words that are not known; their ends are where as many bytes are covered."""
        written = [w.encode().decode("latin-1").translate(self.symbols) for w in words]
        ids = np.array(self.words.encode_batch_fast([written], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int32)
        covered, wanted = np.cumsum(self.length[ids], dtype=np.int64), np.cumsum([len(w) for w in written], dtype=np.int64)
        stop = np.searchsorted(covered, wanted)
        if not np.array_equal(covered[np.minimum(stop, len(ids) - 1)], wanted):
            raise ValueError("the tokens do not cover the words")
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        self.known, self.at = np.r_[self.known, ids], np.r_[self.at, self.at[-1] + stop + 1]
        self.chars += sum(map(len, words))

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts one after another, and how many each has."""
        found = [self.split(part) for part in parts]
        words = [*chain.from_iterable(found)]
        if sum(map(len, words)) != sum(map(len, parts)):
            raise ValueError("the words do not cover the text")
        if len(self.number) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.forget()
        new = [*set(words).difference(self.number)]
        if new:
            self.learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        size = self.at[numbers + 1] - self.at[numbers]
        ends = np.r_[0, np.cumsum(size)]
        ids = self.known[np.arange(ends[-1]) + np.repeat(self.at[numbers] - ends[:-1], size)]
        return ids, np.diff(ends[np.r_[0, np.cumsum([len(x) for x in found], dtype=np.int64)]])

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (and the last one's end)."""
        out, size, parts, owner, chars = [], np.zeros(len(texts), np.int64), [], [], 0

        def encode() -> None:
            ids, each = self.encode_parts(parts)
            out.append(ids)
            np.add.at(size, owner, each)
            parts.clear(), owner.clear()

        for i, text in enumerate(texts):
            for part in parted(text):
                parts.append(part)
                owner.append(i)
                chars += len(part)
                if chars > 8 * PART_CHARS:
                    encode()
                    chars = 0
        if parts:
            encode()
        return np.concatenate(out) if out else np.empty(0, np.int32), np.r_[0, np.cumsum(size)]

    def offsets(self, texts: list[str], ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first character, character after the last, does it cut a character?) of every token; a cut character belongs to all its tokens."""
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        stop = np.cumsum(self.length[ids], dtype=np.int64)
        if len(raw) != (stop[-1] if len(stop) else 0):
            raise ValueError("the tokens do not cover the texts")
        begins = np.append((raw & 0xC0) != 0x80, True)
        character = np.cumsum(begins, dtype=np.int32) - 1
        start = stop - self.length[ids]
        base = np.repeat(np.cumsum([0, *map(len, texts)], dtype=np.int64)[:-1], np.diff(ends))
        return character[start] - base, character[stop - 1] + 1 - base, ~(begins[start] & begins[stop])

    def raw(self, ids) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def pieces(self, ids) -> list[str]:
        """The text of each token; a character that several tokens share goes to the one that completes it."""
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        out = [decoder.decode(self.bytes[i]) for i in ids]
        if out:
            out[-1] += decoder.decode(b"", final=True)
        return out


def parted(text: str) -> Iterator[str]:
    """The text in parts of PART_CHARS characters or more, each up to the next place where no word goes on."""
    start = 0
    while len(text) - start > PART_CHARS:
        seam = SEAM.search(text, start + PART_CHARS)
        if seam is None:
            break
        yield text[start : seam.start()]
        start = seam.start()
    if start < len(text):
        yield text[start:]


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> RankedBPE:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return RankedBPE(path, pattern)


def ranked_encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", into: str = "token_ids", offsets: bool = False) -> DataFrame:
    """The table with a further column array<int> `into`: the token ids of each text (null and empty: none).

    With `offsets` two more, `into`_start and `into`_stop: the characters that
    each token covers, also in part.  Columns of these names are replaced, all
    others stay as they are, and so do repeated rows.  Texts of any length are
    encoded whole; an empty table gives an empty table.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StructType

    new = [into, *([f"{into}_start", f"{into}_stop"] if offsets else [])]
    base = docs.drop(*new)
    schema = StructType([*base.schema.fields])
    for name in new:
        schema = schema.add(name, ArrayType(IntegerType()), False)

    def run(batches):
        for batch in pieces(batches, text):
            bpe, texts = load(ranks, pattern), strings(batch, text)
            ids, ends = bpe.encode_all(texts)
            columns = [ids, *(bpe.offsets(texts, ids, ends)[:2] if offsets else [])]
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c.astype(np.int32), pa.int32())) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, *new])

    return base.mapInArrow(run, schema)


def ranked_decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "token_ids", into: str = "decoded", raw: bool = False) -> DataFrame:
    """The table with a further column `into`: the text of the token ids, or with `raw` its bytes.

    Bytes are joined before they become characters, so characters split over
    tokens are whole again; what is no UTF-8 becomes U+FFFD.  Null ids give
    null, ids outside the vocabulary raise.
    """

    @F.pandas_udf("binary" if raw else "string")
    def back(col):
        bpe = load(ranks, pattern)
        one = bpe.raw if raw else lambda x: bpe.raw(x).decode("utf-8", "replace")
        return col.map(lambda x: None if x is None else one(x))

    return encoded.withColumn(into, back(ids))


def ranked_pieces(encoded: DataFrame, ranks: str, pattern: str, ids: str = "token_ids", into: str = "pieces") -> DataFrame:
    """The table with a further column array<string> `into`: each token's text, split characters where they are completed (null ids: null)."""

    @F.pandas_udf("array<string>")
    def back(col):
        bpe = load(ranks, pattern)
        return col.map(lambda x: None if x is None else bpe.pieces(x))

    return encoded.withColumn(into, back(ids))


def ranked_digests(docs: DataFrame, ranks: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_split (tokens that begin or end inside a character) of every text, encoded and decoded again.

    A null or empty text has no tokens; its digests are those of the empty
    string.  Texts of any length are encoded whole.  Repeated and null ids give
    a row each, an empty table gives an empty table, other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> dict:
        bpe, texts = load(ranks, pattern), strings(batch, "text")
        ids, ends = bpe.encode_all(texts)
        split = np.r_[0, np.cumsum(bpe.offsets(texts, ids, ends)[2])]
        flat, at = ids.tolist(), ends.tolist()
        each = [flat[a:b] for a, b in zip(at, at[1:], strict=False)]
        return {
            "doc_id": values(batch, "doc_id"), "n_tokens": np.diff(ends), "n_split": split[ends[1:]] - split[ends[:-1]],
            "ids_sha256": [sha(",".join([bpe.names[i] for i in x])) for x in each], "decoded_sha256": [sha(bpe.raw(x)) for x in each],
        }

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return map_text(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long")
