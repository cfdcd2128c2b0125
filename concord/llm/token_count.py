"""Exact token counts; huge texts are encoded in overlapping chunks that resynchronise.

A SentencePiece BPE model none of whose pieces holds a word mark after another
character never merges across the start of a word.  A token boundary there is
therefore the same in every encoding that contains it: it is a proven stable
boundary.  Chunks are encoded with offsets, and spliced at such a boundary in
their overlap at which both encodings have a token boundary.  Where the overlap
has none, it is widened, and where no word starts the chunk is doubled, up to
the whole text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text, strings, values

MARKS = " ▁"  # the space and the mark that stands for it


@lru_cache(maxsize=4)
def load_model(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    splits = not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))
    return sp, splits


def word_start(text: str, at: int) -> bool:
    """Does a word's mark begin at `at`, after a character that is no mark?"""
    return 0 < at < len(text) and text[at] in MARKS and text[at - 1] not in MARKS


def _offsets(sp, text: str, start: int, stop: int) -> list[int]:
    """Start of each token of text[start:stop], as offsets in `text` (code points; the library gives bytes)."""
    part = text[start:stop]
    begins = [p.begin for p in sp.encode(part, return_type="proto").pieces]
    if part.isascii():
        return [start + x for x in begins]
    raw = np.frombuffer(part.encode(), dtype=np.uint8)
    point = np.cumsum((raw & 0xC0) != 0x80) - 1
    return (start + np.append(point, len(part))[begins]).tolist()


def count_spliced(sp, text: str, chunk: int, overlap: int) -> int:
    """Tokens of `text`, equal to len(sp.encode(text)).

    Where no word starts since the last seam, the stretch that is encoded from
    there doubles, so that a text without spaces costs a small multiple of its
    length.
    """
    done, total, stop = 0, 0, min(len(text), chunk)
    left = _offsets(sp, text, 0, stop)
    while stop < len(text):
        floor = done + 1 if done else 0  # the library puts a mark before what it encodes: it stands for the one at `done`
        seams = {x for x in left if floor < x < stop and word_start(text, x)}
        stop2 = min(len(text), stop + (chunk if seams else max(chunk, stop - done)))
        wide, seam = overlap, None
        while seams and seam is None:
            start2 = max(floor, max(seams) - wide)
            right = _offsets(sp, text, start2, stop2)
            common = {x for x in seams if x > start2}.intersection(right)
            if common:
                seam = max(common)
            elif start2 == floor:
                break
            else:
                wide *= 2
        if seam is None:  # go on with the wider encoding from the last seam
            left, stop = _offsets(sp, text, floor, stop2), stop2
            continue
        total += sum(1 for x in left if x < seam)
        left, done, stop = [x for x in right if x >= seam], seam, stop2
    return total + len(left)


def count_tokens(text: str, model: str, chunk: int = 16384, overlap: int = 128) -> int:
    sp, splits = load_model(model)
    if len(text) <= chunk or not splits:
        return len(sp.encode(text, num_threads=1)) if text else 0
    return count_spliced(sp, text, chunk, overlap)


def token_counts(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id", limit: int = 4096, chunk: int = 16384, overlap: int = 128) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text.

    `chunk` and `overlap` are in code points; they change the work, not the
    counts.  A null or empty text has no bytes and no tokens.  Rows are taken
    as they come: repeated ids give repeated rows, other columns are ignored,
    an empty table gives an empty table.
    """

    def run(batch: pa.RecordBatch) -> dict:
        sp, splits = load_model(model)
        texts = strings(batch, "text")
        if splits:
            short = [x for x in texts if len(x) <= chunk]
            counts = iter([len(x) for x in sp.encode(short, num_threads=1)] if short else [])
            n = [(next(counts) if len(x) <= chunk else count_spliced(sp, x, chunk, overlap)) if x else next(counts) * 0 for x in texts]
        else:
            n = [count_tokens(x, model, chunk, overlap) for x in texts]
        return {"doc_id": values(batch, "doc_id"), "n_bytes": [len(x.encode()) for x in texts], "n_tokens": n, "over_limit": [k > limit for k in n]}

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return map_text(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
