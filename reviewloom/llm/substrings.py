"""Substring dedup by relative Lempel-Ziv parsing over words.

Blocks of documents are the reference. The index of all blocks is held by fingerprint: a phrase
is the stretch of windows that share an anchor, and every block's phrases are looked up in the
index of every other block through one exchange (windows.py). A document is factored greedily:
as long as the next phrase also starts in a document with a smaller doc_id, the factor grows.
Factors are at least ``size`` words long, as a phrase holds whole windows. Where a phrase is not
found as a whole, the factor ends, and the windows across that boundary are checked one by one, so no
match is lost to the cut of the parse. The union of both is the set of duplicate spans.

Defined cases: a null text has no words; documents with fewer than ``size`` words keep all;
a missing doc_id counts as the largest, and rows with equal doc_id are not earlier than each other;
removed words leave the rest joined by one space.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES
from .windows import Block, Rolling, U, byte_tokens, find_repeats

SIZE = 50
ANCHOR = 10
BLOCK_BYTES = 4 << 20
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_PART = 1 << 20


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints of all words, number of words of each text), about a megabyte at a time."""
    prints, counts, group, size = [], [], [], 0

    def flush():
        data = np.frombuffer(b" ".join([b"", *group, b""]), np.uint8)
        space = _IS_SPACE[data]
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        prints.append(Rolling(byte_tokens(data))(starts, ends))
        bounds = np.cumsum([1, *(len(t) + 1 for t in group)])
        counts.append(np.diff(np.searchsorted(starts, bounds)))

    for text in texts:
        group.append(text)
        size += len(text)
        if size >= _PART:
            flush()
            group, size = [], 0
    if group:
        flush()
    if not prints:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(prints), np.concatenate(counts)


def spans_of(gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of True."""
    steps = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS_SQL = "array<struct<start:int,end:int>>"


def span_rows(gone: np.ndarray) -> list[dict]:
    return [{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in spans_of(gone)), strict=True)]


def remove_repeats(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, spans (word numbers, end exclusive), kept (the text left)."""

    def make_block(ids: np.ndarray, texts: list[bytes]) -> Block:
        tokens, counts = words_of(texts)
        return Block(ids, np.concatenate(([0], np.cumsum(counts))), tokens, size, anchor)

    def finish(block: Block, texts: list[bytes], gone: np.ndarray) -> dict:
        kept, spans, removed = [], [], []
        bounds = block.starts.tolist()
        for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            lost = gone[a:b]
            words = text.split()
            removed.append(int(lost.sum()))
            if removed[-1]:
                words = compress(words, (~lost).tolist())
            spans.append(span_rows(lost) if removed[-1] else [])
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        return {
            "n_words": pa.array(np.diff(block.starts), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, SPANS),
            "kept": pa.array(kept, pa.string()),
        }

    schema = f"n_words long, n_removed long, spans {SPANS_SQL}, kept string"
    return find_repeats(docs, make_block, finish, schema, same_doc=False, block_bytes=block_bytes)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
