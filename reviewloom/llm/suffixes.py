"""Repeated windows of bytes by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``size`` bytes, most significant digit first, and a
group of one drops out after each pass; the groups left at the end are exactly the repeated windows.

* The first digits are passes over the whole corpus, done by fingerprint (windows.py): first
  an anchor of ANCHOR bytes, then the segment around it. Suffixes whose anchor is found nowhere
  else drop out, and those with equal segments everywhere are done.
* The suffixes that are still open are sorted by their bytes, 8 at a time (``radix_order``), all
  those with one anchor in one task. An anchor with very many different segments is
  settled by fingerprints of its windows instead, so no task gets an unbounded group.

Defined cases: a null text is empty; documents shorter than ``size`` bytes keep all; rows
with equal doc_id count as one document, in order of text; texts without doc_id come after all others, in the order of
a hash, each as a document of its own, equal ones as one; matches never cross documents and may overlap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .substrings import SPANS, SPANS_SQL, span_rows
from .windows import Block, byte_tokens, find_repeats

SIZE = 100
ANCHOR = 24
BLOCK_BYTES = 4 << 20


def radix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """A number for each suffix, equal for suffixes that are equal through ``depth`` bytes.

    Passes over digits of 8 bytes, most significant first, each ordering the groups of more than
    one that the passes before have left.
    """
    label = np.zeros(len(starts), np.int64)
    active, group, done = np.arange(len(starts)), np.zeros(len(starts), np.int64), 0
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    for digit in range(0, depth, 8):
        width = min(8, depth - digit)
        key = np.zeros(len(active), np.uint64)
        at = starts[active] + digit
        for byte in range(width):
            key = (key << np.uint64(8)) | padded[at + byte]
        order = np.lexsort((key, group)) if digit else np.argsort(key, kind="stable")
        active, key, group = active[order], key[order], group[order]
        new = np.ones(len(active) + 1, bool)
        new[1:-1] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new[:-1]) - 1
        single = new[:-1] & new[1:]
        label[active[single]] = done + np.arange(int(single.sum()))
        done += int(single.sum())
        active, group = active[~single], group[~single]
        if not len(active):
            return label
    label[active] = done + np.unique(group, return_inverse=True)[1]
    return label


def remove_repeats(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans (byte offsets, end exclusive), kept (the bytes left)."""

    def make_block(ids: np.ndarray, texts: list[bytes]) -> Block:
        data = np.frombuffer(b"".join(texts), np.uint8)
        block = Block(
            ids, np.cumsum([0, *map(len, texts)]), lambda a, b: byte_tokens(data[a:b]), size, anchor
        )
        block.data = data
        return block

    def finish(block: Block, texts: list[bytes], gone: np.ndarray) -> dict:
        kept, spans, removed = [], [], []
        bounds = block.starts.tolist()
        for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            lost = gone[a:b]
            removed.append(int(lost.sum()))
            spans.append(span_rows(lost) if removed[-1] else [])
            kept.append(block.data[a:b][~lost].tobytes() if removed[-1] else text)
        return {
            "n_bytes": pa.array(np.diff(block.starts), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, SPANS),
            "kept": pa.array(kept, pa.binary()),
        }

    schema = f"n_bytes long, n_removed long, spans {SPANS_SQL}, kept binary"
    return find_repeats(
        docs, make_block, finish, schema, same_doc=True, block_bytes=block_bytes,
        label=lambda block, windows: radix_order(block.data, windows, size),
        window=size, sort_windows=lambda data, windows: radix_order(data, windows, size),
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
