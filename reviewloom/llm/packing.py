"""Packing documents into fixed-size sequences: first-fit decreasing per randomised group.

A document's ids are its encoding and one end id. Every full ``size`` ids are a sequence of their
own; the rest of each document is an item to be packed. The items are dealt at random (by a hash
of the document) into groups of about ``group_items``, and each group is packed on its own by
first-fit decreasing. The first bin with room is found in a tournament tree over the bins' free
capacities, in O(log bins) per item. Only (doc_id, start, length, checksum) rows move; ids and
texts stay in their tasks.

Groups are bounded by the choice of their number from the count of items, so no task
holds more than a group, whatever a source or copy group holds; the loss is one or two open
sequences per group.

Defined cases: a null or empty text is the end id alone; rows with equal doc_id are packed as
separate documents; a null doc_id is kept; ties in length are broken by doc_id, then checksum.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import materialize
from .common import arrow_rows
from .encode import VOCABULARY, encoder

SIZE = 2048
END_ID = 1
GROUP_ITEMS = 20_000


class Tournament:
    """Free capacity of bins in the leaves of a binary tree; every node holds the largest below."""

    def __init__(self, size: int):
        self.size, self.leaves, self.used = size, 1, 0
        self.tree = [0, 0]

    def _grow(self) -> None:
        tree = [0] * (4 * self.leaves)
        level = self.leaves
        while level:  # each level of the old tree is the left half of a level of the new one
            tree[2 * level : 3 * level] = self.tree[level : 2 * level]
            level //= 2
        self.leaves *= 2
        tree[1] = tree[2]
        self.tree = tree

    def _set(self, bin_: int, free: int) -> None:
        tree, node = self.tree, bin_ + self.leaves
        tree[node] = free
        node //= 2
        while node:
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
            node //= 2

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) of an item: the first bin with room, or a new one."""
        tree = self.tree
        if tree[1] < length:
            if self.used == self.leaves:
                self._grow()
            bin_, free = self.used, self.size
            self.used += 1
        else:
            node = 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] >= length else 2 * node + 1
            bin_, free = node - self.leaves, tree[node]
        self._set(bin_, free - length)
        return bin_, self.size - free


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, text_crc): each document cut at multiples of size."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ("start", "length", "ids_crc32", "doc_tokens", "text_crc")
    end = array("I", [end_id]).tobytes()

    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            source = []
            for n, (text,) in enumerate(arrow_rows(batch, "text")):
                ids = memoryview(encode(text) + end)
                total, whole = len(ids) // 4, zlib.crc32(ids)
                for start in range(0, total, size):
                    piece = ids[4 * start : 4 * (start + size)]
                    rows.append((start, len(piece) // 4, zlib.crc32(piece), total, whole))
                    source.append(n)
            columns = {"doc_id": batch.column(0).take(pa.array(source, pa.int64()))}
            table = np.array(rows, np.int64).reshape(-1, len(names))
            columns |= {name: pa.array(table[:, k]) for k, name in enumerate(names)}
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _pack_group(table: pa.Table, size: int) -> pa.Table:
    """First-fit decreasing over the items of one group."""
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("text_crc", "ascending")])
    bins = Tournament(size)
    placed = [bins.place(length) for length in table["length"].to_pylist()]
    group = table["group"][0].as_py() if table.num_rows else 0
    sequence = [(group << 32) + bin_ for bin_, _ in placed]
    return table.drop_columns(["group", "text_crc"]).append_column(
        "sequence_id", pa.array(sequence, pa.int64())
    ).append_column("offset", pa.array([offset for _, offset in placed], pa.int64()))


def pack(
    docs: DataFrame,
    size: int = SIZE,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Packed sequences are numbered (group << 32) + bin; full pieces get ids from 2**62 on, a
    range of 2**40 for each task that cuts them.
    """
    cut = materialize(pieces(docs, size, end_id, vocabulary), "pieces")
    rest = cut.where(F.col("length") < size)
    groups = max(1, round(rest.count() / group_items))
    seeded = F.xxhash64(F.lit(size), "doc_id", "text_crc")
    items = rest.withColumn("group", F.pmod(seeded, F.lit(groups)).cast("long"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = items.groupBy("group").applyInArrow(lambda table: _pack_group(table, size), schema)
    full = cut.where(F.col("length") == size).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return full.unionByName(packed)
