"""Finding windows of tokens that also start earlier in the corpus, without moving texts to each other.

The documents are dealt by a hash of doc_id into blocks of a few megabytes, and a block is
analysed as a whole in one task. What blocks have to learn from each other goes through two rounds
of messages that are grouped by fingerprint:

* Every window is assigned to an anchor: the k-gram in it with the least hash (leftmost of
  equals). Equal windows have equal anchors at equal offsets. Consecutive windows with one
  anchor form a segment.
* Round 1: a block sends each of its distinct anchors once, with the fingerprint of its segment
  and the first place of it. Anchors that no other block has cost nothing more. Where all segments of
  an anchor are equal, every block but that of the first place learns that its windows are found
  earlier. Other anchors are open.
* Round 2: a block sends each distinct segment of the open anchors once, and learns which of them
  are found as a whole in an earlier place. The others are the first of their kind.
* Round 3: what is left is settled window by window. The bytes of these segments are sent to the
  task of their anchor, which sorts their windows (sort_windows). Where that is not asked for, and for
  anchors with more than CROWD segments, each distinct window is sent by its fingerprint instead.

A fingerprint that a third of all documents hold is one message per block, so no key is hot, and
messages grow with the input. Blocks keep only arrays of their own text. Anchors, segments and
windows are compared by 64 bits, and segments by their anchor's, windows by 32 more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64
_STEP = 1 << 20  # windows that are analysed at a time
_PLACE = U((1 << 24) - 1)
_LAST = np.iinfo(np.int64).max  # stands for a missing doc_id
EARLIER, OPEN, EARLIER_SEGMENT, EARLIER_WINDOW, CROWDED, SUFFIXES = range(6)
CROWD = 4096  # segments of an anchor that one task may get
_FEW = 1 << 20  # numbers under this stand for so many segments, others are a fingerprint
ANCHORS, SEGMENTS, WINDOWS = EARLIER, EARLIER_SEGMENT, EARLIER_WINDOW  # what is asked, by the answer


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_WINDOW_BASE = 0x2545F4914F6CDD1D
_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i up to n."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n + 1, U(b))
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Rolling:
    """Polynomial fingerprints of any stretch of a token array."""

    def __init__(self, tokens: np.ndarray, base: int = 0x5851F42D4C957F2D):
        n = len(tokens)
        size = 1 << max(10, int(n).bit_length())
        self._powers, self._inverse = _powers(base, size)
        self._sums = np.zeros(n + 1, U)
        with np.errstate(over="ignore"):
            np.cumsum(tokens * self._powers[:n], out=self._sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._sums[end] - self._sums[start]) * self._inverse[start])


def byte_tokens(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, best = 1, values
    while 2 * size <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    rest = width - size
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


@dataclass
class Block:
    """The documents of a block in order of doc_id, as one array of tokens."""

    ids: np.ndarray  # doc_id of each document
    starts: np.ndarray  # first token of each document, and the number of all tokens
    tokens: np.ndarray | Callable[[int, int], np.ndarray]
    size: int  # tokens in a window
    gram: int  # tokens in an anchor

    def __post_init__(self):
        n = int(self.starts[-1])
        self.valid = np.ones(n, bool)
        for s, e in zip(self.starts[:-1].tolist(), self.starts[1:].tolist(), strict=True):
            self.valid[max(s, e - self.size + 1) : e] = False

    def piece(self, a: int, b: int) -> np.ndarray:
        return self.tokens(a, b) if callable(self.tokens) else self.tokens[a:b]

    def pieces(self):
        """(first, tokens) of overlapping pieces; the windows that start in them are disjoint."""
        n = len(self.valid)
        for a in range(0, n, _STEP):
            b = min(n, a + _STEP + self.size - 1)
            if b - a >= self.size:
                yield a, self.piece(a, b)

    def segments(self) -> dict[str, np.ndarray]:
        """start, count (windows), place (of the anchor), anchor and segment (fingerprints)."""
        found = []
        for a, tokens in self.pieces():
            hashes = Rolling(tokens)
            n = len(tokens)
            grams = self._grams(hashes, n)
            ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=U)
            best = (_sliding_min(ranked, self.size - self.gram + 1) & _PLACE).astype(np.int64)
            valid = self.valid[a : a + len(best)]
            change = np.empty(len(best) + 1, bool)
            change[0] = change[-1] = True
            np.not_equal(best[1:], best[:-1], out=change[1:-1])
            step = np.empty(len(best) + 1, bool)
            step[0] = step[-1] = True
            np.not_equal(valid[1:], valid[:-1], out=step[1:-1])
            change |= step
            first = np.flatnonzero(valid & change[:-1])
            last = np.flatnonzero(valid & change[1:])
            place = best[first]
            with np.errstate(over="ignore"):
                whole = mix(hashes(first, last + self.size) ^ mix((place - first).astype(U) + U(1)))
            found.append((first + a, last - first + 1, place + a, grams[place], whole))
        names = ("start", "count", "place", "anchor", "segment")
        kinds = (np.int64, np.int64, np.int64, U, U)
        return {
            name: np.concatenate([f[i] for f in found]) if found else np.zeros(0, kinds[i])
            for i, name in enumerate(names)
        }

    def _grams(self, hashes: Rolling, n: int) -> np.ndarray:
        at = slice(0, n - self.gram + 1)
        with np.errstate(over="ignore"):
            return mix((hashes._sums[self.gram :] - hashes._sums[: n - self.gram + 1]) * hashes._inverse[at])

    def fingerprints(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 bits and 32 more of the windows that start at the given, ascending places."""
        main, check = np.zeros(len(windows), U), np.zeros(len(windows), np.uint32)
        for a, tokens in self.pieces():
            lo, hi = np.searchsorted(windows, (a, a + _STEP))
            if lo < hi:
                at = windows[lo:hi] - a
                main[lo:hi] = Rolling(tokens, _WINDOW_BASE)(at, at + self.size)
                with np.errstate(over="ignore"):
                    other = Rolling(mix(tokens + U(0x632BE59BD9B4E019)), 0x369DEA0F31A53F85)
                check[lo:hi] = (other(at, at + self.size) >> U(32)).astype(np.uint32)
        return main, check

    def where(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and offset in the document of the tokens at these places."""
        doc = np.searchsorted(self.starts, places, side="right") - 1
        return self.ids[doc], places - self.starts[doc]


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, begins, group): a stable order of the keys, where groups begin in it, and each one's group."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is among the ascending ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All windows of the segments, ascending if the segments are."""
    total = int(counts.sum())
    skip = np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + (np.arange(total) - skip)


def _local(anchor: np.ndarray, segment: np.ndarray) -> dict[str, np.ndarray]:
    """For each segment: first, the first one with its anchor, and mixed, whether their segments differ."""
    order, begins, group = groups(anchor)
    head = order[begins]
    differs = segment[order] != segment[head][group] if len(order) else np.zeros(0, bool)
    mixed = np.logical_or.reduceat(differs, begins) if len(begins) else np.zeros(0, bool)
    sizes = np.diff(np.append(begins, len(order)))
    first, is_mixed = np.empty(len(order), np.int64), np.empty(len(order), bool)
    first[order], is_mixed[order] = head[group], mixed[group]
    return {"first": first, "mixed": is_mixed, "heads": head, "head_mixed": mixed, "sizes": sizes}


_COLUMNS = ("<u8", "<u8", "<i8", "<u4")  # key, other, doc, pos


def _pack(block: int, buckets: int, kind: int, key, other, doc, pos) -> pa.Table:
    """Messages as one row per bucket; columns one after the other, which compresses better than records."""
    target = (key % U(buckets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    bounds = np.searchsorted(target[order], np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        at = order[bounds[b] : bounds[b + 1]]
        if len(at):
            parts = zip((key, other, doc, pos), _COLUMNS, strict=True)
            rows.append((b, b"".join(x[at].astype(kind).tobytes() for x, kind in parts)))
    return pa.table({
        "bucket": pa.array([r[0] for r in rows], pa.int32()),
        "block": pa.array([block] * len(rows), pa.int32()),
        "kind": pa.array([kind] * len(rows), pa.int32()),
        "data": pa.array([r[1] for r in rows], pa.binary()),
    })


_MESSAGES = "bucket int, block int, kind int, data binary"
_REPLIES = "block int, kind int, data binary"
_REPLY_SCHEMA = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])


def _unpack(table: pa.Table):
    """(block, key, other, doc, pos) of all messages of a bucket."""
    blocks, columns = [], ([], [], [], [])
    for block, data in zip(table["block"].to_pylist(), table["data"].to_pylist(), strict=True):
        n = len(data) // 28
        blocks.append(np.full(n, block, np.int32))
        for i, kind in enumerate(_COLUMNS):
            columns[i].append(np.frombuffer(data, kind, n, 8 * n * i))
    return np.concatenate(blocks), *(np.concatenate(c) for c in columns)


def _answer(table: pa.Table, same_doc: bool, kind: int) -> pa.Table:
    """Replies to the messages of one bucket.

    A key that only one block sent needs none. ``other`` is part of the key of segments and windows;
    for anchors it is the segment's fingerprint, or their number; keys with different ones are open.
    """
    windows = kind != ANCHORS
    block, key, other, doc, pos = _unpack(table)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    twin = np.zeros(len(key), bool)
    np.equal(ordered[1:], ordered[:-1], out=twin[1:])
    twin[:-1] |= twin[1:]
    at = order[twin]
    block, key, other, doc, pos = block[at], key[at], other[at], doc[at], pos[at]
    order = np.lexsort((pos, doc, other, key)) if windows else np.lexsort((pos, doc, key))
    block, key, other, doc, pos = block[order], key[order], other[order], doc[order], pos[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    if windows:
        new[1:] |= other[1:] != other[:-1]
    begins, group = np.flatnonzero(new), np.cumsum(new) - 1
    is_open = crowded = np.zeros(len(key), bool)
    if not windows and len(key):
        several = other < _FEW
        is_open = np.logical_or.reduceat((other != other[begins][group]) | several, begins)[group]
        number = np.add.reduceat(np.where(several, other, U(1)), begins)
        crowded = is_open & (number > CROWD)[group]
    head = begins[group]
    later = doc > doc[head]
    if same_doc:
        later |= (doc == doc[head]) & (pos > pos[head])
    rows = []
    for reply, chosen in ((kind, later & ~is_open), (OPEN, is_open), (CROWDED, crowded)):
        to, keys = block[chosen], key[chosen]
        by = np.argsort(to, kind="stable")
        to, keys = to[by], keys[by]
        for b in np.unique(to).tolist():
            lo, hi = np.searchsorted(to, (b, b + 1))
            rows.append((b, reply, keys[lo:hi].tobytes()))
    return pa.Table.from_pylist([dict(zip(_REPLY_SCHEMA.names, r, strict=True)) for r in rows], _REPLY_SCHEMA)


def _pack_segments(block: int, buckets: int, anchor, doc, texts: list[bytes]) -> pa.Table:
    """Segments as one row per bucket: lengths, doc_ids, and their bytes one after the other."""
    target = (anchor % U(buckets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    bounds = np.searchsorted(target[order], np.arange(buckets + 1))
    lengths = np.array([len(t) for t in texts], "<u4")
    rows = []
    for b in range(buckets):
        at = order[bounds[b] : bounds[b + 1]]
        if len(at):
            head = np.array([len(at)], "<u4").tobytes() + lengths[at].tobytes() + doc[at].astype("<i8").tobytes()
            rows.append((b, head + b"".join([texts[k] for k in at.tolist()])))
    return pa.table({
        "bucket": pa.array([r[0] for r in rows], pa.int32()),
        "block": pa.array([block] * len(rows), pa.int32()),
        "kind": pa.array([SUFFIXES] * len(rows), pa.int32()),
        "data": pa.array([r[1] for r in rows], pa.binary()),
    })


def _answer_segments(table: pa.Table, size: int, sort_windows) -> pa.Table:
    """Which windows of the segments of one bucket start in an earlier document of another block."""
    blocks, lengths, docs, texts = [], [], [], []
    for block, data in zip(table["block"].to_pylist(), table["data"].to_pylist(), strict=True):
        n = int(np.frombuffer(data, "<u4", 1)[0])
        blocks.append(np.full(n, block, np.int32))
        lengths.append(np.frombuffer(data, "<u4", n, 4))
        docs.append(np.frombuffer(data, "<i8", n, 4 + 4 * n))
        texts.append(data[4 + 12 * n :])
    block, length, doc = (np.concatenate(x) for x in (blocks, lengths, docs))
    data = np.frombuffer(b"".join(texts), np.uint8)
    start = np.cumsum(length.astype(np.int64)) - length
    order = np.argsort(doc, kind="stable")
    counts = length[order].astype(np.int64) - size + 1
    windows = spread(start[order], counts)
    of = np.repeat(order, counts)
    by, begins, group = groups(sort_windows(data, windows))
    head = by[begins][group]
    # Windows that start earlier in their own block are found there.
    found = by[(doc[of[by]] > doc[of[head]]) & (block[of[by]] != block[of[head]])]
    keys = Rolling(byte_tokens(data), _WINDOW_BASE)(windows[found], windows[found] + size)
    to = block[of[found]]
    rows = []
    at = np.argsort(to, kind="stable")
    to, keys = to[at], keys[at]
    for b in np.unique(to).tolist():
        lo, hi = np.searchsorted(to, (b, b + 1))
        rows.append((b, EARLIER_WINDOW, np.unique(keys[lo:hi]).tobytes()))
    return pa.Table.from_pylist([dict(zip(_REPLY_SCHEMA.names, r, strict=True)) for r in rows], _REPLY_SCHEMA)


def _replies(table: pa.Table) -> dict[int, np.ndarray]:
    """The ascending keys of each kind that a block has been told."""
    parts: dict[int, list] = {k: [] for k in (EARLIER, OPEN, EARLIER_SEGMENT, EARLIER_WINDOW, CROWDED)}
    for kind, data in zip(table["kind"].to_pylist(), table["data"].to_pylist(), strict=True):
        parts[kind].append(np.frombuffer(data, "<u8"))
    return {k: np.sort(np.concatenate(v)) if v else np.zeros(0, U) for k, v in parts.items()}


def repeated(block: Block, told: dict[int, np.ndarray], same_doc: bool, label) -> np.ndarray:
    """The windows of a block that start earlier, as ascending places."""
    s = block.segments()
    if not len(s["start"]):
        return s["start"]
    doc, _ = block.where(s["place"])

    def later(first: np.ndarray) -> np.ndarray:
        """Whether segments come after the first ones of their kind."""
        return first != np.arange(len(first)) if same_doc else doc > doc[first]

    anchors, alike = _local(s["anchor"], s["segment"]), _local(s["segment"], s["anchor"])
    earlier = within(s["anchor"], told[EARLIER])
    single = ~within(s["anchor"], told[OPEN]) & ~anchors["mixed"]
    copied = within(s["segment"], told[EARLIER_SEGMENT]) | later(alike["first"])
    whole = earlier | np.where(single, later(anchors["first"]), copied)
    expand = ~whole & ~single
    found = [spread(s["start"][whole], s["count"][whole])]
    windows = spread(s["start"][expand], s["count"][expand])
    if len(windows):
        order, begins, group = groups(label(block, windows))
        head = order[begins][group]
        if same_doc:
            dup_of = order != head
        else:
            of, _ = block.where(windows)
            dup_of = of[order] > of[head]
        dup = np.zeros(len(windows), bool)
        dup[order] = dup_of
        if len(told[EARLIER_WINDOW]):
            dup |= within(block.fingerprints(windows)[0], told[EARLIER_WINDOW])
        found.append(windows[dup])
    return np.sort(np.concatenate(found))


def covered(n: int, windows: np.ndarray, size: int) -> np.ndarray:
    """Whether each of n tokens lies in one of the windows."""
    steps = np.zeros(n + 1, np.int32)
    steps[windows] += 1
    steps[windows + size] -= 1
    return np.cumsum(steps[:-1]) > 0


def n_blocks(docs: DataFrame, block_bytes: int) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, round(total / block_bytes))


def find_repeats(
    docs: DataFrame,
    make_block: Callable[[np.ndarray, list[bytes]], Block],
    finish: Callable[[Block, list[bytes], np.ndarray], dict],
    schema: str,
    same_doc: bool,
    block_bytes: int,
    label=lambda block, windows: block.fingerprints(windows)[0],
    window: int = 0,
    sort_windows: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """One row per document: doc_id and what ``finish`` makes of its block's covered tokens.

    ``make_block`` turns doc_ids and texts into a Block; ``label`` numbers windows so that equal
    ones in a block have equal numbers. ``same_doc``: an earlier start in the same document counts.
    ``sort_windows``, for blocks of bytes with windows of ``window`` bytes, numbers the windows at
    given places of a byte array in the same way.
    """
    buckets = n_blocks(docs, block_bytes)
    doc_id = F.col("doc_id").cast("long")
    spread_key = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    if same_doc:
        # Texts without id are documents of their own, after all others, in the order of a hash.
        top = max(docs.agg(F.max(doc_id)).first()[0] or 0, 0)
        missing = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(max(_LAST - top, 1))) + F.lit(min(top, _LAST - 1) + 1)
    else:
        missing = F.lit(_LAST)
    rows = docs.select(
        F.pmod(spread_key, F.lit(buckets)).cast("int").alias("block"), doc_id.alias("doc_id"), F.coalesce(doc_id, missing).alias("order"), "text"
    )

    def load(table: pa.Table) -> tuple[Block, list[bytes], pa.Table]:
        table = table.sort_by([("order", "ascending"), ("text", "ascending")])
        ids = table["order"].to_numpy()
        texts = [b"" if x is None else x for x in table["text"].cast(pa.binary()).to_pylist()]
        return make_block(ids, texts), texts, table

    def ask_anchors(table: pa.Table) -> pa.Table:
        block, _, _ = load(table)
        s = block.segments()
        local = _local(s["anchor"], s["segment"])
        heads = local["heads"]
        doc, pos = block.where(s["place"][heads])
        number = np.minimum(local["sizes"], _FEW - 1).astype(U)
        other = np.where(local["head_mixed"], number, s["segment"][heads])
        return _pack(table["block"][0].as_py(), buckets, ANCHORS, s["anchor"][heads], other, doc, pos)

    def ask_more(kind: int):
        """Asks about segments or windows of the open anchors, and hands on what the block was told."""

        def ask(table: pa.Table, replies: pa.Table) -> pa.Table:
            handed = pa.table({n: replies["block" if n == "bucket" else n] for n in ("bucket", *_REPLY_SCHEMA.names)})
            told = _replies(replies)
            if not table.num_rows or not len(told[OPEN]):
                return handed
            number = table["block"][0].as_py()
            block, _, _ = load(table)
            s = block.segments()
            chosen = within(s["anchor"], told[OPEN])
            if kind == WINDOWS:
                chosen &= ~within(s["segment"], told[EARLIER_SEGMENT])
            chosen = np.flatnonzero(chosen)
            order, begins, _ = groups(s["segment"][chosen])
            first = chosen[np.sort(order[begins])]
            parts = [handed.cast(pa.schema([("bucket", pa.int32()), *_REPLY_SCHEMA]))]
            if kind == SEGMENTS:
                key, other, place = s["segment"][first], s["anchor"][first], s["place"][first]
            else:
                if sort_windows is not None:
                    crowded = within(s["anchor"][first], told[CROWDED])
                    few, first = first[~crowded], first[crowded]
                    a, b = s["start"][few], s["start"][few] + s["count"][few] + block.size - 1
                    texts = [block.data[i:j].tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)]
                    doc, _ = block.where(a)
                    parts.append(_pack_segments(number, buckets, s["anchor"][few], doc, texts))
                windows = spread(s["start"][first], s["count"][first])
                order, begins, _ = groups(label(block, windows))
                place = np.sort(windows[order[begins]])
                key, other = block.fingerprints(place)
            parts.append(_pack(number, buckets, kind, key, other, *block.where(place)))
            return pa.concat_tables(parts)

        return ask

    def answer(kind: int):
        """Answers what was asked and hands on what the blocks were told in the rounds before."""

        def reply(table: pa.Table) -> pa.Table:
            # An answer has the number of its question; only the kinds of earlier rounds are handed on.
            kinds = np.array(table["kind"].to_pylist())
            asked, sent = kinds == kind, kinds == SUFFIXES
            handed = table.filter(pa.array(~asked & ~sent)).select(_REPLY_SCHEMA.names).cast(_REPLY_SCHEMA)
            parts = [handed]
            if asked.any():
                parts.append(_answer(table.filter(pa.array(asked)), same_doc, kind))
            if sent.any():
                parts.append(_answer_segments(table.filter(pa.array(sent)), window, sort_windows))
            return pa.concat_tables(parts)

        return reply

    def conclude(table: pa.Table, replies: pa.Table) -> pa.Table:
        block, texts, table = load(table.select(["doc_id", "order", "text"]))
        found = repeated(block, _replies(replies), same_doc, label)
        gone = covered(len(block.valid), found, block.size)
        return pa.table({"doc_id": table["doc_id"], **finish(block, texts, gone)})

    told = (
        rows.groupBy("block").applyInArrow(ask_anchors, _MESSAGES).groupBy("bucket").applyInArrow(answer(ANCHORS), _REPLIES)
    )
    for kind in (SEGMENTS, WINDOWS):
        asked = rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(ask_more(kind), _MESSAGES)
        told = asked.groupBy("bucket").applyInArrow(answer(kind), _REPLIES)
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(conclude, f"doc_id long, {schema}")
