"""Periodic runs of words by recompression: exact maximal repetitions without suffix arrays.

A run is a stretch of consecutive words with a smallest period q that no neighbouring word extends, of
``times`` periods and ``least`` words or more. Tasks number the words of many documents in one sequence,
with a symbol of its own before, between and after documents, and recompress it: block compression
replaces each maximal repetition of one symbol by a symbol (a, k), pair compression splits the alphabet in two
and replaces pairs of a left and a right symbol; they alternate until one symbol is left. The levels are a
run-length grammar: equal symbols of a level stand for equal words, and as both steps look at neighbours
only, equal stretches are cut alike but at their ends.

A common extension of two places climbs the levels while both stand at the border of a parent, with at most
one symbol or block read per level, and goes down again where symbols differ, again with one symbol or
block read per level; so each query takes O(log n) steps, and all queries of a slice take them together.

Candidates of period q are the places on a grid of (times - 1) * q words: a run of times * q words holds such a
place and the one q further on, so the words there are equal and the extensions of the two, to both sides, give the
run. This is a harmonic sum, O(n log n) pairs of a document of n words; pairs with different words are dropped
at once. A multiple of the smallest period gives the same stretch, so per stretch the least period counts.

No words are shuffled, and a document is held by one task. A slice of documents has SLICE words, or is one document.

Defined cases: null and empty texts have no words and no runs; every row gives a row, repeated ones too; other
columns are ignored; an empty table gives an empty result. ``with_periodic_tails`` leaves rows without id as they are.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, let

LEAST, TIMES = 6, 4
#: Words whose documents share a grammar, and candidates that are looked at together.
SLICE, CANDIDATES = 1 << 18, 1 << 20


@dataclass
class Level:
    """Symbols of a level. Each has a parent on the next level and children from first to last on the one
    below; ahead and behind count the equal symbols from a place on, itself included, to each side."""

    symbols: np.ndarray
    first: np.ndarray
    last: np.ndarray
    ahead: np.ndarray
    behind: np.ndarray
    parent: np.ndarray | None = None


def _level(symbols: np.ndarray, first: np.ndarray, last: np.ndarray) -> Level:
    n = len(symbols)
    change = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    starts = np.concatenate([[0], change])
    sizes = np.diff(np.concatenate([starts, [n]]))
    at = np.arange(n) - np.repeat(starts, sizes)
    behind = (at + 1).astype(np.int32)
    return Level(symbols, first.astype(np.int32), last.astype(np.int32), (np.repeat(sizes, sizes) - at).astype(np.int32), behind)


def _named(symbols: np.ndarray, first: np.ndarray, other: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """New symbols: those not joined keep theirs in a dense numbering, (symbol, other) pairs get one each."""
    key = symbols[first].astype(np.int64) << 32
    key[joined] |= other[joined].astype(np.int64) + 1
    return np.unique(key, return_inverse=True)[1].astype(np.int32)


def _up(level: Level, first: np.ndarray, symbols: np.ndarray) -> Level:
    n = len(level.symbols)
    last = np.concatenate([first[1:], [n]]) - 1
    level.parent = np.repeat(np.arange(len(first), dtype=np.int32), last - first + 1)
    return _level(symbols, first, last)


def compress_blocks(level: Level) -> Level:
    """A symbol (a, k) for each maximal repetition of k > 1 equal symbols a."""
    first = np.flatnonzero(level.behind == 1)
    size = level.ahead[first]
    return _up(level, first, _named(level.symbols, first, size, size > 1))


def compress_pairs(level: Level, salt: int) -> Level:
    """A symbol for each pair of a left and a right symbol; neighbours differ, as blocks are compressed."""
    symbols = level.symbols
    mixed = (np.arange(int(symbols.max()) + 1, dtype=np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    side = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)[symbols]
    pairs = max(side[:-1] & ~side[1:], ~side[:-1] & side[1:], key=np.count_nonzero)
    is_first = np.ones(len(symbols), bool)
    is_first[1:] = ~pairs
    first = np.flatnonzero(is_first)
    joined = np.append(pairs, False)[first]
    other = np.append(symbols[1:], 0)[first]
    return _up(level, first, _named(symbols, first, other, joined))


def recompress(symbols: np.ndarray) -> list[Level]:
    """The levels of the grammar; the last one has one symbol."""
    n = np.arange(len(symbols))
    levels = [_level(symbols.astype(np.int32), n, n)]
    while len(levels[-1].symbols) > 1:
        levels.append(compress_blocks(levels[-1]))
        if len(levels[-1].symbols) > 1:
            levels.append(compress_pairs(levels[-1], len(levels)))
    return levels


def common_extension(levels: list[Level], x: np.ndarray, y: np.ndarray, ahead: bool = True) -> np.ndarray:
    """How many symbols from places x and y on, to one side, are equal, for pairs x < y.

    The sequence must have a symbol at each end that is nowhere else.
    """
    start, query, apart = x, np.arange(len(x)), []

    def read(level: Level, x, y, where):
        """Past the equal symbols from x and y on: one symbol, or what both blocks have left."""
        rest = level.ahead if ahead else level.behind
        far = np.where(where, np.minimum(rest[x], rest[y]), 0)
        return (x + far, y + far) if ahead else (x - far, y - far)

    for level, above in zip(levels, levels[1:]):
        if not len(query):
            break
        border, parent = above.first if ahead else above.last, level.parent
        same = level.symbols[x] == level.symbols[y]
        inside = (border[parent[x]] != x) | (border[parent[y]] != y)
        x, y = read(level, x, y, same & inside)
        climb = same & (border[parent[x]] == x) & (border[parent[y]] == y)
        apart.append((x[~climb], y[~climb], query[~climb]))
        x, y, query = parent[x[climb]], parent[y[climb]], query[climb]
    x = y = query = np.zeros(0, np.int64)
    for height in range(len(apart) - 1, -1, -1):
        level, above = levels[height], levels[height + 1]
        border = above.first if ahead else above.last
        x, y = border[x], border[y]
        x, y = read(level, x, y, level.symbols[x] == level.symbols[y])
        x, y, query = (np.concatenate(both) for both in zip((x, y, query), apart[height]))
    out = np.empty(len(start), np.int64)
    out[query] = np.abs(x - start[query])
    return out


def _candidates(offsets: np.ndarray, sizes: np.ndarray, times: int):
    """(place, period) of the grids of all documents, about CANDIDATES at a time."""
    periods = sizes // times
    doc = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    places = np.where(sizes[doc] > period, (sizes[doc] - period - 1) // ((times - 1) * period) + 1, 0)
    upto = np.cumsum(places)
    begin = 0
    while begin < len(doc):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + CANDIDATES, "right")))
        some = places[begin:end]
        step = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        q = np.repeat(period[begin:end], some)
        yield np.repeat(offsets[doc[begin:end]], some) + step * (times - 1) * q, q
        begin = end


def runs_of(documents: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """Per document of word numbers the rows (start, length, period) of its runs, by start and period."""
    sizes = np.array([len(d) for d in documents], np.int64)
    offsets = np.cumsum(sizes + 1) - sizes
    top = max((int(d.max()) + 1 for d in documents if len(d)), default=0)
    parts = [np.array([top])]
    for number, document in enumerate(documents):
        parts += [document, np.array([top + number + 1])]
    text = np.concatenate(parts)
    levels = recompress(text)
    found = [np.zeros((0, 3), np.int64)]
    for x, q in _candidates(offsets, sizes, times):
        equal = text[x] == text[x + q]
        x, q = x[equal], q[equal]
        ahead = common_extension(levels, x, x + q)
        behind = common_extension(levels, x - 1, x + q - 1, ahead=False)
        length = behind + ahead + q
        run = length >= np.maximum(least, times * q)
        rows = np.stack([x - behind, length, q], 1)[run]
        # A stretch is found at several places, and with multiples of its smallest period.
        found.append(_distinct(rows))
    rows = _distinct(np.concatenate(found))
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], offsets)
    rows[:, 0] -= np.repeat(offsets, np.diff(np.append(cuts, len(rows))))
    return np.split(rows, cuts[1:])


def _distinct(rows: np.ndarray) -> np.ndarray:
    """The row of least period for each (start, length)."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


def collapse(words: list[bytes], runs: np.ndarray) -> str:
    """The words without those that a run holds after its first period."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        kept[start + period : start + length] = False
    return b" ".join(compress(words, kept.tolist())).decode()


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, runs as (start, length, period) by start and period, collapsed: the text without repeats)."""
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def solved(keys, texts):
        numbers = defaultdict(count().__next__)
        documents = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
        runs = runs_of(documents, least, times)
        lists = [[dict(zip(("start", "length", "period"), row)) for row in found.tolist()] for found in runs]
        columns = [pa.array(keys, id_type), pa.array(lists, run_type), pa.array(map(collapse, texts, runs), pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    def solve(batches):
        for batch in batches:
            keys, texts, size = [], [], 0
            for doc_id, text in arrow_rows(batch, "doc_id", "text"):
                keys.append(doc_id)
                texts.append((text or "").encode().split())  # bytes are split at the ASCII white space
                size += len(texts[-1])
                if size >= SLICE:
                    yield solved(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield solved(keys, texts)

    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    out += ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(solve, out)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document by the checksum of its id gets a tail that repeats its first words."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def changed(words):
        n, g = F.size(words).cast("long"), F.floor(checksum / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))), " ")

    tail = let(words, lambda w: F.when(F.size(w) > 0, changed(w)).otherwise(F.lit("")))
    chosen = (checksum % 10 == 0) & F.col("text").isNotNull()
    return docs.withColumn("text", F.when(chosen, tail).otherwise(F.col("text")))


def digest(found: DataFrame) -> DataFrame:
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("order"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    n = F.size("runs").cast("long")
    return found.select(
        "doc_id",
        n.alias("n_runs"),
        first.start.alias("start"),
        (-first.order).alias("length"),
        first.period.alias("period"),
        F.floor(-first.order * 1000 / first.period).alias("exponent_milli"),
        F.sha2(F.when(n > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
