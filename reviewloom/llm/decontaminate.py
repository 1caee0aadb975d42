"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

The items are normalised (A-Z lowered, everything but digits, letters and non-ASCII characters
to single spaces) and their 13-word windows become the patterns of the automaton. Each text is
normalised the same way and scanned once; a match ends at a space, and the number of spaces
before it is the number of the word, so matches map back to words and to offsets of the original.

Only the benchmark is sent to the tasks. Its patterns are counted first: beyond
``max_patterns`` they are cut into slices by hash, one automaton after the other, and a
text passes through all of them. The texts never move: there is no shuffle of documents.

Defined cases: a null text has no words; an item without an id or without words is ignored;
an item with fewer than 13 words is one window; items with equal windows are all credited; rows
with the same doc_id are judged one by one; an empty benchmark leaves everything clean.
"""

from __future__ import annotations

import math
import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows

WINDOW = 13
#: Documents with at least this share of hit words, 1 in SHARE, are contaminated.
SHARE = 20
MAX_PATTERNS = 200_000
#: Words of the text before lowering A-Z.
_ORIGINAL = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def normalise(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def windows(text: str | None, size: int = WINDOW) -> list[str]:
    """The distinct windows of an item, each as words between single spaces."""
    words = [w.decode("utf-8", "replace") for w in normalise(text)]
    if not words:
        return []
    last = max(1, len(words) - size + 1)
    return list(dict.fromkeys(f" {' '.join(words[i : i + size])} " for i in range(last)))


def patterns(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, items) with the ids of the items that hold the window; an item without id counts, but has none to give."""

    @F.udf("array<string>", useArrow=True)
    def cut(text):
        return windows(text, window)

    return (
        benchmark.select(F.col("item_id").cast("string").alias("item"), F.explode(cut("text")).alias("window"))
        .groupBy("window")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


_automata: dict[str, ahocorasick.Automaton] = {}


def _automaton(key: str, table) -> ahocorasick.Automaton:
    """Built once per Python worker and slice."""
    if key not in _automata:
        _automata.clear()
        automaton = ahocorasick.Automaton()
        for number, (window, _) in enumerate(table.value):
            automaton.add_word(window, (number, window.count(" ") - 1))
        automaton.make_automaton()
        _automata[key] = automaton
    return _automata[key]


def _hits(automaton, table, words: list[bytes], hit: set[int], items: set[str]) -> None:
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    at, count = 0, 0
    for end, (number, length) in automaton.iter(line):
        count += line.count(" ", at, end)
        at = end
        hit.update(range(count - length, count))
        items.update(table.value[number][1])


def _spans(text: str, hit: list[int]) -> list[dict]:
    """Offsets in the original text of the runs of hit words."""
    if not hit:
        return []
    at = np.array([m.span() for m in _ORIGINAL.finditer(text)], np.int64)
    runs = np.split(np.array(hit), np.flatnonzero(np.diff(hit) != 1) + 1)
    return [{"start": int(at[run[0], 0]), "end": int(at[run[-1], 1])} for run in runs]


_FOUND = pa.struct([
    ("n_words", pa.int64()),
    ("hit", pa.list_(pa.int32())),
    ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
])
_FOUND_SQL = "n_words long, hit array<int>, items array<string>, spans array<struct<start:int,end:int>>"


def _scan(rows: DataFrame, table, key: str) -> DataFrame:
    """One automaton over the rows (row, text, found): its hits are added to ``found``."""

    def run(batches):
        automaton = _automaton(key, table) if table.value else None
        for batch in batches:
            found = []
            for text, old in arrow_rows(batch, "text", "found"):
                words = normalise(text)
                hit, items = set(old["hit"]), set(old["items"])
                if automaton is not None and words:
                    _hits(automaton, table, words, hit, items)
                ordered = sorted(hit)
                found.append({
                    "n_words": len(words), "hit": ordered, "items": sorted(items), "spans": _spans(text, ordered)
                })
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            yield pa.RecordBatch.from_pydict(columns | {"found": pa.array(found, _FOUND)})

    return rows.mapInArrow(run, rows.schema)


def _scan_all(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int, max_patterns: int) -> DataFrame:
    """(row, text, found): ``row`` holds the kept columns as they came."""
    spark = docs.sparkSession
    table = patterns(benchmark, window)
    slices = max(1, math.ceil(table.count() / max_patterns))
    nothing = "named_struct('n_words', 0L, 'hit', array(), 'items', array(), 'spans', array())"
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.col("text"),
        F.expr(nothing).cast(f"struct<{_FOUND_SQL.replace(' ', ':').replace(',:', ',')}>").alias("found"),
    )
    for k in range(slices):
        part = table.where(F.pmod(F.xxhash64("window"), F.lit(slices)) == k).collect()
        shared = spark.sparkContext.broadcast(sorted((r["window"], r["items"]) for r in part))
        rows = _scan(rows, shared, uuid.uuid4().hex)
    return rows


def find_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_patterns: int = MAX_PATTERNS
) -> DataFrame:
    """Every document with its hit words and items.

    Returns doc_id, n_words, hit (array of word numbers, ascending), items (array of item ids as
    sorted strings) and spans (array of (start, end): offsets in the original text of each run of
    hit words), one row for each input row.
    """
    return _scan_all(docs, benchmark, ["doc_id"], window, max_patterns).select("row.*", "found.*")


def is_contaminated(n_hit, n_words, share: int = SHARE):
    return (n_hit > 0) & (share * n_hit >= n_words)


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.size("hit").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_patterns: int = MAX_PATTERNS
) -> DataFrame:
    """The clean rows of docs with all their columns. Rows are judged where they lie."""
    rows = _scan_all(docs, benchmark, ["*"], window, max_patterns)
    bad = is_contaminated(F.size("found.hit"), F.col("found.n_words"))
    return rows.where(~bad).select("row.*")
