"""Repeated windows of words and bytes against a plain search."""

import hashlib
import re

import numpy as np
import pytest

from reviewloom.llm import substrings, suffixes
from reviewloom.llm.windows import Rolling, byte_tokens

LAST = 1 << 62


def sha(x):
    return hashlib.sha256(x).hexdigest()


def brute_words(rows, size=50):
    lists = [(LAST if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in lists:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for (doc_id, _), (d, w) in zip(rows, lists):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), sha(left.encode())))
    return sorted(out, key=str)


def missing_order(spark, rows):
    """The places of texts without id: after all ids, by a hash of the text."""
    from pyspark.sql import functions as F

    top = max(d for d, _ in rows if d is not None)
    texts = spark.createDataFrame([(t,) for d, t in rows if d is None], "text string").distinct()
    number = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit((1 << 63) - 1 - top))
    return {r.text: r.n for r in texts.select("text", number.alias("n")).collect()}


def brute_bytes(rows, order, size=100):
    first, out = {}, []
    ordered = sorted(((d is None, order[t] if d is None else d, (t or "").encode(), d) for d, t in rows), key=lambda x: x[:3])
    for number, (*_, b, _) in enumerate(ordered):
        for i in range(len(b) - size + 1):
            first.setdefault(b[i : i + size], (number, i))
    for number, (*_, b, doc_id) in enumerate(ordered):
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] != (number, i):
                gone[i : i + size] = b"\1" * size
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 22])
def test_words(odd, plain, block_bytes):
    got = substrings.digest(substrings.remove_repeats(odd, block_bytes=block_bytes)).collect()
    assert sorted(map(tuple, got), key=str) == brute_words(plain)


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 22])
def test_bytes(spark, odd, plain, block_bytes):
    got = suffixes.digest(suffixes.remove_repeats(odd, block_bytes=block_bytes)).collect()
    assert sorted(map(tuple, got), key=str) == brute_bytes(plain, missing_order(spark, plain))


@pytest.mark.parametrize("block_bytes", [300, 2_000, 1 << 22])
def test_texts_without_id_that_share_a_passage(spark, block_bytes):
    """What is removed does not hang on the blocks that the texts are dealt to."""
    passage = "the passage that three texts without an id share, word for word, and which is long enough to be found. " * 2
    rows = [(None, f"{k}" * (60 * k) + passage + f"end {k}") for k in range(1, 4)] + [(None, "x"), (None, None), (5, "five " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.digest(suffixes.remove_repeats(df, block_bytes=block_bytes)).collect()
    assert sorted(map(tuple, got), key=str) == brute_bytes(rows, missing_order(spark, rows))


def test_ids_near_the_largest_number(spark):
    rows = [((1 << 63) - 2, "abc" * 60), ((1 << 63) - 1, "abc" * 60), (None, "abc" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert suffixes.remove_repeats(df).count() == 3


def test_spans_and_kept_text_agree(odd):
    for r in substrings.remove_repeats(odd).collect():
        assert sum(s["end"] - s["start"] for s in r.spans) == r.n_removed
        assert len(r.kept.split()) == r.n_words - r.n_removed
    for r in suffixes.remove_repeats(odd).collect():
        assert sum(s["end"] - s["start"] for s in r.spans) == r.n_removed == r.n_bytes - len(r.kept)


def test_null_ids_and_empty_tables(odd, none):
    assert suffixes.remove_repeats(odd).count() == odd.count()
    assert substrings.digest(substrings.remove_repeats(none)).collect() == []
    assert suffixes.digest(suffixes.remove_repeats(none)).collect() == []


def test_pieces_of_a_long_text(spark, monkeypatch):
    """A text longer than a piece is analysed in overlapping pieces."""
    from reviewloom.llm import windows

    monkeypatch.setattr(windows, "_STEP", 300)
    data = np.frombuffer((b"abcdefghij" * 30 + bytes(range(97, 122)) * 9) * 4, np.uint8)
    block = windows.Block(np.array([1]), np.array([0, len(data)]), byte_tokens(data), 100, 24)
    told = {k: np.zeros(0, np.uint64) for k in range(4)}
    label = lambda b, w: suffixes.radix_order(data, w, 100)
    found = set(windows.repeated(block, told, True, label).tolist())
    seen, want = set(), set()
    for i in range(len(data) - 99):
        key = data[i : i + 100].tobytes()
        want |= {i} if key in seen else set()
        seen.add(key)
    assert found == want


def test_radix_order_groups_equal_suffixes():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    starts = np.arange(3900)
    label = suffixes.radix_order(data, starts, 13)
    by_text = {}
    for s, g in zip(starts.tolist(), label.tolist()):
        assert by_text.setdefault(data[s : s + 13].tobytes(), g) == g
    assert len(set(by_text.values())) == len(by_text)


def test_fingerprints_of_equal_stretches_are_equal():
    data = np.frombuffer(b"one two three one two three", np.uint8)
    r = Rolling(byte_tokens(data))
    assert r(np.array([0]), np.array([13])) == r(np.array([14]), np.array([27]))
    assert r(np.array([0]), np.array([12])) != r(np.array([14]), np.array([27]))
