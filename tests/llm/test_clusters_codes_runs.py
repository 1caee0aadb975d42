"""Clusters, BPE codes and periodic runs against brute force and the tokenizers library."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewloom.llm import prefix_bpe, runs, shallot


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# Clusters


def plain_means(rows, k=8, rounds=10, seed=3):
    """rows: (id, integer components); the docstring's choices, without bounds."""
    ids = sorted((sha(f"{seed}:{i}"), np.array(v, "<i4").tobytes()) for i, v in rows if i is not None)[:k]
    centroids = [list(map(int, np.frombuffer(v, "<i4"))) for _, v in ids]
    if not centroids:
        return [], {}

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in rows]

    for _ in range(rounds):
        where = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(rows, where) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, c, d) for (i, _), (d, c) in zip(rows, assign())], dict(enumerate(centroids))


def vector_rows():
    rng = random.Random(2)
    rows = [(k, [rng.gauss(k % 5, 0.7) for _ in range(64)]) for k in range(300)]
    rows += [(300 + k, list(rows[0][1])) for k in range(150)]  # copies
    rows += [(500 + k, [float((k + j) % 2) for j in range(64)]) for k in range(60)]  # ties
    return rows + [(3, list(rows[9][1])), (None, list(rows[4][1])), rows[7]]


BAD = [(900, None), (901, [1.0] * 63), (902, [1.0] * 65), (903, [float("nan")] + [0.0] * 63), (904, [None] + [0.0] * 63), (905, [float("inf")] * 64), (906, [])]
VECTORS = "vec_id long, embedding array<double>, cluster string, block string, state string"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, v, "a", "b", None) for i, v in vector_rows() + BAD]
    return spark.createDataFrame(rows, VECTORS).repartition(4)


def test_clusters(vectors):
    members, clusters = shallot.cluster(vectors)
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vector_rows()]
    want, centroids = plain_means(kept)
    key = lambda r: (r[0] is None, *map(lambda x: x or 0, r))
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in members.collect()), key=key) == sorted(want, key=key)
    rows = {r.cluster: r for r in clusters.collect()}
    assert set(rows) == {c for _, c, _ in want}
    for c, r in rows.items():
        assert r.centroid == centroids[c] and r.cluster_inertia == sum(d for _, e, d in want if e == c)
        assert r.inertia == sum(d for _, _, d in want) and r.n == sum(e == c for _, e, _ in want)
    digest = shallot.digest(members, clusters).collect()
    assert len(digest) == len(want)
    assert all(r.centroid_sha256 == sha(",".join(map(str, centroids[r.cluster]))) for r in digest)


def test_clusters_of_few_rows(spark, vectors):
    for condition, n in (("vec_id > 900", 0), ("vec_id IS NULL", 0), ("vec_id = 5", 1), ("vec_id < 3", 3)):
        members, clusters = shallot.cluster(vectors.where(condition))
        assert members.count() == n and clusters.count() == n


def test_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e300] * 64, "", "", "")], VECTORS)
    with pytest.raises(Exception, match="too large"):
        shallot.cluster(df)


def test_rounds_move_no_vectors(spark, vectors):
    buckets = shallot._Buckets(spark)
    try:
        blocks = buckets.write(shallot._blocks(vectors.select("vec_id", "embedding"), 8, 3, 64, 1024).repartition(buckets.n, "block"))
        states = buckets.write(blocks.selectExpr("block", "data AS state"))
        joined = blocks.join(states.select("block", "state").hint("shuffle_hash"), "block")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Exchange" not in plan and "Sort" not in plan
    finally:
        buckets.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("reviewloom_")]


def test_bounds_hold_in_every_round():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n, k, width = int(rng.integers(1, 300)), int(rng.integers(1, 20)), int(rng.choice([1, 2, 8]))
        rows = rng.integers(-30, 30, (n, width))
        centroids, before, state = rows[rng.integers(0, n, k)].copy(), None, None
        for _ in range(5):
            state = shallot.Search(centroids, before).assign(rows, state)
            square = ((rows[:, None] - centroids[None]) ** 2).sum(2)
            first = square.argmin(1)
            assert (state["first"] == first).all()
            assert (state["upper"] >= np.sqrt(square[np.arange(n), first])).all()
            square[np.arange(n), first] = 1 << 40
            assert (state["lower"] <= np.sqrt(square.min(1))).all() or k == 1
            before, centroids = centroids, centroids.copy()
            for c in set(first.tolist()):
                centroids[c] = rows[first == c].sum(0) // (first == c).sum()


# Codes

ODD = [
    "ΟΔΟΣ Σ ς İstanbul", "it's 'stuff WE'LL --'s I'M", "a<|endoftext|>b <|startoftext|><|ENDOFTEXT|>", "a b\x1cc\x85d　e",
    "é ́x ﻿hi a​b", "日本語テキスト 12345 ½ ² ǆ ﬀ ẞ", "😀😀 👨‍👩‍👧", "\x00\x01 \x7f", "aaaaaaa aaa aaaaa", "!!!???...",
    "ab" * 500 + " " + "ab" * 499 + "c", "x" * 60_000, "word " * 40_000, "\U0001e900 Ⴀ Ა", "Straße ÀÉÎõÿß ÜBER×÷ Ø'S ªº µ", "naïve 'T'é's don'T",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected_code(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded)


def test_codes(odd, plain, library):
    order = lambda r: str(r)
    got = [tuple(r) for r in prefix_bpe.digest(prefix_bpe.round_trip(odd)).collect()]
    assert sorted(got, key=order) == sorted((expected_code(library, *row) for row in plain), key=order)


def test_codes_of_odd_texts_and_random_words(spark, library):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abehinst' -1é") for _ in range(rng.randrange(200))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in prefix_bpe.digest(prefix_bpe.round_trip(df)).collect())
    assert got == [expected_code(library, k, t) for k, t in enumerate(texts)]


def test_every_token_of_the_vocabulary_is_its_own_code():
    v = prefix_bpe.coder().vocabulary
    assert v.own == set(v.ids.values())
    inner = {t for t in v.ids if not t.endswith(v.end)}
    ended = {t.removesuffix(v.end) for t in v.ids if t.endswith(v.end) and t != v.end}
    codes = v.ids_of(ended)
    assert all(codes[w] == np.array([v.ids[w + v.end]], "<u4").tobytes() for w in ended) and len(inner) > 1000


def test_trie_shares_prefixes():
    words = {"in", "inside", "insider", "instant", "on", "i"}
    trie = prefix_bpe.Trie(sorted(words) + ["in"])

    def walk(node, path=""):
        return ({path} if node[0] else set()) | {w for edge, child in node[1].values() for w in walk(child, path + edge)}

    assert walk(trie.root) == words and set(trie.root[1]) == {"i", "o"}


def test_states_have_the_tokens_that_end_there():
    v, rng = prefix_bpe.coder().vocabulary, random.Random(5)
    for _ in range(300):
        text, state = "", 0
        for character in (rng.choice("abehinst'1Ã©") for _ in range(rng.randrange(1, 15))):
            text, state = text + character, v._step(state, character)
        endings = [text[k:] for k in range(len(text))]
        assert list(v.inner[state]) == [(v.ids[e], len(e)) for e in endings if e in v.ids]
        assert list(v.closing[state]) == [(v.ids[e + v.end], len(e)) for e in endings if e + v.end in v.ids]


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(prefix_bpe, "MEMO", 5)
    coder = prefix_bpe.Coder()
    texts = ["a b c d e f g h", "a b z y x", ""]
    first = coder.encode(texts)
    assert len(coder.pieces) == len(coder.words) == 5 and coder.encode(texts) == first


# Runs


def plain_runs(w, least=6, times=4):
    seen = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, times * q) and i > s:
                seen.setdefault((s, i - s + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in seen.items()), key=lambda r: (r[0], r[2]))


def expected_runs(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in found), default=None)
    top = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return doc_id, len(found), *top, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


def test_runs(odd, plain):
    got = [tuple(r) for r in runs.digest(runs.find_runs(runs.with_periodic_tails(odd))).collect()]
    assert sorted(got, key=str) == sorted((expected_runs(*row) for row in plain), key=str)


def test_runs_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 20000")
    got = sorted(tuple(r) for r in runs.digest(runs.find_runs(runs.with_periodic_tails(df))).collect())
    assert got == sorted(expected_runs(r.doc_id, r.text) for r in df.collect())
    assert sum(r[1] > 0 for r in got) > 5


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.randrange(1, 8)):
            n, k = rng.choice([0, 1, 5, 6, 7, 20, 60, 200]), rng.choice([1, 2, 3, 50])
            text = [rng.randrange(k) for _ in range(n)]
            if n > 10 and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randrange(1, 30)
                text = [text[min(n - 1, a + (i - a) % p)] if i >= a else text[i] for i in range(n)]
            texts.append(text)
        for least, times in ((6, 4), (2, 2), (1, 3)):
            got = runs.runs_of([np.array(t, np.int64) for t in texts], least, times)
            assert [list(map(tuple, g.tolist())) for g in got] == [plain_runs(t, least, times) for t in texts]


def test_small_groups_of_candidates(monkeypatch):
    monkeypatch.setattr(runs, "CANDIDATES", 7)
    text = [1, 2] * 40 + [5] * 9 + [1, 2, 3] * 7
    assert [tuple(r) for r in runs.runs_of([np.array(text)])[0].tolist()] == plain_runs(text)


def test_grammar_spells_its_text():
    rng = np.random.default_rng(4)
    for text in (rng.integers(0, 3, 500), np.zeros(300, int), np.arange(100), np.array([7])):
        levels = runs.recompress(text)
        assert len(levels[-1].symbols) == 1
        meaning = {s: (s,) for s in text.tolist()}
        for level, above in zip(levels, levels[1:]):
            rules = {}
            for symbol, first, last in zip(above.symbols.tolist(), above.first.tolist(), above.last.tolist()):
                spelt = tuple(x for s in level.symbols[first : last + 1].tolist() for x in meaning[s])
                assert rules.setdefault(symbol, spelt) == spelt  # equal symbols stand for equal words
            assert len(set(rules.values())) == len(rules)  # and different ones for different words
            meaning = rules
        assert meaning[int(levels[-1].symbols[0])] == tuple(text.tolist())


def test_common_extensions():
    rng = np.random.default_rng(5)
    body = np.concatenate([np.tile(rng.integers(0, 2, 9), 12), rng.integers(0, 2, 100), np.zeros(50, int), rng.integers(0, 2, 50)])
    text = np.concatenate([[3], body, [4]])
    levels = runs.recompress(text)
    x, y = np.triu_indices(len(text), 1)
    for ahead in (True, False):
        got = runs.common_extension(levels, x, y, ahead)
        for i, j, n in zip(x[::37].tolist(), y[::37].tolist(), got[::37].tolist()):
            k, step = 0, 1 if ahead else -1
            while j + step * k < len(text) and i + step * k >= 0 and text[i + step * k] == text[j + step * k]:
                k += 1
            assert k == n


def test_one_very_long_text(spark):
    text = "a b c " * 200_000
    df = spark.createDataFrame([(2, text), (None, text)], "doc_id long, text string")
    for r in runs.find_runs(df).collect():
        assert [tuple(x) for x in r.runs] == [(0, 600_000, 3)] and r.collapsed == "a b c"


def test_empty_tables(none):
    assert prefix_bpe.round_trip(none).count() == 0
    assert runs.digest(runs.find_runs(runs.with_periodic_tails(none))).count() == 0
