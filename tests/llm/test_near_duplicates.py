"""Classes against the similarities of all pairs of a small fixture."""

from collections import Counter
from hashlib import md5

import numpy as np

from reviewloom.llm import near_duplicates as nd


def brute_labels(rows, idf):
    """The number of the first row of each row's class."""
    texts = [(t or "").encode() for _, t in rows]
    vectors = [(p, nd.weights(p, c, idf)) for p, c in nd.shingles(texts)]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(vectors[i][0]) and len(vectors[j][0]) and nd.similarity(vectors[i], vectors[j]) >= 0.8:
                label[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def brute_classes(rows, idf):
    roots = brute_labels(rows, idf)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if roots[k] == roots[i]]
        known = [x for x in ids if x is not None]
        out.append((d, min(known) if known else None, len(ids)))
    return sorted(out, key=str)


def test_classes(odd, plain):
    got = sorted(map(tuple, nd.classes(odd).collect()), key=str)
    assert got == brute_classes(plain, nd.idf_table(odd))


def test_block_comparison_of_large_groups(odd, plain, monkeypatch):
    """Stragglers are found when their group does not fit one block."""
    monkeypatch.setattr(nd, "BLOCK", 2)
    got = sorted(map(tuple, nd.classes(odd).collect()), key=str)
    assert got == brute_classes(plain, nd.idf_table(odd))


def test_keep_one(odd, plain):
    kept = nd.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == brute_kept(plain, nd.idf_table(odd))


def brute_kept(rows, idf):
    """The row of least (doc_id, digest) of each class, null ids last, and all rows without words."""
    order = lambda r: (r[0] is None, r[0] or 0, md5((r[1] or "").encode()).hexdigest())
    alone = [r for r in rows if not (r[1] or "").split()]
    worded = sorted((r for r in rows if (r[1] or "").split()), key=order)
    kept, labels = [], brute_labels(worded, idf)
    for row, label in zip(worded, labels, strict=True):
        if label not in {x for _, x in kept}:
            kept.append((row, label))
    return Counter([r for r, _ in kept] + alone)


def test_keep_one_of_repeated_rows(spark):
    w, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    rows = [(1, w), (1, w), (2, w), (3, other), (3, w), (None, w), (None, "z"), (None, "z"), (5, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS digest", "3 AS own", "4 AS row")
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, w), (3, other), (None, "z"), (5, None), (5, "")])


def test_empty(none):
    assert nd.classes(none).collect() == [] and nd.keep_one(none).collect() == []


def test_samples_agree_as_often_as_the_weights(spark):
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    a = (prints[:400], np.full(400, 2, np.float32))
    b = (prints[50:450], np.full(400, 2, np.float32))
    bands = [np.mean(nd.signature(*a) == nd.signature(*b))]
    assert nd.similarity(a, b) == 350 / 450
    assert abs(bands[0] - (350 / 450) ** nd.ROWS) < 0.4
    held = nd.Vectors([a, b, (prints[:1], np.ones(1, np.float32))])
    assert np.allclose(held.similarities(*a), [1, 350 / 450, max(1 / 800, 1 / 400)])


def test_edited_copies_that_are_a_third_of_the_rows(spark):
    """Their common shingles weigh little, so these pairs are similar by the plain measure only."""
    rng = np.random.default_rng(4)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    base = words(271)
    texts = [" ".join(base + words(33)) if k % 3 == 0 else " ".join(words(120)) for k in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = nd.idf_table(docs)
    copies = range(0, 240, 3)
    vectors = {k: (p, nd.weights(p, c, idf)) for k, (p, c) in enumerate(nd.shingles([t.encode() for t in texts]))}
    similar = [(i, j) for i in copies for j in copies if i < j and nd.similarity(vectors[i], vectors[j]) >= nd.THRESHOLD]
    assert len(similar) == 80 * 79 // 2
    rows = nd.signatures(docs, spark.sparkContext.broadcast(idf)).collect()
    bands = {r.doc_id: np.array(r.bands) for r in rows}
    assert np.mean([(bands[i] == bands[j]).any() for i, j in similar]) > 0.995
    found = {r.doc_id: r.class_id for r in nd.classes(docs).collect()}
    assert found == {k: 0 if k % 3 == 0 else k for k in range(240)}


def test_components_of_a_chain(spark):
    edges = [(bytes([k]), bytes([k + 1])) for k in range(40)] + [(bytes([90]), bytes([91])), (bytes([5]), bytes([5]))]
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "u binary, v binary")
    roots = {bytes(r.vertex): bytes(r.root) for r in nd.components(df).collect()}
    assert roots == {**{bytes([k]): bytes([0]) for k in range(1, 41)}, bytes([91]): bytes([90])}
