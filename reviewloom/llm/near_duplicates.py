"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Shingles are five consecutive words (all words of a shorter text), as 64-bit fingerprints.
2. Document frequencies are counted over all documents in a table of 2**20 hashed cells, as hashed
   TF-IDF does. Its size is fixed, so it may be broadcast; the ratio of a shingle's
   frequency to the mean cell, and with it the weights, do not change with the size of the corpus.
3. A text becomes BANDS * ROWS improved consistent weighted samples (Ioffe 2010) of its shingles'
   weights tf * idf: two texts have a sample in common with the probability of their weighted
   Jaccard similarity. As many minima of hashes do the same for the plain one, as either makes
   a link. Texts with equal shingle counts are one vertex from here on.
4. Vertices that share a band are candidates. In each band group all are compared with the member
   of the least doc_id. Groups that then lie in one component are done. In the others the
   stragglers, which are not connected to that member, are compared with all members of the group,
   in blocks of BLOCK by BLOCK vertices, so no candidate is left out; only links are emitted.
5. A candidate pair is a link if the exact weighted Jaccard similarity of its texts is THRESHOLD
   or more, or the plain one is: in a large group of copies the shingles that they have in
   common are frequent and so of low weight, and copies would lose each other by being many.
   Classes are the connected components of the links (alternating large and small stars).

Probability that two texts of similarity 0.8, of either kind, share no band: (1 - 0.8**4)**14 = 0.0006.

Defined cases: texts without words are never similar to others; rows with equal doc_id are
separate rows with the class of their own text; a missing doc_id is the representative only of a
class without any doc_id; the class of a document is its least doc_id.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import materialize
from .substrings import words_of
from .windows import Rolling, U, mix, spread

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 14, 4
BLOCK = 256
CELLS = 1 << 20
_SLICE = 1 << 14  # cells in a row of the frequency table
_TABLE = 4096  # quantiles of the gamma distribution


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x), by bisection."""
    p = (np.arange(_TABLE) + 0.5) / _TABLE
    low, high = np.zeros(_TABLE), np.full(_TABLE, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < p
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return low


_R = _gamma_quantiles().astype(np.float32)
_INVERSE_R = (1 / _R).astype(np.float32)
_LOG_C = np.log(_R).astype(np.float32)
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def shingles(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ascending distinct fingerprints, counts) of each text."""
    words, counts = words_of(texts)
    rolling = Rolling(words)
    ends = np.cumsum(counts)
    out = []
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        n = max(b - a - SHINGLE + 1, min(b - a, 1))
        start = np.arange(a, a + n)
        out.append(np.unique(rolling(start, np.minimum(start + SHINGLE, b)), return_counts=True))
    return out


def cells(prints: np.ndarray) -> np.ndarray:
    return (prints >> U(44)).astype(np.int64)


def _texts(batch) -> list[bytes]:
    column = batch.column(batch.schema.get_field_index("text"))
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _parts(batches, rows: int = 500):
    """Slices of a few hundred rows, which bounds the arrays that are held at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents in which each cell's shingles occur, number of documents with words).

    Each task counts its documents into one dense table and sends it in slices.
    """

    def count(batches):
        total, n = np.zeros(CELLS, np.int64), 0
        for batch in _parts(batches):
            found = [s for s, _ in shingles(_texts(batch)) if len(s)]
            if found:
                total += np.bincount(cells(np.concatenate(found)), minlength=CELLS)
                n += len(found)
        if n:
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array(range(CELLS // _SLICE), pa.int32()),
                "n": pa.array([n] * (CELLS // _SLICE), pa.int64()),
                "data": pa.array(
                    [zlib.compress(part.tobytes(), 1) for part in total.reshape(-1, _SLICE)], pa.binary()
                ),
            })

    def add(table):
        total = np.zeros(_SLICE, np.int64)
        for data in table["data"].to_pylist():
            total += np.frombuffer(zlib.decompress(data), np.int64)
        return pa.table({
            "slice": table["slice"][:1],
            "n": pa.array([sum(table["n"].to_pylist())], pa.int64()),
            "data": pa.array([total.tobytes()], pa.binary()),
        })

    schema = "slice int, n long, data binary"
    counted = docs.select("text").mapInArrow(count, schema)
    rows = counted.groupBy("slice").applyInArrow(add, schema).collect()  # CELLS numbers in all
    total, n = np.zeros(CELLS, np.int64), 0
    for row in rows:
        total[row["slice"] * _SLICE : (row["slice"] + 1) * _SLICE] = np.frombuffer(row["data"], np.int64)
        n = row["n"]
    return total, n


def idf_table(docs: DataFrame) -> np.ndarray:
    total, n = frequencies(docs)
    return (1 + np.log((n + 1) / (np.minimum(total, n) + 1))).astype(np.float32)


def weights(prints: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return counts.astype(np.float32) * idf[cells(prints)]


def signature(prints: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """BANDS keys: fingerprints of ROWS consistent weighted samples each."""
    best = np.full(len(_SEEDS), np.inf, np.float32)
    sample = np.zeros(len(_SEEDS), U)
    log_w = np.log(weight)
    for a in range(0, len(prints), 1024):
        part, logs = prints[a : a + 1024, None], log_w[a : a + 1024, None]
        with np.errstate(over="ignore"):
            bits = part * _SEEDS[None, :]
        which = (bits >> U(52)).astype(np.int32)
        beta = ((bits >> U(16)) & U(0xFFFFFF)).astype(np.float32) * np.float32(2.0**-24)
        r = _R[which]
        t = np.floor(logs * _INVERSE_R[which] + beta)
        score = _LOG_C[((bits >> U(40)) & U(0xFFF)).astype(np.int32)] - r * (t - beta) - r
        at = np.argmin(score, axis=0)
        column = np.arange(len(_SEEDS))
        better = score[at, column] < best
        best = np.where(better, score[at, column], best)
        with np.errstate(over="ignore"):
            found = mix(part[at, 0] ^ mix(t[at, column].astype(np.int64).astype(U) + U(7)))
        sample = np.where(better, found, sample)
    return _keys(sample)


def plain_signature(prints: np.ndarray) -> np.ndarray:
    """BANDS keys: ROWS least hashes each, which agree with the probability of the plain Jaccard similarity."""
    least = np.full(len(_SEEDS), ~U(0), U)
    for a in range(0, len(prints), 1024):
        with np.errstate(over="ignore"):
            least = np.minimum(least, (prints[a : a + 1024, None] * _SEEDS[None, :]).min(axis=0))
    return _keys(mix(least))


def _keys(sample: np.ndarray) -> np.ndarray:
    rows = sample.reshape(BANDS, ROWS)
    key = np.zeros(BANDS, U)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            key = mix(key * U(31) + rows[:, k])
    return key


def similarity(a: tuple, b: tuple) -> float:
    """The larger of the weighted and the plain Jaccard similarity of two (prints, weights)."""
    (prints_a, wa), (prints_b, wb) = a, b
    _, ia, ib = np.intersect1d(prints_a, prints_b, assume_unique=True, return_indices=True)
    low = float(np.minimum(wa[ia], wb[ib]).sum(dtype=np.float64))
    total = float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - low
    both = len(prints_a) + len(prints_b) - len(ia)
    return max(low / total, len(ia) / both) if both else 0.0


class Vectors:
    """The vectors of some texts by shingle, to compare one with all of them."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        sizes = [len(p) for p, _ in vectors]
        prints = np.concatenate([p for p, _ in vectors])
        order = np.argsort(prints, kind="stable")
        self.prints, self.n = prints[order], len(vectors)
        self.row = np.repeat(np.arange(self.n), sizes)[order]
        self.weight = np.concatenate([w for _, w in vectors])[order]
        self.sizes = np.array(sizes)
        self.totals = np.array([w.sum(dtype=np.float64) for _, w in vectors])

    def similarities(self, prints: np.ndarray, weight: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.prints, prints, "left"), np.searchsorted(self.prints, prints, "right")
        counts = high - low
        at = spread(low, counts)
        row = self.row[at]
        common = np.bincount(row, minlength=self.n)
        least = np.bincount(row, np.minimum(self.weight[at], np.repeat(weight, counts)), self.n)
        weighted = least / (self.totals + weight.sum(dtype=np.float64) - least)
        return np.maximum(weighted, common / (self.sizes + len(prints) - common))


def _vertex(prints: np.ndarray, counts: np.ndarray) -> bytes:
    return blake2b(prints.tobytes() + counts.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, idf) -> DataFrame:
    """(doc_id, digest, vertex, bands): digest of the text, BANDS weighted and BANDS plain keys; vertex is null
    for texts without words."""

    def run(batches):
        table = idf.value
        for batch in _parts(batches):
            vertex, bands = [], []
            for prints, counts in shingles(_texts(batch)):
                if not len(prints):
                    vertex.append(None)
                    bands.append([])
                    continue
                vertex.append(_vertex(prints, counts))
                keys = (signature(prints, weights(prints, counts, table)), plain_signature(prints))
                bands.append(np.concatenate(keys).view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "digest": batch.column(2), "vertex": pa.array(vertex, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text", _digest().alias("digest"))
    return texts.mapInArrow(run, f"doc_id {kind}, digest string, vertex binary, bands array<long>")


def _digest() -> Column:
    return F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def _verify(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The (vertex, leader) pairs that are similar. Texts of a leader come one after the other."""

    def run(batches):
        table = idf.value
        leader, vector = None, None

        def vectors(column):
            texts = [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
            return [(p, weights(p, c, table)) for p, c in shingles(texts)]

        for batch in _parts(batches):
            keep = []
            leaders = batch.column(batch.schema.get_field_index("leader")).to_pylist()
            theirs = batch.column(batch.schema.get_field_index("leader_text"))
            for k, vec in enumerate(vectors(batch.column(batch.schema.get_field_index("text")))):
                if leaders[k] != leader:
                    leader, vector = leaders[k], vectors(theirs.slice(k, 1))[0]
                keep.append(similarity(vec, vector) >= threshold)
            names = ("vertex", "leader")
            yield pa.RecordBatch.from_pydict(
                {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            ).filter(pa.array(keep, pa.bool_()))

    mine = texts.select("vertex", "text")
    lead = texts.select(F.col("vertex").alias("leader"), F.col("text").alias("leader_text"))
    joined = pairs.join(mine, "vertex").join(lead, "leader").select("vertex", "leader", "text", "leader_text")
    return joined.mapInArrow(run, "vertex binary, leader binary")


def _of_vertex(held: DataFrame) -> DataFrame:
    """The rows (vertex, text) whose text is of that vertex: rows may share a doc_id."""

    def run(batches):
        for batch in _parts(batches):
            vertices = batch.column(0).to_pylist()
            fits = [_vertex(p, c) == v for (p, c), v in zip(shingles(_texts(batch)), vertices, strict=True)]
            yield batch.filter(pa.array(fits, pa.bool_()))

    return held.mapInArrow(run, "vertex binary, text string")


def _leaders(members: DataFrame) -> DataFrame:
    """(band, key, vertex, leader) of the groups of more than one; the leader's own row is among them."""
    group = members.groupBy("band", "key").agg(
        F.min_by("vertex", F.struct("doc", "vertex")).alias("leader"), F.count(F.lit(1)).alias("n")
    )
    return members.join(group.where("n > 1").drop("n"), ["band", "key"]).drop("doc")


def _straggling(grouped: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of groups in more than one component, with root and whether it is not the leader's."""
    root = roots.select("vertex", "root")
    lead = roots.select(F.col("vertex").alias("leader"), F.col("root").alias("leader_root"))
    rows = grouped.join(root, "vertex", "left").join(lead, "leader", "left").select(
        "band", "key", "vertex", F.coalesce("root", "vertex").alias("root"),
        F.coalesce("leader_root", "leader").alias("leader_root"),
    )
    rows = rows.select("band", "key", "vertex", "root", (F.col("root") != F.col("leader_root")).alias("straggler"))
    sizes = rows.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("straggler").cast("long")).alias("n_stragglers")
    )
    return rows.join(sizes.where("n_stragglers > 0"), ["band", "key"])


def _compare_rest(rest: DataFrame, texts: DataFrame, vertices: DataFrame, idf, threshold: float) -> DataFrame:
    """Links between the stragglers and all members of their groups, block by block.

    A straggler goes to every block of members and a member to every block of stragglers: as long as
    a group has at most BLOCK stragglers, each of its members is sent once.
    """
    n_all = F.ceil(F.col("n") / BLOCK).cast("int")
    n_few = F.ceil(F.col("n_stragglers") / BLOCK).cast("int")
    place = F.xxhash64("vertex")
    few = rest.where("straggler").select(
        "band", "key", "vertex", "root", F.lit(True).alias("asks"), F.pmod(place, n_few).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), n_all - 1)).alias("j"),
    )
    members = rest.select(
        "band", "key", "vertex", "root", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0), n_few - 1)).alias("i"), F.pmod(place, n_all).cast("int").alias("j"),
    )
    rows = few.unionByName(members).join(texts, "vertex").join(vertices.select("vertex", "bands"), "vertex")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("vertex")
        band = table["band"][0].as_py()
        asks = np.array(table["asks"].to_pylist())
        vertex, root = table["vertex"].to_pylist(), table["root"].to_pylist()
        bands = np.array(table["bands"].to_pylist(), np.int64)
        raw = [b"" if t is None else t for t in table["text"].cast(pa.binary()).to_pylist()]
        vectors = [(p, weights(p, c, idf.value)) for p, c in shingles(raw)]
        out: list[tuple[bytes, bytes]] = []
        theirs = np.flatnonzero(~asks)
        if len(theirs):
            held = Vectors([vectors[k] for k in theirs])
            for k in np.flatnonzero(asks).tolist():
                # A pair that shares several bands is compared in the first of them.
                first = np.argmax(bands[theirs] == bands[k], axis=1) == band
                similar = held.similarities(*vectors[k]) >= threshold
                out += [(vertex[k], vertex[m]) for m in theirs[first & similar].tolist() if root[m] != root[k]]
        return pa.table({
            "vertex": pa.array([x for x, _ in out], pa.binary()), "leader": pa.array([y for _, y in out], pa.binary())
        })

    return rows.groupBy("band", "key", "i", "j").applyInArrow(compare, "vertex binary, leader binary")


def links(docs: DataFrame, vertices: DataFrame, idf, threshold: float = THRESHOLD) -> DataFrame:
    """Verified (vertex, leader) pairs."""
    banded = vertices.select("vertex", "doc", F.posexplode("bands").alias("band", "key"))
    grouped = materialize(_leaders(banded), "members")
    wanted = grouped.select("vertex").distinct()
    chosen = vertices.join(wanted, "vertex", "left_semi").select("vertex", F.col("doc").alias("doc_id"))
    own = docs.select(F.col("doc_id").alias("own_id"), "text")
    held = own.join(chosen, own["own_id"].eqNullSafe(chosen["doc_id"])).select("vertex", "text")
    texts = materialize(_of_vertex(held).dropDuplicates(["vertex"]), "texts")
    pairs = grouped.where(F.col("vertex") != F.col("leader")).select("vertex", "leader").distinct()
    good = materialize(_verify(pairs, texts, idf, threshold), "links")
    rest = _straggling(grouped, components(good))
    return good.unionByName(materialize(_compare_rest(rest, texts, vertices, idf, threshold), "links"))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of the edges that is not the least of its component.

    Alternates large and small stars until the edges stay the same. A vertex with many
    neighbours is reduced by a minimum before the shuffle, and its edges are joined, not gathered.
    """
    u, v = F.col("u"), F.col("v")
    now = edges.toDF("u", "v").where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    now = materialize(now, "edges")
    state = None
    while True:
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.least(F.col("m"), u).alias("v"))
        large = materialize(large.distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        )
        now = materialize(small.distinct(), "edges")
        after = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state:
            return now.select(u.alias("vertex"), v.alias("root"))
        state = after


def _placed(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, written, and (vertex, doc, n, root) of their vertices."""
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(docs))  # CELLS numbers
    signed = materialize(signatures(docs, idf), "signatures")
    worded = signed.where(F.col("vertex").isNotNull())
    vertices = materialize(
        worded.groupBy("vertex").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")),
        "vertices",
    )
    roots = components(links(docs, vertices, idf, threshold))
    return signed, vertices.join(roots, "vertex", "left").select("vertex", "doc", "n", F.coalesce("root", "vertex").alias("root"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of the class) and class_size."""
    signed, placed = _placed(docs, threshold)
    of_class = placed.groupBy("root").agg(F.min("doc").alias("class_id"), F.sum("n").alias("class_size"))
    by_vertex = placed.select("vertex", "root").join(of_class, "root").select("vertex", "class_id", "class_size")
    worded = signed.where(F.col("vertex").isNotNull()).select("doc_id", "vertex")
    found = worded.join(by_vertex, "vertex").select("doc_id", "class_id", "class_size")
    alone = signed.where(F.col("vertex").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return found.unionByName(alone)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class with all its columns: the one of least doc_id, null being the last, then of least digest.

    Rows with that doc_id and another text are in classes of their own; of rows equal in both, one stays.
    Texts without words all stay.
    """
    signed, placed = _placed(docs, threshold)
    rows = signed.where(F.col("vertex").isNotNull()).groupBy("vertex", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    of_class = rows.join(placed.select("vertex", "root"), "vertex").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "n")).alias("first")
    )
    alone = signed.where(F.col("vertex").isNull()).select("doc_id", "digest", F.lit(1).cast("long").alias("n")).distinct()
    kept = materialize(of_class.select("first.doc_id", "first.digest", "first.n").unionByName(alone), "kept")
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own"), _digest().alias("own_digest"))
    both = own.join(kept, F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_digest") == F.col("digest")))
    single = both.where("n = 1").select("row.*")
    if kept.where("n > 1").isEmpty():
        return single
    return single.unionByName(both.where("n > 1").dropDuplicates(["own", "own_digest"]).select("row.*"))
