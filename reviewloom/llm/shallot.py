"""k-means over integer vectors by Shallot search.

Every vector remembers its centroid, the second-nearest one, an upper bound of its distance to the first and a
lower bound of the distance to all others. After a round the bounds move by what centroids moved. A vector
whose bounds still part, or whose upper bound is under half the way to the next centroid, is settled without any distance. For
others the distances to the two remembered centroids are taken; the closer one is where the search starts.
Its neighbours, sorted by their distance from it, are visited while they lie in a ball around it: a centroid among the two
nearest cannot be further from it than the vector's distance to it plus the second distance found so far,
so the ball shrinks while the search goes on. Bounds are floats rounded outwards and only decide what is skipped;
all comparisons that assign are of exact integer squared distances, equal ones by the smaller number.

Vectors are dealt once into blocks of BLOCK, in a table bucketed by block. The states of a round are a small
table with the same buckets, so a round joins both without a shuffle and writes states and sums per block; sums are added
by Spark, and only k centroids pass through the driver. Blocks are dealt by number, so equal vectors do not meet in one task. Each
round reads written tables and can be repeated from them.

Defined cases: vectors that are null, of another size or hold a null or a number that is not finite are left out; ids are not
looked at but for the choice of the first centroids, where null ids stand back and equal ones go by the bytes of their vectors;
every kept row gives a row; with fewer than k kept ids there are fewer centroids, and without any no rows.
Components that are too large for exact distances in 64 bits (2**27 for 64 of them) raise an error.
"""

from __future__ import annotations

import heapq
import math
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.scratch import scratch_path
from .common import arrow_rows, sha256

#: Vectors of a row of the tables, so that an Arrow batch of rows stays small, and vectors that are searched together.
BLOCK, SLICE = 64, 8192
_PARTS = "array<struct<cluster: int, n: long, sums: array<long>>>"
_PART_TYPE = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))
#: Relative slack of a bound, far over the rounding of the operations on it.
_SLACK = 1e-9


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + _SLACK)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - _SLACK)).astype(np.float32), np.float32(-np.inf))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer arrays."""
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


class Search:
    """The centroids of a round: distances among them and how far each has moved."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None):
        k = len(centroids)
        self.centroids = centroids
        between = np.sqrt(np.stack([squared(centroids, c) for c in centroids]).astype(float))
        np.fill_diagonal(between, -1)  # each is the first of its own neighbours, and skipped
        self.neighbours = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.reach = np.take_along_axis(between, self.neighbours, 1) * (1 - _SLACK)
        self.half = self.reach[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        self.moved, self.others = np.zeros(k), np.zeros(k)
        if before is not None:
            self.moved = np.sqrt(squared(centroids, before).astype(float)) * (1 + _SLACK)
            top = np.argsort(self.moved)[::-1]
            self.others[:] = self.moved[top[0]]
            self.others[top[0]] = self.moved[top[1]] if k > 1 else 0

    def assign(self, vectors: np.ndarray, state: np.ndarray | None) -> np.ndarray:
        """States (first, second, upper, lower) of all vectors."""
        n, k = len(vectors), len(self.centroids)
        if state is None:
            state = np.zeros(n, STATE)
            state["second"] = min(1, k - 1)
            state["upper"] = np.inf
        else:
            state = state.copy()
            first = state["first"]
            state["upper"] = _up(state["upper"] + self.moved[first])
            state["lower"] = _down(state["lower"] - self.others[first])
        if k == 1:
            state["lower"] = np.inf
            return state
        at = np.flatnonzero(~self._settled(state))
        near = squared(vectors[at], self.centroids[state["first"][at]])
        state["upper"][at] = _up(np.sqrt(near.astype(float)))
        still = ~self._settled(state[at])
        at, near = at[still], near[still]
        if len(at):
            state[at] = self._search(vectors[at], state["first"][at], near, state["second"][at])
        return state

    def _settled(self, state: np.ndarray) -> np.ndarray:
        return (state["upper"] < state["lower"]) | (state["upper"] < self.half[state["first"]])

    def _search(self, x: np.ndarray, first: np.ndarray, near: np.ndarray, second: np.ndarray) -> np.ndarray:
        far = squared(x, self.centroids[second])
        closer = _before(far, second, near, first)
        first, second = np.where(closer, second, first), np.where(closer, first, second)
        near, far = np.where(closer, far, near), np.where(closer, near, far)
        start, other = first.copy(), second.copy()
        centre = np.sqrt(near.astype(float)) * (1 + _SLACK)
        active = np.arange(len(x))
        for rank in range(self.neighbours.shape[1]):
            ball = centre[active] + np.sqrt(far[active].astype(float)) * (1 + _SLACK)
            active = active[self.reach[start[active], rank] <= ball]
            if not len(active):
                break
            seen = self.neighbours[start[active], rank]
            new = seen != other[active]
            at, seen = active[new], seen[new]
            found = squared(x[at], self.centroids[seen])
            best = _before(found, seen, near[at], first[at])
            better = ~best & _before(found, seen, far[at], second[at])
            b, s = at[best], at[better]
            far[b], second[b] = near[b], first[b]
            near[b], first[b] = found[best], seen[best]
            far[s], second[s] = found[better], seen[better]
        out = np.empty(len(x), STATE)
        out["first"], out["second"] = first, second
        out["upper"], out["lower"] = _up(np.sqrt(near.astype(float))), _down(np.sqrt(far.astype(float)))
        return out


#: What is kept of a vector between rounds.
STATE = np.dtype([("first", "<i4"), ("second", "<i4"), ("upper", "<f4"), ("lower", "<f4")])


def _before(d: np.ndarray, c: np.ndarray, than_d: np.ndarray, than_c: np.ndarray) -> np.ndarray:
    return (d < than_d) | ((d == than_d) & (c < than_c))


def _integers(column: pa.ListArray, dimension: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a full vector of finite numbers, and floor(scale * x) of those."""
    full = np.equal(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False), dimension)
    values = column.filter(pa.array(full)).flatten().to_numpy(zero_copy_only=False)
    values = np.asarray(values, float).reshape(-1, dimension)
    finite = np.isfinite(values).all(1)
    with np.errstate(over="ignore"):
        values = np.floor(scale * values[finite])
    if np.abs(values).max(initial=0) >= 2 ** ((60 - math.ceil(math.log2(dimension))) // 2):
        raise ValueError("components are too large for exact distances in 64 bits")
    full[full] = finite
    return full, values.astype(np.int64)


def _blocks(vectors: DataFrame, k: int, seed: int, dimension: int, scale: int) -> DataFrame:
    """(block, ids, data: vectors as 32-bit integers, starts: the k rows of least hash of some blocks)."""
    id_type = to_arrow_type(vectors.schema[0].dataType)

    def deal(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            kept, values = _integers(batch.column(1), dimension, scale)
            ids, values = batch.column(0).filter(pa.array(kept)), values.astype("<i4")
            hashed = ((sha256(f"{seed}:{i}"), row) for i, row in zip(ids.to_pylist(), values) if i is not None)
            starts = [{"hash": h, "vector": v} for h, v in heapq.nsmallest(k, ((h, row.tobytes()) for h, row in hashed))]
            begins = range(0, len(ids), BLOCK)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(range(number, number + len(begins)), pa.int64()),
                "ids": pa.array([ids[b : b + BLOCK].to_pylist() for b in begins], pa.list_(id_type)),
                "data": pa.array([values[b : b + BLOCK].tobytes() for b in begins], pa.binary()),
                "starts": pa.array([[] if b else starts for b in begins], _START_TYPE),
            })
            number += len(begins)

    ids = vectors.schema[0].dataType.simpleString()
    out = f"block long, ids array<{ids}>, data binary, starts array<struct<hash: string, vector: binary>>"
    return vectors.mapInArrow(deal, out)


_START_TYPE = pa.list_(pa.struct([("hash", pa.string()), ("vector", pa.binary())]))


def _parts(first: np.ndarray, rows: np.ndarray) -> list[dict]:
    """Count and componentwise sum of the rows of each cluster."""
    order = np.argsort(first, kind="stable")
    clusters, begins = np.unique(first[order], return_index=True)
    counts, sums = np.diff(np.append(begins, len(first))), np.add.reduceat(rows[order], begins, axis=0)
    return [{"cluster": c, "n": n, "sums": s} for c, n, s in zip(clusters.tolist(), counts.tolist(), sums.tolist())]


def _slices(batches, *names: str):
    """The named columns of about SLICE vectors at a time; a block is a row."""
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE // BLOCK):
            part = batch.slice(begin, SLICE // BLOCK)
            yield [part.column(part.schema.get_field_index(n)).to_pylist() for n in names]


def _round(joined: DataFrame, search: Search) -> DataFrame:
    """(block, state, parts) of one assignment; the parts of a slice are in the row of its first block."""
    dimension = search.centroids.shape[1]

    def work(batches):
        for blocks, data, states in _slices(batches, "block", "data", "state"):
            rows = np.frombuffer(b"".join(data), "<i4").reshape(-1, dimension).astype(np.int64)
            new = search.assign(rows, None if None in states else np.frombuffer(b"".join(states), STATE))
            cuts = np.cumsum([len(d) // (4 * dimension) for d in data])[:-1]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(blocks, pa.int64()),
                "state": pa.array([s.tobytes() for s in np.split(new, cuts)], pa.binary()),
                "parts": pa.array([_parts(new["first"], rows)] + [[]] * len(cuts), _PART_TYPE),
            })

    return joined.select("block", "data", "state").mapInArrow(work, f"block long, state binary, parts {_PARTS}")


def _measured(joined: DataFrame, centroids: np.ndarray, id_field: T.StructField) -> DataFrame:
    """(rows of (id, cluster, distance), parts with the distances as sums) from the last states."""
    row_type = pa.list_(pa.struct([("id", to_arrow_type(id_field.dataType)), ("cluster", pa.int32()), ("distance", pa.int64())]))

    def work(batches):
        for ids, data, states in _slices(batches, "ids", "data", "state"):
            rows = np.frombuffer(b"".join(data), "<i4").reshape(-1, centroids.shape[1]).astype(np.int64)
            first = np.frombuffer(b"".join(states), STATE)["first"]
            distance = squared(rows, centroids[first])
            flat = zip(chain.from_iterable(ids), first.tolist(), distance.tolist())
            yield pa.RecordBatch.from_pydict({
                "rows": pa.array([[{"id": i, "cluster": c, "distance": d} for i, c, d in flat]], row_type),
                "parts": pa.array([_parts(first, distance[:, None])], _PART_TYPE),
            })

    of = id_field.dataType.simpleString()
    schema = f"rows array<struct<id: {of}, cluster: int, distance: long>>, parts {_PARTS}"
    return joined.select("ids", "data", "state").mapInArrow(work, schema)


def _totals(written: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of each cluster, added exactly; k rows come to the driver."""
    sums = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(width)]
    each = written.select(F.inline("parts")).groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*sums).alias("sums"))
    return {r.cluster: (r.n, [int(s) for s in r.sums]) for r in each.collect()}


class _Buckets:
    """Tables in the shared folder that are bucketed alike by block; their names go when the work is done."""

    def __init__(self, spark):
        self.spark, self.names, self.paths = spark, [], []
        self.n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame) -> DataFrame:
        name, path = f"reviewloom_{uuid.uuid4().hex}", scratch_path(self.spark, "clusters")
        self.names.append(name)
        df.write.bucketBy(self.n, "block").option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    seed: int = 3,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dimension: int = 64,
    scale: int = 1024,
) -> tuple[DataFrame, DataFrame]:
    """Members (id, cluster, distance), a row per kept vector, and clusters (cluster, n, cluster_inertia, inertia,
    centroid), a row per non-empty cluster.

    Components become floor(scale * x). The k ids whose sha256 of ``seed:id`` is least give the first centroids;
    each round moves non-empty centroids to the floor of their mean. Distances are squared.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(id_column, vector_column)
    id_field = vectors.schema[0]
    buckets = _Buckets(spark)
    try:
        dealt = _blocks(vectors, k, seed, dimension, scale)
        blocks = buckets.write(dealt.repartition(buckets.n, "block"))
        starts = blocks.select(F.inline("starts")).orderBy("hash", "vector").limit(k).collect()
        centroids = np.array([np.frombuffer(s.vector, "<i4") for s in starts], np.int64).reshape(-1, dimension)
        before, joined = None, blocks.withColumn("state", F.lit(None).cast("binary"))
        for number in range(rounds + 1 if starts else 0):
            written = buckets.write(_round(joined, Search(centroids, before)))
            # The small side is hashed per bucket; neither side is moved or sorted.
            joined = blocks.join(written.select("block", "state").hint("shuffle_hash"), "block")
            if number < rounds:
                before, centroids = centroids, centroids.copy()
                for c, (n, sums) in _totals(written, dimension).items():
                    centroids[c] = [s // n for s in sums]
        path = scratch_path(spark, "clustered")
        _measured(joined.where(F.col("state").isNotNull()), centroids, id_field).write.parquet(path)
    finally:
        buckets.drop()
    measured = spark.read.parquet(path)
    totals = _totals(measured, 1)
    inertia = sum(sums[0] for _, sums in totals.values())
    rows = [(c, n, sums[0], inertia, centroids[c].tolist()) for c, (n, sums) in totals.items()]
    clusters = spark.createDataFrame(rows, "cluster int, n long, cluster_inertia long, inertia long, centroid array<long>")
    return measured.select(F.inline("rows")).withColumnRenamed("id", id_column), clusters


def digest(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Members with the sums of their cluster, of which there are k."""
    centroid = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    each = clusters.select("cluster", "cluster_inertia", "inertia", centroid.alias("centroid_sha256"))
    return members.join(F.broadcast(each), "cluster")
