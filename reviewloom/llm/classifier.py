"""Quality of a text by a byte-level convolutional network, trained and run in numpy.

Filters of WIDTH bytes slide over the whole text. Their largest response in every chunk of 2 * HALF
bytes is kept; chunks overlap by half. The chunks' mean and maximum per filter go through one
logistic unit. Texts of any length are covered, none is cut.

Training: at most SAMPLE labelled documents of each class, those with the least hash of
their doc_id, in that order until their texts have SAMPLE_BYTES bytes. This bounds what the driver
holds and is the only place where rows are sampled. Each of them is learned from whole, by the same
chunks that scores are made of. Scores use nothing but the text.

Defined cases: a null or empty text is one chunk of padding and gets a score; labels that are
missing or not 0 or 1 are not learned from; without labels of both classes every score is 0.5;
rows with equal doc_id are scored one by one, and are taken for training with their label, within the
same bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 6
FILTERS = 16
HALF = 256
SAMPLE, SAMPLE_BYTES = 1500, 16 << 20  # of each class
STEPS = 300
BATCH = 64
THRESHOLD = 0.7
_PIECE = 1 << 18  # bytes that are convolved at a time
_CHUNKS = 256  # chunks that are convolved at a time in training


def fold(doc_id: Column) -> Column:
    """0 to 3: the rows of fold 2 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def _padded(text: bytes) -> np.ndarray:
    """Bytes of whole half chunks, two at least, and WIDTH - 1 more."""
    halves = max(2, -(-max(len(text) - WIDTH + 1, 1) // HALF))
    out = np.zeros(halves * HALF + WIDTH - 1, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out


def _chunks(text: bytes) -> np.ndarray:
    """All chunks of a text, with the WIDTH - 1 bytes after each: a view of its padded bytes."""
    return np.lib.stride_tricks.sliding_window_view(_padded(text), 2 * HALF + WIDTH - 1)[::HALF]


def _largest(data: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and where it is."""
    best, place = np.empty((len(data), FILTERS), np.float32), np.empty((len(data), FILTERS), np.int64)
    for a in range(0, len(data), _CHUNKS):
        part = data[a : a + _CHUNKS]
        response = np.zeros((len(part), 2 * HALF, FILTERS), np.float32)
        for k in range(WIDTH):
            response += filters[k][part[:, k : k + 2 * HALF]]
        at = response.argmax(axis=1)
        place[a : a + _CHUNKS] = at
        best[a : a + _CHUNKS] = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0]
    return best, place


class Network:
    """filters: response to each byte at each place; out: weights of mean and maximum; bias."""

    def __init__(self, filters: np.ndarray, out: np.ndarray, bias: float):
        self.filters, self.out, self.bias = filters, out, bias

    def _pairs(self) -> list[np.ndarray]:
        """Responses to two bytes at a time, so a position takes three look-ups."""
        f = self.filters
        return [(f[k][:, None, :] + f[k + 1][None, :, :]).reshape(1 << 16, -1) for k in range(0, WIDTH, 2)]

    def scorer(self):
        pairs = self._pairs()

        def score(text: bytes) -> float:
            data = _padded(text)
            n = len(data) - WIDTH + 1
            both = (data[:-1].astype(np.int32) << 8) | data[1:]
            best = np.empty((n // HALF, FILTERS), np.float32)
            for a in range(0, n, _PIECE):
                b = min(n, a + _PIECE)
                response = pairs[0].take(both[a:b], axis=0)
                response += pairs[1].take(both[a + 2 : b + 2], axis=0)
                response += pairs[2].take(both[a + 4 : b + 4], axis=0)
                best[a // HALF : b // HALF] = response.reshape(-1, HALF, FILTERS).max(axis=1)
            chunk = np.maximum(np.maximum(best[:-1], best[1:]), 0)
            x = np.concatenate((chunk.mean(axis=0), chunk.max(axis=0)))
            return float(1 / (1 + np.exp(-np.clip(x @ self.out + self.bias, -30, 30))))

        return score


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Network:
    """Trains on the chunks of each text by Adam on the logistic loss.

    A fixed number of steps, each on as many texts of one class as of the other.
    """
    rng = np.random.default_rng(seed)
    state = {
        "filters": rng.normal(0, 0.2, (WIDTH, 256, FILTERS)).astype(np.float32),
        "out": rng.normal(0, 0.2, 2 * FILTERS).astype(np.float32),
        "bias": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in state.items()}
    second = {k: np.zeros_like(v) for k, v in state.items()}
    column = np.arange(FILTERS)
    classes = [np.flatnonzero(labels == c) for c in (0, 1)]
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(own, BATCH // 2) for own in classes])
        data = np.concatenate([texts[k] for k in rows])
        counts = np.array([len(texts[k]) for k in rows])
        begins = np.cumsum(counts) - counts
        of = np.repeat(np.arange(len(rows)), counts)
        best, at = _largest(data, state["filters"])
        chunk = np.maximum(best, 0)
        mean = np.add.reduceat(chunk, begins) / counts[:, None]
        top = np.maximum.reduceat(chunk, begins)
        x = np.concatenate((mean, top), axis=1)
        p = 1 / (1 + np.exp(-np.clip(x @ state["out"] + state["bias"], -30, 30)))
        error = ((p - labels[rows]) / len(rows)).astype(np.float32)
        dx = error[:, None] * state["out"]
        is_top = chunk == top[of]
        dchunk = dx[of, :FILTERS] / counts[of][:, None] + np.where(is_top, dx[of, FILTERS:], 0)
        dchunk[chunk <= 0] = 0
        dfilters = np.empty_like(state["filters"])
        for k in range(WIDTH):
            byte = np.take_along_axis(data, at + k, axis=1).astype(np.int64)
            flat = np.bincount((byte * FILTERS + column).ravel(), dchunk.ravel(), 256 * FILTERS)
            dfilters[k] = flat.reshape(256, FILTERS)
        gradient = {"filters": dfilters, "out": x.T @ error, "bias": error.sum(keepdims=True)}
        for name, g in gradient.items():
            g = g + 1e-4 * state[name]
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            rate = 0.02 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            state[name] = (state[name] - rate * first[name] / (np.sqrt(second[name]) + 1e-7)).astype(np.float32)
    return Network(state["filters"], state["out"], float(state["bias"][0]))


def _bytes(column) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network | None:
    """The network fitted on the sample, or None if a class is missing.

    The sample's doc_ids are chosen from the labels alone; their number is bounded, so they
    are broadcast. The first text of a class is taken whatever its size.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 2))
    order = F.xxhash64(F.col("doc_id"), F.lit("train"))
    chosen = None
    for quality in (0, 1):
        part = usable.where(F.col("quality") == quality).orderBy(order, "doc_id").limit(sample)
        part = part.select("doc_id", F.col("quality").cast("int").alias("quality"))
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    found = texts.join(F.broadcast(chosen), "doc_id").withColumn("order", order)
    number = Window.partitionBy("quality").orderBy("order", "doc_id", "data")
    first = found.withColumn("number", F.row_number().over(number)).where(F.col("number") <= sample)
    upto = F.sum(F.length("data")).over(number.rowsBetween(Window.unboundedPreceding, 0))
    bounded = first.withColumn("upto", upto).where((F.col("number") == 1) | (F.col("upto") <= sample_bytes))
    rows = bounded.select("quality", "number", "data").collect()
    rows.sort(key=lambda r: (r["quality"], r["number"]))
    y = np.array([r["quality"] for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return None
    return fit([_chunks(bytes(r["data"])) for r in rows], y)


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        rate = shared.value.scorer() if shared.value is not None else lambda text: 0.5
        for batch in batches:
            scores = [rate(t) for t in _bytes(batch.column(1))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(scores, pa.float64())})

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def digest(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
