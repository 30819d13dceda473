"""Quality classifier: random-indexing vectors, a small network, calibration.

1. ``word_vectors``: every token bucket has a sparse random index vector;
   over all documents a token's vector is the sum of the index vectors of
   its neighbours.  Tokens are runs of one kind of character (letters,
   digits or others but white space), hashed to ``BUCKETS`` buckets.
2. ``fit``: a document's vector is the mean of its tokens' unit vectors
   and their mean square; a two-layer numpy network learns the
   label from it, and a temperature fitted on rows left out of the
   training calibrates its probabilities.
3. ``score``: map-only.

Scale: the vector table has a fixed size (BUCKETS x DIM), so it and the
network are broadcast.  Its sums are pre-aggregated in each task and added
by (bucket, dimension) over the cluster, so no key is hot.  The network is
fitted on the driver on at most ``MAX_TRAIN`` labelled rows (those with the
least hashes of their id); word counts cover all documents.

Results defined for odd input: a null or empty text has the zero vector
and gets the network's score for it; labels that repeat an id count by
their least value, null labels not at all; without labels of both classes
every score is the share of label 1 (0.5 without labels); extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.textkit import flat_bytes, slices, span_hashes

BUCKETS, DIM, NONZERO, REACH = 1 << 14, 64, 2, 2
#: Labelled documents that the network is fitted on, at most.
MAX_TRAIN = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 60, 256, 3e-3, 1e-4, 11

_KIND = np.full(256, 3, np.uint8)  # other
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token, and tokens per row."""
    data, offsets = flat_bytes(col)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(col), np.int64)
    kind = _KIND[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    inside = kind[starts] != 0
    starts, ends = starts[inside], ends[inside]
    buckets = span_hashes(data, starts, ends) >> np.uint64(50)
    return buckets.astype(np.int64), np.diff(np.searchsorted(starts, offsets))


def index_vectors(buckets: int = BUCKETS, dim: int = DIM, nonzero: int = NONZERO,
                  seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the few nonzero entries of each bucket's index vector."""
    rng = np.random.RandomState(seed)
    return rng.randint(0, dim, (buckets, nonzero)), rng.choice([-1, 1], (buckets, nonzero))


def context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's (cell, total) of the token-by-dimension table."""
    where, sign = index_vectors()
    table = np.zeros(BUCKETS * DIM, np.int64)
    for batch in batches:
        for part in slices(batch, "text", 2 << 20):
            found, counts = tokens(part.column(0))
            row = np.repeat(np.arange(len(counts)), counts)
            for gap in range(1, REACH + 1):
                near = row[gap:] == row[:-gap]
                left, right = found[:-gap][near], found[gap:][near]
                for word, other in ((left, right), (right, left)):
                    # neighbours as (word, other) pairs, each pair's sum once
                    pair, times = np.unique(word * BUCKETS + other, return_counts=True)
                    word, other = pair // BUCKETS, pair % BUCKETS
                    for k in range(NONZERO):
                        table += np.bincount(word * DIM + where[other, k], sign[other, k] * times,
                                             BUCKETS * DIM).astype(np.int64)
    cells = np.flatnonzero(table)
    for a in range(0, len(cells), 100_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells[a:a + 100_000], pa.int64()), pa.array(table[cells[a:a + 100_000]])], ["cell", "total"])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vectors (BUCKETS x DIM) from the neighbours of all tokens of all texts."""
    sums = (docs.select(F.col(text_col).cast("string").alias("text"))
            .mapInArrow(context_sums, "cell long, total long")
            .groupBy("cell").agg(F.sum("total").alias("total")).filter("total <> 0"))
    found = sums.toArrow()  # at most BUCKETS * DIM rows
    table = np.zeros(BUCKETS * DIM)
    table[found.column("cell").to_numpy()] = found.column("total").to_numpy()
    table = table.reshape(BUCKETS, DIM)
    norm = np.sqrt((table ** 2).sum(1, keepdims=True))
    return (table / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(col: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per row: the mean of the tokens' vectors, and of their squares."""
    found, counts = tokens(col)
    out = np.zeros((len(counts), 2 * DIM), np.float32)
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(found):
        return out
    # each distinct (row, bucket) once, weighted by its count
    pair, times = np.unique(row * BUCKETS + found, return_counts=True)
    row, found = pair // BUCKETS, pair % BUCKETS
    weight = (times / counts[row]).astype(np.float32)[:, None]
    has = np.flatnonzero(counts)
    first = np.searchsorted(row, has)
    for a in range(0, DIM, 16):  # in blocks of dimensions, to bound the temporaries
        v = vectors[found, a:a + 16]
        out[has, a:a + 16] = np.add.reduceat(v * weight, first)
        out[has, DIM + a:DIM + a + 16] = np.add.reduceat(v * v * weight, first)
    return out


@dataclass
class QualityModel:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    constant: float | None = None

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-_logits(self.layers, (x - self.mean) / self.scale) / self.temperature))


def _logits(layers: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return (np.maximum(x @ w1 + b1, 0) @ w2 + b2)[:, 0]


def train_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> list[np.ndarray]:
    """Two layers with Adam on the log loss."""
    rng = np.random.RandomState(seed)
    layers = [rng.randn(x.shape[1], HIDDEN) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN),
              rng.randn(HIDDEN, 1) * np.sqrt(1 / HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for a in range(0, len(x), BATCH):
            xb, yb = x[order[a:a + BATCH]], y[order[a:a + BATCH]]
            h = np.maximum(xb @ layers[0] + layers[1], 0)
            d = ((1 / (1 + np.exp(-(h @ layers[2] + layers[3])[:, 0])) - yb) / len(xb))[:, None]
            dh = (d @ layers[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((xb.T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                g = g + DECAY * layers[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                layers[i] = layers[i] - RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return layers


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows left out of training."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "label", max_train: int = MAX_TRAIN) -> QualityModel:
    """Word vectors from all ``docs``, the network from ``labels`` (id, 0 or 1)."""
    vectors = word_vectors(docs, text_col)
    chosen = (labels.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("double").alias("y"))
              .dropna().orderBy(F.xxhash64("id"), "id").limit(max_train))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                x = pooled(part.column(2), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 2 * DIM).cast(pa.list_(pa.float32()))],
                    ["h", "y", "x"])

    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), "id")
            .groupBy("id", "y").agg(F.min("text").alias("text"))  # a row for each id: at most max_train
            .select(F.xxhash64("id").alias("h"), "y", "text")
            .mapInArrow(pool, "h long, y double, x array<float>").toArrow())
    h, y = rows.column("h").to_numpy(), rows.column("y").to_numpy()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), 2 * DIM).astype(np.float64)
    empty = np.zeros(2 * DIM)
    if not 0 < y.sum() < len(y):
        return QualityModel(vectors, empty, empty, [], 1.0, float(y.mean()) if len(y) else 0.5)
    order = np.lexsort((y, h))
    x, y, h = x[order], y[order], h[order]
    mean, scale = x.mean(0), x.std(0) + 1e-6
    left_out = h % 5 == 0
    if left_out.all() or not left_out.any():
        left_out = np.arange(len(h)) % 5 == 0
    z = (x - mean) / scale
    layers = train_network(z[~left_out], y[~left_out]) if (~left_out).any() else train_network(z, y)
    return QualityModel(vectors, mean, scale, layers, calibrate(_logits(layers, z[left_out]), y[left_out]))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                p = m.probability(pooled(part.column(1), m.vectors).astype(np.float64))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, score double")
            .select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
