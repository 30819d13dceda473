"""Random forests grown level by level from distributed histograms.

All open nodes of all trees grow in the same job.  A task walks its rows
(blocks of sparse bins, ``csr``) down the trees and counts, for every open
node and every feature drawn for it, the rows of each class by bin; Spark
adds the counts by (node, feature, bin), sums them from the last bin down
by a window, and keeps the best split of each node by Gini impurity.  Only
nodes (the model) pass through the driver: one job for each level.

* Rows take part in a tree as often as a Poisson(1) number that is a hash of
  (seed, tree, row's id): a bootstrap that needs no shuffle and repeats on
  any cluster.  All counts are whole numbers, so sums have no order.
* Each node draws the features whose hash of (seed, node, feature) is below
  a share: sqrt(features) on average.  A node whose drawn features are all
  constant draws from four times the share in the next job, up to all of
  them, so it only stays a leaf if no feature splits it.
* A node is split if it holds ``min_samples_split`` rows, of both classes,
  and lies above ``max_depth`` (None: no limit).

An absent entry is bin 0.  Counts of words are their own bins up to 32 and
eighths of an octave beyond (``count_bin``); scores in [-1, 1] are binned
in 64ths on the scale of their inverse hyperbolic tangent (``score_bin``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.operators import csr

LEAF = -1
#: The feature under which a node's own totals are counted.
TOTAL = -1
_POISSON = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 20)])])


def count_bin(n: Column) -> Column:
    n = n.cast("double")
    return F.when(n < 32, F.floor(n)).otherwise(32 + F.floor(8 * F.log2(n / 32))).cast("double")


def score_bin(x: Column) -> Column:
    z = F.greatest(F.least(F.atanh(x), F.lit(8.0)), F.lit(-8.0))
    return (1 + F.floor((z + 8) * 64)).cast("double")


def binned(df: DataFrame, columns: list[str], y: Column) -> DataFrame:
    """(id, y, idx, val): rows of scores as sparse rows of bins."""
    return df.select("id", y.cast("double").alias("y"), F.array(*[F.lit(i) for i in range(len(columns))]).alias("idx"),
                     F.array(*[score_bin(F.col(c)) for c in columns]).alias("val"))


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _keys(seed: int, numbers: np.ndarray) -> np.ndarray:
    start = np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return _mix(_mix(np.asarray(numbers).astype(np.uint64) + np.uint64(1)) + start)


def row_weights(seed: int, tree: int, key: np.ndarray) -> np.ndarray:
    """How often each row takes part in a tree."""
    h = _mix(key.astype(np.uint64) ^ _keys(seed, np.array([tree]))[0])
    return np.searchsorted(_POISSON, h / 2.0 ** 64, "right")


def drawn(node_key: np.ndarray, feature: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Whether each node (by its key) draws a feature."""
    return _mix(node_key ^ _mix(feature.astype(np.uint64) + np.uint64(7))) / 2.0 ** 64 < share


@dataclass
class Trees:
    """Nodes of all trees; the first ``len(roots)`` of them are the roots.
    Rows with a bin of ``feature`` from ``bin`` on go right; ``p`` is the
    share of class 1."""
    n_trees: int
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    p: list[float] = field(default_factory=list)
    tree: list[int] = field(default_factory=list)

    def add(self, tree: int) -> int:
        for values, x in ((self.feature, LEAF), (self.bin, 0), (self.left, 0), (self.right, 0), (self.p, 0.5), (self.tree, tree)):
            values.append(x)
        return len(self.tree) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, np.int32) for x in (self.feature, self.bin, self.left, self.right))


def walk(block: csr.Block, dim: int, nodes: tuple[np.ndarray, ...], n_trees: int) -> np.ndarray:
    """The node that each row ends in, by tree (n_trees x rows)."""
    feature, cut, left, right = nodes
    place = block.row() * dim + block.idx  # ascending
    at = np.repeat(np.arange(n_trees), len(block))
    row = np.tile(np.arange(len(block)), n_trees)
    inner = np.flatnonzero(feature[at] != LEAF)
    while len(inner):
        here = at[inner]
        wanted = row[inner] * dim + feature[here]
        found = np.searchsorted(place, wanted)
        found[found == len(place)] = 0
        hit = place[found] == wanted if len(place) else np.zeros(len(wanted), bool)
        value = np.where(hit, block.val[found] if len(place) else 0, 0)
        at[inner] = np.where(value >= cut[here], right[here], left[here])
        inner = inner[feature[at[inner]] != LEAF]
    return at.reshape(n_trees, len(block))


def _histogram(block: csr.Block, dim: int, nodes, n_trees: int, slot_of: np.ndarray, node_key: np.ndarray,
               share: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Weighted rows of each class, and rows, by (slot, feature, bin)."""
    ends = walk(block, dim, nodes, n_trees)
    row, bins = block.row(), block.val.astype(np.int64)
    width = int(bins.max(initial=0)) + 1
    keys, weights, classes = [], [], []
    positive = block.y > 0
    for tree in range(n_trees):
        slot = slot_of[ends[tree]]
        weight = row_weights(seed, tree, block.key)
        slot[weight == 0] = -1
        rows = np.flatnonzero(slot >= 0)
        keys.append(slot[rows] * (dim + 1) * width)  # feature TOTAL, bin 0
        weights.append(weight[rows])
        classes.append(positive[rows])
        entry = np.flatnonzero(slot[row] >= 0)
        at = slot[row[entry]]
        taken = drawn(node_key[at], block.idx[entry], share[at])
        entry, at = entry[taken], at[taken]
        keys.append((at * (dim + 1) + block.idx[entry] + 1) * width + bins[entry])
        weights.append(weight[row[entry]])
        classes.append(positive[row[entry]])
    keys, weights, classes = np.concatenate(keys), np.concatenate(weights), np.concatenate(classes)
    key, inverse = np.unique(keys, return_inverse=True)
    sums = [np.bincount(inverse, x, len(key)).astype(np.int64) for x in (weights * ~classes, weights * classes, np.ones(len(keys)))]
    return {"slot": key // ((dim + 1) * width), "feature": key // width % (dim + 1) - 1, "bin": key % width,
            "n0": sums[0], "n1": sums[1], "n": sums[2]}


def best_splits(blocks: DataFrame, dim: int, trees: Trees, slot_of: np.ndarray, node_key: np.ndarray,
                share: np.ndarray, seed: int) -> pd.DataFrame:
    """One row per open node (slot): its totals (n0, n1, n), and its best split
    (feature, bin, and the totals r0, r1, r of the right side) if it has one."""
    nodes, n_trees = trees.arrays(), trees.n_trees
    shared = blocks.sparkSession.sparkContext.broadcast((nodes, slot_of, node_key, share))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, slot_of, node_key, share = shared.value
        for block in csr.read_blocks(batches):
            found = _histogram(block, dim, nodes, n_trees, slot_of, node_key, share, seed)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found.values()], list(found))

    counts = (blocks.mapInArrow(count, "slot long, feature long, bin long, n0 long, n1 long, n long")
              .groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "n")]))
    from_here = Window.partitionBy("slot", "feature").orderBy(F.desc("bin"))
    of_node = Window.partitionBy("slot")
    totals = [F.max(F.when(F.col("feature") == TOTAL, F.col(c))).over(of_node).alias(f"t{c[1:]}") for c in ("n0", "n1", "n")]
    sides = counts.select("slot", "feature", "bin", *totals, *[F.sum(c).over(from_here).alias(f"r{c[1:]}") for c in ("n0", "n1", "n")])
    left0, left1 = F.col("t0") - F.col("r0"), F.col("t1") - F.col("r1")
    purity = ((F.col("r0") * F.col("r0") + F.col("r1") * F.col("r1")) / (F.col("r0") + F.col("r1"))
              + (left0 * left0 + left1 * left1) / (left0 + left1))
    valid = (F.col("feature") != TOTAL) & (F.col("bin") > 0) & (left0 + left1 > 0)
    split = F.when(valid, F.struct(purity.alias("purity"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "r0", "r1", "r"))
    best = sides.groupBy("slot").agg(F.max("t0").alias("n0"), F.max("t1").alias("n1"), F.max("t").alias("n"), F.max(split).alias("s"))
    found = best.select("slot", "n0", "n1", "n", (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), "s.r0", "s.r1", "s.r",
                        F.col("s").isNotNull().alias("splits")).toPandas().sort_values("slot")
    shared.destroy()
    return found


@dataclass
class Forest:
    n_trees: int = 100
    max_depth: int | None = 20
    min_samples_split: int = 3
    seed: int = 42

    def fit(self, blocks: DataFrame, dim: int) -> Trees:
        """``blocks``: packed rows with y > 0 for class 1 and bins as values."""
        trees = Trees(self.n_trees)
        drawn_share = max(1, int(np.sqrt(dim))) / max(1, dim)
        # open nodes: (node, depth, draws so far)
        todo = [(trees.add(t), 0, 0) for t in range(self.n_trees)]
        while todo:
            slot_of = np.full(len(trees.tree), -1, np.int64)
            slot_of[[node for node, _, _ in todo]] = np.arange(len(todo))
            share = np.minimum(1.0, drawn_share * 4.0 ** np.array([draws for _, _, draws in todo]))
            node_key = _keys(self.seed + 1, np.array([node for node, _, _ in todo]))
            found = best_splits(blocks, dim, trees, slot_of, node_key, share, self.seed)
            later = []
            for r in found.itertuples(index=False):
                node, depth, draws = todo[r.slot]
                trees.p[node] = r.n1 / (r.n0 + r.n1)
                if not self._splittable(r.n0, r.n1, r.n, depth):
                    continue
                if not r.splits:
                    if share[r.slot] < 1.0:
                        later.append((node, depth, draws + 1))
                    continue
                trees.feature[node], trees.bin[node] = int(r.feature), int(r.bin)
                trees.left[node], trees.right[node] = trees.add(trees.tree[node]), trees.add(trees.tree[node])
                for child, n0, n1, n in ((trees.left[node], r.n0 - r.r0, r.n1 - r.r1, r.n - r.r), (trees.right[node], r.r0, r.r1, r.r)):
                    trees.p[child] = n1 / (n0 + n1)
                    if self._splittable(n0, n1, n, depth + 1):
                        later.append((child, depth + 1, 0))
            todo = later
        return trees

    def _splittable(self, n0: int, n1: int, n: int, depth: int) -> bool:
        return n >= self.min_samples_split and n0 > 0 and n1 > 0 and (self.max_depth is None or depth < self.max_depth)


def to_nodes(spark: SparkSession, trees: Trees) -> DataFrame:
    """(node, tree, feature, bin, left, right, p)."""
    table = pd.DataFrame({"node": np.arange(len(trees.tree)), "tree": trees.tree, "feature": trees.feature, "bin": trees.bin,
                          "left": trees.left, "right": trees.right, "p": trees.p})
    return spark.createDataFrame(table, "node int, tree int, feature int, bin int, left int, right int, p double")


def from_nodes(nodes: DataFrame) -> Trees:
    table = nodes.toPandas().sort_values("node")
    return Trees(int(table["tree"].max()) + 1, *[table[c].tolist() for c in ("feature", "bin", "left", "right", "p", "tree")])


def probabilities(rows: DataFrame, trees: Trees) -> DataFrame:
    """(id, p): the trees' mean share of class 1, for rows (id, idx, val)."""
    shared = rows.sparkSession.sparkContext.broadcast((trees.arrays(), np.array(trees.p), trees.n_trees))
    dim = max([0, *trees.feature]) + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, p, n_trees = shared.value
        for batch in batches:
            idx, val = batch.column(1), batch.column(2)
            sizes = idx.value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            flat, values = idx.flatten().to_numpy(), val.flatten().to_numpy()
            known = flat < dim  # other features split no node
            ptr = np.concatenate([[0], np.cumsum(np.bincount(row[known], minlength=batch.num_rows))])
            block = csr.Block(np.zeros(0, np.int64), np.zeros(batch.num_rows), ptr, flat[known], values[known])
            mean = p[walk(block, dim, nodes, n_trees)].mean(axis=0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(mean)], ["id", "p"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "idx", "val").mapInArrow(score, f"id {kind}, p double")
