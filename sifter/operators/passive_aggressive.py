"""Passive-aggressive classifier (PA-I, Crammer et al. 2006) trained by
iterative parameter mixing (McDonald, Hall and Mann 2010).

The rows lie in blocks (``csr``).  Each epoch hands the current weights to
the tasks; every block runs the online PA-I updates over its own rows, in
an order drawn from (seed, epoch, block), and emits its weights in
proportion to its rows; they are added up as fixed-point numbers, exactly
and so in any order.  Number, content and order of the
blocks follow from the rows alone, so the model depends neither on
partitions nor on Arrow's batch size.  The weight vector -- the model, as
long as the vocabulary -- is the only thing that reaches the driver.
Scoring is a join of the long bag with the weight table and a sum per
article, all JVM-side.

Rows are sparse: ``idx`` (array<int>, feature indices) and ``val``
(array<double>); labels are +1 (reliable) and -1 (fake).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.operators import csr


#: Fixed-point unit of the sums (1.4e-14), and the largest value that they hold.
FIXED = float(1 << 46)
LARGEST = 1e5


def sparse_rows(long: DataFrame, index: DataFrame, labels: DataFrame | None = None,
                id_col: str = "id") -> DataFrame:
    """(id, idx, val[, y]) from the long bag and a (word, idx) table;
    unknown words drop out."""
    j = long.join(index, "word")
    rows = j.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("idx", F.col("n").cast("double").alias("v")))).alias("_e"))
    rows = rows.select(id_col, F.col("_e.idx").alias("idx"), F.col("_e.v").alias("val"))
    if labels is not None:
        rows = labels.join(rows, id_col, "left").select(
            id_col, "y", F.coalesce("idx", F.array().cast("array<int>")).alias("idx"),
            F.coalesce("val", F.array().cast("array<double>")).alias("val"))
    return rows


@dataclass
class PAModel:
    weights: DataFrame  # (idx, w)
    bias: float

    def decision(self, long: DataFrame, index: DataFrame, articles: DataFrame,
                 id_col: str = "id") -> DataFrame:
        """Margin w.x + b per article (articles without known words get b)."""
        m = (long.join(index, "word").join(self.weights, "idx")
             .groupBy(id_col).agg(F.sum(F.col("n") * F.col("w")).alias("_m")))
        return (articles.join(m, id_col, "left")
                .withColumn("margin", F.coalesce("_m", F.lit(0.0)) + F.lit(self.bias)).drop("_m"))

    def score(self, long, index, articles, id_col="id", out_col="score") -> DataFrame:
        """tanh(margin / 2) = P(reliable) - P(fake) under a logistic link."""
        d = self.decision(long, index, articles, id_col)
        return d.withColumn(out_col, F.tanh(F.col("margin") / 2.0)).drop("margin")


def _epoch_fn(w: np.ndarray, b: float, C: float, seed: int, epoch: int, total: int):
    """One block's pass: its share of the mixed weights, intercept and mean
    loss as fixed-point numbers."""
    def run(block: csr.Block) -> np.ndarray:
        ws, bs, loss = w.copy(), b, 0.0
        order = np.random.default_rng((seed, epoch, int(block.key[0]) & (1 << 63) - 1)).permutation(len(block))
        for i in order:
            at = slice(block.ptr[i], block.ptr[i + 1])
            idx, val, y = block.idx[at], block.val[at], block.y[i]
            hinge = max(0.0, 1.0 - y * (float(ws[idx] @ val) + bs))
            loss += hinge
            if hinge > 0.0:
                tau = min(C, hinge / (float(val @ val) + 1.0))
                ws[idx] += tau * y * val
                bs += tau * y
        values = np.concatenate([ws, [bs, loss / len(block)]]) * (len(block) / total)
        if np.abs(values).max() > LARGEST:
            raise ValueError(f"a weight or loss of {np.abs(values).max():.3g} is beyond {LARGEST}")
        return np.rint(values * FIXED).astype(np.int64)
    return run


class PassiveAggressive:
    """``epochs``: at most so many; training stops once the mean loss has not
    fallen ``tol`` below its least value for ``patience`` epochs in a row.
    ``partitions``: the blocks that learn apart and are mixed (by default one
    for each ``csr.BLOCK_ROWS`` rows); a parameter of the model."""

    def __init__(self, C: float = 1.0, epochs: int = 1000, tol: float = 1e-3, seed: int = 42,
                 partitions: int | None = None, patience: int = 5):
        self.C, self.epochs, self.tol, self.seed, self.partitions = C, epochs, tol, seed, partitions
        self.patience = patience

    def weights(self, rows: DataFrame, dim: int) -> tuple[np.ndarray, float]:
        """Weights and intercept from rows (id, y, idx, val)."""
        data = csr.pack(rows, self.partitions, self.seed)
        total = csr.n_rows(data)
        w, b, best, waited = np.zeros(dim), 0.0, np.inf, 0
        loaded = csr.load(data)
        for epoch in range(self.epochs if total else 0):
            run = _epoch_fn(w, b, self.C, self.seed, epoch, total)
            mixed = loaded.treeAggregate(np.zeros(dim + 2, np.int64), lambda a, block: a + run(block), lambda a, c: a + c) / FIXED
            w, b, loss = mixed[:dim], float(mixed[dim]), mixed[dim + 1]
            waited = waited + 1 if loss > best - self.tol else 0
            best = min(best, loss)
            if waited >= self.patience:
                break
        loaded.unpersist()
        return w, b

    def fit(self, rows: DataFrame, dim: int) -> PAModel:
        w, b = self.weights(rows, dim)
        nz = np.nonzero(w)[0]
        table = pd.DataFrame({"idx": nz.astype(np.int64), "w": w[nz]})
        return PAModel(rows.sparkSession.createDataFrame(table, "idx long, w double"), b)
