"""The squared hinge's minimum from its dual, by passes over the cluster.

The dual has one number a >= 0 a row: minimise |X'ya|^2 / 2 + |a|^2 / (4C) -
sum a, with the intercept as a feature of constant 1 and the weights X'ya.
Newton's method on the weights guesses in each step which rows count and is
wrong for most steps; the dual's bounds are followed by projection instead.
Rows' lengths differ by orders of magnitude; in the numbers b = a * sqrt(|x|^2
+ 1 + 1 / (2C)) the dual's curvature is 1 along every row, and the bounds are
the same.

1. Gradient steps with projection, of Barzilai and Borwein's lengths (Dai and
   Fletcher 2005), one pass a step, until few rows enter or leave the bound.
2. Conjugate gradients on the rows off the bound, one pass a step.  A step
   that crosses the bound is projected; rows whose derivative calls them off
   the bound come in when they weigh more than the others' (Dostal 2003).

A row's numbers stay in its partition beside its block; a pass sends the weights
of a direction to the tasks and adds up one vector as long as the vocabulary.
Every ``LINEAGE`` passes the rows' numbers (not the blocks) are checkpointed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import SparkSession

from sifter.operators import csr
from sifter.session import ensure_checkpoint_dir

#: Passes between two checkpoints; passes of conjugate gradients between two looks at the weights' derivative.
LINEAGE, LOOK = 25, 25
#: Gradient steps end after so many passes in which no more than this share of the rows changed sides.
QUIET, SETTLED = 2, 0.005
#: Passes in all, and looks without a gain after which the dual is left.
PASSES, PATIENCE = 20_000, 8
#: Sums of a pass besides the vector.
MORE = 6

_ONE = BatchedSerializer(CPickleSerializer(), 1)  # lets two RDDs be zipped without another pass over either


@dataclass
class Numbers:
    """Of a block's rows: the scale, the dual's number, its derivative, the
    derivative off the bound, the direction."""
    h: np.ndarray
    b: np.ndarray
    g: np.ndarray
    f: np.ndarray
    p: np.ndarray


def _times(block: csr.Block, h: np.ndarray, q: np.ndarray, v: np.ndarray, C: float) -> np.ndarray:
    """The curvature times ``v``, whose weights over all rows are ``q``."""
    return h * block.y * (block.dot(q, block.row()) + q[-1]) + h * h * v / (2.0 * C)


def _sums(block: csr.Block, h: np.ndarray, v: np.ndarray, dim: int, *more: float) -> np.ndarray:
    """The block's share of the weights of ``v``, and ``more``."""
    a = block.y * h * v
    return np.concatenate([np.bincount(block.idx, block.val * a[block.row()], dim), [a.sum()], more, np.zeros(MORE - len(more))])


def start(block: csr.Block, _, dim: int, C: float):
    """b = 0, and the weights of the steepest direction."""
    h = 1.0 / np.sqrt(np.bincount(block.row(), block.val * block.val, len(block)) + 1.0 + 0.5 / C)
    zero = np.zeros_like(h)
    return Numbers(h, zero, -h, zero, zero), _sums(block, h, h, dim, h @ h, (h ** 4).sum() / (2.0 * C))


def gradient_step(block: csr.Block, n: Numbers, dim: int, C: float, q: np.ndarray, length: float):
    """A projected step from b, whose weights are ``q``; returns those of the new b."""
    g = _times(block, n.h, q, n.b, C) - n.h
    b, d = np.maximum(0.0, n.b - length * g), g - n.g
    s = b - n.b
    return Numbers(n.h, b, g, n.f, s), _sums(block, n.h, b, dim, s @ s, ((n.h * s) ** 2).sum() / (2.0 * C), n.p @ d, d @ d,
                                             ((b > 0) != (n.b > 0)).sum())


def face(block: csr.Block, n: Numbers, dim: int, C: float, q: np.ndarray, free: bool):
    """The derivative at b (weights ``q``); returns the weights of the steepest
    direction of the rows off the bound, and with ``free`` of those that it calls off."""
    g = _times(block, n.h, q, n.b, C) - n.h
    calls = np.where(n.b > 0, 0.0, np.minimum(g, 0.0))
    f = np.where(n.b > 0, g, calls if free else 0.0)
    return Numbers(n.h, n.b, g, f, np.zeros_like(f)), _sums(block, n.h, f, dim, f @ f, ((n.h * f) ** 2).sum() / (2.0 * C), calls @ calls)


def conjugate_step(block: csr.Block, n: Numbers, dim: int, C: float, q: np.ndarray, length: float, turn: float):
    """A step along f - turn * p, whose weights are ``q``, cut off at the bound;
    returns the weights of the new f and, behind them, of what was cut off."""
    p = n.f - turn * n.p
    ap = _times(block, n.h, q, p, C)
    b, g, on = n.b - length * p, n.g - length * ap, (n.b > 0) | (p != 0)
    f, calls, cut = np.where(on, g, 0.0), np.where(on, 0.0, np.minimum(g, 0.0)), np.minimum(b, 0.0)
    sums = _sums(block, n.h, f, dim, f @ f, ((n.h * f) ** 2).sum() / (2.0 * C), f @ ap,
                 (n.h * n.h * f * p).sum() / (2.0 * C), (b < 0).sum(), calls @ calls)
    lost = _sums(block, n.h, cut, dim)[:dim + 1] if cut.any() else np.zeros(dim + 1)
    return Numbers(n.h, b - cut, g, f, p), np.concatenate([sums, lost])


class Passes:
    """The rows' numbers, pass after pass, one element a partition."""

    def __init__(self, rows: RDD, dim: int):
        self.dim, self.sc = dim, rows.context
        self.blocks = rows.mapPartitions(lambda blocks: [list(blocks)])._reserialize(_ONE).persist(StorageLevel.MEMORY_AND_DISK)
        self.kept, self.old, self.shared, self.n = None, [], [], 0
        ensure_checkpoint_dir(SparkSession.active())

    def run(self, step, *args) -> tuple[np.ndarray, np.ndarray]:
        """The weights and the sums that ``step(block, numbers, dim, *args)`` returns, added over all blocks."""
        dim, shared = self.dim, self.sc.broadcast(args)

        def one(pair):
            found, total = [], 0.0
            for block, numbers in zip(pair[0], pair[1][0] or [None] * len(pair[0])):
                new, more = step(block, numbers, dim, *shared.value)
                found.append(new)
                total = total + more
            return found, total

        before = self.blocks.map(lambda blocks: (None, None))._reserialize(_ONE) if self.kept is None else self.kept
        now = self.blocks.zip(before).map(one)._reserialize(_ONE).persist(StorageLevel.MEMORY_AND_DISK)
        self.old.append(before)
        self.shared.append(shared)
        self.kept, self.n = now, self.n + 1
        total = now.map(lambda x: x[1]).treeReduce(lambda a, b: a + b, csr.levels(now, dim))
        if self.n % LINEAGE == 0:  # the numbers alone, so that a lost executor costs few passes
            self.old.append(now)
            self.kept = now.map(lambda x: (x[0], None))._reserialize(_ONE).persist(StorageLevel.MEMORY_AND_DISK)
            self.kept.checkpoint()
            self.kept.count()
            self.forget(0)
        else:
            self.forget(LINEAGE)
        return total[:dim + 1], total[dim + 1:]

    def forget(self, lineage: int) -> None:
        """Frees the numbers of earlier passes; what sent them stays until the next checkpoint."""
        for rdd in self.old:
            if rdd.is_cached:
                rdd.unpersist()
        self.old = []
        if not lineage:
            for shared in self.shared:
                shared.unpersist()
            self.shared = []

    def end(self) -> None:
        self.old += [rdd for rdd in (self.kept, self.blocks) if rdd is not None]
        self.forget(0)


def _approach(passes: Passes, C: float, w: np.ndarray, length: float, few: float) -> tuple[np.ndarray, float]:
    """Gradient steps from b (weights ``w``) until few rows change sides in ``QUIET``
    passes in a row; the weights there, and the last length."""
    quiet = 0
    while quiet < QUIET and passes.n < PASSES:
        there, (ss, own, change, square, moved, _) = passes.run(gradient_step, C, w, length)
        curved = (there - w) @ (there - w) + own
        w, quiet = there, quiet + 1 if moved <= few else 0
        if not curved > 0:
            break
        # in turn by the step itself, and by the change of derivative on the one before
        length = change / square if passes.n % 2 and change > 0 else ss / curved
    return w, length


def minimise(rows: RDD, dim: int, C: float, tol: float, look) -> np.ndarray:
    """Weights, then the intercept; ``look(weights)`` gives the objective's largest
    derivative.  Ends where that is at most ``tol``, or gains nothing any more."""
    passes = Passes(rows, dim)
    try:
        q, sums = passes.run(start, C)
        if not sums[0] > 0:
            return np.zeros(dim + 1)
        w, length, n_rows = np.zeros(dim + 1), sums[0] / (q @ q + sums[1]), rows.map(len).sum()
        best, late, turns, many, free, few, last = np.inf, 0, 0, True, True, SETTLED * n_rows, n_rows
        while passes.n < PASSES:
            if many:
                w, length = _approach(passes, C, w, length, few)
            q, (ff, pp, calls, *_) = passes.run(face, C, w, free)
            if not free and calls > ff:
                q, (ff, pp, *_) = passes.run(face, C, w, True)
            if not ff > 0:
                return w
            qp, gain, turn = q, ff, 0.0
            while passes.n < PASSES:
                curved = qp @ qp + pp
                step = gain / curved
                q, rest = passes.run(conjugate_step, C, qp, step, turn)
                (ff, own, by_curve, cross, crossed, calls), lost = rest[:MORE], rest[MORE:]
                w, turns = w - step * qp - lost, turns + 1
                if turns % LOOK == 0 or ff <= 1e-12 * last:
                    slope, last = look(w), ff
                    late = 0 if slope < 0.9 * best else late + 1
                    best = min(best, slope)
                    if slope <= tol or late >= PATIENCE:
                        return w
                if crossed or calls > ff or not ff > 0:
                    many, free = crossed > few, not crossed
                    break
                turn = by_curve / curved
                pp = own - 2.0 * turn * cross + turn * turn * pp
                qp, gain = q - turn * qp, ff
        return w
    finally:
        passes.end()
