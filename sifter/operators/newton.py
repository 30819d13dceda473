"""Linear classifiers by a Newton method over the cluster.

Minimises ``|w|^2 / 2 + C * sum of losses`` (logistic or squared hinge).  The
rows stay on the cluster as loaded blocks (``csr``).  A Newton step is
solved by conjugate gradients, one job for each product of Hessian and
vector.  The preconditioner is made by one job a step: the Hessian's share
of the ``HEAVY`` rows that weigh most (curvature times squared length) as it
is, and the diagonal of all other rows' share.  Long texts make large
eigenvalues that follow their rows, frequent words make others that follow
their columns; this takes both.  It is inverted on the driver (Woodbury), in
the size of those rows.  It only sets the number of jobs: the products are
over all rows.  One more job gives gradient and objective at the end of the
step and the objective at other lengths of it (``LENGTHS``), which cost a
row no more than its two margins; the best length is taken.

The squared hinge has rows that count and rows that don't, and a step from
afar misjudges which; so its minimum is found from its dual (``dual``), and
the steps only start there.  With no more than a block of rows, or without a
penalty on the intercept, it is followed from small ``C`` to the one asked for
(``PATH``), each from the one before, which takes fewer passes there.  Only vectors as long as the
vocabulary (the model) and the heavy rows pass through the driver.

Both problems have one minimum, and the solver stops where no partial
derivative exceeds ``tol``, so the result doesn't depend on the order in
which the tasks' sums are added, on the preconditioner or on the path.

``block_inverses`` is another preconditioner (the blocks' own inverses,
averaged: Wang, Roosta, Xu and Mahoney 2018).  It is exact for one block
and does little for many if words outnumber rows, so ``minimise`` doesn't
use it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame

from sifter.operators import csr, dual

#: Lengths of a step that its last job compares.
LENGTHS = np.array([1.0, 8.0, 4.0, 2.0, 1.5, *(0.75 ** np.arange(1.0, 40.0))])
#: Entries of a rare column, and frequent columns that are multiplied out at a time.
RARE = 8
CHUNK = 1024
#: Rows that the preconditioner takes whole, and entries that these have at most.
HEAVY = 512
ENTRIES = 4_000_000
#: Shares of C at which the squared hinge's minimum is found in turn, and the derivative (times C) that does on the way.
PATH = (1e-4, 1e-3, 1e-2, 10 ** -1.5, 0.1, 10 ** -0.5, 1.0)
NEAR = 30.0


def logistic(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of a signed margin, its derivative and second derivative."""
    p = 0.5 * (1.0 - np.tanh(z / 2.0))  # 1 - sigma(z)
    return np.logaddexp(0.0, -z), -p, p * (1.0 - p)


def squared_hinge(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    short = np.maximum(0.0, 1.0 - z)
    return short * short, -2.0 * short, 2.0 * (z < 1.0)


LOSSES = {"logistic": logistic, "squared_hinge": squared_hinge}


@dataclass(frozen=True)
class Problem:
    """``penalised_bias``: whether the intercept counts in |w|^2 (as a feature
    of constant 1 does)."""
    loss: str
    C: float = 1.0
    penalised_bias: bool = False


@dataclass
class Rows:
    """A block and the inner products of its rows (intercept included)."""
    block: csr.Block
    products: np.ndarray


def with_products(block: csr.Block) -> Rows:
    """Rare columns add their pairs of entries, frequent ones are multiplied out
    as dense matrices, ``CHUNK`` columns at a time."""
    n = len(block)
    order = np.argsort(block.idx, kind="stable")
    val, row = block.val[order], block.row()[order]
    number, count = np.unique(block.idx[order], return_inverse=True, return_counts=True)[1:]
    first = np.cumsum(count) - count
    out = np.ones(n * n, np.float32)
    for k in range(1, RARE + 1):
        at = first[count == k][:, None] + np.arange(k)  # the entries of the columns that have k
        for i in range(k):
            out += np.bincount((row[at[:, i], None] * n + row[at]).ravel(), (val[at[:, i], None] * val[at]).ravel(), n * n) \
                if len(at) else 0.0
    out = out.reshape(n, n)
    often = np.flatnonzero(count > RARE)
    place = np.full(len(count), -1)
    place[often] = np.arange(len(often))
    entry = np.flatnonzero(place[number] >= 0)
    column = place[number[entry]]
    for lo in range(0, len(often), CHUNK):
        a, b = np.searchsorted(column, (lo, lo + CHUNK))
        part = np.zeros((n, CHUNK), np.float32)
        part[row[entry[a:b]], column[a:b] - lo] = val[entry[a:b]]
        out += part @ part.T
    return Rows(block, out)


def prepare(blocks: DataFrame) -> RDD:
    return csr.load(blocks, with_products)


@dataclass
class Heavy:
    """Rows by weight, largest first: entries of row i stand at ptr[i]:ptr[i + 1];
    ``curve``: C times the loss's second derivative."""
    weight: np.ndarray
    curve: np.ndarray
    ptr: np.ndarray
    idx: np.ndarray
    val: np.ndarray

    def most(self) -> "Heavy":
        """The ``HEAVY`` heaviest that weigh anything, fewer if they pass ``ENTRIES``."""
        order = np.argsort(-self.weight, kind="stable")[:HEAVY]
        order = order[self.weight[order] > 0]
        size = np.diff(self.ptr)[order]
        order = order[np.cumsum(size) <= ENTRIES]
        size = size[:len(order)]
        ptr = np.append(0, np.cumsum(size))
        at = np.repeat(self.ptr[order] - ptr[:-1], size) + np.arange(ptr[-1])
        return Heavy(self.weight[order], self.curve[order], ptr, self.idx[at], self.val[at])

    def __add__(self, other: "Heavy") -> "Heavy":
        weight, curve, idx, val = (np.concatenate([getattr(self, k), getattr(other, k)]) for k in ("weight", "curve", "idx", "val"))
        return Heavy(weight, curve, np.append(self.ptr, self.ptr[-1] + other.ptr[1:]), idx, val).most()


NO_ROWS = Heavy(np.zeros(0), np.zeros(0), np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0))


def _block(rows: Rows | csr.Block) -> csr.Block:
    return rows.block if isinstance(rows, Rows) else rows


def _sums(rows: RDD, width: int, partial) -> np.ndarray:
    """Sums over all blocks of what ``partial(rows)`` gives: 1 x width numbers."""
    return rows.treeAggregate(np.zeros((1, width)), lambda total, r: total + partial(r), lambda a, b: a + b,
                              csr.levels(rows, width))


def evaluate(rows: RDD, dim: int, theta: np.ndarray, problem: Problem, step: np.ndarray | None = None):
    """The objective at ``theta + t * step`` (weights, then the intercept) for
    all t of ``LENGTHS``, and the gradient at ``theta + step``: one job."""
    loss, C = LOSSES[problem.loss], problem.C
    step = np.zeros_like(theta) if step is None else step
    lengths = LENGTHS if step.any() else LENGTHS[:1]

    def partial(rows):
        block = _block(rows)
        row = block.row()
        start, ahead = block.dot(theta, row) + theta[dim], block.dot(step, row) + step[dim]
        slope = C * loss(block.y * (start + ahead))[1] * block.y
        out = np.zeros((1, dim + 1 + len(lengths)))
        out[0, :dim] = np.bincount(block.idx, block.val * slope[row], dim)
        out[0, dim] = slope.sum()
        out[0, dim + 1:] = [C * loss(block.y * (start + t * ahead))[0].sum() for t in lengths]
        return out

    sums = _sums(rows, dim + 1 + len(lengths), partial)
    counted = _penalty(dim, problem)
    there = theta + step
    values = sums[0, dim + 1:] + [0.5 * (counted * (theta + t * step) ** 2).sum() for t in lengths]
    return values, sums[0, :dim + 1] + counted * there


def hessian_times(rows: RDD, dim: int, theta: np.ndarray, v: np.ndarray, problem: Problem) -> np.ndarray:
    """Product of the Hessian at ``theta`` and ``v``: one job."""
    loss, C = LOSSES[problem.loss], problem.C

    def partial(rows):
        block = _block(rows)
        row = block.row()
        second = C * loss(block.y * (block.dot(theta, row) + theta[dim]))[2]
        bent = second * (block.dot(v, row) + v[dim])
        return np.append(np.bincount(block.idx, block.val * bent[row], dim), bent.sum())[None]

    return _sums(rows, dim + 1, partial)[0] + _penalty(dim, problem) * v


def block_inverses(rows: RDD, dim: int, theta: np.ndarray, v: np.ndarray, problem: Problem, n_blocks: int) -> np.ndarray:
    """Mean over the blocks of (1 + n_blocks * their Hessian)^-1 v: one job.

    With A = the block's rows times the roots of their curvatures,
    (1 + A'A)^-1 v = v - A'(1 + AA')^-1 A v.
    """
    loss, C = LOSSES[problem.loss], problem.C

    def partial(rows):
        block = rows.block
        row = block.row()
        root = np.sqrt(n_blocks * C * loss(block.y * (block.dot(theta, row) + theta[dim]))[2])
        on = np.flatnonzero(root > 0)
        system = root[on, None] * rows.products[np.ix_(on, on)].astype(float) * root[on]
        system[np.diag_indices(len(on))] += 1.0
        back = np.zeros(len(block))
        back[on] = root[on] * np.linalg.solve(system, (root * (block.dot(v, row) + v[dim]))[on])
        return np.append(np.bincount(block.idx, block.val * back[row], dim), back.sum())[None]

    return v - _sums(rows, dim + 1, partial)[0] / n_blocks


def _penalty(dim: int, problem: Problem) -> np.ndarray:
    counted = np.ones(dim + 1)
    counted[dim] = float(problem.penalised_bias)
    return counted


def curvature(rows: RDD, dim: int, theta: np.ndarray, problem: Problem) -> tuple[np.ndarray, Heavy]:
    """The diagonal of the losses' Hessian at ``theta``, and the rows that weigh
    most in it: one job."""
    loss, C = LOSSES[problem.loss], problem.C

    def add(total, rows):
        block = _block(rows)
        row, squares = block.row(), block.val * block.val
        second = C * loss(block.y * (block.dot(theta, row) + theta[dim]))[2]
        diagonal = np.append(np.bincount(block.idx, squares * second[row], dim), second.sum())
        weight = second * (1.0 + np.bincount(row, squares, len(block)))
        return total[0] + diagonal, total[1] + Heavy(weight, second, block.ptr, block.idx, block.val).most()

    return rows.treeAggregate((np.zeros(dim + 1), NO_ROWS), add, lambda a, b: (a[0] + b[0], a[1] + b[1]))


def preconditioner(diagonal: np.ndarray, heavy: Heavy, dim: int, problem: Problem):
    """v -> M^-1 v with M = the penalty, the heavy rows' share of the Hessian and
    the diagonal of the others'.

    With A = the heavy rows times the roots of their curvatures and d = the
    rest, (d + A'A)^-1 v = v/d - (1/d) A'(1 + A (1/d) A')^-1 A (v/d).
    """
    n, idx, ptr = len(heavy.curve), heavy.idx, heavy.ptr
    row, root = np.repeat(np.arange(n), np.diff(ptr)), np.sqrt(heavy.curve)
    val = heavy.val * root[row]
    own = np.append(np.bincount(idx, val * val, dim), heavy.curve.sum())
    d = _penalty(dim, problem) + np.maximum(diagonal - own, 0.0)
    d[dim] = max(d[dim], 1e-6 * max(1.0, diagonal[dim]))
    scaled = val / np.sqrt(d[idx])
    often = np.bincount(idx, minlength=dim)[idx] > 1  # a word of one heavy row meets no other
    system = np.outer(root, root) / d[dim]
    system[np.diag_indices(n)] += 1.0 + np.bincount(row[~often], scaled[~often] ** 2, n)
    order = np.flatnonzero(often)[np.argsort(idx[often], kind="stable")]
    names, column = np.unique(idx[order], return_inverse=True)
    for lo in range(0, len(names), CHUNK):
        a, b = np.searchsorted(column, (lo, lo + CHUNK))
        part = np.zeros((n, CHUNK), np.float32)
        part[row[order[a:b]], column[a:b] - lo] = scaled[order[a:b]]
        system += part @ part.T
    inverse = np.linalg.inv(system)

    def apply(v: np.ndarray) -> np.ndarray:
        v = v / d
        u = inverse @ (np.bincount(row, val * v[idx], n) + root * v[dim])
        return v - np.append(np.bincount(idx, val * u[row], dim), root @ u) / d

    return apply


def newton_step(gradient: np.ndarray, product, inverse, accuracy: float = 0.2) -> np.ndarray:
    """Solves Hessian * s = -gradient by preconditioned conjugate gradients, to
    an accuracy relative to the start."""
    s, r = np.zeros_like(gradient), -gradient
    z = inverse(r)
    d, rz = z, r @ z
    goal = accuracy ** 2 * rz
    for _ in range(len(gradient)):
        hd = product(d)
        alpha = rz / (d @ hd)
        s, r = s + alpha * d, r - alpha * hd
        if np.sqrt(r @ r) <= accuracy * np.sqrt(gradient @ gradient):
            break
        z = inverse(r)
        rz, before = r @ z, rz
        if rz <= goal:
            break
        d = z + rz / before * d
    return s


def descend(rows: RDD, dim: int, theta: np.ndarray, problem: Problem, tol: float, max_iter: int) -> np.ndarray:
    """The minimum, from ``theta`` on; raises if ``max_iter`` steps don't reach it."""
    gradient = evaluate(rows, dim, theta, problem)[1]
    for _ in range(max_iter):
        if np.abs(gradient).max() <= tol:
            return theta
        here = theta
        inverse = preconditioner(*curvature(rows, dim, here, problem), dim, problem)
        step = newton_step(gradient, lambda v: hessian_times(rows, dim, here, v, problem), inverse)
        values, ahead = evaluate(rows, dim, theta, problem, step)
        best = int(np.argmin(values))
        # where the values differ in their last digits only, the gradient at the full step decides
        if values[0] - values[best] <= 1e-12 * abs(values[best]) and np.abs(ahead).max() < np.abs(gradient).max():
            best = 0
        theta = theta + LENGTHS[best] * step
        gradient = ahead if best == 0 else evaluate(rows, dim, theta, problem)[1]
    if np.abs(gradient).max() <= tol:
        return theta
    raise ValueError(f"no minimum within {max_iter} steps: derivative {np.abs(gradient).max():.2e}")


def minimise(blocks: DataFrame, dim: int, problem: Problem, tol: float = 1e-6, max_iter: int = 1000) -> np.ndarray:
    """The minimum (weights, then the intercept) over packed rows; raises if
    ``max_iter`` steps don't reach it."""
    rows = csr.load(blocks)
    try:
        theta = np.zeros(dim + 1)
        hinge = problem.loss == "squared_hinge"
        many = hinge and problem.penalised_bias and rows.map(len).sum() > csr.BLOCK_ROWS
        if many:
            theta = dual.minimise(rows, dim, problem.C, tol, lambda w: np.abs(evaluate(rows, dim, w, problem)[1]).max())
        for share in PATH if hinge and not many else PATH[-1:]:
            part = replace(problem, C=share * problem.C)
            theta = descend(rows, dim, theta, part, tol if share == PATH[-1] else max(tol, NEAR * part.C), max_iter)
        return theta
    finally:
        rows.unpersist()
