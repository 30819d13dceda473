"""Vectorised text primitives shared by the operators of this subpackage.

Everything here works on one Arrow string column inside a task: words are
found and hashed with numpy over the column's byte buffer, so no Python
object is made per word.  Words are runs of bytes other than space and
``\\x09-\\x0D``; ``A-Z`` is lower-cased where a caller asks for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time (bounds numpy's temporaries).
SEGMENT = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.RandomState(20240229)
_BYTE = (_rng.randint(0, 1 << 32, 256, dtype=np.uint64) << np.uint64(32)
         | _rng.randint(0, 1 << 32, 256, dtype=np.uint64)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, SEGMENT + 1)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix64(h: np.ndarray) -> np.ndarray:
    """Final avalanche of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (len + 1) of a string column; null counts as empty."""
    col = col.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that stay within one row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1] = False
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span (spans ascend and do not overlap)."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        lo = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, lo + SEGMENT, "right")))
        seg = data[lo:ends[b - 1]]
        up, down = _power_tables(len(seg) + 1)
        sums = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[seg] if lower else seg] * up[:len(seg)], out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        a = b
    return out


def words(col: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every row, in text order, and words per row."""
    data, offsets = flat_bytes(col)
    starts, ends = runs(~_SPACE[data], offsets)
    counts = np.diff(np.searchsorted(starts, offsets))
    return span_hashes(data, starts, ends, lower), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k-word window in text order, and windows per row.

    A row of 1 to k-1 words has one window, its whole sequence; a row
    without words has none.
    """
    row_start = np.concatenate([[0], np.cumsum(counts)])
    valid = np.zeros(len(hashes), bool)
    out = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - k + 1
    if n > 0:
        acc = np.zeros(n, np.uint64)
        for i in range(k):
            acc = (acc + hashes[i:i + n]) * np.uint64(0xD6E8FEB86659FD93)
        out[:n] = mix64(acc)
        row = np.repeat(np.arange(len(counts)), counts)
        valid[:n] = row[:n] == row[k - 1:]
    for r in np.flatnonzero((counts > 0) & (counts < k)):
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for w in hashes[row_start[r]:row_start[r + 1]]:
                h = (h + w) * np.uint64(0xA0761D6478BD642F)
        out[row_start[r]] = mix64(np.array([h + np.uint64(counts[r])]))[0]
        valid[row_start[r]] = True
    return out[valid], np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of text (a row at least),
    so a task's temporaries do not grow with the batch."""
    col = batch.column(batch.schema.get_field_index(text))
    _, offsets = flat_bytes(col)
    a, n = 0, batch.num_rows
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, n)
        yield batch.slice(a, b - a)
        a = b
