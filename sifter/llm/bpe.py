"""Byte-level BPE encoding and decoding with padded numpy matrices.

The distinct pieces of a slice of texts (matches of the split pattern,
merged separately) are put in length buckets as rows of padded matrices
of token ids.  In every round each row merges its leftmost pair of
minimum rank; ranks come from one hashed pair table, the row closes the
gap, and rows without a mergeable pair leave the matrix.  A round costs
the matrix' width, so pieces longer than ``LONGEST`` bytes take the same
merges in the same order from a heap instead (n log n, not n squared).

Results defined for odd input: a null or empty text has no ids and
decodes to no bytes; ids of several rows never mix; extra columns of the
input are not read.  Whole texts are encoded, whatever their length.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.textkit import slices

#: Bytes; longer pieces are merged from a heap.
LONGEST = 256
#: Pieces whose ids a task keeps between slices (it starts anew beyond).
KEPT_PIECES = 500_000
#: Rows of a matrix.
MATRIX_ROWS = 20_000
NO_PAIR = np.int32(2**31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class PairTable:
    """(left id, right id) -> id of the joined token, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        self.base = max(ranks.values(), default=0) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.bits = max(4, int(4 * len(pairs) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_PAIR, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):  # each round the first key that wants a free slot gets it
            self.probes += 1
            free = self.keys[slot[left]] == -1
            _, first = np.unique(slot[left], return_index=True)
            won = np.zeros(len(left), bool)
            won[first] = True
            won &= free
            self.keys[slot[left[won]]] = keys[left[won]]
            self.values[slot[left[won]]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_PAIR where it isn't in the table."""
        keys = left.astype(np.int64) * self.base + right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], NO_PAIR)
        todo = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        for _ in range(self.probes):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


class Splitter:
    """All matches of the split pattern, in order.

    The letter and number properties are spelt out for texts without a
    character from U+0250 on, which the standard library's matcher handles
    faster; any other text, or a pattern with other properties, goes to
    the ``regex`` package.
    """

    LIMIT = 0x250

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        self.narrow = None
        for prop in ("L", "N"):
            members = "".join(chr(c) for c in range(self.LIMIT) if unicodedata.category(chr(c))[0] == prop)
            # alone as a class of its own, within a class as its members
            pattern = re.sub(r"(\[[^\[\]]*)\\p\{%s\}" % prop, lambda m, x=members: m[1] + x, pattern)
            pattern = pattern.replace(r"\p{%s}" % prop, f"[{members}]")
        if r"\p" not in pattern and r"\P" not in pattern:
            self.narrow = re.compile(pattern)
        # U+001C to U+001F are white space to one matcher only
        self.odd = re.compile("[\x1c-\x1f%c-%c]" % (self.LIMIT, 0x10FFFF))

    def __call__(self, text: str) -> list[str]:
        if self.narrow is None or self.odd.search(text):
            return self.full.findall(text)
        return self.narrow.findall(text)


class Numbering(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number

    def take_new(self) -> list[str]:
        new, self.new = self.new, []
        return new


class ByteBpe:
    """Encoder and decoder for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = Splitter(pattern)
        self.pairs = PairTable(ranks)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_end = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known = Numbering()
        self.flat = np.zeros(0, np.int32)  # ids of the known pieces
        self.start, self.end = np.zeros(0, np.int64), np.zeros(0, np.int64)  # by number

    def merge_matrix(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (concatenated) and their number for pieces of similar length."""
        width = int(lens.max())
        inside = np.arange(width) < lens[:, None]
        ids = np.zeros((len(lens), width), np.int32)
        ids[inside] = self.byte_id[data]
        ranks = np.full((len(lens), width), NO_PAIR, np.int32)
        if width > 1:
            paired = inside[:, 1:]
            ranks[:, :-1][paired] = self.pairs.rank(ids[:, :-1][paired], ids[:, 1:][paired])
        # columns are the first axis: a merge moves whole columns
        ids, ranks = np.ascontiguousarray(ids.T), np.ascontiguousarray(ranks.T)
        done, done_lens, lens = np.zeros_like(ids), lens.copy(), lens.copy()
        row = np.arange(len(lens))
        while True:
            at = ranks.argmin(axis=0)
            best = ranks[at, np.arange(len(row))]
            live = best != NO_PAIR
            if not live.all():
                gone = np.flatnonzero(~live)
                done[:len(ids), row[gone]] = ids[:, gone]
                done_lens[row[gone]] = lens[gone]
                keep = np.flatnonzero(live)
                if not len(keep):
                    break
                width = int(lens[keep].max())
                ids, ranks = ids[:width, keep], ranks[:width, keep]
                lens, row, at, best = lens[keep], row[keep], at[keep], best[keep]
            here = np.arange(len(row))
            # the id after the merge goes, as does the rank that stood at it
            if len(ids) <= 32:
                for j in range(int(at.min()), len(ids) - 1):
                    np.copyto(ids[j], ids[j + 1], where=at < j)
                    np.copyto(ranks[j], ranks[j + 1], where=at <= j)
            else:
                cols = np.arange(len(ids) - 1)[:, None]
                ids[:-1] = np.take_along_axis(ids, cols + (cols > at), axis=0)
                ranks[:-1] = np.take_along_axis(ranks, cols + (cols >= at), axis=0)
            ranks[-1] = NO_PAIR
            ids[at, here] = best
            lens -= 1
            ranks[at, here] = NO_PAIR
            for side in (0, -1):  # the merged id's pairs to the right and to the left
                which = np.flatnonzero(at + 1 < lens if side == 0 else at > 0)
                p = at[which] + side
                ranks[p, which] = self.pairs.rank(ids[p, which], ids[p + 1, which])
        return done.T[np.arange(done.shape[0]) < done_lens[:, None]], done_lens

    def merge_heap(self, piece: bytes) -> tuple[int, ...]:
        """The same merges for one long piece: least rank first, leftmost first."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        first = self.pairs.rank(ids[:-1], ids[1:])
        ids = ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_PAIR]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                r = int(self.pairs.rank(np.array([ids[i]]), np.array([ids[j]]))[0])
                if r != NO_PAIR:
                    heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return tuple(x for x in ids if x >= 0)

    def learn(self, pieces: list[str]) -> None:
        """Adds the ids of the pieces numbered last."""
        if not pieces:
            return
        raw = [p.encode() for p in pieces]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        # buckets of similar byte length, at most MATRIX_ROWS pieces each
        bucket = np.where(lens > LONGEST, 99, np.maximum(2, np.ceil(np.log2(np.maximum(lens, 1)) * 2)))
        order = np.argsort(bucket, kind="stable")
        flats, sizes, a = [self.flat], np.zeros(len(raw), np.int64), 0
        while a < len(order):
            b = min(a + MATRIX_ROWS, int(np.searchsorted(bucket[order], bucket[order[a]], "right")))
            part = order[a:b]
            if bucket[part[0]] == 99:
                merged = [self.merge_heap(raw[i]) for i in part]
                flats.append(np.fromiter(chain.from_iterable(merged), np.int32))
                sizes[part] = np.fromiter(map(len, merged), np.int64, len(merged))
            else:
                joined = np.frombuffer(b"".join([raw[i] for i in part]), np.uint8)
                flat, sizes[part] = self.merge_matrix(joined, lens[part])
                flats.append(flat)
            a = b
        end = np.empty(len(raw), np.int64)
        end[order] = len(self.flat) + np.cumsum(sizes[order])
        self.flat = np.concatenate(flats)
        self.start = np.concatenate([self.start, end - sizes])
        self.end = np.concatenate([self.end, end])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and their offsets (len + 1)."""
        if len(self.known) > KEPT_PIECES:
            self.forget()
        split = [self.split(t) for t in texts]
        n_pieces = np.fromiter(map(len, split), np.int64, len(split))
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)),
                             np.int64, int(n_pieces.sum()))
        self.learn(self.known.take_new())
        ids, sizes = gather(self.flat, self.start[number], self.end[number])
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, upto[np.concatenate([[0], np.cumsum(n_pieces)])]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, concatenated, and of how many bytes each is."""
        end = self.token_end[ids]
        start = np.where(ids > 0, self.token_end[ids - 1], 0)
        return gather(self.token_bytes, start, end)


def gather(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[start:end] of every span, concatenated, and the spans' sizes."""
    sizes = end - start
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(start - before, sizes) + np.arange(int(sizes.sum()))], sizes


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded binary) of every text; ``decoded`` are
    the bytes that the ids stand for.

    Map-only: no shuffle.  The rank table (a fixed file of about 1 MB)
    goes to the tasks as a broadcast variable, so only the driver needs
    the file.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((load_ranks(ranks_path), pattern))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(*shared.value)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids, offsets = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                decoded, sizes = bpe.decode(ids)
                upto = np.concatenate([[0], np.cumsum(sizes)])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                     pa.Array.from_buffers(pa.binary(), part.num_rows, [
                         None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(decoded)])],
                    ["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(encode, f"id {kind}, ids array<int>, decoded binary")
            .withColumnRenamed("id", id_col))
