"""Token counts by heap-and-linked-list byte-pair merging.

A text is split at the added tokens of the tokenizer file (one token
each) and then into pieces by the file's split pattern.  Every distinct
piece is merged once: its bytes are a doubly linked list of symbols, a
heap holds its adjacent pairs by (merge rank, place), and the least one
is popped again and again, joined with its neighbour, and the two pairs
that this makes are pushed.  A popped pair whose place holds another pair
by now is stale and is passed over.  The count of a piece is its initial
symbols less its merges; no identifiers are made.

A piece of n bytes costs n log n, so one word of a million letters is no
special case.  Piece counts are kept between texts of a task up to
``KEPT_PIECES`` (then a task starts anew); memory is one text, its longest
piece and that many counts.  Map-only: nothing is shuffled, no state grows
with the table, and a lost task repeats its own rows alone.  The merges (a
file of about 2 MB) go to the tasks as a broadcast variable.

Results defined for odd input: a null or empty text has 0 bytes and 0
tokens; repeated rows are counted each; a null id stays null; extra
columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.bpe import Splitter
from sifter.llm.textkit import flat_bytes, slices

#: Pieces whose counts a task keeps between texts.
KEPT_PIECES = 500_000
#: Bits of a place in a piece, below the rank in a heap entry.
PLACE_BITS = 40

# --- fixed values: the split pattern that the file's byte-level splitter names,
# and the code points that became letters or numbers in Unicode 17, which that
# splitter (Unicode 16) still takes for other characters.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SINCE_UNICODE_16 = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F))
# --- end of fixed values

_NEWER = regex.compile("[%s]" % "".join(f"{chr(a)}-{chr(b)}" for a, b in SINCE_UNICODE_16))
#: A private-use character: neither letter nor number nor white space.
_OTHER = "\ue000"


@dataclass(frozen=True)
class Merges:
    """What counting needs of a tokenizer file."""
    symbols: tuple[int, ...]          # id of each byte
    pairs: dict[tuple[int, int], tuple[int, int]]  # pair of ids -> (rank, id of the join)
    added: tuple[str, ...]            # strings that are one token each


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable bytes
    stand for themselves, the rest for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def load_merges(path: str) -> Merges:
    """The merges of a byte-level BPE file.  Raises on a file that asks for
    anything else (normalizer, other splitters, prefix space, dropout)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, splitter = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not any(
                 model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
             and spec.get("normalizer") is None and splitter.get("type") == "ByteLevel"
             and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)
             and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]))
    if not plain:
        raise ValueError(f"not a plain byte-level BPE file: {path}")
    vocab = model["vocab"]
    pairs = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
    return Merges(tuple(vocab[c] for c in _byte_letters()), pairs, tuple(t["content"] for t in spec["added_tokens"]))


def count_piece(raw: bytes, merges: Merges) -> int:
    """Tokens of one piece: its bytes less the merges that they undergo."""
    n = len(raw)
    pairs = merges.pairs
    if n < 2:
        return n
    symbol, after, before = [merges.symbols[b] for b in raw], range(1, n + 1), range(-1, n - 1)
    # compact links for a long piece, faster ones for a short one
    symbol, after, before = ((array("q", x) for x in (symbol, after, before)) if n > 4096
                             else (symbol, list(after), list(before)))
    heap = []
    for at in range(n - 1):
        found = pairs.get((symbol[at], symbol[at + 1]))
        if found:
            heap.append(found[0] << PLACE_BITS | at)
    heapq.heapify(heap)
    merged = 0
    while heap:
        entry = heapq.heappop(heap)
        at = entry & (1 << PLACE_BITS) - 1
        right = after[at]
        if symbol[at] < 0 or right == n:
            continue
        found = pairs.get((symbol[at], symbol[right]))
        if found is None or found[0] != entry >> PLACE_BITS:
            continue
        merged += 1
        symbol[at], symbol[right] = found[1], -1
        after[at] = beyond = after[right]
        if beyond < n:
            before[beyond] = at
            found = pairs.get((symbol[at], symbol[beyond]))
            if found:
                heapq.heappush(heap, found[0] << PLACE_BITS | at)
        left = before[at]
        if left >= 0:
            found = pairs.get((symbol[left], symbol[at]))
            if found:
                heapq.heappush(heap, found[0] << PLACE_BITS | left)
    return n - merged


class Counter(dict):
    """Tokens of texts; a dict of the pieces counted so far."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges
        self.split = Splitter(PATTERN)
        strings = sorted(filter(None, merges.added), key=len, reverse=True)  # the longest of one start wins
        self.added = regex.compile("|".join(map(regex.escape, strings))) if strings else None

    def __missing__(self, piece: str) -> int:
        self[piece] = n = count_piece(piece.encode(), self.merges)
        return n

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and _NEWER.search(text):
            plain = _NEWER.sub(_OTHER, text)
            return [text[m.start():m.end()] for m in self.split.full.finditer(plain)]
        return self.split(text)

    def count(self, text: str) -> int:
        if len(self) > KEPT_PIECES:
            self.clear()
        if self.added is None or not self.added.search(text):
            return sum(map(self.__getitem__, self.pieces(text)))
        total, at = 0, 0
        for m in self.added.finditer(text):
            total += 1 + sum(map(self.__getitem__, self.pieces(text[at:m.start()])))
            at = m.end()
        return total + sum(map(self.__getitem__, self.pieces(text[at:])))


def token_counts(docs: DataFrame, path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text under the tokenizer
    file at ``path`` (read by the driver)."""
    shared = docs.sparkSession.sparkContext.broadcast(load_merges(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                _, offsets = flat_bytes(part.column(1))
                tokens = [counter.count(t) if t else 0 for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(offsets[1:] - offsets[:-1], pa.int64()), pa.array(tokens, pa.int64())],
                    ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
