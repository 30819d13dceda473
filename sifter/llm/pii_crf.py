r"""Personal data by patterns and a skip-chain conditional random field.

The patterns (e-mail, IP, card, phone with their checks) give the base
spans.  A document's nodes are its base spans, whose label is observed,
and its other candidates: digit groups, words with ``@``, and words equal
to the local part of one of its e-mail addresses.  Nodes near each other
share a chain potential; each node and the document's first observed one
that it repeats (the same digits, the same text, an address' local part;
the first one, if none is observed) share a skip potential.  Links between
the repeats besides would count their own evidence again.  Loopy sum-product message passing then gives every candidate
the distribution of its label; a candidate that is some kind of personal
data with probability ``SURE`` or more is added as a span.

The node and edge potentials are log-ratios of counts over all documents,
labelled by the base spans (one pass, partial counts per task, at most
``TEMPLATES * FEATURES * 5 + 50`` cells in the end); a prior of
``AGREE`` agreeing skip edges stands for consistency.  Finding is
map-only, and a round costs time in proportion to a document's length:
repeats are linked to one for each key, not to all.  Messages pass until they
settle, in each document on its own, so that evidence reaches every repeat
and no document's result depends on its batch.

Results defined for odd input: a null or empty text has no spans; rows
that repeat an id are judged each on its own; digit groups of any length
are compared as text; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.textkit import flat_bytes, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0: none
FEATURES, TEMPLATES = 1 << 12, 5
DAMPING, SURE, AGREE, SMOOTH = 0.3, 0.8, 2000.0, 0.5
#: A document's messages pass until none would change by more than
#: ``TOLERANCE``.  Loops may swing for ever: every ``PATIENCE`` rounds halve the
#: step, and a document that still swings stops after ``MOST_ROUNDS``.
TOLERANCE, PATIENCE, MOST_ROUNDS = 1e-4, 100, 1000
#: Weight of the chain potentials: neighbours' labels and the features count
#: the same evidence twice.
CHAIN = 0.25
#: Characters between nodes that share a chain potential; digits that a
#: repeated number has at least; characters of a repeated word.
NEAR, LEAST_DIGITS, LEAST_CHARS = 40, 7, 6

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9](?:[\x20().-]{0,3}[0-9])++")
_AT_WORD = re.compile(r"[^\x20\x09-\x0D@]{1,64}@[^\x20\x09-\x0D@]{1,64}")
_WORD = re.compile(r"[A-Za-z0-9._%+-]++")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; each starts where the run of local characters before
    an ``@`` does, or at the end of the match before."""
    last, at = 0, text.find("@")
    floor = 0
    while at >= 0:
        run = text[max(last, floor):at]
        start = at - (len(run) - len(run.rstrip(_LOCAL)))
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        floor = at + 1
        at = text.find("@", at + 1)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) that the patterns find, in order; and the matches
    that fail their kind's check."""
    spans, failed = [], []
    if "@" in text:
        spans += [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
        else:
            failed.append(m.span())
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
        elif len(digits) >= 12:
            failed.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
            else:
                failed.append(m.span())
    return sorted(spans), failed


def _free(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of ``taken`` (both sorted by start)."""
    out, i, reach = [], 0, 0
    for a, b in spans:
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= a:
            out.append((a, b))
    return out


def nodes(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) of base spans and candidates, by start; the
    candidates' label is 0."""
    taken = sorted((a, b) for a, _, b in base)
    found = [m.span() for m in _GROUP.finditer(text)]
    if "@" in text:
        found += [m.span() for m in _AT_WORD.finditer(text)]
    locals_ = {text[a:b].split("@", 1)[0].lower() for a, k, b in base if k == 0}
    locals_ = {x for x in locals_ if len(x) >= LEAST_CHARS}
    if locals_:
        found += [m.span() for m in _WORD.finditer(text) if m[0].lower().rstrip(".") in locals_]
    free, last = [], 0
    for a, b in _free(sorted(set(found)), taken):
        if a >= last:
            free.append((a, b, 0))
            last = b
    return sorted([(a, b, 1 + k) for a, k, b in base] + free)


def shape(word: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", word))[:16]


class Overlap:
    """Tells whether a span overlaps any of ``spans``, by bisection."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [a for a, _ in spans]
        self.reach = list(accumulate((b for _, b in spans), max))

    def __call__(self, a: int, b: int) -> bool:
        n = bisect_left(self.starts, b)
        return n > 0 and self.reach[n - 1] > a


def features(text: str, a: int, b: int, failed: Overlap) -> list[int]:
    word = text[a:b]
    digits = sum(c.isdigit() for c in word[:64])
    values = (shape(word), f"{digits}|{'@' in word}", f"{text[a - 1:a]}|{word[:1]}",
              f"{text[b:b + 1]}|{word[-1:]}", f"{min(len(word), 40)}|{failed(a, b)}")
    return [i * FEATURES + zlib.crc32(v.encode("utf-8", "replace")) % FEATURES for i, v in enumerate(values)]


def keys(word: str) -> list[str]:
    """What a repeat of this node has in common with it."""
    word = word.lower().rstrip(".")
    digits = _NOT_DIGIT.sub("", word)
    out = [word] if len(word) >= LEAST_CHARS else []
    if "@" in word:
        local = word.split("@", 1)[0]
        return out + ([local] if len(local) >= LEAST_CHARS else [])
    # alike with or without a country code
    return out + [f"#{d}" for d in {digits, digits[-9:]} if len(d) >= LEAST_DIGITS]


def graph(text: str, found: list[tuple[int, int, int]], failed: list[tuple[int, int]]):
    """Feature rows of the nodes, and their (left, right, kind) edges: 0 chain,
    1 to the repeat before, which is counted, 2 to the first observed or first
    one, along which messages pass with the potential of 1."""
    overlap = Overlap(failed)
    rows = [features(text, a, b, overlap) for a, b, _ in found]
    edges, before, first = [], {}, {}
    repeats = [keys(text[a:b]) for a, b, _ in found]
    for observed in (True, False):
        for i, (_, _, label) in enumerate(found):
            if bool(label) == observed:
                for k in repeats[i]:
                    first.setdefault(k, i)
    for i, (a, _, _) in enumerate(found):
        if i and a - found[i - 1][1] <= NEAR:
            edges.append((i - 1, i, 0))
        edges += [(j, i, 1) for j in sorted({before[k] for k in repeats[i] if k in before})]
        edges += [(j, i, 2) for j in sorted({first[k] for k in repeats[i]} - {i})]
        for k in repeats[i]:
            before[k] = i
    return rows, edges


def candidates(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    """Rows whose text has a digit or ``@``; no other can have a node."""
    col = batch.column(batch.schema.get_field_index("text"))
    data, offsets = flat_bytes(col)
    hit = ((data >= 48) & (data <= 57)) | (data == 64)
    upto = np.concatenate([[0], np.cumsum(hit)])[offsets]
    for i in np.flatnonzero(np.diff(upto)):
        yield int(i), col[int(i)].as_py()


def count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts: of (feature, label), then of (edge type, label, label)."""
    table = np.zeros(TEMPLATES * FEATURES * LABELS + 2 * LABELS * LABELS, np.int64)
    pairs = TEMPLATES * FEATURES * LABELS
    for batch in batches:
        for part in slices(batch, "text"):
            for _, text in candidates(part):
                base, failed = base_spans(text)
                found = nodes(text, base)
                rows, edges = graph(text, found, failed)
                for row, (_, _, label) in zip(rows, found, strict=True):
                    for f in row:
                        table[f * LABELS + label] += 1
                for i, j, kind in (e for e in edges if e[2] < 2):
                    table[pairs + (kind * LABELS + found[i][2]) * LABELS + found[j][2]] += 1
    cells = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(table[cells])], ["cell", "n"])


class Crf:
    """Potentials in logs: ``unary`` per feature and label, ``edge`` per type and label pair."""

    def __init__(self, counts: np.ndarray):
        n = TEMPLATES * FEATURES * LABELS
        seen = counts[:n].reshape(-1, LABELS).astype(float)
        prior = seen.sum(0) + 1
        prior /= prior.sum()
        self.unary = np.log((seen + 2 * SMOOTH * prior) / (seen.sum(1, keepdims=True) + 2 * SMOOTH))
        pair = counts[n:].reshape(2, LABELS, LABELS) + SMOOTH
        pair[1] += AGREE * np.eye(LABELS)
        total = pair.sum((1, 2), keepdims=True)
        self.edge = np.log(pair * total / (pair.sum(2, keepdims=True) * pair.sum(1, keepdims=True)))
        self.edge[0] *= CHAIN
        # a repeat says as much for one kind as for another
        self.edge[1] = np.log(pair[1] / np.sqrt(np.outer(np.diag(pair[1]), np.diag(pair[1]))))

    def posteriors(self, rows: np.ndarray, labels: np.ndarray, edges: np.ndarray,
                   owner: np.ndarray | None = None) -> np.ndarray:
        """Label distributions of the nodes of any number of documents;
        ``owner`` is each node's document, ascending from 0."""
        unary = self.unary[rows].mean(1)
        known = labels > 0
        unary[known] = -1e6  # no number of neighbours outweighs what is observed
        unary[known, labels[known]] = 0.0
        owner = np.zeros(len(rows), np.int64) if owner is None else owner
        kind = np.minimum(edges[:, 2], 1)
        left = np.concatenate([edges[:, 0], edges[:, 1]])
        right = np.concatenate([edges[:, 1], edges[:, 0]])
        pot = np.concatenate([self.edge[kind], self.edge[kind].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(left), LABELS))
        at = np.arange(len(left))  # messages of documents that have not settled

        def belief(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Nodes that the messages reach, and what they believe."""
            nodes, where = np.unique(right[at], return_inverse=True)
            total = unary[nodes]
            for k in range(LABELS):
                total[:, k] += np.bincount(where, message[at, k], len(nodes))
            return nodes, total

        for n in range(MOST_ROUNDS):
            if not len(at):
                break
            nodes, total = belief(at)
            out = (total[np.searchsorted(nodes, left[at])] - message[back[at]])[:, :, None] + pot[at]
            top = out.max(1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(1, keepdims=True)))[:, 0]
            new -= new.max(1, keepdims=True)
            change = np.zeros(owner[-1] + 1)
            np.maximum.at(change, owner[left[at]], np.abs(new - message[at]).max(1))
            step = (1 - DAMPING) / 2 ** (n // PATIENCE)
            message[at] += step * (new - message[at])
            at = at[change[owner[left[at]]] > TOLERANCE]
        nodes, total = belief(np.arange(len(left)))
        unary[nodes] = total
        total = unary
        p = np.exp(total - total.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def train(docs: DataFrame, text_col: str = "text") -> Crf:
    """Potentials from all documents."""
    cells = (docs.select(F.col(text_col).cast("string").alias("text"))
             .mapInArrow(count_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(TEMPLATES * FEATURES * LABELS + 2 * LABELS * LABELS)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return Crf(counts)


def spans_of(part: pa.RecordBatch, model: Crf) -> dict[int, list[tuple[int, int, int, bool]]]:
    """Per row that has any: (start, kind, end, base) in order."""
    out = {}
    rows, labels, edges, owner = [], [], [], []
    for i, text in candidates(part):
        base, failed = base_spans(text)
        found = nodes(text, base)
        out[i] = [(a, k, b, True) for a, k, b in base]
        if len(found) > len(base):
            at = len(rows)
            own, links = graph(text, found, failed)
            rows += own
            edges += [(x + at, y + at, kind) for x, y, kind in links if kind != 1]
            labels += [label for _, _, label in found]
            owner += [(i, a, b) for a, b, _ in found]
    if rows:
        label = np.array(labels)
        document = np.unique([i for i, _, _ in owner], return_inverse=True)[1]
        p = model.posteriors(np.array(rows), label, np.array(edges, np.int64).reshape(-1, 3), document)
        best = p[:, 1:].argmax(1)
        for n in np.flatnonzero((label == 0) & (p[np.arange(len(p)), 1 + best] >= SURE)):
            i, a, b = owner[n]
            out[i].append((a, int(best[n]), b, False))
    return {i: sorted(s) for i, s in out.items() if s}


def find(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) with spans an array of (kind, start, end, base): code points,
    end exclusive, ordered by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = spans_of(part, shared.value)
                lists = [[(KINDS[k], a, b, base) for a, k, b, base in found.get(i, ())] for i in range(part.num_rows)]
                flat = [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for x in lists for s in x]
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, struct))], ["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
            .withColumnRenamed("id", id_col))
