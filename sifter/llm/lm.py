"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of the bigram, the unigram
and the uniform distribution.  The mixture weights depend on how often the
context was seen (buckets of powers of two) and are learned by
expectation-maximisation on held-out counts: those of all training documents,
each of which is deleted from the counts that its own tokens are predicted
from.

Counts are exact and grow with the corpus, so they are never broadcast.
Documents are dealt to chunks of about ``CHUNK_CHARS`` characters; a chunk
sends its distinct unigrams and bigrams (64-bit hashes, packed in order)
with their counts to the parts of the key space, a part adds up what all
chunks sent and answers each with the totals in the order in which it
asked, and the chunk scores its documents from them.  A frequent n-gram
therefore travels once for each chunk, and a task holds one chunk or one
part, both of bounded size.

Results defined for odd input: a null or empty text is one end token; rows
that repeat an id are documents of their own; without training documents
every probability is 1; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.stage import staged
from sifter.llm.textkit import mix64, words

#: Characters of a chunk and of the texts that fill a part.
CHUNK_CHARS, PART_CHARS = 12_000_000, 8_000_000
EM_ROUNDS, BUCKETS = 50, 24
#: Steps of a probability's binary logarithm in the counts that EM reads.
STEP = 4

END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte plane by byte plane."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd"), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    planes = counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.int64)[:, 0]


@dataclass
class Tokens:
    """Tokens of a chunk: unigram and bigram keys, and each document's first token."""
    unigram: np.ndarray
    bigram: np.ndarray
    first: np.ndarray
    counts: np.ndarray

    @property
    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def tokenize(col: pa.Array) -> Tokens:
    hashes, n = words(col, lower=True)
    counts = n + 1
    first = np.cumsum(counts) - counts
    unigram = np.empty(int(counts.sum()), np.uint64)
    is_end = np.zeros(len(unigram), bool)
    is_end[first + n] = True
    unigram[is_end] = END
    unigram[~is_end] = hashes
    before = np.empty_like(unigram)
    before[1:] = unigram[:-1]
    before[first] = START
    return Tokens(unigram, mix64(before * _A + unigram * _B), first, counts)


def cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the key space begins in ascending keys (parts + 1)."""
    edges = np.array([-(-(p << 64) // parts) for p in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


REQUEST = "part int, chunk int, kind int, n int, keys binary, counts binary"
ANSWER = "chunk int, kind int, part int, n int, totals binary, tokens long, types long, documents long"


def ask(parts: int):
    """A chunk's distinct n-grams with their training counts, for every part."""
    def run(table: pa.Table) -> pa.Table:
        t = tokenize(table.column("text").combine_chunks())
        chunk = table.column("chunk")[0].as_py()
        train = np.repeat(table.column("train").to_numpy(), t.counts)
        rows = []
        for kind, keys in enumerate((t.unigram, t.bigram)):
            distinct, own = np.unique(keys, return_inverse=True)
            counts = np.bincount(own[train], minlength=len(distinct))
            at = cuts(distinct, parts)
            for p in np.flatnonzero(np.diff(at)):
                a, b = at[p], at[p + 1]
                rows.append((int(p), chunk, kind, int(b - a), pack(distinct[a:b]), pack_counts(counts[a:b])))
        return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(
            [("part", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()),
             ("keys", pa.binary()), ("counts", pa.binary())])})
    return run


def answer(table: pa.Table) -> pa.Table:
    """A part's totals for each chunk, in the order in which it asked; for
    unigrams one row (chunk -1) with the part's tokens and types."""
    rows = []
    part = table.column("part")[0].as_py()
    for kind in (0, 1):
        asked = sorted((r for r in table.filter(pc.equal(table.column("kind"), kind)).to_pylist()),
                       key=lambda r: r["chunk"])
        if not asked:
            continue
        keys = np.concatenate([unpack(r["keys"], r["n"]) for r in asked])
        counts = np.concatenate([unpack_counts(r["counts"], r["n"]) for r in asked])
        order = np.argsort(keys, kind="stable")
        new = np.diff(keys[order], prepend=keys[order[:1]] - np.uint64(1)) != 0
        per_key = np.add.reduceat(counts[order], np.flatnonzero(new))
        totals = np.empty(len(keys), np.int64)
        totals[order] = per_key[np.cumsum(new) - 1]
        a = 0
        for r in asked:
            rows.append((r["chunk"], kind, part, r["n"], pack_counts(totals[a:a + r["n"]]), 0, 0, 0))
            a += r["n"]
        if kind == 0:
            at_end = np.flatnonzero(keys == END)[:1]
            end = int(totals[at_end[0]]) if len(at_end) else 0
            rows.append((-1, 0, part, 0, b"", int(per_key.sum()), int((per_key > 0).sum()), end))
    names = [("chunk", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("n", pa.int32()),
             ("totals", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()), ("documents", pa.int64())]
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(names)})


@dataclass
class Model:
    """Training tokens, types and documents, and the weights (bigram, unigram,
    uniform) by context bucket."""
    tokens: int
    types: int
    documents: int
    weights: np.ndarray


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count)), at most BUCKETS - 1."""
    return np.minimum(np.frexp(np.maximum(context, 0).astype(float))[1], BUCKETS - 1)


def looked_up(docs: pa.Table, answers: pa.Table):
    """Tokens of a chunk with the totals of each token's unigram, bigram and context."""
    t = tokenize(docs.column("text").combine_chunks())
    found = []
    for kind, keys in enumerate((t.unigram, t.bigram)):
        _, own = np.unique(keys, return_inverse=True)
        got = sorted((r for r in answers.to_pylist() if r["kind"] == kind), key=lambda r: r["part"])
        totals = np.concatenate([unpack_counts(r["totals"], r["n"]) for r in got]) if got else np.zeros(0, np.int64)
        found.append((own, totals))
    unigram = found[0][1][found[0][0]] if len(t.unigram) else np.zeros(0, np.int64)
    bigram = found[1][1][found[1][0]] if len(t.bigram) else np.zeros(0, np.int64)
    return t, unigram, bigram, found


def _previous(t: Tokens, of_token: np.ndarray, at_start) -> np.ndarray:
    out = np.empty_like(of_token)
    out[1:] = of_token[:-1]
    out[t.first] = at_start
    return out


def held_out_counts(tokens: int, documents: int):
    """(bucket, bigram step, unigram step, n): how often tokens of training
    documents have such estimates once their own document is deleted."""
    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        t, unigram, bigram, found = looked_up(docs, answers)
        train = np.repeat(docs.column("train").to_numpy(), t.counts)
        own = []
        for numbers, _ in found:  # occurrences in the token's own document
            pair = t.document * (int(numbers.max()) + 1 if len(numbers) else 1) + numbers
            _, where, times = np.unique(pair, return_inverse=True, return_counts=True)
            own.append(times[where])
        uni, bi = unigram - own[0], bigram - own[1]
        context = _previous(t, uni, documents - 1)
        left = np.maximum(tokens - t.counts[t.document], 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            p2 = np.where(context > 0, bi / np.maximum(context, 1), 0)
            p1 = uni / left
            steps = [np.where(p > 0, np.round(-np.log2(np.maximum(p, 1e-30)) * STEP), -1).astype(np.int64) for p in (p2, p1)]
        cell = ((bucket(context) * 1024 + steps[0] + 1) * 1024 + steps[1] + 1)[train]
        cells, n = np.unique(cell, return_counts=True)
        return pa.table({"cell": cells, "n": n})
    return run


def learn_weights(cell: np.ndarray, n: np.ndarray, types: int) -> np.ndarray:
    """EM for the weights of each context bucket; a bucket without held-out
    tokens takes those of all buckets together."""
    where = cell // (1 << 20)
    p = []
    for shift in (1024, 1):
        step = cell // shift % 1024 - 1
        p.append(np.where(step >= 0, 2.0 ** (-step / STEP), 0))
    p = np.stack([*p, np.full(len(cell), 1 / (types + 1))], 1)

    def run(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = np.full(3, 1 / 3)
        for _ in range(EM_ROUNDS if len(n) else 0):
            share = w * p
            share /= share.sum(1, keepdims=True)
            w = (share * n[:, None]).sum(0) / n.sum()
            w = np.maximum(w, 1e-6)
            w /= w.sum()
        return w

    pooled = run(p, n)
    out = np.tile(pooled, (BUCKETS, 1))
    for b in range(BUCKETS):
        if n[where == b].sum() >= 100:
            out[b] = run(p[where == b], n[where == b])
    out[0, 1:] /= out[0, 1:].sum()  # an unseen context has no bigram estimate
    out[0, 0] = 0
    return out


def score_chunk(model: Model):
    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        t, unigram, bigram, _ = looked_up(docs, answers)
        context = _previous(t, unigram, model.documents)
        w = model.weights[bucket(context)]
        p = (w[:, 0] * bigram / np.maximum(context, 1) + w[:, 1] * unigram / max(model.tokens, 1)
             + w[:, 2] / (model.types + 1))
        if not model.tokens:
            p = np.ones(len(unigram))
        base = np.log10((unigram + 1) / (model.tokens + model.types + 1))
        at = t.first
        return pa.table({"id": docs.column("id").combine_chunks(), "n_tokens": t.counts.astype(np.int64),
                         "n_known": np.add.reduceat((unigram > 0).astype(np.int64), at),
                         "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(np.log10(p), at)})
    return run


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every
    document, from a model of those where ``train`` holds."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chars = docs.agg(F.coalesce(F.sum(F.char_length(text)), F.lit(0))).first()[0]
    chunks, parts = 1 + chars // CHUNK_CHARS, 1 + chars // PART_CHARS
    kind = docs.schema[id_col].dataType.simpleString()
    dealt = docs.select(F.pmod(F.xxhash64(id_col, text), F.lit(chunks)).cast("int").alias("chunk"),
                        F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), text.alias("text"))
    answers = staged(dealt.groupBy("chunk").applyInArrow(ask(parts), REQUEST)
                     .groupBy("part").applyInArrow(answer, ANSWER), "lm-answers")
    tokens, types, documents = (answers.filter("chunk = -1").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "documents")]).first())
    answers = answers.filter("chunk >= 0").select("chunk", "kind", "part", "n", "totals")

    held = (dealt.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(held_out_counts(tokens, documents), "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())  # a bounded number of cells
    model = Model(tokens, types, documents, learn_weights(
        held.column("cell").to_numpy(), held.column("n").to_numpy().astype(float), types))
    return (dealt.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(score_chunk(model), f"id {kind}, n_tokens long, n_known long, base_score double, score double")
            .select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                    "base_score", "score"))
