"""Ranked lexical search by pipelined term partitioning.

The inverted index is partitioned by term: every term has one owner, and
the owners are stages that follow one another.  An item bundle (up to
``BUNDLE`` items with their weighted terms) carries a sparse accumulator of
document scores through the stages.  At each stage it meets its owner's
postings in a ``cogroup``, adds their integer contributions, and moves on.
After the last stage each bundle hands in its best documents, and one
selection over all bundles ranks them.

*Owners* are bands of document frequency, rarest first (each band four
times as frequent as the one before): a bundle gathers its accumulators
from short lists.  *Pruning* is exact: what a term can add is at most its
weight times 1,000,000 (the impact of endless occurrences), so an
accumulator that can't reach the tenth best one of its item any more is
dropped, and an item's later, longer lists fill few new ones.  A dropped
document that a later owner meets again starts below its true score, which
was too low already, so it can't return.

Scale.  Accumulators are held by document block: up to ``BLOCK_DOCS``
documents and ``BLOCK_BYTES`` of text (a longer document is a block of its
own), made by the scan and written once.  The cogroup's key is (block,
bundle), so a task holds one block's lists of one owner and one bundle, and
a term that stands in every document is spread over all blocks.  Each
stage shuffles the owner's lists once and the pruned accumulators; text is
never shuffled.  Terms that no item asks for are dropped by a bitmap of
fixed size while the text is read; the owner of a term comes from bitmaps
of the same size, so what is broadcast is 1 MB a stage, whatever the data.
(Terms that share a bit with one of another band go to the more frequent
band together; a term always has one owner, so results don't change.)
Every bundle meets every block: work grows with items times blocks.

Results defined for odd input: a null or empty text has no terms; a
document without terms counts in nothing and is never returned; rows of
documents or items that repeat an id are documents or items of their own
(an item's repeated row gives its list twice); a null doc_id ranks after
others of the same score; an item without a scoring document, an empty
table of items or of documents give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.llm.stage import staged
from sifter.llm.textkit import flat_bytes, runs, slices, span_hashes

#: Documents and bytes of text of a block.
BLOCK_DOCS = 4096
BLOCK_BYTES = 4 << 20
#: Items that travel together, on average.
BUNDLE = 256
#: Stages, and how much more frequent a band's terms are than the one before.
OWNERS = 4
BAND = 4
#: Bits of the bitmap of terms.
SLOTS = 1 << 23
#: What one occurrence of a term of weight 1 adds at most.
MOST_IMPACT = 1_000_000
#: Blocks that share one copy of a bundle when the bundles set out.
BLOCKS_A_COPY = 64

# fixed values: the bytes that a term is made of (ASCII letters and digits, and
# every byte of a character beyond ASCII), and lower case for A-Z
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes % np.uint64(slots)).astype(np.int64)


def _in_bitmap(bitmap: bytes, slots: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(bitmap, np.uint8)
    return bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 == 1


def term_counts(col: pa.Array, slots: int = SLOTS, asked: bytes | None = None):
    """Terms per row, and for the distinct (row, term) pairs, by row and then
    in text order: row, term, occurrences, bitmap slot.

    ``asked``: only terms whose bit is set are returned.
    """
    data, offsets = flat_bytes(col)
    starts, ends = runs(_IN_TERM[data], offsets)
    n_terms = np.diff(np.searchsorted(starts, offsets))
    row = np.repeat(np.arange(len(col)), n_terms)
    hashes = span_hashes(data, starts, ends, lower=True)
    if asked is not None:
        keep = _in_bitmap(asked, _slot(hashes, slots))
        row, hashes, starts, ends = row[keep], hashes[keep], starts[keep], ends[keep]
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat = _LOWER[data[np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])]] if len(starts) else np.zeros(0, np.uint8)
    terms = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(flat.tobytes())])
    pairs = pa.table({"row": row, "term": terms.cast(pa.string()), "slot": _slot(hashes, slots)}).group_by(
        ["row", "term", "slot"], use_threads=False).aggregate([([], "count_all")])
    order = np.argsort(pairs["row"].to_numpy(), kind="stable")
    pairs = pairs.take(pa.array(order))
    return n_terms, pairs["row"].to_numpy(), pairs["term"].combine_chunks(), pairs["count_all"].to_numpy(), pairs["slot"].to_numpy()


# ------------------------------------------------------------------ bundles


def item_terms(items: DataFrame, id_col: str, text_col: str, slots: int) -> DataFrame:
    """(item, item_id, term, slot, times): the terms of every item row."""
    kind = items.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, row, term, times, slot = term_counts(part.column(2), slots)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), term, pa.array(slot, pa.int64()),
                     pa.array(times, pa.int64())], ["item", "item_id", "term", "slot", "times"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
                        F.col(text_col).cast("string").alias("text"))
    return staged(rows.mapInArrow(count, f"item long, item_id {kind}, term string, slot long, times long"), "search-items")


def bitmaps(of: DataFrame, slots: int, *by: str) -> dict[tuple, bytes]:
    """The slots of each group as a bitmap of slots / 8 bytes."""
    number = F.col("slot") + 1  # Spark's buckets are numbered from 1
    parts = (of.select(*by, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
             .groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    found: dict[tuple, bytearray] = {}
    for p in parts:
        bits = found.setdefault(tuple(p[b] for b in by), bytearray(slots // 8))
        at = (p["bucket"] - 1) * 4096
        bits[at:at + 4096] = p["bits"][:len(bits) - at]
    return {k: bytes(v) for k, v in found.items()}


# -------------------------------------------------------------------- index


def blocks(docs: DataFrame, asked: bytes, id_col: str, text_col: str, slots: int = SLOTS,
           block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Document blocks with the postings of the asked terms.

    (block, docs, n, terms, slots, dfs, postings): the documents' ids and
    terms with repeats, the block's distinct terms with their bitmap slots
    and documents, and the postings as packed triples (term, place of the
    document, occurrences), by term.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(asked)
    kind = docs.schema[id_col].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sized in slices(batch, "text", block_bytes):
                for lo in range(0, sized.num_rows, block_docs):
                    part = sized.slice(lo, block_docs)
                    n, row, term, times, slot = term_counts(part.column(1), slots, shared.value)
                    coded = term.dictionary_encode()
                    number = coded.indices.to_numpy()
                    order = np.argsort(number, kind="stable")
                    triples = np.stack([number[order], row[order], times[order]]).astype("<i4")
                    _, first = np.unique(number, return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)),
                         pa.array([n.tolist()], pa.list_(pa.int64())),
                         pa.array([coded.dictionary.to_pylist()], pa.list_(pa.string())),
                         pa.array([slot[first].tolist()], pa.list_(pa.int64())),
                         pa.array([np.bincount(number).tolist()], pa.list_(pa.int64())),
                         pa.array([triples.tobytes()], pa.binary())],
                        ["docs", "n", "terms", "slots", "dfs", "postings"])

    made = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(index, f"docs array<{kind}>, n array<long>, terms array<string>, slots array<long>, "
                               "dfs array<long>, postings binary"))
    return staged(made.select(F.monotonically_increasing_id().alias("block"), "*"), "search-blocks")


def routed(index: DataFrame, owners: list[bytes | None], bundles: int) -> DataFrame:
    """(owner, block, bundle, docs, n, terms, postings): every block's lists
    dealt to the owners of their terms."""
    shared = index.sparkSession.sparkContext.broadcast(owners)
    kind = index.schema["docs"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, docs, n, terms, slots, postings = (batch.column(c).slice(i, 1) for c in range(6))
                triples = np.frombuffer(postings[0].as_py(), "<i4").reshape(3, -1)
                slot = slots[0].values.to_numpy()
                owner = np.full(len(slot), -1)
                for o, bitmap in enumerate(shared.value):  # the more frequent band has the last word
                    if bitmap is not None:
                        owner[_in_bitmap(bitmap, slot)] = o
                names = terms[0].values
                for o in np.unique(owner[owner >= 0]):
                    mine = np.flatnonzero(owner == o)
                    new = np.full(len(slot), -1, np.int32)
                    new[mine] = np.arange(len(mine))
                    kept = triples[:, owner[triples[0]] == o].copy()
                    kept[0] = new[kept[0]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o], pa.int32()), block, docs, n,
                         pa.array([names.take(pa.array(mine)).to_pylist()], pa.list_(pa.string())),
                         pa.array([kept.tobytes()], pa.binary())],
                        ["owner", "block", "docs", "n", "terms", "postings"])

    dealt = index.select("block", "docs", "n", "terms", "slots", "postings").mapInArrow(
        deal, f"owner int, block long, docs {kind}, n array<long>, terms array<string>, postings binary")
    return dealt.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))))


# ----------------------------------------------------------------- pipeline


def add_contributions(scores: np.ndarray, query: list[tuple[int, int, int]], triples: np.ndarray, impact: np.ndarray) -> None:
    """Adds, for each (row of scores, term, weight), the weighted impacts of
    the term's postings."""
    start = np.searchsorted(triples[0], np.arange(triples[0].max(initial=-1) + 2))
    for item, term, weight in query:
        a, b = start[term], start[term + 1]
        scores[item, triples[1, a:b]] += weight * impact[a:b]


def still_open(scores: np.ndarray, left: np.ndarray, top: int) -> np.ndarray:
    """Which accumulators may still be among the ``top`` of their row, ``left``
    being what later stages can add to a row at most."""
    held = scores > 0
    if scores.shape[1] > top:
        least = np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]
        held &= scores + left[:, None] >= least[:, None]
    return held


def _stage_fn(owner: int, owners: int, n_docs: int, n_terms: int, top: int):
    """The cogrouped function of one owner: the bundle's accumulators in this
    block after its contributions."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left
        bundle = left.to_pylist()[0]
        owned = np.frombuffer(bundle["owners"], "<i4")
        items = np.frombuffer(bundle["items"], "<i4")
        weights = np.frombuffer(bundle["weights"], "<i8")
        n_items, size = len(bundle["ids"]), bundle["size"]
        scores = np.zeros((n_items, size), np.int64)
        held = np.frombuffer(bundle["places"], "<i4").reshape(2, -1)
        scores[held[0], held[1]] = np.frombuffer(bundle["scores"], "<i8")
        mine = np.flatnonzero(owned == owner)
        if right.num_rows and len(mine):
            lists = right.column("terms").combine_chunks()[0].values
            number = pc.index_in(pa.array([bundle["terms"][i] for i in mine], pa.string()), lists).to_numpy(zero_copy_only=False)
            triples = np.frombuffer(right.column("postings")[0].as_py(), "<i4").reshape(3, -1).astype(np.int64)
            n = right.column("n").combine_chunks()[0].values.to_numpy()
            m = 25 + 75 * n * n_docs // n_terms
            impact = 1_000_000_000 * triples[2] // (1000 * triples[2] + 8 * m[triples[1]])
            query = [(items[i], int(t), weights[i]) for i, t in zip(mine, number) if t == t]
            add_contributions(scores, query, triples, impact)
        later = owned > owner
        rest = np.bincount(items[later], weights[later].astype(float), n_items).astype(np.int64) * MOST_IMPACT
        places = np.nonzero(still_open(scores, rest, top))
        bundle["places"] = np.stack(places).astype("<i4").tobytes()
        bundle["scores"] = scores[places].astype("<i8").tobytes()
        return pa.Table.from_pylist([bundle], left.schema)
    return run


_BUNDLE_SCHEMA = ("block long, bundle int, size int, ids array<long>, terms array<string>, owners binary, items binary, "
                  "weights binary, places binary, scores binary")


def travelling(query: DataFrame, index: DataFrame, bundles: int) -> DataFrame:
    """Every bundle's own copy for every block, without accumulators.

    ``query``: (item, bundle, term, owner, weight).
    """
    packed = query.groupBy("bundle").agg(F.collect_list(F.struct("item", "term", "owner", "weight")).alias("q"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, items = np.unique([q["item"] for q in row["q"]], return_inverse=True)
                yield pa.RecordBatch.from_pylist([{
                    "bundle": row["bundle"], "ids": ids.tolist(), "terms": [q["term"] for q in row["q"]],
                    "owners": np.array([q["owner"] for q in row["q"]], "<i4").tobytes(),
                    "items": items.astype("<i4").tobytes(),
                    "weights": np.array([q["weight"] for q in row["q"]], "<i8").tobytes()}],
                    pa.schema([("bundle", pa.int32()), ("ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())),
                               ("owners", pa.binary()), ("items", pa.binary()), ("weights", pa.binary())]))

    packed = packed.mapInArrow(pack, "bundle int, ids array<long>, terms array<string>, owners binary, items binary, weights binary")
    copies = max(1, -(-index.count() // BLOCKS_A_COPY))
    salted = packed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    places = (index.select("block", F.size("docs").alias("size"),
                           F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int").alias("copy"))
              .withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)))))
    none = F.lit(b"").cast("binary")
    return places.join(salted, ["bundle", "copy"]).select(
        "block", "bundle", "size", "ids", "terms", "owners", "items", "weights", none.alias("places"), none.alias("scores"))


def handed_in(bundles: DataFrame, index: DataFrame, top: int) -> DataFrame:
    """(item, doc_id, score): the best of every bundle in every block."""
    kind = index.schema["docs"].dataType.elementType.simpleString()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                item, place = np.frombuffer(row["places"], "<i4").reshape(2, -1)
                score = np.frombuffer(row["scores"], "<i8")
                by_id = np.argsort(np.array([(d is None, d if d is not None else 0) for d in row["docs"]],
                                            [("none", bool), ("id", object)]), order=("none", "id"), kind="stable")
                rank_of = np.empty(len(by_id), np.int64)
                rank_of[by_id] = np.arange(len(by_id))
                order = np.lexsort((rank_of[place], -score, item))
                item, place, score = item[order], place[order], score[order]
                nth = np.arange(len(item)) - np.searchsorted(item, item)
                keep = nth < top
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["ids"][i] for i in item[keep]], pa.int64()),
                     pa.array([row["docs"][p] for p in place[keep]], batch.schema.field("docs").type.value_type),
                     pa.array(score[keep], pa.int64())], ["item", "doc_id", "score"])

    rows = bundles.select("block", "ids", "places", "scores").join(index.select("block", "docs"), "block")
    return rows.select("ids", "places", "scores", "docs").mapInArrow(best, f"item long, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 10, owners: int = OWNERS, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text", bundle: int = BUNDLE,
           slots: int = SLOTS, block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item.
    ``owners``, ``bundle``, ``slots`` (a multiple of 64) and the block's sizes
    change the work's shape, not the result."""
    spark: SparkSession = docs.sparkSession
    asked = item_terms(items, item_col, item_text, slots)
    bitmap = bitmaps(asked.select("slot").distinct(), slots).get((), bytes(slots // 8))
    index = blocks(docs, bitmap, id_col, text_col, slots, block_docs, block_bytes)
    counted = index.select(F.explode(F.filter("n", lambda x: x > 0)).alias("n")).agg(F.count("n"), F.sum("n")).first()
    n_docs, n_terms = counted[0], counted[1] or 0
    kind = dict(asked.dtypes)["item_id"]
    if not n_docs:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {docs.schema[id_col].dataType.simpleString()}, score long")
    frequency = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy(
        F.col("t.terms").alias("term")).agg(F.sum("t.dfs").alias("df"))
    # the last owner has the terms in over 1 / BAND of the documents, and so on down
    band = F.floor(F.log(float(BAND), F.lit(n_docs) / F.col("df"))).cast("int")
    query = asked.join(frequency, "term").select(
        "item", "item_id", "term", "slot", F.greatest(F.lit(0), F.lit(owners - 1) - band).alias("owner"),
        (F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))) * F.col("times")).cast("long").alias("weight"))
    # one owner a slot, so that a bitmap finds it
    shared = query.groupBy("slot").agg(F.max("owner").alias("owner"))
    query = staged(query.drop("owner").join(shared, "slot"), "search-query")
    n_items = query.select("item").distinct().count()
    n_bundles = max(1, -(-n_items // bundle))
    routes = bitmaps(query.select("owner", "slot").distinct(), slots, "owner")
    postings = routed(index, [routes.get((o,)) for o in range(owners)], n_bundles)
    bundled = query.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(n_bundles)).cast("int"))
    bundles = travelling(bundled, index, n_bundles)
    for owner in range(owners):
        mine = postings.filter(F.col("owner") == owner)
        bundles = bundles.groupBy("block", "bundle").cogroup(mine.groupBy("block", "bundle")).applyInArrow(
            _stage_fn(owner, owners, n_docs, n_terms, top), _BUNDLE_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = handed_in(bundles, index, top).withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(query.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term
), lens AS (
  SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lens
), dfs AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) x GROUP BY item_id, term
), weighted AS (
  SELECT item_id, q.term, times * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM q JOIN dfs ON q.term = dfs.term, totals
), impacts AS (
  SELECT tf.doc_id, tf.term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)) AS impact
  FROM tf JOIN lens ON tf.doc_id = lens.doc_id, totals
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM weighted JOIN impacts ON weighted.term = impacts.term GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
