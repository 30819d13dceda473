"""Filter interaction audit on sorted posting lists.

Every filter has, for each part, the sorted list of the ids that fail it.
A run of filters in some order removes the union of their lists; what one
filter removes there is the difference of its own list and the union of
the lists before it, which depends on the set of those filters and not on
their order.  So each of the 2^k sets has its union built once from the
lists, each (set, filter) its difference, and all k! orders are read off
the summed sizes.

Unions and differences are galloping k-way merges: the lists advance
together over one id range after another, each finding the end of its
range by doubling its step and then halving (``gallop``), so a short list
skips what a long one holds without reading it.

Scale.  Ids are row numbers of the staged verdicts, and lists are cut into
id ranges of ``RANGE`` rows: a group is one part's lists in one range, so a
part with a third of all rows has many groups and no group grows with the
table.  Only (digest, id) pairs and verdict bits are shuffled, never text.
Copies are found by the least id of each digest (a hash aggregate whose map
side collapses a hot text) and a join on (digest, id), which spreads a hot
text by id.  The sizes of all ranges are added per part: 80 numbers
for five filters.  Counts are longs; results don't depend on partitions.

Results defined for odd input: a null text is an empty one; a null part is
the empty string; every row counts, also one that repeats an id; rows of
equal text and equal id are no copies of each other; a null id neither is a
copy nor has one; labels that repeat an id count if any of them is 1; an
empty table has no parts and gives no rows; columns of other names are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.stage import staged

#: Rows of an id range: the longest posting list.
RANGE = 1 << 16
#: Ids that the longest list contributes to one step of a merge.
STEP = 4096

WORD = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------------ posting lists


def gallop(ids: np.ndarray, at: int, bound: int) -> int:
    """First place from ``at`` on whose id is over ``bound``: the step doubles
    until it is passed, then a binary search within the last step."""
    step, low = 1, at
    while low + step < len(ids) and ids[low + step] <= bound:
        low += step
        step *= 2
    return low + int(np.searchsorted(ids[low:low + step + 1], bound, "right"))


def id_ranges(lists: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The lists' slices in successive id ranges.  A range ends where the
    first list to do so has given ``STEP`` ids; the others gallop there."""
    at = [0] * len(lists)
    while True:
        ends = [ids[a + STEP - 1] for ids, a in zip(lists, at) if a + STEP <= len(ids)]
        if not ends:
            break
        bound = min(ends)
        to = [gallop(ids, a, bound) for ids, a in zip(lists, at)]
        yield [ids[a:b] for ids, a, b in zip(lists, at, to)]
        at = to
    yield [ids[a:] for ids, a in zip(lists, at)]


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted ids that stand in any list."""
    merged = [np.unique(np.concatenate(parts)) for parts in id_ranges(lists)] if lists else []
    return np.concatenate(merged) if merged else np.zeros(0, np.int64)


def _held(ids: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Which of the sorted ids stand in the sorted list ``by``."""
    if not len(by):
        return np.zeros(len(ids), bool)
    place = np.searchsorted(by, ids)
    return by[np.minimum(place, len(by) - 1)] == ids


def difference(ids: np.ndarray, without: np.ndarray) -> np.ndarray:
    """Sorted ids of the first list that the second doesn't hold."""
    left = [a[~_held(a, b)] for a, b in id_ranges([ids, without])]
    return np.concatenate(left)


def shared(ids: np.ndarray, other: np.ndarray) -> int:
    """How many ids stand in both lists."""
    return sum(int(_held(a, b).sum()) for a, b in id_ranges([ids, other]))


def removal_sizes(lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple[int, ...]]:
    """(filter, set before as bits, removed, of these good, toxic) for each
    filter and each set of others."""
    k = len(lists)
    for before in range(1 << k):
        gone = union([lists[f] for f in range(k) if before >> f & 1])
        for f in range(k):
            if not before >> f & 1:
                removed = difference(lists[f], gone)
                yield f, before, len(removed), shared(removed, good), shared(removed, toxic)


# ------------------------------------------------------------------ verdicts


@dataclass(frozen=True)
class Filter:
    """``failed``: condition on the text (not null), or None for the filter
    that fails copies of an earlier document."""
    name: str
    failed: Column | None


def contract_filters(text: Column) -> list[Filter]:
    """The five filters of the audit query."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    counts = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0]  # words are matched once
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [Filter("A", counts["n"] < 200),
            Filter("B", 100 * counts["distinct"].cast("long") < 50 * counts["n"].cast("long")),
            Filter("C", 100 * capitals.cast("long") > 3 * F.length(text).cast("long")),
            Filter("D", text.rlike(r"[#$%&*|]")),
            Filter("E", None)]


def verdicts(docs: DataFrame, filters, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(row, part, bits, good, toxic): each document's failed filters as bits,
    under a row number of its own."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tests = filters(F.col("text"))
    bits = [F.when(f.failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(tests) if f.failed is not None]
    by_copy = sum(1 << i for i, f in enumerate(tests) if f.failed is None)
    judged = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                          text.alias("text"))
              .select(F.monotonically_increasing_id().alias("row"), "id", "part",
                      sum(bits, F.lit(0)).alias("bits"), F.unhex(F.sha2("text", 256)).alias("digest")))
    judged = staged(judged, "audit-verdicts")
    marks = labels.groupBy(F.col(labels.columns[0]).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    found = judged.join(marks, "id", "left")
    if by_copy:
        firsts = judged.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
        copy = F.col("first").isNull() & F.col("id").isNotNull()
        found = found.join(firsts, ["digest", "id"], "left").withColumn(
            "bits", F.col("bits") + F.when(copy, F.lit(by_copy)).otherwise(F.lit(0)))
    return found.select("row", "part", "bits", F.coalesce("good", F.lit(False)).alias("good"),
                        F.coalesce("toxic", F.lit(False)).alias("toxic"))


def posting_lists(found: DataFrame, names: list[str]) -> DataFrame:
    """(part, range, n, fail_<name>..., good, toxic): sorted row numbers by
    part and id range."""
    # a row number is the task's number above 33 bits of place in the task
    of_range = F.expr(f"struct(shiftright(row, 33) AS task, shiftright(row & 8589934591, {RANGE.bit_length() - 1}) AS piece)")

    def listed(condition: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, F.col("row"))))

    return found.groupBy("part", of_range.alias("range")).agg(
        F.count("*").alias("n"),
        *[listed(F.col("bits").bitwiseAND(1 << i) != 0).alias(f"fail_{name}") for i, name in enumerate(names)],
        listed(F.col("good")).alias("good"), listed(F.col("toxic")).alias("toxic"))


def set_sizes(lists: DataFrame, names: list[str]) -> DataFrame:
    """(part, filter, before, removed, good, toxic, n), added over id ranges."""
    k = len(names)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cols = [batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(2, k + 4)]
                found = list(removal_sizes(cols[:k], cols[k], cols[k + 1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * len(found), pa.string()),
                     pa.array([batch.column(1)[i].as_py()] * len(found), pa.int64()),
                     *[pa.array([row[c] for row in found], pa.int64()) for c in range(5)]],
                    ["part", "n", "filter", "before", "removed", "good", "toxic"])

    counted = lists.select("part", "n", *[f"fail_{x}" for x in names], "good", "toxic").mapInArrow(
        sizes, "part string, n long, filter long, before long, removed long, good long, toxic long")
    return counted.groupBy("part", "filter", "before").agg(
        *[F.sum(c).alias(c) for c in ("n", "removed", "good", "toxic")])


def audit(docs: DataFrame, labels: DataFrame, filters=contract_filters, id_col: str = "doc_id",
          text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: documents kept after
    the step, removed by it, failing its filter but removed earlier
    (redundant), failing its filter only (unique_fails), removed ones that
    are labelled good or toxic, and the filter's removals over all orders
    (shapley).

    ``labels``: (id, quality, toxic).  ``filters``: text column -> filters;
    their k! orders are all listed, so k should be small (5 here).
    """
    spark = docs.sparkSession
    names = [f.name for f in filters(F.lit(""))]
    k = len(names)
    found = verdicts(docs, filters, labels, id_col, text_col, part_col)
    sizes = staged(set_sizes(posting_lists(found, names), names), "audit-sizes")
    steps = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(names[x] for x in order), step, f, before))
            before |= 1 << f
    plan = spark.createDataFrame(steps, "filter_order string, step int, filter long, before long")
    same_filter = Window.partitionBy("part", "filter")
    # a part has k! * k rows here, whatever its documents
    listed = plan.join(sizes, ["filter", "before"]).select(
        "*", F.sum("removed").over(same_filter).alias("shapley"),
        F.max(F.when(F.col("before") == 0, F.col("removed"))).over(same_filter).alias("fails"),
        F.max(F.when(F.col("step") == k, F.col("removed"))).over(same_filter).alias("unique_fails"),
        F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step")).alias("gone"))
    return listed.select("part", "filter_order", "step", (F.col("n") - F.col("gone")).alias("kept"), "removed",
                         (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
                         F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM t GROUP BY text
), marks AS (
  SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), v AS (
  SELECT t.part,
         [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
          100 * len(regexp_extract_all(t.text, '[A-Z]')) > 3 * length(t.text),
          regexp_matches(t.text, '[#$%&*|]'), coalesce(t.doc_id > f.first, false)] AS fails,
         coalesce(m.quality = 1, false) AS good, coalesce(m.toxic = 1, false) AS toxic
  FROM t JOIN firsts f ON f.text = t.text LEFT JOIN marks m ON m.doc_id = t.doc_id
), groups AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM v GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step, ord(filter_order[step]) - 64 AS f,
         [ord(x) - 64 FOR x IN string_split(filter_order[1:step - 1], '') IF x <> ''] AS before
  FROM orders, generate_series(1, 5) g(step)
), listed AS (
  SELECT g.part, s.filter_order, s.step, s.f,
         sum(n) FILTER (WHERE NOT fails[s.f] AND len([b FOR b IN s.before IF fails[b]]) = 0) AS kept,
         sum(n) FILTER (WHERE fails[s.f] AND len([b FOR b IN s.before IF fails[b]]) = 0) AS removed,
         sum(n) FILTER (WHERE fails[s.f] AND len([b FOR b IN s.before IF fails[b]]) > 0) AS redundant,
         sum(n) FILTER (WHERE fails[s.f] AND len([x FOR x IN fails IF x]) = 1) AS unique_fails,
         sum(good) FILTER (WHERE fails[s.f] AND len([b FOR b IN s.before IF fails[b]]) = 0) AS good_lost,
         sum(toxic) FILTER (WHERE fails[s.f] AND len([b FOR b IN s.before IF fails[b]]) = 0) AS toxic_lost
  FROM groups g, steps s GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM listed
"""
