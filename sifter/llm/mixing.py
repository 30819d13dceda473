"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded shuffled order,
offered ``MAX_REPEATS`` times.  An entry's virtual finish time is the
source's cumulative words up to it, divided by the source's target; the
mix is the prefix of all entries in order of finish time that fits the
total budget.

Scale: the text is read once for the sizes, which go to a narrow stage
table.  Cumulative sums run inside (source, hash bucket) groups on top of
the bucket totals, so a source that holds a third of all rows is spread
over ``BUCKETS`` groups.  The global order is a range partition of finish
times; only the range in which the budget ends is sorted row by row.

Results defined for odd input: a null or empty text has size 0 and is
never taken; a null source is a source of its own, last in order; rows
that repeat an id are queued each on its own; entries equal in every
sorting column are taken together or not at all; empty input gives no
rows.  Other columns than id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.stage import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Source weights by rank, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words; passes over a source at most.
SHARE, MAX_REPEATS = 1.5, 2
SEED = "mix-"
#: Hash buckets of a source's queue, of md5's first three digits.
BUCKETS = 4096
#: Ranges of finish time: so many to one, up to RANGE_END.
RANGES, RANGE_END = 4096, 4


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, src rank, source_size, target): the share of all words dealt
    by weight; a target stops at ``repeats`` times its source, and what
    is over goes to the others by weight (one row per source)."""
    order = Window.orderBy(F.asc_nulls_last("source"))
    by_weight = Window.orderBy("full_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    wide = "decimal(38,6)"
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("src", F.row_number().over(order) - 1)
           .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("src") % len(weights) + 1).cast("long"))
           # the level of words per weight at which a source is full
           .withColumn("full_at", (F.col("source_size") * repeats).cast("double") / F.col("w"))
           .withColumn("total", F.sum("source_size").over(everything))
           .withColumn("w_all", F.sum("w").over(everything))
           .withColumn("size_upto", F.sum("source_size").over(by_weight))
           .withColumn("w_upto", F.sum("w").over(by_weight)))
    # full if the level that fills it costs no more than the budget
    cost = (F.col("size_upto").cast(wide) * repeats * F.col("w")
            + F.col("source_size").cast(wide) * repeats * (F.col("w_all") - F.col("w_upto")))
    per = per.withColumn("full", cost <= F.lit(share).cast("decimal(10,4)") * F.col("total").cast("decimal(28,0)") * F.col("w"))
    per = (per.withColumn("full_size", F.sum(F.when(F.col("full"), F.col("source_size")).otherwise(0)).over(everything))
           .withColumn("w_open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(everything)))
    level = (F.lit(share) * F.col("total") - F.col("full_size") * repeats) / F.nullif(F.col("w_open"), F.lit(0))
    return per.select("source", "src", "source_size",
                      F.when(F.col("full"), (F.col("source_size") * repeats).cast("double"))
                      .otherwise(F.col("w") * level).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """(id, size, source_size, target, taken) of every document."""
    sizes = staged(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("key")), "mix-sizes")
    targets = staged(source_targets(sizes, weights, share, repeats), "mix-targets")
    bucket = F.conv(F.substring("key", 1, 3), 16, 10).cast("int")
    queue = (sizes.join(targets.withColumnRenamed("source", "t_source"),
                        F.col("source").eqNullSafe(F.col("t_source")))
             .select("id", "src", "size", "key", "source_size", "target", bucket.alias("bucket")))
    before = (queue.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
              .withColumn("before", F.coalesce(F.sum("words").over(
                  Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("words"))
    inside = Window.partitionBy("src", "bucket").orderBy("key", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    queue = (queue.withColumn("upto", F.sum("size").over(inside))
             .join(before, ["src", "bucket"])
             .withColumn("upto", F.col("upto") + F.col("before")).drop("bucket", "before"))
    queue = staged(queue, "mix-queue")

    entries = (queue.filter("size > 0")
               .select("src", "size", "key", "target",
                       "upto", "source_size", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("again"))
               .withColumn("finish", (F.col("upto") + F.col("again") * F.col("source_size")) / F.col("target"))
               .withColumn("range", F.least(F.floor(F.col("finish") * RANGES), F.lit(RANGES * RANGE_END)).cast("int")))
    budget = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)) * share).first()[0]
    # the first range whose words no longer fit, and the words before it
    ranges = (entries.groupBy("range").agg(F.sum("size").alias("words"))
              .withColumn("upto", F.sum("words").over(Window.orderBy("range"))))
    cut = ranges.filter(F.col("upto") > budget).orderBy("range").select("range", F.col("upto") - F.col("words")).first()
    place = ("finish", "src", "key", "size")
    last = None
    if cut:
        last = (entries.filter(F.col("range") == cut[0])
                .withColumn("upto", F.sum("size").over(Window.orderBy(*place).rangeBetween(
                    Window.unboundedPreceding, Window.currentRow)))
                .filter(F.col("upto") + cut[1] <= budget)
                .orderBy(*[F.desc(c) for c in place]).select(*place).first())

    def is_in(again: int):
        finish = (F.col("upto") + again * F.col("source_size")) / F.col("target")
        if not cut:
            return F.lit(1)
        range_ = F.least(F.floor(finish * RANGES), F.lit(RANGES * RANGE_END))
        fits = range_ < cut[0]
        if last:
            here = F.struct(finish.alias("finish"), "src", "key", "size")
            end = F.struct(*[F.lit(x).cast(entries.schema[c].dataType).alias(c) for c, x in zip(place, last, strict=True)])
            fits |= (range_ == cut[0]) & (here <= end)
        return fits.cast("int")

    copies = sum((is_in(a) for a in range(repeats)), F.lit(0))
    return queue.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("size") * copies).otherwise(0).cast("long").alias("taken"))



def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: a document that is taken
    twice is there twice, one that isn't taken not at all.  Rows that differ in
    any column are documents of their own; rows equal in all columns are one
    that is taken as often as all of them."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    rows = docs.select(row.alias("row"), F.struct(F.col(id_col).alias("id"), whole.alias("key")).alias("doc"),
                       F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    taken = (mix(rows, "doc", "text", "source", **options).filter("taken > 0")
             .groupBy("doc").agg(F.sum(F.expr("taken div size")).alias("times")))
    return (rows.select("row", "doc").join(taken, "doc").dropDuplicates(["doc"])
            .withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
            .select("row.*"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE src % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM per
), level AS (
  -- a source is full if filling all others to its level costs no more than the budget
  SELECT a.source, a.src, a.source_size, a.w,
         (SELECT sum(least(2.0 * b.source_size, 2.0 * a.source_size / a.w * b.w)) FROM weighted b)
           <= 1.5 * (SELECT sum(source_size) FROM weighted) + 1e-6 AS is_full
  FROM weighted a
), targets AS (
  SELECT source, src, source_size,
         CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
              ELSE w * ((1.5 * (SELECT sum(source_size) FROM level)
                         - 2 * (SELECT coalesce(sum(source_size), 0) FROM level WHERE is_full))
                        / (SELECT sum(w) FROM level WHERE NOT is_full)) END AS target
  FROM level
), queued AS (
  SELECT s.doc_id, s.size, s.k, t.src, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY t.src ORDER BY s.k, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), entries AS (
  SELECT q.doc_id, q.size, q.k, q.src, CAST(upto + again * source_size AS DOUBLE) / target AS finish
  FROM queued q, (SELECT 0 AS again UNION ALL SELECT 1) r
  WHERE size > 0
), ranked AS (
  SELECT *, sum(size) OVER (ORDER BY finish, src, k, size) AS total FROM entries
), won AS (
  SELECT doc_id, k, src, size, sum(size) AS taken FROM ranked
  WHERE total <= 1.5 * (SELECT sum(size) FROM sized)
  GROUP BY doc_id, k, src, size
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(w.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN won w ON q.doc_id = w.doc_id AND q.src = w.src AND q.size = w.size
"""
