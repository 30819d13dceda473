"""Distribution summaries: box statistics, label balance, label ratio in
the first N rows, null counts.

Box statistics take exact quartiles from the few rows between approximate
ones, then one more aggregate for whiskers and mean after joining the
quartiles back -- a join on the group key against one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.session import stage

#: Ranks (as shares) on either side of a quantile that are looked at row by
#: row, the approximate quantiles' accuracy, and rows from which on it holds.
MARGIN, ACCURACY, FEW = 0.001, 10_000, 2000


def exact_quantiles(df: DataFrame, value: str, by: str, probs: Sequence[float]) -> DataFrame:
    """(by, i, q): the interpolated quantile ``probs[i]`` of each group.

    Mergeable approximate quantiles bracket each rank; the rows below the
    bracket are counted, and only distinct values inside it (a share of
    about ``2 * MARGIN``) are ranked, so no group's values meet in a task.
    """
    v = F.col(value).cast("double")
    rows = df.select(by, v.alias("_v")).filter("_v IS NOT NULL")
    edges = rows.groupBy(by).agg(
        F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
        F.percentile_approx("_v", [max(p - MARGIN, 0.0) for p in probs], ACCURACY).alias("a"),
        F.percentile_approx("_v", [min(p + MARGIN, 1.0) for p in probs], ACCURACY).alias("b"))
    few = F.col("n") < FEW
    cases = edges.select(by, "n", F.explode(F.array(*[F.struct(
        F.lit(i).alias("i"), F.when(few, F.col("lo")).otherwise(F.col("a")[i]).alias("a"),
        F.when(few, F.col("hi")).otherwise(F.col("b")[i]).alias("b"),
        (F.lit(p) * (F.col("n") - 1)).alias("rank")) for i, p in enumerate(probs)])).alias("c")).select(by, "c.*")
    # values below the bracket count together, those inside one by one
    seen = (rows.join(cases, by).filter("_v <= b")
            .withColumn("_v", F.when(F.col("_v") >= F.col("a"), F.col("_v")))
            .groupBy(by, "i", "rank", "_v").agg(F.count(F.lit(1)).alias("k")))
    upto = F.sum("k").over(Window.partitionBy(by, "i").orderBy(F.asc_nulls_first("_v")))
    at = seen.withColumn("upto", upto).filter("_v IS NOT NULL")
    value_at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("_v")))
    low, high = value_at(F.floor("rank")), value_at(F.ceil("rank"))
    return (at.groupBy(by, "i", "rank").agg(low.alias("x"), high.alias("y"))
            .select(by, "i", (F.col("x") + (F.col("y") - F.col("x")) * (F.col("rank") - F.floor("rank"))).alias("q")))


def box_stats(df: DataFrame, value: str, by: str, whis: float = 1.0, approx: bool = False) -> DataFrame:
    """Per group: n, mean, q1, median, q3, whisker_low, whisker_high
    (most extreme values within ``whis`` * IQR of the box).  ``approx``:
    quartiles from the mergeable sketch alone.

    The values are written once, beside their group: three passes read them,
    and what they are derived from (a text's words) costs far more."""
    df = stage(df.select(by, F.col(value).cast("double").alias(value)), "box-values")
    v, probs = F.col(value), (0.25, 0.5, 0.75)
    if approx:
        q = (df.groupBy(by).agg(F.percentile_approx(v, list(probs), ACCURACY).alias("_q"))
             .select(by, F.posexplode("_q").alias("i", "q")))
    else:
        q = exact_quantiles(df, value, by, probs)
    pick = lambda i: F.max(F.when(F.col("i") == i, F.col("q")))
    quart = q.groupBy(by).agg(pick(0).alias("q1"), pick(1).alias("median"), pick(2).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo_fence, hi_fence = F.col("q1") - whis * iqr, F.col("q3") + whis * iqr
    return (df.select(by, v.alias("_v")).join(quart, by).groupBy(by, "q1", "median", "q3").agg(
        F.count("_v").alias("n"), F.avg("_v").alias("mean"),
        F.min(F.when(F.col("_v") >= lo_fence, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(F.col("_v") <= hi_fence, F.col("_v"))).alias("whisker_high"))
        .select(by, "n", "mean", "q1", "median", "q3", "whisker_low", "whisker_high"))


def label_balance(df: DataFrame, label: str = "type") -> DataFrame:
    """Count and share per label."""
    return (df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, one row."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


#: Rows that a range of ``global_position`` holds, about.
RANGE_ROWS = 1_000_000


def global_position(df: DataFrame, order_col: str, n_buckets: int | None = None,
                    out_col: str = "pos") -> DataFrame:
    """1-based position of each row in ``order_col`` order (unique values),
    without sorting everything in one task: approximate quantiles cut the
    key range into buckets of near-equal size (a bounded list of cut
    points), a per-bucket count table gives offsets, and a window inside
    each bucket gives the local rank."""
    n_buckets = n_buckets or 1 + df.count() // RANGE_ROWS
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set(df.approxQuantile(order_col, probs, 0.1 / n_buckets))) if probs else [0.0]
    splits_ = [-float("inf")] + cuts + [float("inf")]
    b = Bucketizer(splits=splits_, inputCol="_key", outputCol="_bucket")
    keyed = b.transform(df.withColumn("_key", F.col(order_col).cast("double")))
    offsets = (keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_off", F.coalesce(F.sum("_n").over(
                   Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select("_bucket", "_off"))
    w = Window.partitionBy("_bucket").orderBy(order_col)
    return (keyed.join(F.broadcast(offsets), "_bucket")
            .withColumn(out_col, F.col("_off") + F.row_number().over(w))
            .drop("_key", "_bucket", "_off"))


def label_share_ratio(df: DataFrame, shares: Sequence[float], order_col: str = "id",
                      label: str = "type") -> DataFrame:
    """``label_prefix_ratio`` up to shares of the rows, rounded down."""
    n_rows = df.count()
    return label_prefix_ratio(df, [int(s * n_rows) for s in shares], order_col, label)


def label_prefix_ratio(df: DataFrame, cutoffs: Sequence[int], order_col: str = "id",
                       label: str = "type") -> DataFrame:
    """fake/reliable ratio among the first N rows (in ``order_col``
    order) for each N in ``cutoffs``: one positional pass, counts per
    cut interval, then a running sum over the (few) intervals."""
    cuts = sorted({int(c) for c in cutoffs})
    pos = global_position(df.select(order_col, label), order_col)
    interval = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(cuts))):
        interval = F.when(F.col("pos") <= c, F.lit(i)).otherwise(interval)
    counts = (pos.withColumn("_iv", interval).filter(F.col("_iv").isNotNull())
              .groupBy("_iv").agg(F.count_if(F.col(label) == "fake").alias("_f"),
                                  F.count_if(F.col(label) == "reliable").alias("_r")))
    spark = df.sparkSession
    ivs = spark.createDataFrame([(i, c) for i, c in enumerate(cuts)], "_iv int, first_n long")
    run = Window.orderBy("_iv").rowsBetween(Window.unboundedPreceding, 0)
    return (ivs.join(counts, "_iv", "left").na.fill(0, ["_f", "_r"])
            .withColumn("fakes", F.sum("_f").over(run))
            .withColumn("reals", F.sum("_r").over(run))
            .select("first_n", "fakes", "reals",
                    F.when(F.col("reals") > 0, F.col("fakes") / F.col("reals")).alias("ratio")))
