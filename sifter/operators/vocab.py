"""Word table: counts per label, stem merge, wide view, vocabulary cut.

``word_counts`` is two hash aggregates: first per (type, id, word) inside
each article (that is what the long bag already is), then per
(type, word) with a map-side partial step -- so a very frequent word
reaches the final aggregate as one partial row per map task.

``cut`` works on the frequency histogram (total -> number of words), not
on the sorted word list: the histogram has at most about sqrt(2T) rows
for T word occurrences, so its running sum is a small single-partition
window at any scale; the bounds come back as a one-row table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.session import checkpoint

LABEL_VALUES = ("fake", "reliable")


def word_counts(long_typed: DataFrame) -> DataFrame:
    """(type, word, n_docs, n_total) from a long bag with a ``type``."""
    return (long_typed.groupBy("type", "word")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_total")))


def to_wide(counts: DataFrame, labels=LABEL_VALUES) -> DataFrame:
    """One row per word: ``<label>_docs``, ``<label>_total`` per label
    (missing -> 0) and ``freq_*`` = their sum.  Pivot over fixed values:
    one aggregate, no extra pass to find the labels."""
    piv = (counts.groupBy("word").pivot("type", list(labels))
           .agg(F.first("n_docs").alias("docs"), F.first("n_total").alias("total")))
    cols = [F.col("word")]
    for lab in labels:
        for part in ("docs", "total"):
            cols.append(F.coalesce(F.col(f"{lab}_{part}"), F.lit(0)).cast("long")
                        .alias(f"{lab}_{part}"))
    wide = piv.select(*cols)
    return (wide.withColumn("freq_docs", sum((F.col(f"{lab}_docs") for lab in labels), F.lit(0)))
            .withColumn("freq_total", sum((F.col(f"{lab}_total") for lab in labels), F.lit(0))))


def merge_stems(form_counts: DataFrame, stems: DataFrame, merge: str = "sum",
                first_seen: DataFrame | None = None) -> DataFrame:
    """Fold counts of word forms into their stems.

    ``form_counts``: (type, word, n_docs, n_total) of unstemmed forms;
    ``stems``: (word, stem).
    * ``sum``: add the counts of all forms of a stem (the intent).
    * ``first_form``: per stem, the counts of the form seen first win;
      labels seen only in later forms get (0, 0).  Needs ``first_seen``:
      (word, first_pos) -- the order in which forms were first seen.
    (Stemming before counting, ``merge='exact'``, is ``terms(stem=True)``
    followed by ``word_counts``; an article with two forms counts once.)
    """
    joined = form_counts.join(stems.select("word", "stem"), "word")
    if merge == "sum":
        return (joined.groupBy("type", F.col("stem").alias("word"))
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_total").alias("n_total")))
    if merge != "first_form":
        raise ValueError(f"unknown merge mode {merge!r}")
    if first_seen is None:
        raise ValueError("first_form needs first_seen")
    # the first form of each stem (ties broken by the form itself)
    first = (stems.join(first_seen, "word")
             .groupBy("stem").agg(F.min_by("word", F.struct("first_pos", "word")).alias("_first")))
    j = joined.join(first, "stem")
    own = F.col("word") == F.col("_first")
    return (j.groupBy("type", F.col("stem").alias("word"))
            .agg(F.coalesce(F.max(F.when(own, F.col("n_docs"))), F.lit(0)).alias("n_docs"),
                 F.coalesce(F.max(F.when(own, F.col("n_total"))), F.lit(0)).alias("n_total")))


def cut_bounds(wide: DataFrame, head_mass: float, tail_mass: float,
               total_col: str = "freq_total") -> DataFrame:
    """One row (upper, lower, n_words, total): keep ``lower <= t < upper``.

    With C_f the occurrences of all words of total >= f and T all
    occurrences: upper = largest f with C_f - f >= head_mass * T;
    lower = largest f < upper with C_f - f >= (1 - tail_mass) * T, or the
    least total if none.  No upper: nothing is kept.
    """
    hist = wide.groupBy(F.col(total_col).alias("f")).agg(F.count(F.lit(1)).alias("nw"))
    run = Window.orderBy(F.desc("f")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    h = (hist.withColumn("c", F.sum(F.col("f") * F.col("nw")).over(run))
         .withColumn("T", F.sum(F.col("f") * F.col("nw")).over(whole)))
    head_ok = (F.col("c") - F.col("f")) >= F.lit(float(head_mass)) * F.col("T")
    tail_ok = (F.col("c") - F.col("f")) >= F.lit(float(1 - tail_mass)) * F.col("T")
    # one pass over the histogram: upper as a window value, then one aggregate
    h = h.withColumn("upper", F.max(F.when(head_ok, F.col("f"))).over(whole))
    return (h.agg(F.first("upper").alias("upper"),
                  F.max(F.when(tail_ok & (F.col("f") < F.col("upper")), F.col("f"))).alias("_lo"),
                  F.min("f").alias("_least"), F.sum("nw").alias("n_words"),
                  F.first("T").alias("total_words"))
            .select("upper", F.when(F.col("upper").isNotNull(),
                                    F.coalesce("_lo", "_least")).alias("lower"),
                    "n_words", "total_words"))


def cut(wide: DataFrame, head_mass: float = 0.5, tail_mass: float = 0.05,
        total_col: str = "freq_total") -> DataFrame:
    """Words kept after cutting the head and the tail by mass.  The
    bounds are a one-row table, broadcast by construction.  ``wide`` is
    read twice (histogram and filter): pass a materialised word table
    (``materialize``) when it is expensive to derive."""
    b = cut_bounds(wide, head_mass, tail_mass, total_col)
    t = F.col(total_col)
    return (wide.crossJoin(F.broadcast(b.select("upper", "lower")))
            .filter((t >= F.col("lower")) & (t < F.col("upper")))
            .drop("upper", "lower"))


def cut_stats(wide: DataFrame, head_mass: float = 0.5, tail_mass: float = 0.05,
              total_col: str = "freq_total") -> DataFrame:
    """Unique words before and after, removed from head and tail, and the
    least total kept (one row)."""
    b = cut_bounds(wide, head_mass, tail_mass, total_col)
    t = F.col(total_col)
    j = wide.crossJoin(F.broadcast(b.select("upper", "lower")))
    kept = (t >= F.col("lower")) & (t < F.col("upper"))
    return j.agg(F.count(F.lit(1)).alias("words_before"),
                 F.count_if(kept).alias("words_after"),
                 F.count_if(~kept | kept.isNull()).alias("words_removed"),
                 F.count_if(F.col("upper").isNull() | (t >= F.col("upper"))).alias("removed_head"),
                 F.count_if(t < F.col("lower")).alias("removed_tail"),
                 F.first("lower").alias("min_level"))


def materialize(wide: DataFrame) -> DataFrame:
    """Write the word table once (reliable checkpoint): it is as large
    as the vocabulary, and the cut, its statistics and the lexicon all
    read it more than once."""
    return checkpoint(wide)


def top_words(long: DataFrame, n: int = 30) -> DataFrame:
    """Most frequent words over all bags (total count, word as tie-break)."""
    return (long.groupBy("word").agg(F.sum("n").alias("total"))
            .orderBy(F.desc("total"), "word").limit(n))


def word_slice(wide: DataFrame, offset: int, length: int,
               total_col: str = "freq_total") -> DataFrame:
    """Rows ``offset`` .. ``offset+length`` of the table sorted by total."""
    return (wide.orderBy(F.desc(total_col), "word").offset(offset).limit(length))


def fr_ratio(wide: DataFrame) -> DataFrame:
    """fake/reliable article ratio per word; infinite when no reliable
    article has the word."""
    r = F.col("reliable_docs")
    return wide.select("word", F.when(r == 0, F.lit(float("inf")))
                       .otherwise(F.col("fake_docs") / r).alias("fr_ratio"))
