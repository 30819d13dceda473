"""Near-duplicate removal by text prefix (keep the first article).

Design for scale: "first" of a group is ``min(id)``.  Groups are keyed by
a SHA-256 digest of the key columns, so only ``(digest, id)`` is
shuffled, never the text.  The per-group minimum is a hash aggregate with
a map-side partial step, so a hot group (say the empty prefix holding a
third of all rows) collapses to one row per map task before the
shuffle.  The firsts are then matched back by ``id`` -- a unique,
evenly spread key -- so no join or window ever sees the hot group as one
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_CHARS = 500  # the reference's shortening length
DIGEST = "_digest"


def prefix(col: Column | str, n: int | None = PREFIX_CHARS) -> Column:
    """First ``n`` characters (None: all); null text counts as empty text."""
    c = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    return c if n is None else F.substring(c, 1, n)


def prefix_digest(text: Column, n: int | None = PREFIX_CHARS) -> Column:
    """SHA-256 of the first ``n`` characters (null text as '')."""
    return F.sha2(prefix(text, n), 256)


def group_digest(df: DataFrame, keys: Sequence[str] | None = None,
                 text_col: str = "content", n: int | None = PREFIX_CHARS) -> Column:
    """Digest of the grouping key: the text prefix (or a ``_digest``
    column computed at the scan), or a list of columns."""
    if not keys:
        if DIGEST in df.columns and text_col not in df.columns:
            return F.col(DIGEST)
        return prefix_digest(F.col(text_col), n)
    return F.sha2(F.to_json(F.struct(*[F.col(k) for k in keys])), 256)


def first_ids(df: DataFrame, keys: Sequence[str] | None = None, id_col: str = "id",
              text_col: str = "content", n: int | None = PREFIX_CHARS) -> DataFrame:
    """One id per group: the lowest."""
    return (df.select(F.col(id_col), group_digest(df, keys, text_col, n).alias("_key"))
            .groupBy("_key").agg(F.min(id_col).alias(id_col))
            .select(id_col))


def duplicate_ids(df: DataFrame, keys: Sequence[str] | None = None, id_col: str = "id",
                  text_col: str = "content", n: int = PREFIX_CHARS) -> DataFrame:
    """Ids of every article but the first of its group."""
    return (df.select(id_col)
            .join(first_ids(df, keys, id_col, text_col, n), id_col, "left_anti"))


def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None, id_col: str = "id",
                    text_col: str = "content", n: int = PREFIX_CHARS,
                    source: DataFrame | None = None) -> DataFrame:
    """Keep the first article of each group (semi join on id).

    ``source``: the same rows read narrowly (not redistributed); the
    digests are computed there, so only ids travel to the semi join and
    ``df`` keeps its distribution by id.
    """
    firsts = first_ids(df if source is None else source, keys, id_col, text_col, n)
    return df.join(firsts, id_col, "left_semi")


def remove_ids(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Drop every row whose id is in ``ids`` (a given duplicates list)."""
    return df.join(ids.select(id_col), id_col, "left_anti")


def flag_duplicates(df: DataFrame, keys: Sequence[str] | None = None, id_col: str = "id",
                    text_col: str = "content", n: int = PREFIX_CHARS) -> DataFrame:
    """All rows with a boolean ``duplicate`` column (left join on id)."""
    firsts = first_ids(df, keys, id_col, text_col, n).withColumn("_first", F.lit(True))
    return (df.join(firsts, id_col, "left")
            .withColumn("duplicate", F.col("_first").isNull())
            .drop("_first"))


def share_removed_without(flagged: DataFrame, label: str = "reliable", by: str = "orig_type") -> DataFrame:
    """One row: articles, duplicates and share removed of all labels but one."""
    return (flagged.filter(F.col(by).isNull() | (F.col(by) != label))
            .agg(F.count(F.lit(1)).alias("source_articles"), F.count_if(F.col("duplicate")).alias("duplicates"))
            .withColumn("percentage_removed", F.round(
                F.when(F.col("source_articles") > 0, F.col("duplicates") / F.col("source_articles")), 6)))


def duplicate_distribution(flagged: DataFrame, by: str = "orig_type") -> DataFrame:
    """Per source label: articles, duplicates, remaining, share removed.

    ``rollup`` adds the overall row (label null).
    """
    return (flagged.rollup(by)
            .agg(F.count(F.lit(1)).alias("source_articles"),
                 F.count_if(F.col("duplicate")).alias("duplicates"))
            .withColumn("included_articles", F.col("source_articles") - F.col("duplicates"))
            .withColumn("percentage_removed",
                        F.round(F.col("duplicates") / F.col("source_articles"), 6)))
