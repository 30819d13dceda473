"""Label filter and grouping (reduce step).

Every row gets a ``status``: ``included`` (label maps to a group),
``excluded`` (label null or in the exclusion set), ``skipped`` (id
unreadable or label unknown).  Unknown labels go to the rejects instead
of ending the run.  All of it is one projection over the scan.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's label tables) -------------
# Source labels that are dropped.
EXCLUDED_TYPES = ("satire", "conspiracy", "clickbait", "unreliable", "political",
                  "state", "unknown", "rumor", "")
# Source label -> label group.
LABEL_GROUPS = {"fake": "fake", "bias": "fake", "junksci": "fake", "hate": "fake",
                "reliable": "reliable"}
# Labels of the second corpus (statements) -> label group; others are dropped.
STATEMENT_GROUPS = {"true": "reliable", "mostly-true": "reliable",
                    "false": "fake", "pants-fire": "fake"}
# --- end of fixed values -------------------------------------------------

INCLUDED, EXCLUDED, IGNORED, SKIPPED = "included", "excluded", "ignored", "skipped"
STATUSES = (INCLUDED, EXCLUDED, IGNORED, SKIPPED)


def map_lookup(col: Column, mapping: dict[str, str]) -> Column:
    """Literal map lookup; null when the key is absent."""
    lit_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return lit_map[col]


def apply_labels(df: DataFrame, mapping: dict[str, str] = LABEL_GROUPS,
                 excluded=EXCLUDED_TYPES, label_col: str = "orig_type",
                 id_col: str = "id") -> DataFrame:
    """Add ``type`` (label group) and ``status`` to every row."""
    group = map_lookup(F.col(label_col), mapping)
    status = (F.when(F.col(id_col).isNull(), F.lit(SKIPPED))
              .when(F.col(label_col).isNull() | F.col(label_col).isin(*excluded), F.lit(EXCLUDED))
              .when(group.isNull(), F.lit(SKIPPED))
              .otherwise(F.lit(INCLUDED)))
    return df.withColumn("type", group).withColumn("status", status)


def reduce_corpus(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """Split labelled rows into (kept, rejects)."""
    labelled = apply_labels(df, **kw)
    kept = labelled.filter(F.col("status") == INCLUDED).drop("status")
    rejects = labelled.filter(F.col("status") != INCLUDED)
    return kept, rejects


def label_filter_group(df: DataFrame, **kw) -> DataFrame:
    """Rows kept by the label filter, with their group label."""
    kept, _ = reduce_corpus(df, **kw)
    return kept


def account(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Row accounting: one row per status, zero-filled, plus ``read``.

    A single aggregate (partial + final); the status list is fixed, so the
    zero-fill is a pivot over known values and needs no join.
    """
    counts = (df.groupBy().pivot(status_col, list(STATUSES)).count()
              .na.fill(0))
    total = sum((F.col(s) for s in STATUSES), F.lit(0))
    return counts.select(*[F.col(s).cast("long").alias(s) for s in STATUSES],
                         total.cast("long").alias("read"))


def statement_labels(df: DataFrame, label_col: str = "orig_type") -> DataFrame:
    """Second-corpus labels: map the four usable labels, drop the rest."""
    return (df.withColumn("type", map_lookup(F.col(label_col), STATEMENT_GROUPS))
            .filter(F.col("type").isNotNull()))
