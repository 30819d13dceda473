"""Readers for the parquet tables and the corpus view over them.

``corpus`` maps the driver's ``documents``/``labels`` tables onto the
article schema the operators expect (id, domain, orig_type, content,
scraped_at).  It only renames and labels rows; it does none of the work
of any operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Stored bytes of texts that one task is given, about.
TEXT_BYTES = 8 * 1024 * 1024


def text_partitions(df: DataFrame) -> int:
    """Partitions for texts that a scan reads: one for each ``TEXT_BYTES`` of its
    files, two for each of its tasks and the session's shuffle partitions at least.
    A given number isn't merged by adaptive execution, which goes by the bytes of
    packed texts; their words, counted in a task's memory, are many times as large."""
    stored = 0
    if df.inputFiles():
        files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
        stored = files.agg(F.sum("file_size")).first()[0] or 0
    return max(-(-stored // TEXT_BYTES), 2 * df.rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_documents(spark: SparkSession, sf_dir: str, *cols: str,
                   distribute: bool = True) -> DataFrame:
    """The documents table, hash-distributed by ``doc_id``.

    Text work is per article, so the corpus is distributed by its key
    once, right after the scan (column-pruned first).  Every later
    per-article aggregate and every join on the id (labels, split ids,
    duplicate lists) finds its required distribution already in place and
    adds no exchange; a scan of few large row groups no longer pins the
    text work to few tasks.  Storage bucketed by id makes this shuffle
    free as well.  The texts are dealt to ``text_partitions`` tasks.
    """
    df = read_table(spark, sf_dir, "documents")
    if cols:
        df = df.select(*cols)
    return df.repartition(text_partitions(df), "doc_id") if distribute else df


def orig_type_from_labels(has_label: Column, quality: Column, toxic: Column) -> Column:
    """Source label of an article from the driver's label flags.

    No label row gives ``''`` (an excluded value), toxic articles are
    ``hate``, low quality ``junksci``, the rest ``reliable``.
    """
    return (F.when(has_label.isNull(), F.lit(""))
            .when(toxic == 1, F.lit("hate"))
            .when(quality == 0, F.lit("junksci"))
            .otherwise(F.lit("reliable")))


def corpus(spark: SparkSession, sf_dir: str, distribute: bool = True,
           text_key=None) -> DataFrame:
    """Articles as (id, domain, orig_type, content, scraped_at).

    A left join on the unique key ``doc_id``; Spark plans it as a
    sort-merge or (runtime-sized, via AQE) broadcast join.
    ``distribute=False`` gives the undistributed scan, for side tables
    (duplicate digests, split ids) that never move the text;
    ``text_key``: a function of the text column computed at the scan,
    before any join, returned as ``_digest`` in place of ``content`` --
    so only that key, never the text, crosses a shuffle.
    """
    docs = read_documents(spark, sf_dir, "doc_id", "source", "text", distribute=distribute)
    if text_key is not None:
        docs = docs.select("doc_id", "source", text_key(F.col("text")).alias("_digest"))
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", "quality", "toxic", F.lit(True).alias("_has_label"))
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("doc_id").alias("id"),
                    F.col("source").alias("domain"),
                    orig_type_from_labels(F.col("_has_label"), F.col("quality"), F.col("toxic")).alias("orig_type"),
                    F.col("_digest") if text_key is not None else F.col("text").alias("content"),
                    F.lit(None).cast("string").alias("scraped_at")))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the second corpus (short labelled statements): rows
    of ``documents`` with a six-valued truth label derived from the label
    flags.  Unlabelled rows get ``half-true``, which the statement label
    map drops."""
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", "quality", "toxic", F.lit(True).alias("_has_label"))
    label = (F.when(F.col("_has_label").isNull(), F.lit("half-true"))
             .when(F.col("toxic") == 1, F.lit("pants-fire"))
             .when(F.col("quality") == 0, F.lit("false"))
             .otherwise(F.lit("true")))
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("doc_id").alias("id"), label.alias("orig_type"),
                    F.col("text").alias("content")))
