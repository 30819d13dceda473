"""Landing the corpus: narrow decisions first, then each kept text once.

Labels, duplicates and splits are decided on a read without texts (ids and
prefix digests) and written as a narrow table.  Then the texts of the kept
articles, and no others, are distributed by id: a bit set of the kept ids
(``bitset``) drops the other texts while they are read.

``land_bucketed`` writes articles as a table bucketed and sorted by id.
What later groups or joins that table by id (bags, summaries, splits) needs
no exchange of it: the buckets are the distribution, in this session and,
by the table's path, in the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.operators import bitset, dedup, splits
from sifter.session import stage
from sifter.sources import tables

#: Buckets of a landed table: a parameter of the table, to raise with its size.
BUCKETS = 64


def article_ids(narrow: DataFrame, seed: int = 42) -> DataFrame:
    """The kept articles without their texts, with their split: of label-filtered
    rows (id, ..., _digest), the first of each digest.  Written once."""
    firsts = dedup.first_ids(narrow)
    kept = narrow.drop("_digest").join(firsts, "id", "left_semi")
    return stage(kept.join(splits.split_ids(firsts.distinct(), seed=seed), "id"), "article-ids")


def kept_texts(docs: DataFrame, ids: DataFrame, partitions: int | None = None) -> DataFrame:
    """``docs`` (id, content, not distributed) joined with ``ids``; only texts
    whose id may be kept are distributed, by id."""
    maybe = bitset.prefilter(docs, "id", ids)
    return maybe.repartition(partitions or tables.text_partitions(docs), "id").join(ids, "id")


def land_bucketed(df: DataFrame, path: str, buckets: int = BUCKETS, by: str = "id") -> DataFrame:
    """``df`` written below ``path`` as Parquet in buckets of ``by``, one file
    each, and read as a bucketed table."""
    name = f"landed_{uuid.uuid4().hex}"
    (df.repartition(buckets, by).sortWithinPartitions(by).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, by).sortBy(by).saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, buckets: int = BUCKETS, by: str = "id") -> DataFrame:
    """A table that another session landed below ``path``."""
    name = f"landed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
