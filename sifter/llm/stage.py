"""Stage tables below the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sifter.session import ensure_checkpoint_dir


def stage_path(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written once as Parquet in the folder that
    ``spark.checkpoint.dir`` names, and read back: cuts lineage and
    survives lost executors."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
