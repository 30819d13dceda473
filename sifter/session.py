"""Session construction and lineage cutting.

On a cluster the session is built by the launcher; ``get_spark`` is for
tests, the bench and local runs.  ``checkpoint`` always writes to the
folder the cluster names in ``spark.checkpoint.dir``; only when that is
unset and the master is local does it pick a scratch folder of its own;
elsewhere it raises.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # text columns are wide: keep scan splits moderate so a task's
    # exploded tokens fit in memory.
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "sifter",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only if unset."""
    sc = spark.sparkContext
    conf_dir = (spark.conf.get("spark.checkpoint.dir", None)
                or sc.getConf().get("spark.checkpoint.dir", None))
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="sifter-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a Parquet table below the shared checkpoint folder.
    Unlike a checkpoint, what is read back has its real size, so joins with
    it are planned by that."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
