"""Training rows packed as blocks of compressed sparse rows.

A trainer that passes over its rows many times reads them as blocks: one
table row holds the labels, the row pointers, the feature indices and the
values of up to about ``BLOCK_ROWS`` articles as binary columns, which a
task turns into numpy arrays without a copy per value.  Which block a row
is in, and where, are hashes of its id, and the number of blocks follows
from the number of rows, so neither depends on the cluster: not on the
partitions, not on the size of Arrow batches.

The blocks are written once below ``spark.checkpoint.dir`` and read by
every pass.  A block is bounded by its rows' own words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.operators import splits
from sifter.session import ensure_checkpoint_dir, stage

#: Rows of a block, on average.
BLOCK_ROWS = 2048
#: Numbers that the tasks of a pass may send to the driver to be added there (64 MB).
DIRECT = 8_000_000

_FIELDS = (("key", "<i8"), ("y", "<f8"), ("ptr", "<i8"), ("idx", "<i4"), ("val", "<f8"))
SCHEMA = "block int, " + ", ".join(f"{name} binary" for name, _ in _FIELDS)


@dataclass
class Block:
    """``key``: a hash of each row's id; ``y``: its label; entries of row i
    stand at ptr[i]:ptr[i + 1] of ``idx`` (ascending) and ``val``."""
    key: np.ndarray
    y: np.ndarray
    ptr: np.ndarray
    idx: np.ndarray
    val: np.ndarray

    def __len__(self) -> int:
        return len(self.y)

    def row(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self)), np.diff(self.ptr))

    def dot(self, w: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.bincount(row, self.val * w[self.idx], len(self))


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of a task, one at a time."""
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(name)) for name, _ in _FIELDS]
        for i in range(batch.num_rows):
            yield Block(*[np.frombuffer(c[i].as_py(), kind) for c, (_, kind) in zip(cols, _FIELDS)])


def load(blocks: DataFrame, ready=None) -> RDD:
    """The blocks as numpy arrays (or what ``ready`` makes of each), kept by the executors (memory, then disk;
    read again from their table if an executor is lost), for trainers that
    add up a vector over all rows in every pass: such a pass is a
    ``treeAggregate``, as in Spark's own linear models, and costs a fifth of a
    DataFrame job's fixed time.  Unpersist it after the fit."""
    names = [name for name, _ in _FIELDS]
    kinds = [kind for _, kind in _FIELDS]
    loaded = blocks.select(*names).rdd.map(lambda r: Block(*[np.frombuffer(x, k) for x, k in zip(r, kinds)]))
    return (loaded if ready is None else loaded.map(ready)).persist(StorageLevel.MEMORY_AND_DISK)


def levels(rows: RDD, width: int) -> int:
    """Levels in which the tasks' vectors of ``width`` numbers are added: few of
    them straight on the driver, which saves a stage in every pass."""
    return 1 if rows.getNumPartitions() * width <= DIRECT else 2


def word_index(bags: DataFrame, words_col: str = "words") -> DataFrame:
    """(word, idx): every word of the bags, numbered."""
    return splits.dense_index(bags.select(F.explode(F.map_keys(words_col)).alias("word")), "word")


def sparse_rows(bags: DataFrame, index: DataFrame, y: Column, id_col: str = "id",
                words_col: str = "words") -> DataFrame:
    """(id, y, idx, val) of every bag; words outside the index drop out."""
    long = bags.select(F.col(id_col).alias("id"), F.explode(words_col).alias("word", "n")).join(index, "word")
    rows = long.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("idx", F.col("n").cast("double").alias("v")))).alias("e"))
    none = F.array().cast("array<struct<idx:int,v:double>>")
    return (bags.select(F.col(id_col).alias("id"), y.cast("double").alias("y")).join(rows, "id", "left")
            .withColumn("e", F.coalesce("e", none))
            .select("id", "y", F.col("e.idx").alias("idx"), F.col("e.v").alias("val")))


def n_rows(blocks: DataFrame) -> int:
    return blocks.agg(F.sum(F.length("y") / 8)).first()[0] or 0


def pack(rows: DataFrame, n_blocks: int | None = None, seed: int = 42) -> DataFrame:
    """Blocks of rows (id, y, idx, val): ``n_blocks``, or by default as many as
    ``BLOCK_ROWS`` asks for.  No rows: no blocks."""
    n_blocks = n_blocks or max(1, -(-rows.count() // BLOCK_ROWS))
    one = F.struct(F.xxhash64(F.lit(seed), "id").alias("place"), F.col("id").cast("string").alias("id"),
                   F.xxhash64("id").alias("key"), "y", "idx", "val")
    gathered = (rows.select(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n_blocks)).cast("int").alias("block"), one.alias("r"))
                .groupBy("block").agg(F.sort_array(F.collect_list("r")).alias("rows")))

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.column(1).slice(i, 1).flatten()
                key, y, idx, val = (r.field(c) for c in ("key", "y", "idx", "val"))
                ptr = np.concatenate([[0], np.cumsum(idx.value_lengths().to_numpy())])
                parts = (key.to_numpy(), y.to_numpy(), ptr, idx.flatten().to_numpy(), val.flatten().to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1)] + [pa.array([np.ascontiguousarray(p, kind).tobytes()], pa.binary())
                                                     for p, (_, kind) in zip(parts, _FIELDS)],
                    ["block", *[name for name, _ in _FIELDS]])

    ensure_checkpoint_dir(rows.sparkSession)
    spread = min(n_blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return stage(gathered.repartition(spread, "block").mapInArrow(flatten, SCHEMA), "csr-blocks")
