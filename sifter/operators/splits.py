"""Reproducible ten-way splits and the split plan.

``assign_splits(balanced=True)``: rows are ranked by
``md5('<seed>-<id>')`` and split ``k`` is ``rank mod k + 1`` -- random
and exactly balanced, like a seeded shuffle of ``i mod 10``.  The rank
is computed without a global sort: the leading hex digits of the digest
form buckets (uniform by construction, so no bucket is hot), a tiny
per-bucket count table gives each bucket's offset, and a window inside
each bucket gives the position.  ``balanced=False`` is a pure
projection (``hash mod k``) with no shuffle at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TEST_SPLIT = 1


def split_key(id_col: str = "id", seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def hash_unit(id_col: str = "id", seed: int = 42) -> Column:
    """A number in [0, 1) from the first 8 hex digits of the split key."""
    return F.conv(F.substring(split_key(id_col, seed), 1, 8), 16, 10).cast("double") / float(1 << 32)


def assign_splits(df: DataFrame, k: int = 10, seed: int = 42, balanced: bool = True,
                  id_col: str = "id", bucket_digits: int = 4,
                  out_col: str = "split", ids: DataFrame | None = None) -> DataFrame:
    """Add ``out_col`` (1..k).  The balanced rank is computed on the id
    column alone (``ids``: the same rows' ids from a narrow read, if
    given) and joined back on the id, so wide rows (text) never move
    for it."""
    if not balanced:
        return df.withColumn(out_col, (F.floor(hash_unit(id_col, seed) * k) + 1).cast("int"))
    src = (df if ids is None else ids).select(id_col).distinct()  # a repeated id has one split
    return df.join(split_ids(src, k, seed, id_col, bucket_digits, out_col), id_col)


def split_ids(ids: DataFrame, k: int = 10, seed: int = 42, id_col: str = "id",
              bucket_digits: int = 4, out_col: str = "split") -> DataFrame:
    """(id, split) with split = rank of md5(seed-id) mod k + 1."""
    keyed = ids.select(id_col, split_key(id_col, seed).alias("_skey")) \
               .withColumn("_bucket", F.substring("_skey", 1, bucket_digits))
    # one row per non-empty bucket: at most 16**bucket_digits rows
    offsets = (keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset",
                           F.sum("_n").over(Window.orderBy("_bucket")
                                            .rowsBetween(Window.unboundedPreceding, -1)))
               .select("_bucket", F.coalesce("_offset", F.lit(0)).alias("_offset")))
    w = Window.partitionBy("_bucket").orderBy("_skey")
    return (keyed.join(F.broadcast(offsets), "_bucket")
            .select(id_col, (((F.col("_offset") + F.row_number().over(w) - 1) % k) + 1)
                    .cast("int").alias(out_col)))


def split_table(df: DataFrame, **kw) -> DataFrame:
    """(id, split) for every article."""
    id_col = kw.get("id_col", "id")
    return split_ids(df.select(id_col), **kw)


def dense_index(keys: DataFrame, key_col: str, out_col: str = "idx",
                bucket_digits: int = 4) -> DataFrame:
    """(key, 0-based dense index) for distinct keys, without a one-task
    sort: the same bucketed ranking as the balanced split (md5-prefix
    buckets, a bounded offset table, a window inside each bucket)."""
    keyed = (keys.select(key_col).distinct()
             .withColumn("_h", F.md5(F.col(key_col).cast("string")))
             .withColumn("_bucket", F.substring("_h", 1, bucket_digits)))
    offsets = (keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(
                   Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select("_bucket", "_offset"))
    w = Window.partitionBy("_bucket").orderBy("_h", key_col)
    return (keyed.join(F.broadcast(offsets), "_bucket")
            .select(key_col, (F.col("_offset") + F.row_number().over(w) - 1).cast("int").alias(out_col)))


@dataclass(frozen=True)
class SplitPlan:
    """Which splits train the base models (t1), the meta model (t2), and
    which one validates.  Split 1 is the test split."""
    t1: tuple[int, ...] = (3, 4, 5, 6, 7)
    t2: tuple[int, ...] = (8, 9, 10)
    val: int = 2
    test: int = TEST_SPLIT
    k: int = 10
    check: bool = True
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if not 2 <= self.val <= self.k:
            raise ValueError(f"validation split must be in 2..{self.k}")
        t1, t2 = set(self.t1), set(self.t2)
        if t1 & t2:
            raise ValueError("training sets t1 and t2 overlap")
        if self.check and (t1 | t2 | {self.val}) != set(range(2, self.k + 1)):
            raise ValueError(f"t1, t2 and val must cover exactly 2..{self.k}")
        if self.val in t1 | t2:
            raise ValueError("validation split is used for training")


def train_rows(df: DataFrame, plan: SplitPlan, split_col: str = "split") -> DataFrame:
    """Drop test and validation rows; add ``trn_split`` (1 = t1, 2 = t2)."""
    s = F.col(split_col)
    trn = (F.when(s.isin(*plan.t1), F.lit(1)).when(s.isin(*plan.t2), F.lit(2))
           if plan.t2 else F.when(s.isin(*plan.t1), F.lit(1)))
    return (df.filter(~s.isin(plan.test, plan.val))
            .withColumn("trn_split", trn.cast("int")))


def eval_rows(df: DataFrame, splits: DataFrame, split: int, id_col: str = "id",
              split_col: str = "split") -> DataFrame:
    """Rows whose id is in the given split (semi join on the id list)."""
    ids = splits.filter(F.col(split_col) == split).select(id_col)
    return df.join(ids, id_col, "left_semi")


def train_test(df: DataFrame, test_fraction: float = 0.2, seed: int = 42,
               id_col: str = "id", out_col: str = "is_test") -> DataFrame:
    """Random 80/20 style split by a hash threshold (no shuffle)."""
    return df.withColumn(out_col, hash_unit(id_col, seed) < test_fraction)


def shuffled(df: DataFrame, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Seeded random order, for file export only."""
    return df.orderBy(split_key(id_col, seed))
