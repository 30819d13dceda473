import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sifter.operators import profile, splits


@settings(max_examples=5, deadline=None)
@given(st.sets(st.integers(min_value=0, max_value=10**12), min_size=1, max_size=300))
def test_balanced_split_covers_each_id_once(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    out = splits.assign_splits(df, bucket_digits=2).collect()
    assert sorted(r.id for r in out) == sorted(ids)
    sizes = {}
    for r in out:
        sizes[r.split] = sizes.get(r.split, 0) + 1
    assert all(1 <= k <= 10 for k in sizes)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_bucket_width_does_not_change_result(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "id long")
    a = {r.id: r.split for r in splits.assign_splits(df, bucket_digits=1).collect()}
    b = {r.id: r.split for r in splits.assign_splits(df, bucket_digits=4).collect()}
    assert a == b


def test_split_plan_checks():
    splits.SplitPlan()
    with pytest.raises(ValueError):
        splits.SplitPlan(t1=(3, 4), t2=(5,), val=2)
    with pytest.raises(ValueError):
        splits.SplitPlan(val=1)
    with pytest.raises(ValueError):
        splits.SplitPlan(t1=(2, 3, 4, 5, 6, 7), t2=(8, 9, 10), val=2)


def test_global_position(spark):
    ids = [5, 1, 99, 42, 7, 1000, 3]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r.pos for r in profile.global_position(df, "id", n_buckets=4).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(ids))}


def test_dense_index(spark):
    df = spark.createDataFrame([(w,) for w in ["b", "a", "c", "a", "d"]], "word string")
    got = {r.word: r.idx for r in splits.dense_index(df, "word", bucket_digits=1).collect()}
    assert sorted(got) == ["a", "b", "c", "d"] and sorted(got.values()) == [0, 1, 2, 3]
