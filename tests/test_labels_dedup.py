from pyspark.sql import functions as F

from sifter.operators import dedup, labels

SCHEMA = "id long, orig_type string, content string"


def test_label_status(spark):
    rows = [(1, "satire", "a"), (2, "", "b"), (3, None, "c"), (4, "opinion", "d"),
            (5, "bias", "e"), (6, "reliable", "f"), (None, "fake", "g")]
    df = labels.apply_labels(spark.createDataFrame(rows, SCHEMA))
    got = {r.id: (r.status, r.type) for r in df.collect()}
    assert got[1] == ("excluded", None)
    assert got[2] == ("excluded", None)
    assert got[3] == ("excluded", None)
    assert got[4] == ("skipped", None)
    assert got[5] == ("included", "fake")
    assert got[6] == ("included", "reliable")
    assert got[None] == ("skipped", "fake")
    acc = labels.account(df).first()
    assert acc.included + acc.excluded + acc.ignored + acc.skipped == acc.read == 7
    assert (acc.included, acc.excluded, acc.skipped) == (2, 3, 2)


def test_statement_labels(spark):
    vals = ["true", "mostly-true", "half-true", "barely-true", "false", "pants-fire"]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vals)], SCHEMA)
    got = {r.orig_type: r.type for r in labels.statement_labels(df).collect()}
    assert got == {"true": "reliable", "mostly-true": "reliable", "false": "fake",
                   "pants-fire": "fake"}


def test_prefix_duplicates(spark):
    base = "x" * 499
    rows = [(10, "fake", base + "A" + "tail1"), (11, "fake", base + "A" + "tail2"),
            (20, "fake", base + "B"), (21, "fake", base + "C"),
            (30, "reliable", ""), (31, "reliable", ""), (32, "reliable", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    dups = sorted(r.id for r in dedup.duplicate_ids(df).collect())
    assert dups == [11, 31, 32]
    kept = dedup.drop_duplicates(df)
    assert sorted(r.id for r in kept.collect()) == [10, 20, 21, 30]
    # idempotent: a second pass finds nothing
    assert dedup.duplicate_ids(kept).count() == 0


def test_dup_distribution(spark):
    rows = [(1, "hate", "same"), (2, "hate", "same"), (3, "reliable", "other")]
    df = spark.createDataFrame(rows, SCHEMA)
    d = {r.orig_type: r for r in dedup.duplicate_distribution(dedup.flag_duplicates(df)).collect()}
    assert (d["hate"].source_articles, d["hate"].duplicates, d["hate"].included_articles) == (2, 1, 1)
    assert d[None].source_articles == 3 and d[None].duplicates == 1


def test_hot_group_dedup(spark):
    """One prefix holding a third of the rows still dedups to one row."""
    n = 3000
    rows = [(i, "fake", "hot" if i % 3 == 0 else f"t{i}") for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert dedup.duplicate_ids(df).count() == n // 3 - 1
    assert dedup.drop_duplicates(df).filter(F.col("content") == "hot").first().id == 0



from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "a", "ab", "b" * 520, "b" * 500 + "x", None]),
                          st.sampled_from(["fake", "reliable"])), min_size=1, max_size=25))
def test_dedup_matches_brute_force(spark, rows):
    data = [(i, lab, txt) for i, (txt, lab) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    seen, expect = set(), []
    for i, _, txt in data:  # ids ascend, so the first seen is the lowest id
        key = (txt or "")[:500]
        if key in seen:
            expect.append(i)
        seen.add(key)
    assert sorted(r.id for r in dedup.duplicate_ids(df).collect()) == expect
    kept = dedup.drop_duplicates(df)
    assert dedup.duplicate_ids(kept).count() == 0
    assert kept.count() == len(data) - len(expect)
