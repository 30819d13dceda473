from pyspark.sql import functions as F

from sifter.operators import profile as PR


def test_box_stats_exact_and_approx(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 5)], "g string, v int")
    b = {r.g: r for r in PR.box_stats(df, "v", "g").collect()}
    a = b["a"]
    assert (a.q1, a.median, a.q3, a.n) == (3.0, 5.0, 7.0, 9)
    # fences at 3 - 4 and 7 + 4: 100 is outside, 8 is the highest inside
    assert (a.whisker_low, a.whisker_high) == (1.0, 8.0)
    assert b["b"].median == 5.0 and b["b"].whisker_low == 5.0
    ap = {r.g: r for r in PR.box_stats(df, "v", "g", approx=True).collect()}
    assert abs(ap["a"].median - 5.0) <= 1.0


def test_label_prefix_ratio(spark):
    rows = [(i, "fake" if i % 3 == 0 else "reliable") for i in range(1, 31)]
    df = spark.createDataFrame(rows, "id long, type string")
    got = {r.first_n: (r.fakes, r.reals) for r in PR.label_prefix_ratio(df, [10, 30]).collect()}
    assert got[10] == (3, 7) and got[30] == (10, 20)


def test_balance_and_nulls(spark):
    df = spark.createDataFrame([("fake", None), ("reliable", 1), ("reliable", 2)], "type string, x int")
    b = {r.type: (r.n, round(r.share, 4)) for r in PR.label_balance(df).collect()}
    assert b == {"fake": (1, 0.3333), "reliable": (2, 0.6667)}
    n = PR.null_counts(df).first()
    assert (n.type, n.x) == (0, 1)


def test_box_stats_derives_its_values_once(spark):
    """Three passes read the values; what they come from may be a whole text."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(n):
        seen.add(1)
        return float(n)

    df = spark.range(40).select((F.col("id") % 2).alias("g"), value("id").alias("v"))
    assert {r.g: (r.n, r.median) for r in PR.box_stats(df, "v", "g").collect()} == {0: (20, 19.0), 1: (20, 20.0)}
    assert seen.value == 40
