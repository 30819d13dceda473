import math
import time

from pyspark.sql import functions as F

from sifter.operators import features as FE
from sifter.operators import summary as SU


def test_bags_and_empty_article(spark):
    df = spark.createDataFrame([(1, "the cat the hat"), (2, ""), (3, "!!!")], "id long, content string")
    bags = {r.id: r.words for r in FE.with_bags(df, stem=False).collect()}
    assert bags[1] == {"the": 2, "cat": 1, "hat": 1}
    assert bags[2] == {} and bags[3] == {}


def test_bag_vocab_filter(spark):
    df = spark.createDataFrame([(1, "a b b c")], "id long, content string")
    vocab = spark.createDataFrame([("b",), ("c",)], "word string")
    assert FE.with_bags(df, stem=False, vocab=vocab).first().words == {"b": 2, "c": 1}


def test_stemmed_bag(spark):
    df = spark.createDataFrame([(1, "run runs running")], "id long, content string")
    assert FE.with_bags(df, stem=True).first().words == {"run": 3}


def test_token_lengths(spark):
    df = spark.createDataFrame([(["ab", "abcd"],), ([],), (["a", "bbb", "cc"],)], "t array<string>")
    mean, median = FE.token_lengths("t")
    got = [(r.m, r.md) for r in df.select(mean.alias("m"), median.alias("md")).collect()]
    assert got == [(3.0, 3.0), (None, None), (2.0, 2.0)]


def test_entropy_and_feature(spark):
    df = spark.createDataFrame([({"a": 2, "b": 2},), ({"x": 5},)], "words map<string,int>")
    ent = [r.e for r in df.select(FE.bow_entropy("words").alias("e")).collect()]
    assert math.isclose(ent[0], 1.0) and ent[1] == 0.0
    out = df.select(FE.add_feature("words", "a", F.lit(9)).alias("w")).collect()
    assert out[0].w == {"b": 2.0, "a": 9.0}
    assert out[1].w == {"x": 5.0, "a": 9.0}


def test_entropy_of_a_long_bag_takes_its_total_once(spark):
    # with the total taken again for each word, this bag alone needs 4e10 additions
    n = 200_000
    bag = spark.range(1).select(F.map_from_arrays(F.sequence(F.lit(1), F.lit(n)).cast("array<string>"),
                                                  F.array_repeat(F.lit(1), n)).alias("words"))
    start = time.monotonic()
    assert math.isclose(bag.select(FE.bow_entropy("words")).first()[0], math.log2(n), rel_tol=1e-9)
    assert time.monotonic() - start < 60


def test_token_arrays(spark):
    df = spark.createDataFrame([({"a": 2, "b": 1},)], "words map<string,int>")
    assert sorted(df.select(FE.token_arrays("words").alias("t")).first().t) == ["a", "a", "b"]


def test_summary_columns(spark):
    df = spark.createDataFrame(
        [(1, "d", "bias", "fake", "ab abcd", 3), (2, "d", "reliable", "reliable", "", 4),
         (3, "d", "hate", "fake", "x", 1)],
        "id long, domain string, orig_type string, type string, content string, split int")
    vocab = spark.createDataFrame([("abcd",)], "word string")
    s = {r.id: r for r in SU.summarize(df.withColumn("scraped_at", F.lit(None).cast("string")),
                                       vocab, stem=False).collect()}
    assert s[1].words == {"abcd": 1} and s[1].mean_word_len == 3.0 and s[1].median_word_len == 3.0
    assert s[2].words == {} and s[2].mean_word_len is None and s[2].content_len == 0
