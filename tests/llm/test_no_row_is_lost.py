"""Rows that repeat an id or a text are neither lost nor counted beyond a bound."""

from collections import Counter

from pyspark.sql import functions as F

from sifter.llm import mixing, ngram_join, quality_model

SCHEMA = "doc_id long, text string, source string, lang string"


def test_mix_keeps_rows_that_differ_in_another_column(spark):
    rows = [(1, "one two three", "s", "en"), (1, "one two three", "s", "fr"), (1, "one two three", "s", None), (2, "four five", "s", "en"),
            (None, "six", "s", "en"), (None, "six", "s", "de"), (3, "seven", "s", "en"), (3, "seven", "s", "en")]
    got = Counter(map(tuple, mixing.apply(spark.createDataFrame(rows, SCHEMA)).collect()))
    sizes = Counter(map(tuple, rows))
    assert set(got) <= set(sizes) and all(n <= 2 * sizes[r] for r, n in got.items())
    assert len(got) >= 6  # one source: one and a half times its words, so nearly all rows at least once
    again = mixing.apply(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert Counter(map(tuple, again.collect())) == got


def test_the_same_row_represents_a_group_on_any_partitions(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, s, lang) for s in ("a", "b", None) for lang in ("en", "fr")] + [(2, text, "a", "en"), (3, "", "a", "en"), (3, "", "b", "en")]
    seen = {tuple(sorted(map(str, ngram_join.representatives(spark.createDataFrame(rows, SCHEMA).repartition(n)).collect())))
            for n in (1, 3, 7)}
    assert len(seen) == 1 and len(seen.pop()) == 2


def test_training_rows_are_bounded_by_ids(spark, monkeypatch):
    rows = [(1, f"good text number {i}") for i in range(50)] + [(2, "bad bad"), (3, None), (4, "not labelled")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    seen = []
    monkeypatch.setattr(quality_model, "train_network", lambda z, y: seen.append(len(y)) or train(z, y))
    monkeypatch.setattr(quality_model, "calibrate", lambda logits, y: seen.append(len(y)) or 1.0)
    train = _train
    model = quality_model.fit(docs, labels)
    assert sum(seen) <= 3
    scored = quality_model.score(docs, model)
    assert scored.count() == 53 and scored.filter(F.col("score").isNull()).count() == 0


_train = quality_model.train_network
