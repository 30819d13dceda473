"""Statistics and links that a cut of the work would change."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sifter.llm import lm, ngram_join, url_filter
from tests.llm.conftest import sentence
from tests.llm.test_corpus_operators import brute_join


def test_suffix_statistics_count_all_labelled_urls(spark):
    rows = [(f"http://a{i % 50}.s{i % 30}.org/{'9' * (i % 2)}{i}", i % 2) for i in range(300)]
    model = url_filter.fit(spark.createDataFrame(rows, "url string, label int"), max_train=40, trees=2)
    got = model.features(spark.createDataFrame(rows, "url string, label int")).select("site", "site_log_n", "top_log_n").collect()
    assert {(r.site, round(r.site_log_n, 6), round(r.top_log_n, 6)) for r in got} == {
        (f"s{i}.org", 2.397895, 5.70711) for i in range(30)}  # log1p(10), log1p(300)
    assert model.rate == 0.5


@pytest.mark.parametrize("chars", [300, 12_000_000])
def test_weights_are_learned_from_all_training_documents(spark, monkeypatch, chars):
    monkeypatch.setattr(lm, "CHUNK_CHARS", chars)
    seen, learn = [], lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda cell, n, types: seen.append(n.sum()) or learn(cell, n, types))
    rnd = random.Random(1)
    rows = [(i, sentence(rnd, 60)) for i in range(4)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") != 3).first()
    assert seen == [3 * 61] and got.train_tokens == 3 * 61


def test_links_of_a_block_are_counted_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NGRAMS", 40)  # several blocks for two sets, most of them empty
    rnd = random.Random(5)
    rows = []
    for f in range(12):
        base = sentence(rnd, 90, 100_000)
        rows += [(2 * f, base), (2 * f + 1, base + " more")]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 80, 100, 3).collect()
    assert Counter(tuple(r) for r in got) == brute_join(rows, 80, 100, 3)
