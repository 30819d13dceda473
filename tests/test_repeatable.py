"""Results don't depend on the cluster's settings or on how a table is stored."""

import random
import shutil
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.functions import clean
from sifter.operators import profile, splits, stacking
from sifter.plans import catalog, modeling
from sifter.session import ensure_checkpoint_dir
from sifter.sources import files
from sifter.streaming import scoring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bags(spark):
    rnd = random.Random(0)
    rows = []
    for i in range(60):
        words = {f"w{rnd.randrange(30) + 12 * (i % 2)}": rnd.randrange(1, 4) for _ in range(12)}
        rows.append((i, "reliable" if i % 2 else "fake", "x", 1 + (i >= 40), words))
    return spark.createDataFrame(rows, "id long, type string, orig_type string, trn_split int, words map<string,int>")


@pytest.mark.parametrize("name", stacking.BASE_MODELS)
def test_models_repeat(spark, bags, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for partitions in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            mi = modeling.ModelInputs(bags.repartition(int(partitions)), None, None, False)
            scores = modeling.base_scores(mi, name, mi.bags.filter("trn_split = 2"),
                                          {"max_iter": 20, "epochs": 4, "n_trees": 8, "shards": 3})
            seen.append({r.id: round(r.score, 6) for r in scores.collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and len(seen[0]) == 20


def test_meta_repeats_and_needs_all_scores(spark):
    rnd = random.Random(1)
    rows = [(i, "reliable" if i % 2 else "fake", rnd.random() + i % 2, rnd.random()) for i in range(50)]
    wide = spark.createDataFrame(rows, "id long, type string, preds_linear double, preds_pa double")
    seen = []
    for n in (2, 9):
        asm, meta = stacking.fit_meta(wide.repartition(n), ("linear", "pa"), n_trees=8, shards=3)
        seen.append({r.id: r.preds_meta for r in stacking.score_meta(asm, meta, wide, ("linear", "pa")).collect()})
    assert seen[0] == seen[1]
    holes = wide.withColumn("preds_pa", F.when(F.col("id") > 3, F.col("preds_pa")))
    with pytest.raises(ValueError, match="'pa': 4"):
        stacking.fit_meta(holes, ("linear", "pa"))


def test_fold_agrees_with_strip_accents():
    con = duckdb.connect()
    decomposed = clean._decomposed()
    for letter, base in decomposed.items():
        assert con.execute("SELECT strip_accents(?)", [letter]).fetchone()[0] == base
    assert len(clean.FOLD_FROM) == len(clean.FOLD_TO)


def test_fold_keeps_words_whole(spark):
    text = "Đorđe Ňemec Țara Việt Nam ﬁne Łódź straße"
    got = spark.range(1).select(clean.clean_text(F.lit(text)).alias("c")).first().c
    assert got == "dorde nemec tara viet nam fine lodz strasse"


@pytest.mark.parametrize("name", ["stream_clean_labels", "stream_lexicon_scores"])
def test_streams_read_tables_of_several_files(spark, tmp_path, name):
    spark.read.parquet(f"{SF}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    shutil.copy(f"{SF}/labels.parquet", f"{tmp_path}/labels.parquet")
    columns = ("id",) if name == "stream_clean_labels" else ("id", "score")
    whole, parts = (sorted(map(tuple, catalog.REGISTRY[name].fn(spark, d).select(*columns).collect()))
                    for d in (SF, str(tmp_path)))
    assert whole == parts and whole


def test_a_retried_batch_adds_no_row(spark, tmp_path):
    for batch, rows in ((0, 5), (1, 3), (1, 3)):
        scoring.write_batch(spark.range(rows), batch, f"{tmp_path}/sink")
    assert spark.read.parquet(f"{tmp_path}/sink").count() == 8


def test_no_local_scratch_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_quartiles_are_exact_beyond_few_rows(spark, monkeypatch):
    monkeypatch.setattr(profile, "FEW", 100)
    monkeypatch.setattr(profile, "MARGIN", 0.02)
    rnd = np.random.RandomState(0)
    values = {"a": rnd.randn(3000), "b": rnd.randint(0, 5, 999).astype(float), "c": np.array([2.0, 9.0, 4.0]),
              "d": np.array([1.0])}
    rows = [(k, float(x)) for k, v in values.items() for x in v] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for r in profile.box_stats(df, "v", "g").collect():
        assert np.allclose([r.q1, r.median, r.q3], np.quantile(values[r.g], [0.25, 0.5, 0.75]))
        assert r.n == len(values[r.g])


def test_repeated_ids_get_one_split(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "y")], "id long, content string")
    got = splits.assign_splits(df).collect()
    assert len(got) == 4 and len({r.split for r in got if r.id == 1}) == 1


def test_dict_text_in_either_quotes(spark):
    texts = ["{\"don't\": 1, 'a': 2}", "{}", "{'b': 3,}", "no dict", None, "{'it\\'s': 4}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.m for r in df.select(files.parse_literal_map("t").alias("m")).collect()]
    assert got == [{"don't": 1, "a": 2}, {}, {"b": 3}, None, None, {"it's": 4}]
    assert files.literal_map_failures(df, "t") == 1
    again = df.select(files.parse_literal_map(files.format_literal_map(files.parse_literal_map("t"))).alias("m"))
    assert [r.m for r in again.collect()] == got


def test_share_removed_without_a_label(spark):
    from sifter.operators import dedup
    df = spark.createDataFrame([("hate", True), ("hate", False), ("reliable", True)], "orig_type string, duplicate boolean")
    assert tuple(dedup.share_removed_without(df).first()) == (2, 1, 0.5)
