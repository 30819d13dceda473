from sifter.plans import jobs
from sifter.sources import tables
from sifter.streaming import scoring

SF = "/root/testdata/sf0.001"


def test_run_pipeline(spark, tmp_path):
    cfg = jobs.PipelineConfig(
        out=str(tmp_path / "run"), stem=False,
        params={"random_forest": {"n_trees": 5, "max_depth": 4}, "linear": {"max_iter": 20},
                "svm": {"max_iter": 20}, "pa": {"epochs": 2}},
        meta_trees=5, meta_depth=4)
    metrics = jobs.run_pipeline(spark, tables.corpus(spark, SF), cfg,
                                narrow=tables.corpus(spark, SF, distribute=False),
                                statements=tables.statements(spark, SF))
    got = {(r.dataset, r.model) for r in metrics.collect()}
    for ds in ("validation", "test", "statements"):
        for m in (*cfg.models, "simple", "meta"):
            assert (ds, m) in got
    assert spark.read.parquet(f"{cfg.out}/duplicates").count() >= 0
    # a later session scores from what was saved: the run's own metrics, its training set, and a new table
    key = lambda r: (r.dataset, r.model)
    ran = sorted(metrics.collect(), key=key)
    for ds in ("validation", "statements"):
        again = sorted(jobs.score_saved(spark, cfg, ds).collect(), key=key)
        assert again == [r for r in ran if r.dataset == ds]
    fitted_on = jobs.score_saved(spark, cfg, "train1").collect()
    n = spark.read.parquet(f"{cfg.out}/training").filter("trn_split = 1").count()
    assert {r.model for r in fitted_on} == {*cfg.models, "simple", "meta"} and {r.n for r in fitted_on} == {n}
    assert max(r.accuracy for r in fitted_on) > 0.9
    rows = jobs.dataset_bags(spark, cfg, "test").limit(3)
    assert {r.n for r in jobs.score_saved(spark, cfg, "some", rows).collect()} == {rows.count()}
    assert sorted(spark.read.json(f"{cfg.out}/metrics/test").select("dataset").distinct().collect()) == [("test",)]
    meta = jobs.PS.load_metadata(spark, f"{cfg.out}/models/pa")
    assert meta["valset_used"] == cfg.plan.val and meta["params"] == {"epochs": 2}


def test_label_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, "bias", "Hello, World!"), (2, "satire", "x")],
                          "id long, orig_type string, content string").write.parquet(str(src))
    stream = spark.readStream.schema("id long, orig_type string, content string").parquet(str(src))
    q = (scoring.label_stream(stream).writeStream.format("memory").queryName("lab")
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {r.id: (r.status, r.clean) for r in spark.sql("SELECT * FROM lab").collect()}
    assert got == {1: ("included", "hello world"), 2: ("excluded", "x")}


def test_scoring_stream(spark, tmp_path):
    lex = spark.createDataFrame([("good", 1.0, 1.0), ("bad", 1.0, -1.0)],
                                "word string, idf_weight double, fakeness_score double")
    src = tmp_path / "in"
    spark.createDataFrame([(1, "fake", "bad bad"), (2, "reliable", "good"), (3, "fake", "zzz")],
                          "id long, type string, content string").write.parquet(str(src))
    stream = spark.readStream.schema("id long, type string, content string").parquet(str(src))
    q = scoring.start_scoring(stream, lex, str(tmp_path / "sink"), str(tmp_path / "ck"), once=True)
    q.awaitTermination()
    got = {r.id: round(r.score, 6) for r in spark.read.parquet(str(tmp_path / "sink")).collect()}
    assert got == {1: round(-2 / 2.1, 6), 2: round(1 / 1.1, 6), 3: 0.0}
