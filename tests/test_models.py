import random

from pyspark.sql import functions as F

from sifter.operators import classifiers as CL
from sifter.operators import passive_aggressive as PA
from sifter.operators import stacking as ST


def _data(spark, n=120, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        fake = i % 2 == 0
        words = {("lies" if fake else "facts"): rnd.randint(1, 4), "the": rnd.randint(1, 5),
                 f"noise{rnd.randint(0, 9)}": 1}
        rows.append((i, "fake" if fake else "reliable", words))
    return spark.createDataFrame(rows, "id long, type string, words map<string,int>")


def _accuracy(scored):
    ok = scored.select(((F.col("score") < 0) == (F.col("type") == "fake")).alias("ok"))
    return ok.filter("ok").count() / ok.count()


def test_vector_models_separate(spark):
    df = _data(spark)
    cv = CL.fit_vectorizer(df)
    train = CL.with_label(CL.vectorize(df, cv)).cache()
    for name, params in [("linear", {"max_iter": 50}), ("svm", {"max_iter": 50}),
                         ("multi_nb", {}), ("compl_nb", {}),
                         ("random_forest", {"n_trees": 10, "max_depth": 4})]:
        model = CL.fit_model(name, train, params)
        scored = CL.score(model, CL.vectorize(df, cv), name)
        assert _accuracy(scored) > 0.9, name
        assert scored.filter((F.col("score") < -1) | (F.col("score") > 1)).count() == 0


def test_passive_aggressive(spark):
    df = _data(spark)
    long = df.select("id", F.explode("words").alias("word", "n"))
    index = long.select("word").distinct().orderBy("word").withColumn(
        "idx", F.monotonically_increasing_id().cast("int"))
    index = spark.createDataFrame([(r.word, i) for i, r in enumerate(index.collect())],
                                  "word string, idx int")
    y = df.select("id", F.when(F.col("type") == "reliable", 1.0).otherwise(-1.0).alias("y"))
    rows = PA.sparse_rows(long, index, y)
    model = PA.PassiveAggressive(epochs=3, partitions=3).fit(rows, index.count())
    scored = model.score(long, index, df.select("id", "type"))
    assert _accuracy(scored) > 0.9


def test_stacking(spark):
    rows = [(i, "fake" if i % 2 == 0 else "reliable", m, (-0.8 if i % 2 == 0 else 0.7) + 0.01 * j)
            for i in range(40) for j, m in enumerate(ST.BASE_MODELS)]
    longp = spark.createDataFrame(rows, "id long, type string, model string, score double")
    base = longp.select("id", "type", F.lit("x").alias("orig_type")).distinct()
    wide = ST.to_wide(longp.select("id", "model", "score"), base)
    assert set(ST.pred_col(m) for m in ST.BASE_MODELS) <= set(wide.columns)
    asm, meta = ST.fit_meta(wide, n_trees=5, max_depth=3)
    out = ST.score_meta(asm, meta, wide)
    agree = out.filter(((F.col("preds_meta") < 0) == (F.col("type") == "fake"))).count()
    assert agree == 40
    # replacing one model's column by a left join keeps every row
    new = spark.createDataFrame([(0, 0.9)], "id long, score double")
    replaced = ST.add_predictions(wide, new, "svm")
    assert replaced.count() == 40 and replaced.filter("preds_svm IS NOT NULL").count() == 1
