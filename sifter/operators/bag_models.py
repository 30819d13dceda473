"""Text classifiers as Spark ML estimators on bags of words.

An estimator is fitted on articles (id, type, words); its model adds a
``score`` in [-1, 1], P(reliable) - P(fake), to any table with id and words.
Models are written and read like Spark's own, alone or as a stage of a
``PipelineModel``: what a model knows lies in Parquet tables beside its
metadata, so a later run scores without training.

* ``LinearBag``: logistic regression or squared-hinge SVM (``newton``),
  passive-aggressive, multinomial or complement naive Bayes.  All five are
  a weight per word and an intercept, and score tanh(margin / 2).
* ``Lexicon``: idf weight and fakeness score per word.
* ``ForestBag``, ``ForestTable``: random forests (``forest``) on bags, or on
  columns of scores as the meta model does.

Scoring joins the long bag with the word table (no hint: a table below
Spark's byte threshold is broadcast, a larger one is shuffled) and adds
per article; words that the model doesn't know drop out, and an article
without known words gets the intercept's score.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.operators import csr, forest, lexicon, newton, splits
from sifter.operators import passive_aggressive as PA
from sifter.operators import vocab as V
from sifter.session import stage


class BagColumns(Params):
    idCol = Param(Params._dummy(), "idCol", "article id, unique", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "fake or reliable", TypeConverters.toString)
    wordsCol = Param(Params._dummy(), "wordsCol", "bag of words, map of counts", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "score in [-1, 1]", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(idCol="id", labelCol="type", wordsCol="words", scoreCol="score")

    def _long(self, df: DataFrame) -> DataFrame:
        return df.select(F.col(self.getOrDefault("idCol")).alias("id"), F.explode(self.getOrDefault("wordsCol")).alias("word", "n"))

    def _articles(self, df: DataFrame) -> DataFrame:
        """(id, type, words); rows with another label are left out."""
        o = self.getOrDefault
        return df.select(F.col(o("idCol")).alias("id"), F.col(o("labelCol")).alias("type"), F.col(o("wordsCol")).alias("words")) \
                 .filter(F.col("type").isin("fake", "reliable"))


# ---------------------------------------------------------------- persistence


class _TableWriter(MLWriter):
    def __init__(self, instance: "TableModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"facts": json.dumps(self.instance.facts)})
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path.rstrip('/')}/{name}")


class _TableReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> "TableModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {name: self.sparkSession.read.parquet(f"{path.rstrip('/')}/{name}") for name in self.cls.TABLES}
        model = self.cls(tables, json.loads(metadata["facts"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TableModel(Model, MLWritable, MLReadable):
    """A model that is some tables and a few numbers."""
    TABLES: tuple[str, ...] = ()

    def __init__(self, tables: dict[str, DataFrame], facts: dict):
        super().__init__()
        self.tables, self.facts = tables, facts

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


# --------------------------------------------------------------- linear models


class LinearBagModel(BagColumns, TableModel):
    """``tables['weights']``: (word, w); ``facts['bias']``."""
    TABLES = ("weights",)

    def margins(self, df: DataFrame) -> DataFrame:
        """``df`` with the margin w.x + b."""
        sums = self._long(df).join(self.tables["weights"], "word").groupBy("id").agg(F.sum(F.col("n") * F.col("w")).alias("margin"))
        id_col = self.getOrDefault("idCol")
        return (df.join(sums.withColumnRenamed("id", id_col), id_col, "left")
                .withColumn("margin", F.coalesce("margin", F.lit(0.0)) + F.lit(float(self.facts["bias"]))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.margins(dataset).withColumn(self.getOrDefault("scoreCol"), F.tanh(F.col("margin") / 2.0)).drop("margin")


def _sign() -> Column:
    return F.when(F.col("type") == "reliable", 1.0).otherwise(-1.0)


class LinearBag(BagColumns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """``kind``: logistic, svm, pa, multinomial or complement.  ``options``
    (JSON) are the solver's: C and tol (logistic, svm), C, epochs, tol, seed
    and partitions (pa), alpha (naive Bayes)."""
    kind = Param(Params._dummy(), "kind", "the model", TypeConverters.toString)
    options = Param(Params._dummy(), "options", "the solver's parameters as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, kind: str = "logistic", options: str = "{}"):
        super().__init__()
        self._setDefault(kind="logistic", options="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearBagModel:
        kind, options = self.getOrDefault("kind"), json.loads(self.getOrDefault("options"))
        train = self._articles(dataset)
        weights, bias = (self._naive_bayes(train, kind, **options) if kind in ("multinomial", "complement")
                         else self._iterative(train, kind, options))
        return self._copyValues(LinearBagModel({"weights": weights}, {"bias": bias, "kind": kind, **options}))

    def _iterative(self, train: DataFrame, kind: str, options: dict):
        index = stage(csr.word_index(train), "word-index")
        dim = index.count()
        rows = csr.sparse_rows(train, index, _sign())
        if kind == "pa":
            w, bias = PA.PassiveAggressive(**options).weights(rows, dim)
        else:
            problem = {"logistic": newton.Problem("logistic", options.get("C", 1.0)),
                       "svm": newton.Problem("squared_hinge", options.get("C", 1.0), penalised_bias=True)}[kind]
            solver = {k: v for k, v in options.items() if k in ("tol", "max_iter")}
            theta = newton.minimise(csr.pack(rows), dim, problem, **solver)
            w, bias = theta[:dim], float(theta[dim])
        nz = np.nonzero(w)[0]
        table = train.sparkSession.createDataFrame(pd.DataFrame({"idx": nz.astype(np.int32), "w": w[nz]}), "idx int, w double")
        return stage(index.join(table, "idx").select("word", "w"), "word-weights"), float(bias)

    @staticmethod
    def _naive_bayes(train: DataFrame, kind: str, alpha: float = 1.0):
        """Log-probability ratios of the words from one aggregate by word; the
        prior is smoothed like the counts and doesn't count in the complement
        form."""
        by_word = train.select("type", F.explode("words").alias("word", "n")).groupBy("word").agg(
            *[F.coalesce(F.sum(F.when(F.col("type") == c, F.col("n"))), F.lit(0)).cast("double").alias(c)
              for c in ("fake", "reliable")])
        by_word = stage(by_word, "word-totals")
        total = by_word.agg(F.count("*").alias("v"), F.sum("fake").alias("fake"), F.sum("reliable").alias("reliable")).first()
        n = {r["type"]: r["count"] for r in train.groupBy("type").count().collect()}
        fake, reliable = total["fake"] or 0.0, total["reliable"] or 0.0
        smooth = alpha * total["v"]
        # the other class's counts stand for a class in the complement form, with the sign turned
        ratio = F.log((F.col("reliable") + alpha) / (F.col("fake") + alpha)) + float(np.log((fake + smooth) / (reliable + smooth))
                                                                                     if total["v"] else 0.0)
        prior = float(np.log((n.get("reliable", 0) + alpha) / (n.get("fake", 0) + alpha)))
        return stage(by_word.select("word", ratio.alias("w")), "word-weights"), prior if kind == "multinomial" else 0.0


# --------------------------------------------------------------------- lexicon


class LexiconModel(BagColumns, TableModel):
    """``tables['lexicon']``: (word, idf_weight, fakeness_score)."""
    TABLES = ("lexicon",)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        id_col = self.getOrDefault("idCol")
        long = self._long(dataset).withColumnRenamed("id", id_col)
        return lexicon.score_lexicon(long, self.tables["lexicon"], dataset, id_col, self.getOrDefault("scoreCol"))


class Lexicon(BagColumns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    def _fit(self, dataset: DataFrame) -> LexiconModel:
        train = self._articles(dataset)
        long = train.select("type", "id", F.explode("words").alias("word", "n"))
        wide = V.to_wide(V.word_counts(long))
        table = stage(lexicon.fit_lexicon(stage(wide, "word-totals"), lexicon.n_articles(train)), "lexicon")
        return self._copyValues(LexiconModel({"lexicon": table}, {}))


# --------------------------------------------------------------------- forests


class ForestBagModel(BagColumns, TableModel):
    """``tables``: the nodes of the trees and the word index."""
    TABLES = ("nodes", "index")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        id_col = self.getOrDefault("idCol")
        bags = dataset.select(F.col(id_col).alias("id"), F.col(self.getOrDefault("wordsCol")).alias("words"))
        rows = csr.sparse_rows(bags, self.tables["index"], F.lit(0.0))
        rows = rows.withColumn("val", F.transform("val", forest.count_bin))
        p = forest.probabilities(rows, forest.from_nodes(self.tables["nodes"])).select(
            F.col("id").alias(id_col), (2.0 * F.col("p") - 1.0).alias(self.getOrDefault("scoreCol")))
        return dataset.join(p, id_col, "left")


class ForestBag(BagColumns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """``options`` (JSON): those of ``forest.Forest``."""
    options = Param(Params._dummy(), "options", "the forest's parameters as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, options: str = "{}"):
        super().__init__()
        self._setDefault(options="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestBagModel:
        train = self._articles(dataset)
        index = stage(csr.word_index(train), "word-index")
        rows = csr.sparse_rows(train, index, _sign()).withColumn("val", F.transform("val", forest.count_bin))
        options = json.loads(self.getOrDefault("options"))
        trees = forest.Forest(**options).fit(csr.pack(rows), index.count())
        nodes = stage(forest.to_nodes(dataset.sparkSession, trees), "forest-nodes")
        return self._copyValues(ForestBagModel({"nodes": nodes, "index": index}, options))


class ForestTableModel(BagColumns, TableModel):
    """A forest on columns of scores; ``facts['columns']`` names them."""
    TABLES = ("nodes",)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        id_col = self.getOrDefault("idCol")
        rows = forest.binned(dataset.withColumnRenamed(id_col, "id") if id_col != "id" else dataset,
                             self.facts["columns"], F.lit(0.0))
        p = forest.probabilities(rows, forest.from_nodes(self.tables["nodes"])).select(
            F.col("id").alias(id_col), F.when(F.col("p") > 0.5, 1.0).otherwise(-1.0).alias(self.getOrDefault("scoreCol")))
        return dataset.join(p, id_col, "left")


class ForestTable(BagColumns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts +1 (reliable) or -1 (fake) from ``columns`` (names as JSON) of
    scores in [-1, 1]."""
    columns = Param(Params._dummy(), "columns", "names of the input columns as JSON", TypeConverters.toString)
    options = Param(Params._dummy(), "options", "the forest's parameters as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: str = "[]", options: str = "{}"):
        super().__init__()
        self._setDefault(columns="[]", options="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestTableModel:
        columns, options = json.loads(self.getOrDefault("columns")), json.loads(self.getOrDefault("options"))
        o = self.getOrDefault
        train = dataset.select(F.col(o("idCol")).alias("id"), F.col(o("labelCol")).alias("type"), *columns) \
                       .filter(F.col("type").isin("fake", "reliable"))
        rows = forest.binned(train, columns, _sign())
        trees = forest.Forest(**options).fit(csr.pack(rows), len(columns))
        nodes = stage(forest.to_nodes(dataset.sparkSession, trees), "forest-nodes")
        return self._copyValues(ForestTableModel({"nodes": nodes}, {"columns": columns, **options}))


# -------------------------------------------------------------------- registry

#: Base models by name: estimator, and the options that it takes.  The forest's
#: and the meta model's sizes are the reference's.
_REGISTRY = {
    "linear": (lambda o: LinearBag(kind="logistic", options=json.dumps(o)), ("C", "tol", "max_iter"), {}),
    "svm": (lambda o: LinearBag(kind="svm", options=json.dumps(o)), ("C", "tol", "max_iter"), {}),
    "pa": (lambda o: LinearBag(kind="pa", options=json.dumps(o)), ("C", "epochs", "tol", "seed", "partitions"), {}),
    "multi_nb": (lambda o: LinearBag(kind="multinomial", options=json.dumps(o)), ("alpha",), {}),
    "compl_nb": (lambda o: LinearBag(kind="complement", options=json.dumps(o)), ("alpha",), {}),
    "random_forest": (lambda o: ForestBag(options=json.dumps(o)), ("n_trees", "max_depth", "min_samples_split", "seed"),
                      {"n_trees": 100, "max_depth": 20, "min_samples_split": 3, "seed": 42}),
}


def estimator(name: str, params: dict | None = None) -> Estimator:
    """The estimator of base model ``name``; parameters that it doesn't know are
    those of other models and are left out."""
    make, known, defaults = _REGISTRY[name]
    return make(defaults | {k: v for k, v in (params or {}).items() if k in known})


def meta_estimator(columns: list[str], n_trees: int = 100, max_depth: int | None = None, seed: int = 0) -> ForestTable:
    """The meta model: a forest without a limit on its depth."""
    options = {"n_trees": n_trees, "max_depth": max_depth, "min_samples_split": 2, "seed": seed}
    return ForestTable(columns=json.dumps(columns), options=json.dumps(options))
