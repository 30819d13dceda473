"""Training and scoring flows shared by the queries and the jobs.

``model_inputs``: training articles (de-duplicated, label-filtered, with
their split set) as bags restricted to the cut vocabulary.  Base models
fit on set 1 and score set 2 (out-of-sample scores for the meta model)
or an evaluation split; the meta model fits on set 2's scores.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.operators import bag_models as BM
from sifter.operators import dedup, labels, splits
from sifter.operators import features as FE
from sifter.operators import stacking as ST
from sifter.operators import vocab as V
from sifter.session import stage


@dataclass
class ModelInputs:
    bags: DataFrame        # (id, type, orig_type, split, trn_split, words) training rows
    vocab: DataFrame       # cut word table
    corpus: DataFrame      # all de-duplicated articles with split (id, type, orig_type, split, content)
    stem: bool


def model_inputs(corpus: DataFrame, plan: splits.SplitPlan, stem: bool = True,
                 head: float = 0.5, tail: float = 0.05,
                 narrow: DataFrame | None = None) -> ModelInputs:
    """``corpus``: articles distributed by id; ``narrow``: the same rows
    read without redistribution (for digests and split ranks)."""
    kept = labels.label_filter_group(corpus)
    side = kept if narrow is None else labels.label_filter_group(narrow)
    firsts = dedup.first_ids(side)
    df = (splits.assign_splits(kept.join(firsts, "id", "left_semi"), ids=firsts)
          .select("id", "type", "orig_type", "split", "content")
          .persist(StorageLevel.MEMORY_AND_DISK))
    train = splits.train_rows(df, plan)
    long = FE.terms(train, ("type", "id"), stem=stem)
    vocab = V.cut(V.materialize(V.to_wide(V.word_counts(long))), head, tail)
    bags = FE.with_bags(train, "id", "content", stem=stem, vocab=vocab, long=long).drop("content")
    # the training table is read by every model fit and scorer: write it
    # once instead of re-deriving it from the text
    return ModelInputs(stage(bags, "training-bags"), vocab, df, stem)


def eval_bags(mi: ModelInputs, split: int) -> DataFrame:
    rows = mi.corpus.filter(F.col("split") == split)
    return FE.with_bags(rows, "id", "content", stem=mi.stem).drop("content")


def training_set(mi: ModelInputs, k: int) -> DataFrame:
    return mi.bags.filter(F.col("trn_split") == k)


def fit_base(mi: ModelInputs, name: str, params: dict | None = None) -> Model:
    """One base model, fitted on training set 1: adds ``score`` to any table
    with ``id`` and ``words``, and can be saved."""
    return BM.estimator(name, params).fit(training_set(mi, 1))


def fit_all(mi: ModelInputs, models=ST.BASE_MODELS, params: dict | None = None) -> dict[str, Model]:
    """Every base model, fitted once."""
    return {m: fit_base(mi, m, (params or {}).get(m)) for m in models}


def scores_of(models: dict[str, Model], target: DataFrame) -> DataFrame:
    """(id, type, model, score) of ``target`` under each model."""
    longs = [m.transform(target).select("id", "type", F.lit(name).alias("model"), "score") for name, m in models.items()]
    return reduce(DataFrame.unionByName, longs)


def fit_meta(wide: DataFrame, models=ST.BASE_MODELS, n_trees: int = 100, max_depth: int | None = None) -> Model:
    """The meta model on a wide score table (``stacking.to_wide``); raises if a
    row lacks a score."""
    return BM.meta_estimator([ST.pred_col(m) for m in models], n_trees, max_depth).fit(ST.require_scores(wide, models))


def base_scores(mi: ModelInputs, name: str, target: DataFrame, params: dict | None = None):
    """(id, type, orig_type, score) of ``target`` under model ``name``."""
    return fit_base(mi, name, params).transform(target).select("id", "type", "orig_type", "score")


def stacked_many(mi: ModelInputs, targets: dict[str, DataFrame], models=ST.BASE_MODELS,
                 params: dict | None = None) -> dict[str, DataFrame]:
    """Wide score tables of several targets; each base model is fitted
    once (on training set 1) and scores every target."""
    fitted = fit_all(mi, models, params)
    return {name: ST.to_wide(scores_of(fitted, tgt), tgt.select("id", "type", "orig_type"), models)
            for name, tgt in targets.items()}


def stacked(mi: ModelInputs, models=ST.BASE_MODELS, params: dict | None = None,
            target: DataFrame | None = None) -> DataFrame:
    """Wide score table of ``target`` (default: training set 2)."""
    if target is None:
        target = training_set(mi, 2)
    return stacked_many(mi, {"t": target}, models, params)["t"]
