"""Structured Streaming entry points.

Cleaning, labelling and scoring with a fitted model are stateless, so
the batch operators apply per micro-batch.  ``label_stream`` is a pure
projection (runs directly on a streaming DataFrame); ``start_scoring``
runs the bag-of-words + lexicon scoring per micro-batch through
``foreachBatch`` (the per-article counting would otherwise be a
stateful streaming aggregation with unbounded state), into a Parquet
sink partitioned by batch id.  Checkpoints live under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sifter.functions import clean as C
from sifter.operators import features as FE
from sifter.operators import labels
from sifter.operators import lexicon as LX


def label_stream(stream: DataFrame) -> DataFrame:
    """Add ``type``/``status`` and the cleaned text to a stream of
    articles (id, orig_type, content)."""
    return labels.apply_labels(stream).withColumn("clean", C.clean_text("content"))


def score_batch(batch: DataFrame, lexicon: DataFrame, stem: bool = False) -> DataFrame:
    """Lexicon scores of one batch of articles (id, type, content)."""
    long = FE.terms(batch.select("id", "content"), ("id",), stem=stem)
    return LX.score_lexicon(long, lexicon, batch.drop("content"))


def write_batch(scored: DataFrame, batch_id: int, sink_path: str) -> None:
    """A partition for each batch id, written anew if the batch is retried,
    so no row repeats."""
    scored.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")


def start_scoring(stream: DataFrame, lexicon: DataFrame, sink_path: str, checkpoint_path: str,
                  stem: bool = False, once: bool = False) -> StreamingQuery:
    """Score each micro-batch into ``sink_path`` (``write_batch``)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(score_batch(batch, lexicon, stem), batch_id, sink_path)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_path)
    if once:
        w = w.trigger(availableNow=True)
    return w.start()
