"""Queries over the driver tables, one per operator, with SQL where it exists.

Each query applies its operator to its whole table with production
parameters and derives the digest columns from the operator's outputs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm import (bpe, filter_audit, lexical_search, line_dedup, lm, mixing, ngram_join, order_minhash, pii_crf, quality_model,
                        quality_rules, token_count, url_filter)
from sifter.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


@register("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document as digests."""
    coded = bpe.encode_decode(read_table(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@register("op6_fair_queueing", mixing.SQL)
def op6_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


@register("op8_quality_rules", quality_rules.SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The rules that the query's contract names.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow",
             "net/es/": "block", "net/fr/": "block"}


@register("op1_url_trees")
def op1_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; the URLs that a rule decides are the
    labelled ones that train the trees."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.labelled_by_rules(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model)


def remainder(id_col: str, parts: int):
    """The fold that the contracts name: crc32 of the id as text, modulo."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


@register("op5_quality_network")
def op5_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, from labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = (read_table(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1)
              .select("doc_id", F.col("quality").alias("label")))
    model = quality_model.fit(docs, labels)
    return quality_model.score(docs, model).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op3_skip_chain")
def op3_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, and all spans."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii_crf.find(docs, pii_crf.train(docs))
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])

    def is_kind(kind: str):
        return lambda s: F.when(s["kind"] == kind, 1)

    return found.select(
        "doc_id",
        *[F.size(F.array_compact(F.transform(base, is_kind(k)))).cast("long").alias(f"n_{k}") for k in pii_crf.KINDS],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@register("op9_line_alignment")
def op9_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those deleted, and the digest of what is left."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs, find=line_dedup.blocks).select(
        "row.doc_id", "n_lines", F.size("cut").cast("long").alias("n_deleted"),
        F.array_join(F.col("cut").cast("array<string>"), ",").alias("deleted"),
        F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("left_sha256"))


@register("op2_order_minhash")
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return order_minhash.compare_edited(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.col("edited").alias("edited_sha256"),
        order_minhash.written(F.col("fingerprint")).alias("fingerprint"),
        order_minhash.written(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


@register("op4_ngram_join")
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles, component and links of every document at a similarity of 0.9."""
    return ngram_join.join(read_table(spark, sf_dir, "documents"), 90, 100, k=3)


@register("op7_deleted_interpolation")
def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under the model of the training fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.score(docs, remainder("doc_id", 7) != 2)
    return scored.select(
        "doc_id", F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score")


@register("op11_heap_token_counts")
def op11_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over 512 tokens."""
    return token_count.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op12_filter_audit", filter_audit.SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove, alone and in every order, by language."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), labels)


@register("op13_term_pipeline_search", lexical_search.SQL)
def op13_term_pipeline_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
