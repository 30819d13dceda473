"""Named queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (``documents``, ``labels``) and returns a
DataFrame whose column names equal the oracle SQL's.  Doubles are
rounded to 6 places on both sides where float summation order could
differ between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions import clean as C
from sifter.functions.stem import stem_table
from sifter.operators import dedup, labels, splits
from sifter.operators import evaluate as EV
from sifter.operators import features as FE
from sifter.operators import lexicon as LX
from sifter.operators import profile as PR
from sifter.operators import stacking as STK
from sifter.operators import summary as SU
from sifter.operators import vocab as V
from sifter.plans import modeling as MD
from sifter.plans.porter_sql import stems_cte
from sifter.session import ensure_checkpoint_dir
from sifter.sources import files as FI
from sifter.sources import landing, tables
from sifter.streaming import scoring as SS


@dataclass
class Query:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


# ---------------------------------------------------------------- SQL pieces
CORPUS_SQL = """
corpus AS (
  SELECT d.doc_id AS id, d.source AS domain, d.text AS content,
         CASE WHEN l.doc_id IS NULL THEN ''
              WHEN l.toxic = 1 THEN 'hate'
              WHEN l.quality = 0 THEN 'junksci'
              ELSE 'reliable' END AS orig_type
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

KEPT_SQL = CORPUS_SQL + """,
kept AS (
  SELECT id, domain, content, orig_type,
         CASE WHEN orig_type = 'reliable' THEN 'reliable' ELSE 'fake' END AS type
  FROM corpus
  WHERE orig_type IN ('fake', 'bias', 'junksci', 'hate', 'reliable')
)"""

FLAGGED_SQL = KEPT_SQL + """,
flagged AS (
  SELECT *, row_number() OVER (PARTITION BY left(coalesce(content, ''), 500)
                               ORDER BY id) > 1 AS duplicate
  FROM kept
)"""

SPLITS_SQL = """
split_ids AS (
  SELECT doc_id AS id,
         CAST((row_number() OVER (ORDER BY md5('42-' || CAST(doc_id AS VARCHAR))) - 1) % 10 + 1
              AS INTEGER) AS split
  FROM documents
)"""


def kept_corpus(spark: SparkSession, sf_dir: str, distribute: bool = True) -> DataFrame:
    return labels.label_filter_group(tables.corpus(spark, sf_dir, distribute))


def kept_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept articles as (id, domain, orig_type, type, _digest): the prefix
    digest is computed at the scan, so the label join moves no text."""
    return labels.label_filter_group(
        tables.corpus(spark, sf_dir, distribute=False, text_key=dedup.prefix_digest))


def deduped_split_corpus(spark: SparkSession, sf_dir: str, shared: bool = False, only=None) -> DataFrame:
    """Kept, de-duplicated articles with their balanced split, distributed
    by id.  Labels, duplicates and splits are decided without texts
    (``landing``); only the kept texts are distributed, once.  ``only``:
    narrows the ids further before any text moves."""
    ids = landing.article_ids(kept_digests(spark, sf_dir))
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    out = landing.kept_texts(docs, only(ids) if only else ids)
    # ``shared=True`` (several branches read the text: summaries, model
    # inputs) persists it -- memory spilling to disk, rebuilt from lineage if
    # an executor is lost.  Whole runs write this stage as Parquet
    # (``jobs.run_pipeline``).
    return out.persist(StorageLevel.MEMORY_AND_DISK) if shared else out


def corpus_with_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.assign_splits(kept_corpus(spark, sf_dir))


# ------------------------------------------------------- step 0: reduce, dedup
@register("label_filter_group", "WITH " + KEPT_SQL + """
SELECT id, domain, orig_type, type FROM kept""")
def q_label_filter_group(spark, sf_dir):
    """Label filter (P1) and grouping (P2) over the whole corpus, from a
    column-pruned typed scan (S7)."""
    return kept_corpus(spark, sf_dir, distribute=False).select("id", "domain", "orig_type", "type")


@register("row_accounting", "WITH " + CORPUS_SQL + "," + SPLITS_SQL + """,
st AS (
  SELECT CASE WHEN c.orig_type IN ('satire','conspiracy','clickbait','unreliable','political',
                                   'state','unknown','rumor','') THEN 'excluded'
              WHEN c.orig_type NOT IN ('fake','bias','junksci','hate','reliable') THEN 'skipped'
              WHEN s.split IN (1, 2) THEN 'ignored'
              ELSE 'included' END AS status
  FROM corpus c JOIN split_ids s ON c.id = s.id
)
SELECT count(*) FILTER (WHERE status = 'included') AS included,
       count(*) FILTER (WHERE status = 'excluded') AS excluded,
       count(*) FILTER (WHERE status = 'ignored') AS ignored,
       count(*) FILTER (WHERE status = 'skipped') AS skipped,
       count(*) AS read
FROM st""")
def q_row_accounting(spark, sf_dir):
    """Row accounting (S4) with the split guard (P6): test and validation
    rows are 'ignored'."""
    plan = splits.SplitPlan()
    df = splits.assign_splits(labels.apply_labels(tables.corpus(spark, sf_dir, distribute=False)))
    status = (F.when((F.col("status") == labels.INCLUDED)
                     & F.col("split").isin(plan.test, plan.val), F.lit(labels.IGNORED))
              .otherwise(F.col("status")))
    return labels.account(df.withColumn("status", status))


@register("duplicate_ids", "WITH " + KEPT_SQL + """
SELECT id FROM (
  SELECT id, row_number() OVER (PARTITION BY left(coalesce(content, ''), 500) ORDER BY id) AS rn
  FROM kept) WHERE rn > 1""")
def q_duplicate_ids(spark, sf_dir):
    """Ids of all but the first article with the same 500-character
    prefix (P5, W1), among label-filtered articles (W2)."""
    return dedup.duplicate_ids(kept_digests(spark, sf_dir))


@register("duplicate_ids_multi", "WITH " + KEPT_SQL + """
SELECT id FROM (
  SELECT id, row_number() OVER (PARTITION BY domain, length(content) ORDER BY id) AS rn
  FROM kept) WHERE rn > 1""")
def q_duplicate_ids_multi(spark, sf_dir):
    """Duplicates on several columns (W1b): same domain and text length."""
    df = kept_corpus(spark, sf_dir, distribute=False).withColumn("content_len", F.length("content"))
    return dedup.duplicate_ids(df, keys=["domain", "content_len"])


@register("dedup_keep_first", "WITH " + KEPT_SQL + """
SELECT id, orig_type, type FROM (
  SELECT *, row_number() OVER (PARTITION BY left(coalesce(content, ''), 500) ORDER BY id) AS rn
  FROM kept) WHERE rn = 1""")
def q_dedup_keep_first(spark, sf_dir):
    """Reduce + dedup in one pass (C1, W2, J1): first of each prefix."""
    return dedup.drop_duplicates(kept_digests(spark, sf_dir)).select("id", "orig_type", "type")


@register("dups_distribution", "WITH " + FLAGGED_SQL + """
SELECT orig_type, count(*) AS source_articles,
       count(*) FILTER (WHERE duplicate) AS duplicates,
       count(*) - count(*) FILTER (WHERE duplicate) AS included_articles,
       round(count(*) FILTER (WHERE duplicate) / count(*), 6) AS percentage_removed
FROM flagged GROUP BY ROLLUP (orig_type)""")
def q_dups_distribution(spark, sf_dir):
    """Duplicate distribution by source label (A18, J2), overall row by
    rollup."""
    return dedup.duplicate_distribution(dedup.flag_duplicates(kept_digests(spark, sf_dir)))


# ------------------------------------------------------------- step 1: splits
@register("splits_balanced", "WITH " + SPLITS_SQL + " SELECT id, split FROM split_ids")
def q_splits_balanced(spark, sf_dir):
    """Balanced ten-way split of all documents."""
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return splits.assign_splits(docs)


@register("splits_hash", """
SELECT doc_id AS id,
       CAST(floor(CAST(('0x' || substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT)
                  / 4294967296.0 * 10) + 1 AS INTEGER) AS split
FROM documents""")
def q_splits_hash(spark, sf_dir):
    """Hash split (W3, balanced=False): a projection, no shuffle."""
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return splits.assign_splits(docs, balanced=False)


@register("split_sizes", "WITH " + SPLITS_SQL + """
SELECT split, count(*) AS n FROM split_ids GROUP BY split""")
def q_split_sizes(spark, sf_dir):
    """Rows per split: differ by at most one."""
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return splits.assign_splits(docs).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("train_test_split", """
SELECT doc_id AS id,
       CAST(('0x' || substr(md5('7-' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT)
         / 4294967296.0 < 0.2 AS is_test
FROM documents""")
def q_train_test_split(spark, sf_dir):
    """Random 80/20 train/test split by hash threshold."""
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return splits.train_test(docs, 0.2, seed=7)


@register("train_sets", "WITH " + KEPT_SQL + "," + SPLITS_SQL + """
SELECT k.id, k.type, s.split,
       CAST(CASE WHEN s.split IN (3,4,5,6,7) THEN 1 WHEN s.split IN (8,9,10) THEN 2 END
            AS INTEGER) AS trn_split
FROM kept k JOIN split_ids s ON k.id = s.id
WHERE s.split NOT IN (1, 2)""")
def q_train_sets(spark, sf_dir):
    """Split lookup by id join (J3), split guard (P6), set assignment
    under a validated split plan (P10, U2)."""
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    split_ids = splits.assign_splits(docs)
    df = kept_corpus(spark, sf_dir).join(split_ids, "id")
    return splits.train_rows(df, splits.SplitPlan()).select("id", "type", "split", "trn_split")


@register("train_set_slice", "WITH " + KEPT_SQL + "," + SPLITS_SQL + """
SELECT k.id, k.type FROM kept k JOIN split_ids s ON k.id = s.id
WHERE s.split IN (8, 9, 10)""")
def q_train_set_slice(spark, sf_dir):
    """Rows of training set 2, the meta model's input."""
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    df = kept_corpus(spark, sf_dir).join(splits.assign_splits(docs), "id")
    return (splits.train_rows(df, splits.SplitPlan())
            .filter(F.col("trn_split") == 2).select("id", "type"))


@register("eval_split", "WITH " + KEPT_SQL + "," + SPLITS_SQL + """
SELECT id, orig_type, type FROM kept
WHERE id IN (SELECT id FROM split_ids WHERE split = 2)""")
def q_eval_split(spark, sf_dir):
    """Validation rows by semi join on the split's id list."""
    docs = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return splits.eval_rows(kept_corpus(spark, sf_dir), splits.assign_splits(docs), 2) \
        .select("id", "orig_type", "type")


# --------------------------------------------------------------- step 2: text

PLAN = splits.SplitPlan()

TRAIN_SQL = KEPT_SQL + """,
deduped AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY left(coalesce(content, ''), 500) ORDER BY id) AS rn
    FROM kept) WHERE rn = 1
),
dsplit AS (
  SELECT *, CAST((row_number() OVER (ORDER BY md5('42-' || CAST(id AS VARCHAR))) - 1) % 10 + 1
                 AS INTEGER) AS split
  FROM deduped
),
train AS (SELECT * FROM dsplit WHERE split NOT IN (1, 2)),
toks AS (
  SELECT id, type, unnest(""" + C.tokens_sql(C.clean_sql("content")) + """) AS word FROM train
),
terms AS (SELECT type, id, word, CAST(count(*) AS INTEGER) AS n FROM toks GROUP BY type, id, word),
counts AS (SELECT type, word, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_total FROM terms
           GROUP BY type, word),
wide AS (
  SELECT word,
         CAST(coalesce(sum(n_docs) FILTER (WHERE type = 'fake'), 0) AS BIGINT) AS fake_docs,
         CAST(coalesce(sum(n_total) FILTER (WHERE type = 'fake'), 0) AS BIGINT) AS fake_total,
         CAST(coalesce(sum(n_docs) FILTER (WHERE type = 'reliable'), 0) AS BIGINT) AS reliable_docs,
         CAST(coalesce(sum(n_total) FILTER (WHERE type = 'reliable'), 0) AS BIGINT) AS reliable_total,
         CAST(sum(n_docs) AS BIGINT) AS freq_docs, CAST(sum(n_total) AS BIGINT) AS freq_total
  FROM counts GROUP BY word
)"""


_ALL_TOKENS = "SELECT DISTINCT unnest(" + C.tokens_sql(C.clean_sql("content")) + ") AS word FROM dsplit"


def stemmed_sql(sql: str) -> str:
    """An oracle over ``TRAIN_SQL`` with its words, and those of the evaluation
    rows, stemmed before they are counted."""
    at = sql.index("terms AS (SELECT type, id, word,")
    sql = sql[:at] + stems_cte(_ALL_TOKENS) + ",\n" + sql[at:]
    sql = sql.replace("terms AS (SELECT type, id, word, CAST(count(*) AS INTEGER) AS n FROM toks GROUP BY type, id, word)",
                      "terms AS (SELECT type, id, stem AS word, CAST(count(*) AS INTEGER) AS n FROM toks JOIN stems ON toks.word = stems.word "
                      "GROUP BY type, id, stem)")
    return sql.replace("AS word FROM evalrows) GROUP BY id, word", "AS form FROM evalrows) e JOIN stems ON e.form = stems.word GROUP BY id, stem") \
              .replace("eterms AS (\n  SELECT id, word,", "eterms AS (\n  SELECT id, stem AS word,")


def cut_sql(head: float, tail: float) -> str:
    """Cut bounds as prefix sums over words (not over a histogram)."""
    return f""",
ranked AS (
  SELECT word, freq_total,
         sum(freq_total) OVER (ORDER BY freq_total DESC
                               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c,
         sum(freq_total) OVER () AS t
  FROM wide
),
up AS (
  SELECT max(freq_total) FILTER (WHERE c - freq_total >= CAST({float(head)!r} AS DOUBLE) * t) AS upper,
         min(freq_total) AS least FROM ranked
),
bounds AS (
  SELECT up.upper,
         CASE WHEN up.upper IS NULL THEN NULL ELSE coalesce(
           (SELECT max(freq_total) FROM ranked
            WHERE freq_total < up.upper
              AND c - freq_total >= CAST({float(1 - tail)!r} AS DOUBLE) * t), up.least) END AS lower
  FROM up
),
vocab AS (
  SELECT w.* FROM wide w, bounds b WHERE w.freq_total >= b.lower AND w.freq_total < b.upper
)"""


def train_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label-filtered, de-duplicated articles with a balanced split,
    training splits only (the word table's input)."""
    return deduped_split_corpus(spark, sf_dir, only=lambda ids: splits.train_rows(ids, PLAN))


def train_wide(spark, sf_dir, stem=False):
    long = FE.terms(train_corpus(spark, sf_dir), ("type", "id"), stem=stem)
    return V.materialize(V.to_wide(V.word_counts(long)))


def train_count(spark, sf_dir):
    """Number of training articles, from ids only (no text)."""
    firsts = dedup.first_ids(kept_digests(spark, sf_dir))
    ids = splits.train_rows(splits.split_ids(firsts), PLAN)
    return LX.n_articles(ids)


@register("clean_text", "SELECT doc_id AS id, " + C.clean_sql("text") + " AS clean FROM documents")
def q_clean_text(spark, sf_dir):
    """Clean text (F1): fold, placeholders, no punctuation, lower case."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), C.clean_text("text").alias("clean"))


@register("clean_text_light",
          "SELECT doc_id AS id, " + C.clean_sql("text", C.LIGHT) + " AS clean FROM documents")
def q_clean_text_light(spark, sf_dir):
    """Clean text, notebook variant (F2): only punctuation removal on."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), C.clean_text("text", C.LIGHT).alias("clean"))


@register("tokenize", """
SELECT doc_id AS id, CAST(pos AS INTEGER) AS pos, token FROM (
  SELECT doc_id, generate_subscripts(toks, 1) - 1 AS pos, unnest(toks) AS token
  FROM (SELECT doc_id, """ + C.tokens_sql(C.clean_sql("text")) + """ AS toks FROM documents))""")
def q_tokenize(spark, sf_dir):
    """Tokenise cleaned text (F3): whitespace split, no empty tokens."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"),
                       F.posexplode(C.tokenize(C.clean_text("text"))).alias("pos", "token"))


@register("stem_tokens", "WITH " + stems_cte("SELECT DISTINCT unnest(" + C.tokens_sql(C.clean_sql("text")) + ") AS word FROM documents") + """
SELECT word AS token, stem FROM stems""")
def q_stem_tokens(spark, sf_dir):
    """Porter stems (F4) of every distinct token of the corpus."""
    docs = tables.read_table(spark, sf_dir, "documents")
    toks = docs.select(F.explode(C.tokenize(C.clean_text("text"))).alias("token"))
    return stem_table(toks, "token")


# -------------------------------------------------------------- step 3: words
@register("word_counts", "WITH " + TRAIN_SQL + " SELECT type, word, n_docs, n_total FROM counts")
def q_word_counts(spark, sf_dir):
    """Word counts per label (A1) over the training splits of the
    de-duplicated corpus: articles containing the word and occurrences."""
    long = FE.terms(train_corpus(spark, sf_dir), ("type", "id"), stem=False)
    return V.word_counts(long)


@register("landed_word_counts", "WITH " + TRAIN_SQL + " SELECT type, word, n_docs, n_total FROM counts")
def q_landed_word_counts(spark, sf_dir):
    """Word counts (A1) from a corpus landed once in buckets of the id (S7, S9,
    C1): counting words by article exchanges no text."""
    landed = landing.land_bucketed(deduped_split_corpus(spark, sf_dir), scratch_path(spark, "landed"))
    return V.word_counts(FE.terms(splits.train_rows(landed, PLAN), ("id", "type"), stem=False))


@register("word_counts_stemmed", "WITH " + stemmed_sql(TRAIN_SQL) + " SELECT type, word, n_docs, n_total FROM counts")
def q_word_counts_stemmed(spark, sf_dir):
    """Word counts per label on stemmed tokens (A1 + F4, merge='exact')."""
    long = FE.terms(train_corpus(spark, sf_dir), ("type", "id"), stem=True)
    return V.word_counts(long)


@register("word_table_wide", "WITH " + TRAIN_SQL + " SELECT * FROM wide")
def q_word_table_wide(spark, sf_dir):
    """Wide word table (S6, F12): fake, reliable and freq = their sum."""
    return train_wide(spark, sf_dir)


@register("stem_merge", "WITH " + TRAIN_SQL + """
SELECT type, left(word, 5) AS word, CAST(sum(n_docs) AS BIGINT) AS n_docs,
       CAST(sum(n_total) AS BIGINT) AS n_total
FROM counts GROUP BY type, left(word, 5)""")
def q_stem_merge(spark, sf_dir):
    """Stem merge (A2, merge='sum') with ``left(token, 5)`` as the stem
    table, so both engines can state it."""
    counts = V.word_counts(FE.terms(train_corpus(spark, sf_dir), ("type", "id"), stem=False))
    stems = counts.select("word").distinct().withColumn("stem", F.substring("word", 1, 5))
    return V.merge_stems(counts, stems, "sum")


@register("stem_merge_first", "WITH " + TRAIN_SQL + """,
firstpos AS (SELECT word, min(id) AS first_pos FROM terms GROUP BY word),
firstform AS (
  SELECT left(word, 5) AS stem, arg_min(word, (first_pos, word)) AS first FROM firstpos
  GROUP BY left(word, 5)
)
SELECT c.type, left(c.word, 5) AS word,
       coalesce(max(CASE WHEN c.word = f.first THEN c.n_docs END), 0) AS n_docs,
       coalesce(max(CASE WHEN c.word = f.first THEN c.n_total END), 0) AS n_total
FROM counts c JOIN firstform f ON left(c.word, 5) = f.stem
GROUP BY c.type, left(c.word, 5)""")
def q_stem_merge_first(spark, sf_dir):
    """Stem merge, parity mode (A2, merge='first_form'): the form first
    seen (lowest article id) keeps its counts."""
    long = FE.terms(train_corpus(spark, sf_dir), ("type", "id"), stem=False)
    counts = V.word_counts(long)
    stems = counts.select("word").distinct().withColumn("stem", F.substring("word", 1, 5))
    first_seen = long.groupBy("word").agg(F.min("id").alias("first_pos"))
    return V.merge_stems(counts, stems, "first_form", first_seen)


@register("vocab_cut", "WITH " + TRAIN_SQL + cut_sql(0.5, 0.05) + " SELECT word, freq_total FROM vocab")
def q_vocab_cut(spark, sf_dir):
    """Vocabulary cut by mass (A3, W6, W9; the frame preprocess C5 with
    F12's totals): head 0.5, tail 0.05."""
    return V.cut(train_wide(spark, sf_dir), 0.5, 0.05).select("word", "freq_total")


@register("vocab_cut_stats", "WITH " + TRAIN_SQL + cut_sql(0.5, 0.05) + """
SELECT count(*) AS words_before,
       count(*) FILTER (WHERE w.freq_total >= b.lower AND w.freq_total < b.upper) AS words_after,
       count(*) FILTER (WHERE NOT coalesce(w.freq_total >= b.lower AND w.freq_total < b.upper, false))
         AS words_removed,
       count(*) FILTER (WHERE b.upper IS NULL OR w.freq_total >= b.upper) AS removed_head,
       count(*) FILTER (WHERE w.freq_total < b.lower) AS removed_tail,
       min(b.lower) AS min_level
FROM wide w, bounds b""")
def q_vocab_cut_stats(spark, sf_dir):
    """Cut statistics (A4)."""
    return V.cut_stats(train_wide(spark, sf_dir), 0.5, 0.05)


DOC_TERMS_SQL = """
dterms AS (
  SELECT id, word, CAST(count(*) AS INTEGER) AS n FROM (
    SELECT doc_id AS id, unnest(""" + C.tokens_sql(C.clean_sql("text")) + """) AS word
    FROM documents) GROUP BY id, word
)"""


def doc_corpus(spark, sf_dir):
    docs = tables.read_documents(spark, sf_dir, "doc_id", "text")
    return docs.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


@register("bag_of_words", "WITH " + DOC_TERMS_SQL + " SELECT id, word, n FROM dterms")
def q_bag_of_words(spark, sf_dir):
    """Bag of words (F5, F6 without stemming) in long form: the sparse
    document-term table (M2)."""
    return FE.terms(doc_corpus(spark, sf_dir), ("id",), stem=False)


@register("bag_of_words_stemmed", "WITH " + DOC_TERMS_SQL + ", " + stems_cte("SELECT DISTINCT word FROM dterms") + """
SELECT id, stem AS word, CAST(sum(n) AS INTEGER) AS n FROM dterms JOIN stems ON dterms.word = stems.word GROUP BY id, stem""")
def q_bag_of_words_stemmed(spark, sf_dir):
    """Bag of words with Porter stems (F6) in long form."""
    return FE.terms(doc_corpus(spark, sf_dir), ("id",), stem=True)


@register("bag_vocab_filtered", "WITH " + TRAIN_SQL + cut_sql(0.5, 0.05) + "," + DOC_TERMS_SQL + """
SELECT id, word, n FROM dterms WHERE word IN (SELECT word FROM vocab)""")
def q_bag_vocab_filtered(spark, sf_dir):
    """Bag restricted to the cut vocabulary (F7, J6: semi join)."""
    vocab = V.cut(train_wide(spark, sf_dir), 0.5, 0.05)
    return FE.terms(doc_corpus(spark, sf_dir), ("id",), stem=False, vocab=vocab)


@register("bow_entropy", "WITH " + DOC_TERMS_SQL + """,
tot AS (SELECT id, sum(n) AS l FROM dterms GROUP BY id)
SELECT d.id, round(sum(d.n / t.l * log2(t.l / d.n)), 6) AS entropy
FROM dterms d JOIN tot t ON d.id = t.id GROUP BY d.id""")
def q_bow_entropy(spark, sf_dir):
    """Entropy of each article's bag."""
    bags = FE.bag_map(FE.terms(doc_corpus(spark, sf_dir), ("id",), stem=False))
    return bags.select("id", F.round(FE.bow_entropy("words"), 6).alias("entropy"))


@register("bow_size", "WITH " + DOC_TERMS_SQL + """
SELECT d.doc_id AS id, CAST(count(t.word) AS INTEGER) AS n_words,
       CAST(coalesce(sum(t.n), 0) AS BIGINT) AS n_tokens
FROM documents d LEFT JOIN dterms t ON d.doc_id = t.id GROUP BY d.doc_id""")
def q_bow_size(spark, sf_dir):
    """Distinct words (F11) and tokens per article; empty articles get an
    empty bag."""
    bags = FE.with_bags(doc_corpus(spark, sf_dir), stem=False)
    return bags.select("id", FE.bag_size("words").alias("n_words"),
                       F.aggregate(F.map_values("words"), F.lit(0).cast("long"),
                                   lambda a, x: a + x).alias("n_tokens"))


@register("add_feature", "WITH " + DOC_TERMS_SQL + """
SELECT id, word AS key, CAST(n AS DOUBLE) AS value FROM dterms WHERE word <> 'content_len'
UNION ALL
SELECT doc_id AS id, 'content_len' AS key, CAST(length(text) AS DOUBLE) AS value FROM documents""")
def q_add_feature(spark, sf_dir):
    """Scalar feature into the bag (F15, F16): ``content_len`` under its
    own key, shown as map entries."""
    bags = FE.with_bags(doc_corpus(spark, sf_dir), stem=False)
    with_len = bags.select("id", FE.add_feature("words", "content_len",
                                                F.length("content")).alias("words"))
    return with_len.select("id", F.explode("words").alias("key", "value"))


@register("top_words", "WITH " + DOC_TERMS_SQL + """
SELECT word, CAST(sum(n) AS BIGINT) AS total FROM dterms GROUP BY word ORDER BY total DESC, word LIMIT 30""")
def q_top_words(spark, sf_dir):
    """Top 30 words over all bags."""
    return V.top_words(FE.terms(doc_corpus(spark, sf_dir), ("id",), stem=False), 30)


@register("word_slice", "WITH " + TRAIN_SQL + """
SELECT word, freq_total FROM wide ORDER BY freq_total DESC, word LIMIT 50 OFFSET 1000""")
def q_word_slice(spark, sf_dir):
    """Rows 1000..1050 of the word table by total."""
    return V.word_slice(train_wide(spark, sf_dir), 1000, 50).select("word", "freq_total")


@register("fr_ratio", "WITH " + TRAIN_SQL + """
SELECT word, CASE WHEN reliable_docs = 0 THEN CAST('inf' AS DOUBLE)
                  ELSE fake_docs / reliable_docs END AS fr_ratio FROM wide""")
def q_fr_ratio(spark, sf_dir):
    """Fake-to-reliable article ratio per word."""
    return V.fr_ratio(train_wide(spark, sf_dir))


# ------------------------------------------------- step 4: summary and profile


def split_corpus(spark, sf_dir):
    """De-duplicated, label-filtered articles with their balanced split,
    persisted for queries whose plan reads the text in several branches."""
    return deduped_split_corpus(spark, sf_dir, shared=True)


TOKS_EXPR = C.tokens_sql(C.clean_sql("content"))

SUMMARY_SQL = TRAIN_SQL + cut_sql(0.5, 0.05) + """,
summary AS (
  SELECT t.id, t.domain, t.orig_type, t.type, t.split, CAST(length(t.content) AS INTEGER) AS content_len,
         CASE WHEN len(tk.toks) > 0 THEN list_avg(list_transform(tk.toks, lambda x: length(x))) END
           AS mean_word_len,
         CASE WHEN len(tk.toks) > 0
              THEN list_aggregate(list_transform(tk.toks, lambda x: length(x)), 'median') END
           AS median_word_len
  FROM train t JOIN (SELECT id, """ + TOKS_EXPR + """ AS toks FROM train) tk ON t.id = tk.id
),
vterms AS (SELECT id, word, n FROM terms WHERE word IN (SELECT word FROM vocab))"""


@register("article_summary", "WITH " + SUMMARY_SQL + """
SELECT s.id, s.domain, s.orig_type, s.type, s.split, s.content_len,
       round(s.mean_word_len, 6) AS mean_word_len, round(s.median_word_len, 6) AS median_word_len,
       CAST(count(v.word) AS INTEGER) AS n_words, CAST(coalesce(sum(v.n), 0) AS BIGINT) AS n_tokens
FROM summary s LEFT JOIN vterms v ON s.id = v.id
GROUP BY ALL""")
def q_article_summary(spark, sf_dir):
    """Article summary (C2, F7-F10): label columns carried through (P7),
    vocabulary-filtered bag, text length, mean and median token length;
    shown with bag sizes instead of the map."""
    df = split_corpus(spark, sf_dir)
    vocab = V.cut(train_wide(spark, sf_dir), 0.5, 0.05)
    s = SU.summarize(df, vocab, PLAN, stem=False)
    return s.select("id", "domain", "orig_type", "type", "split", "content_len",
                    F.round("mean_word_len", 6).alias("mean_word_len"),
                    F.round("median_word_len", 6).alias("median_word_len"),
                    F.size("words").alias("n_words"),
                    F.aggregate(F.map_values("words"), F.lit(0).cast("long"),
                                lambda a, x: a + x).alias("n_tokens"))


@register("article_summary_stemmed")
def q_article_summary_stemmed(spark, sf_dir):
    """Article summary with stemmed words and the stemmed vocabulary
    (C2 as the reference runs it), bag as MAP<STRING,INT>."""
    df = split_corpus(spark, sf_dir)
    long = FE.terms(splits.train_rows(df, PLAN), ("type", "id"), stem=True)
    vocab = V.cut(V.materialize(V.to_wide(V.word_counts(long))), 0.5, 0.05)
    return SU.summarize(df, vocab, PLAN, stem=True, long=long)


EVAL_SQL = TRAIN_SQL + """,
evalrows AS (SELECT id, orig_type, type, content, split FROM dsplit WHERE split IN (1, 2)),
eterms AS (
  SELECT id, word, CAST(count(*) AS INTEGER) AS n FROM (
    SELECT id, unnest(""" + TOKS_EXPR + """) AS word FROM evalrows) GROUP BY id, word
)"""


@register("eval_set", "WITH " + EVAL_SQL + """
SELECT e.id, e.orig_type, e.type, t.word, t.n
FROM evalrows e JOIN eterms t ON e.id = t.id WHERE e.split = 2""")
def q_eval_set(spark, sf_dir):
    """Validation set (C3, F6): unfiltered bags of split 2, long form."""
    df = deduped_split_corpus(spark, sf_dir)
    ev = SU.prepare_eval(df, PLAN.val, stem=False)
    return ev.select("id", "orig_type", "type", F.explode("words").alias("word", "n"))


@register("statements_set", """
WITH st AS (
  SELECT d.doc_id AS id, d.text AS content,
         CASE WHEN l.doc_id IS NULL THEN 'half-true' WHEN l.toxic = 1 THEN 'pants-fire'
              WHEN l.quality = 0 THEN 'false' ELSE 'true' END AS orig_type
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
kept AS (
  SELECT id, orig_type, CASE WHEN orig_type IN ('true', 'mostly-true') THEN 'reliable' ELSE 'fake' END
         AS type, content
  FROM st WHERE orig_type IN ('true', 'mostly-true', 'false', 'pants-fire')
)
SELECT id, orig_type, type, CAST(count(t.word) AS INTEGER) AS n_words
FROM kept LEFT JOIN (SELECT id AS tid, unnest(""" + TOKS_EXPR + """) AS word FROM kept) t
  ON kept.id = t.tid
GROUP BY ALL""")
def q_statements_set(spark, sf_dir):
    """Second corpus (C4, P4, S5 labels): keep true/mostly-true/false/
    pants-fire, map to reliable/fake, bag each statement; shown with its
    token count."""
    ev = SU.prepare_statements(tables.statements(spark, sf_dir), stem=False)
    return ev.select("id", "orig_type", "type",
                     F.aggregate(F.map_values("words"), F.lit(0),
                                 lambda a, x: a + x).alias("n_words"))


@register("box_stats", "WITH " + SUMMARY_SQL + """
, q AS (
  SELECT orig_type, count(*) AS n, round(avg(content_len), 6) AS mean,
         quantile_cont(content_len, 0.25) AS q1, quantile_cont(content_len, 0.5) AS median,
         quantile_cont(content_len, 0.75) AS q3
  FROM summary GROUP BY orig_type
)
SELECT q.orig_type, q.n, q.mean, round(q.q1, 6) AS q1, round(q.median, 6) AS median,
       round(q.q3, 6) AS q3,
       CAST(min(s.content_len) FILTER (WHERE s.content_len >= q.q1 - (q.q3 - q.q1)) AS DOUBLE)
         AS whisker_low,
       CAST(max(s.content_len) FILTER (WHERE s.content_len <= q.q3 + (q.q3 - q.q1)) AS DOUBLE)
         AS whisker_high
FROM q JOIN summary s ON q.orig_type = s.orig_type GROUP BY ALL""")
def q_box_stats(spark, sf_dir):
    """Box-plot summary of text length per source label."""
    s = SU.summarize(split_corpus(spark, sf_dir), None, PLAN, stem=False)
    b = PR.box_stats(s, "content_len", "orig_type", whis=1.0)
    return b.select("orig_type", "n", F.round("mean", 6).alias("mean"),
                    *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
                    "whisker_low", "whisker_high")


@register("box_stats_word_len", "WITH " + SUMMARY_SQL + """
, q AS (
  SELECT type, count(mean_word_len) AS n, avg(mean_word_len) AS mean,
         quantile_cont(mean_word_len, 0.25) AS q1, quantile_cont(mean_word_len, 0.5) AS median,
         quantile_cont(mean_word_len, 0.75) AS q3
  FROM summary GROUP BY type
)
SELECT q.type, q.n, round(q.mean, 6) AS mean, round(q.q1, 6) AS q1, round(q.median, 6) AS median,
       round(q.q3, 6) AS q3,
       round(min(s.mean_word_len) FILTER (WHERE s.mean_word_len >= q.q1 - (q.q3 - q.q1)), 6)
         AS whisker_low,
       round(max(s.mean_word_len) FILTER (WHERE s.mean_word_len <= q.q3 + (q.q3 - q.q1)), 6)
         AS whisker_high
FROM q JOIN summary s ON q.type = s.type GROUP BY ALL""")
def q_box_stats_word_len(spark, sf_dir):
    """Box-plot summary of mean token length per label."""
    s = SU.summarize(split_corpus(spark, sf_dir), None, PLAN, stem=False)
    b = PR.box_stats(s, "mean_word_len", "type", whis=1.0)
    return b.select("type", "n", *[F.round(c, 6).alias(c) for c in
                                   ("mean", "q1", "median", "q3", "whisker_low", "whisker_high")])


@register("label_balance", "WITH " + KEPT_SQL + """
SELECT type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM kept GROUP BY type""")
def q_label_balance(spark, sf_dir):
    """Class totals and balance (A5)."""
    b = PR.label_balance(kept_corpus(spark, sf_dir, distribute=False))
    return b.withColumn("share", F.round("share", 6))


SHARES = (0.25, 0.5, 0.75, 1.0)


@register("label_prefix_ratio", "WITH " + KEPT_SQL + """,
pos AS (SELECT type, row_number() OVER (ORDER BY id) AS pos FROM kept),
c AS (SELECT DISTINCT CAST(floor(share * (SELECT count(*) FROM kept)) AS BIGINT) AS first_n
      FROM (SELECT unnest([""" + ", ".join(map(str, SHARES)) + """]) AS share))
SELECT c.first_n, count(*) FILTER (WHERE p.type = 'fake') AS fakes,
       count(*) FILTER (WHERE p.type = 'reliable') AS reals,
       round(CASE WHEN count(*) FILTER (WHERE p.type = 'reliable') > 0 THEN
         count(*) FILTER (WHERE p.type = 'fake') / count(*) FILTER (WHERE p.type = 'reliable') END, 6)
         AS ratio
FROM c LEFT JOIN pos p ON p.pos <= c.first_n GROUP BY c.first_n""")
def q_label_prefix_ratio(spark, sf_dir):
    """Fake/reliable ratio among the first quarter, half, three quarters and all
    of the articles by id (A19)."""
    r = PR.label_share_ratio(kept_corpus(spark, sf_dir, distribute=False), SHARES)
    return r.withColumn("ratio", F.round("ratio", 6))


@register("null_counts", """
SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE text IS NULL) AS text,
       count(*) FILTER (WHERE lang IS NULL) AS lang, count(*) FILTER (WHERE source IS NULL) AS source,
       count(*) FILTER (WHERE n_chars IS NULL) AS n_chars
FROM documents""")
def q_null_counts(spark, sf_dir):
    """Null count per column."""
    return PR.null_counts(tables.read_table(spark, sf_dir, "documents"))


@register("distinct_labels", "WITH " + CORPUS_SQL + " SELECT DISTINCT orig_type FROM corpus")
def q_distinct_labels(spark, sf_dir):
    """Distinct source labels."""
    return tables.corpus(spark, sf_dir).select("orig_type").distinct()


# ------------------------------------------------------ step 5: lexicon model
LEX_SQL = EVAL_SQL + cut_sql(0.5, 0.05) + """,
tot AS (SELECT sum(freq_total) AS t, sum(fake_total) AS tf, sum(reliable_total) AS tr FROM vocab),
nart AS (SELECT count(*) AS n FROM train),
scaled AS (SELECT v.word, v.freq_docs, v.fake_total * (tot.t / tot.tf) AS fs,
                  v.reliable_total * (tot.t / tot.tr) AS rs FROM vocab v, tot),
lex AS (
  SELECT word, ln(nart.n / (freq_docs + 1.001)) AS idf_weight,
         2.0 / (1.0 + exp(-least(greatest((rs - fs) / greatest(least(rs, fs), 1.0), -100.0), 100.0)))
           - 1.0 AS fakeness_score
  FROM scaled, nart
),
scores AS (
  SELECT e.id, e.type, e.split,
         coalesce(sum(t.n * l.idf_weight * l.fakeness_score) / (0.1 + sum(t.n * l.idf_weight)), 0.0)
           AS score
  FROM evalrows e LEFT JOIN eterms t ON e.id = t.id LEFT JOIN lex l ON t.word = l.word
  GROUP BY e.id, e.type, e.split
)"""


def fitted_lexicon(spark, sf_dir, stem=False):
    vocab = V.cut(train_wide(spark, sf_dir, stem), 0.5, 0.05)
    return LX.fit_lexicon(vocab, train_count(spark, sf_dir))


def lexicon_scored(spark, sf_dir, stem=False):
    df = deduped_split_corpus(spark, sf_dir)
    rows = df.filter(F.col("split").isin(PLAN.test, PLAN.val)).select("id", "type", "split", "content")
    long = FE.terms(rows, ("id",), stem=stem)
    return LX.score_lexicon(long, fitted_lexicon(spark, sf_dir, stem), rows.drop("content"))


@register("lexicon_model", "WITH " + LEX_SQL + """
SELECT word, round(idf_weight, 6) AS idf_weight, round(fakeness_score, 6) AS fakeness_score FROM lex""")
def q_lexicon_model(spark, sf_dir):
    """Lexicon model (A6-A8, A10, A11): label scaling, idf weight and
    fakeness score per vocabulary word."""
    m = fitted_lexicon(spark, sf_dir)
    return m.select("word", F.round("idf_weight", 6).alias("idf_weight"),
                    F.round("fakeness_score", 6).alias("fakeness_score"))


@register("tfidf_weights", "WITH " + TRAIN_SQL + """, nart AS (SELECT count(*) AS n FROM train)
SELECT word, round(ln(nart.n / freq_docs) * (ln(freq_total) + 1), 6) AS tfidf FROM wide, nart""")
def q_tfidf_weights(spark, sf_dir):
    """Tf-idf weight per word."""
    n = train_count(spark, sf_dir)
    w = train_wide(spark, sf_dir).crossJoin(F.broadcast(n))
    return w.select("word", F.round(LX.tfidf(F.col("freq_docs"), F.col("freq_total"),
                                             F.col("n_articles")), 6).alias("tfidf"))


@register("lexicon_scores", "WITH " + LEX_SQL + """
SELECT id, type, split, round(score, 6) AS score FROM scores""")
def q_lexicon_scores(spark, sf_dir):
    """Lexicon scores of the validation and test articles."""
    s = lexicon_scored(spark, sf_dir)
    return s.select("id", "type", "split", F.round("score", 6).alias("score"))


# ------------------------------------------------------------ step 6: evaluate
EVAL_METRICS_SQL = """
lab AS (SELECT *, CASE WHEN isnan(score) THEN NULL WHEN score < 0 THEN 'fake' ELSE 'reliable' END
          AS pred FROM scores),
conf AS (
  SELECT CASE WHEN split = 1 THEN 'test' ELSE 'validation' END AS dataset,
         count(*) FILTER (WHERE pred = 'fake' AND type = 'fake') AS tp,
         count(*) FILTER (WHERE pred = 'fake' AND type <> 'fake') AS fp,
         count(*) FILTER (WHERE coalesce(pred, '') <> 'fake' AND type = 'reliable') AS tn,
         count(*) FILTER (WHERE coalesce(pred, '') <> 'fake' AND type <> 'reliable') AS fn
  FROM lab GROUP BY 1
),
m AS (
  SELECT *, CAST(tp + fp + tn + fn AS DOUBLE) AS n,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall,
         CASE WHEN tn + fp > 0 THEN tn / (tn + fp) END AS tnr,
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1f,
         CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0 END AS f1r
  FROM conf
)
SELECT dataset, tp, fp, tn, fn, CAST(n AS BIGINT) AS n,
       round((tp + tn) / n, 6) AS accuracy,
       round((coalesce(recall, 0) + coalesce(tnr, 0))
             / ((CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END)), 6)
         AS balanced_accuracy,
       round(((tp + fn) * f1f + (tn + fp) * f1r) / n, 6) AS f1_weighted,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tn + fn > 0 THEN tn / (tn + fn) END, 6) AS npv,
       round(recall, 6) AS recall, round(tnr, 6) AS tnr,
       round(tp / n, 6) AS m_tp, round(fp / n, 6) AS m_fp, round(fn / n, 6) AS m_fn,
       round(tn / n, 6) AS m_tn
FROM m"""


def metric_columns(m: DataFrame, by) -> DataFrame:
    dbl = ["accuracy", "balanced_accuracy", "f1_weighted", "precision", "npv", "recall", "tnr"]
    mat = F.col("confusion_matrix")
    return m.select(*by, "tp", "fp", "tn", "fn", "n", *[F.round(c, 6).alias(c) for c in dbl],
                    F.round(mat[0][0], 6).alias("m_tp"), F.round(mat[0][1], 6).alias("m_fp"),
                    F.round(mat[1][0], 6).alias("m_fn"), F.round(mat[1][1], 6).alias("m_tn"))


@register("evaluate", "WITH " + LEX_SQL + "," + EVAL_METRICS_SQL)
def q_evaluate(spark, sf_dir):
    """Lexicon model evaluated on validation and test in one pass (F13,
    A13-A15, M14)."""
    s = lexicon_scored(spark, sf_dir).withColumn(
        "dataset", F.when(F.col("split") == PLAN.test, "test").otherwise("validation"))
    return metric_columns(EV.evaluate(s, "score", "type", ["dataset"]), ["dataset"])


# ------------------------------------------------------ step 7-8: classifiers


def _inputs(spark, sf_dir):
    return MD.model_inputs(tables.corpus(spark, sf_dir), PLAN, stem=True,
                           narrow=tables.corpus(spark, sf_dir, distribute=False,
                                                text_key=dedup.prefix_digest))


def _base_query(name):
    def q(spark, sf_dir):
        mi = _inputs(spark, sf_dir)
        target = mi.bags.filter(F.col("trn_split") == 2)
        return MD.base_scores(mi, name, target).select(
            "id", "type", F.round("score", 6).alias("score"))
    return q


for _name, _ops in (("logreg", "M1 M3 M9 M10"), ("svm", "M1 M7 M9"),
                    ("nb_multinomial", "M1 M5 M9"), ("nb_complement", "M1 M6 M9"),
                    ("random_forest", "M1 M8 M9"), ("passive_aggressive", "M4 M9")):
    _model = {"logreg": "linear", "nb_multinomial": "multi_nb", "nb_complement": "compl_nb",
              "passive_aggressive": "pa"}.get(_name, _name)
    _fn = _base_query(_model)
    _fn.__doc__ = (f"Model '{_model}' fitted on training set 1, scoring training set 2 "
                   f"({_ops}; features placed beside id and label, J8): "
                   f"P(reliable) - P(fake) in [-1, 1].")
    register(_name)(_fn)


@register("stacked_scores")
def q_stacked_scores(spark, sf_dir):
    """Out-of-sample scores of all six base models on training set 2
    (models from the registry with their parameters, M13), unioned (U1)
    and pivoted to one column per model (M10, J5)."""
    mi = _inputs(spark, sf_dir)
    return MD.stacked(mi)


@register("meta_predictions")
def q_meta_predictions(spark, sf_dir):
    """Meta model (M12) fitted on set 2's scores, predicting the
    validation split (+1 reliable, -1 fake: labels as +-1, F18)."""
    mi = _inputs(spark, sf_dir)
    val = MD.eval_bags(mi, PLAN.val)
    wides = MD.stacked_many(mi, {"set2": MD.training_set(mi, 2), "val": val})
    meta = MD.fit_meta(wides["set2"])
    return meta.transform(STK.require_scores(wides["val"])).select("id", "type", F.col("score").alias("preds_meta"))


@register("dups_without_reliable", "WITH " + FLAGGED_SQL + """
SELECT count(*) AS source_articles, count(*) FILTER (WHERE duplicate) AS duplicates,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE duplicate) / count(*) END, 6) AS percentage_removed
FROM flagged WHERE orig_type <> 'reliable'""")
def q_dups_without_reliable(spark, sf_dir):
    """Share of duplicates among all labels but the reliable one."""
    return dedup.share_removed_without(dedup.flag_duplicates(kept_digests(spark, sf_dir)))


# ------------------------------------------------------- step 9: file formats


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_roundtrip", "WITH " + KEPT_SQL + """
SELECT id, domain, orig_type, type, md5(content) AS content_md5 FROM kept""")
def q_csv_roundtrip(spark, sf_dir):
    """Corpus CSV scan (S1, S3, S9): the corpus written in the raw
    17-column CSV layout (quoted, multi-line) and read back with an
    explicit schema and a corrupt-record column; ids cast with
    ``try_cast``, unreadable ids to the rejects (P8); ``type`` renamed to
    ``orig_type`` and grouped (P3); then reduced (C1)."""
    c = tables.corpus(spark, sf_dir).withColumnRenamed("orig_type", "type")
    path = scratch_path(spark, "corpus-csv")
    FI.write_corpus_csv(c, path)
    rows, _rejects = FI.read_corpus_csv(spark, path)
    kept, _ = labels.reduce_corpus(rows)
    return kept.select("id", "domain", "orig_type", "type", F.md5("content").alias("content_md5"))


@register("csv_parallel_read", "WITH " + KEPT_SQL + """
SELECT id, domain, orig_type, type, md5(content) AS content_md5 FROM kept""")
def q_csv_parallel_read(spark, sf_dir):
    """Corpus CSV scan (S1) with records found by quote parity, so that many
    tasks read one multi-line file."""
    c = tables.corpus(spark, sf_dir).withColumnRenamed("orig_type", "type")
    path = scratch_path(spark, "corpus-csv")
    FI.write_corpus_csv(c, path)
    rows, _rejects = FI.read_corpus_csv(spark, path, parallel=True)
    kept, _ = labels.reduce_corpus(rows)
    return kept.select("id", "domain", "orig_type", "type", F.md5("content").alias("content_md5"))


@register("csv_accounting", "WITH " + CORPUS_SQL + "," + SPLITS_SQL + """,
st AS (
  SELECT CASE WHEN c.orig_type = '' THEN 'excluded' WHEN s.split IN (1, 2) THEN 'ignored' ELSE 'included' END AS status
  FROM corpus c JOIN split_ids s ON c.id = s.id
  UNION ALL SELECT 'skipped' FROM corpus WHERE orig_type IN ('hate', 'junksci')
)
SELECT count(*) FILTER (WHERE status = 'included') AS included, count(*) FILTER (WHERE status = 'excluded') AS excluded,
       count(*) FILTER (WHERE status = 'ignored') AS ignored, count(*) FILTER (WHERE status = 'skipped') AS skipped
FROM st""")
def q_csv_accounting(spark, sf_dir):
    """Raw CSV with bad records landed in one pass, by status (S3, S4, P6):
    every hateful article stands in it a second time with an id that is no
    number, every junk article as a record of two columns."""
    c = tables.corpus(spark, sf_dir).withColumnRenamed("orig_type", "type")
    path = scratch_path(spark, "raw-csv")
    no_number = c.filter("type = 'hate'").withColumn("id", F.concat(F.lit("id "), "id"))
    FI.write_corpus_csv(c.withColumn("id", F.col("id").cast("string")).unionByName(no_number), f"{path}/whole")
    FI.write_corpus_csv(c.filter("type = 'junksci'"), f"{path}/short", FI.CORPUS_COLUMNS[:2])
    held_out = splits.split_ids(tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))).filter("split IN (1, 2)")
    _, account = FI.land_corpus_csv(spark, f"{path}/*", scratch_path(spark, "landed-csv"), held_out)
    return account


@register("statements_tsv", r"""
SELECT row_number() OVER (ORDER BY d.doc_id) - 1 AS id,
       CASE WHEN l.doc_id IS NULL THEN 'half-true' WHEN l.toxic = 1 THEN 'pants-fire' WHEN l.quality = 0 THEN 'false' ELSE 'true' END AS orig_type,
       md5(regexp_replace(d.text, '[\t\r\n]', ' ', 'g')) AS content_md5
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_statements_tsv(spark, sf_dir):
    """Second corpus written as TSV files and read back (S5): the ids are the
    record numbers in file order, over several files."""
    path = scratch_path(spark, "statements-tsv")
    FI.write_statements_tsv(tables.statements(spark, sf_dir), path,
                            files=max(4, tables.text_partitions(tables.read_table(spark, sf_dir, "documents"))))
    return FI.read_statements_tsv(spark, path).select("id", "orig_type", F.md5("content").alias("content_md5"))


@register("literal_map_roundtrip", "WITH " + DOC_TERMS_SQL + " SELECT id, word, n FROM dterms")
def q_literal_map_roundtrip(spark, sf_dir):
    """Bags stored as dict text and parsed back."""
    bags = FE.bag_map(FE.terms(doc_corpus(spark, sf_dir), ("id",), stem=False))
    text = bags.select("id", FI.format_literal_map("words").alias("words_text"))
    parsed = text.select("id", FI.parse_literal_map("words_text").alias("words"))
    # a plain explode has Spark test the map's size first, which parses each text twice
    return parsed.select("id", F.explode_outer("words").alias("word", "n")).filter("word IS NOT NULL")


# ------------------------------------------------------------------ streaming


def documents_glob(sf_dir: str) -> str:
    """The documents table for a file stream: a pattern that matches its path
    alone, since a stream takes a plain path only if it is a folder."""
    return f"{sf_dir.rstrip('/')}/documents.parque[t]"


@register("stream_lexicon_scores", "WITH " + LEX_SQL + """
SELECT id, type, split, round(score, 6) AS score FROM scores""")
def q_stream_lexicon_scores(spark, sf_dir):
    """Lexicon scoring of the validation and test articles as a
    Structured Streaming job: the documents table read as a file stream,
    joined to the (static) evaluation ids, scored per micro-batch with
    ``foreachBatch`` into a Parquet sink, run to completion."""
    lex = fitted_lexicon(spark, sf_dir)
    ev = deduped_split_corpus(spark, sf_dir).filter(F.col("split").isin(PLAN.test, PLAN.val)) \
        .select("id", "type", "split")
    schema = tables.read_table(spark, sf_dir, "documents").schema
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(documents_glob(sf_dir))
    stream = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("content")).join(ev, "id")
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    q = SS.start_scoring(stream, lex, sink, ckpt, once=True)
    q.awaitTermination()
    return spark.read.parquet(sink).select("id", "type", "split", F.round("score", 6).alias("score"))


NB_SQL = "WITH " + TRAIN_SQL + cut_sql(0.5, 0.05) + """,
tbags AS (SELECT id, word, n FROM terms WHERE word IN (SELECT word FROM vocab)),
t1 AS (SELECT id, type FROM train WHERE split IN (3, 4, 5, 6, 7)),
t2 AS (SELECT id, type FROM train WHERE split IN (8, 9, 10)),
feat AS (SELECT DISTINCT b.word FROM tbags b JOIN t1 ON b.id = t1.id),
nf AS (SELECT count(*) AS v FROM feat),
classes AS (SELECT 'fake' AS type UNION ALL SELECT 'reliable'),
docs AS (SELECT c.type, count(t1.id) AS n_c FROM classes c LEFT JOIN t1 ON t1.type = c.type GROUP BY c.type),
ndocs AS (SELECT count(*) AS n FROM t1),
ncj AS (SELECT t1.type, b.word, sum(b.n) AS n FROM tbags b JOIN t1 ON b.id = t1.id GROUP BY t1.type, b.word),
tot AS (SELECT c.type, coalesce(sum(ncj.n), 0) AS total FROM classes c LEFT JOIN ncj ON ncj.type = c.type
        GROUP BY c.type),
theta AS (
  SELECT c.type, f.word, ln(coalesce(ncj.n, 0) + 1.0) - ln(tot.total + nf.v * 1.0) AS th
  FROM classes c CROSS JOIN feat f JOIN tot ON tot.type = c.type CROSS JOIN nf
  LEFT JOIN ncj ON ncj.type = c.type AND ncj.word = f.word
),
prior AS (SELECT d.type, ln(d.n_c + 1.0) - ln(nd.n + 2.0) AS pr FROM docs d, ndocs nd),
raw AS (
  SELECT t2.id, t2.type AS label, c.type AS cls,
         (SELECT pr FROM prior p WHERE p.type = c.type)
           + coalesce(sum(b.n * th.th), 0) AS r
  FROM t2 CROSS JOIN classes c
  LEFT JOIN tbags b ON b.id = t2.id
  LEFT JOIN theta th ON th.type = c.type AND th.word = b.word
  GROUP BY t2.id, t2.type, c.type
)
SELECT id, label AS type,
       round(tanh((max(r) FILTER (WHERE cls = 'reliable') - max(r) FILTER (WHERE cls = 'fake')) / 2), 6)
         AS score
FROM raw GROUP BY id, label"""


@register("nb_multinomial_exact", NB_SQL)
def q_nb_multinomial_exact(spark, sf_dir):
    """Multinomial naive Bayes (M1, M5, M9) on unstemmed bags, fitted on
    training set 1 and scoring set 2; P(reliable) - P(fake) from Spark's
    smoothed prior and class-conditional word probabilities."""
    mi = MD.model_inputs(tables.corpus(spark, sf_dir), PLAN, stem=False,
                         narrow=tables.corpus(spark, sf_dir, distribute=False,
                                              text_key=dedup.prefix_digest))
    target = mi.bags.filter(F.col("trn_split") == 2)
    return MD.base_scores(mi, "multi_nb", target).select(
        "id", "type", F.round("score", 6).alias("score"))


@register("row_cap", "WITH " + CORPUS_SQL + " SELECT id, orig_type FROM corpus ORDER BY id LIMIT 100")
def q_row_cap(spark, sf_dir):
    """Row cap (S2): the first 100 articles in id order -- the cap is the
    feature here."""
    return FI.row_cap(tables.corpus(spark, sf_dir, distribute=False), 100).select("id", "orig_type")


@register("shortened", "WITH " + KEPT_SQL + " SELECT id, left(coalesce(content, ''), 500) AS shortened FROM kept")
def q_shortened(spark, sf_dir):
    """Shortened corpus (P5): (id, first 500 characters)."""
    kept = kept_corpus(spark, sf_dir, distribute=False)
    return kept.select("id", dedup.prefix("content").alias("shortened"))


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """Every base model fitted on training set 1, scored on the validation
    split and evaluated in one aggregate keyed by model (M11, M14, A13,
    A14)."""
    mi = _inputs(spark, sf_dir)
    val = MD.eval_bags(mi, PLAN.val)
    longs = MD.scores_of(MD.fit_all(mi), val)
    return metric_columns(EV.evaluate(longs, "score", "type", ["model"]), ["model"])


CNB_SQL = NB_SQL[:NB_SQL.index("prior AS (")] + """
tj AS (SELECT word, sum(n) AS t FROM ncj GROUP BY word),
tall AS (SELECT sum(total) AS t FROM tot),
ctheta AS (
  SELECT c.type, f.word,
         -(ln(coalesce(tj.t, 0) - coalesce(ncj.n, 0) + 1.0) - ln(tall.t - tot.total + nf.v * 1.0)) AS th
  FROM classes c CROSS JOIN feat f JOIN tot ON tot.type = c.type CROSS JOIN nf CROSS JOIN tall
  LEFT JOIN ncj ON ncj.type = c.type AND ncj.word = f.word
  LEFT JOIN tj ON tj.word = f.word
),
raw AS (
  SELECT t2.id, t2.type AS label, c.type AS cls, coalesce(sum(b.n * th.th), 0) AS r
  FROM t2 CROSS JOIN classes c
  LEFT JOIN tbags b ON b.id = t2.id
  LEFT JOIN ctheta th ON th.type = c.type AND th.word = b.word
  GROUP BY t2.id, t2.type, c.type
)
SELECT id, label AS type,
       round(tanh((max(r) FILTER (WHERE cls = 'reliable') - max(r) FILTER (WHERE cls = 'fake')) / 2), 6)
         AS score
FROM raw GROUP BY id, label"""


@register("nb_complement_exact", CNB_SQL)
def q_nb_complement_exact(spark, sf_dir):
    """Complement naive Bayes (M1, M6, M9) on unstemmed bags, fitted on
    training set 1 and scoring set 2: weights from the other class's
    counts, no prior in the score."""
    mi = MD.model_inputs(tables.corpus(spark, sf_dir), PLAN, stem=False,
                         narrow=tables.corpus(spark, sf_dir, distribute=False,
                                              text_key=dedup.prefix_digest))
    target = mi.bags.filter(F.col("trn_split") == 2)
    return MD.base_scores(mi, "compl_nb", target).select(
        "id", "type", F.round("score", 6).alias("score"))


def _unstemmed_inputs(spark, sf_dir):
    return MD.model_inputs(tables.corpus(spark, sf_dir), PLAN, stem=False,
                           narrow=tables.corpus(spark, sf_dir, distribute=False, text_key=dedup.prefix_digest))


# the same naive Bayes models on stems, registered above
for _name, _sql in (("nb_multinomial", NB_SQL), ("nb_complement", CNB_SQL)):
    REGISTRY[_name].sql = stemmed_sql(_sql)


@register("saved_scores", NB_SQL)
def q_saved_scores(spark, sf_dir):
    """A model saved as a PipelineModel and read again by its path scores set 2
    without training (S13, M11): the same scores as the fitted one's."""
    mi = _unstemmed_inputs(spark, sf_dir)
    path = scratch_path(spark, "saved-model")
    PipelineModel([MD.fit_base(mi, "multi_nb")]).write().overwrite().save(path)
    scored = PipelineModel.load(path).transform(MD.training_set(mi, 2))
    return scored.select("id", "type", F.round("score", 6).alias("score"))


GRADIENT_SQL = NB_SQL[:NB_SQL.index("nf AS (")].rstrip().rstrip(",") + """
SELECT word, CAST(0 AS DOUBLE) AS slope FROM feat UNION ALL SELECT NULL, CAST(0 AS DOUBLE)"""


def _optimum_query(name: str, slope, penalised_bias: bool):
    def q(spark, sf_dir):
        mi = _unstemmed_inputs(spark, sf_dir)
        rows = MD.training_set(mi, 1).select("id", "type", "words")
        model = MD.fit_base(mi, name)
        y = F.when(F.col("type") == "reliable", 1.0).otherwise(-1.0)
        sloped = model.margins(rows).select("words", (slope(y * F.col("margin")) * y).alias("s"))
        by_word = (sloped.select(F.explode("words").alias("word", "n"), "s").groupBy("word").agg(F.sum(F.col("n") * F.col("s")).alias("g"))
                   .join(model.tables["weights"], "word", "left").select("word", (F.col("g") + F.coalesce("w", F.lit(0.0))).alias("g")))
        bias = sloped.agg((F.sum("s") + F.lit(model.facts["bias"] * penalised_bias)).alias("g")).select(F.lit(None).cast("string").alias("word"), "g")
        return by_word.unionByName(bias).select("word", F.round(F.abs("g"), 4).alias("slope"))
    q.__doc__ = (f"Model '{name}' at its optimum (M3, M7): the objective's derivative for every word, and for the "
                 "intercept (null), from its weights and the bags alone; all 0, so the one minimum is found.")
    return q


register("logreg_optimum", GRADIENT_SQL)(_optimum_query("linear", lambda z: -1.0 / (1.0 + F.exp(z)), False))
register("svm_optimum", GRADIENT_SQL)(_optimum_query("svm", lambda z: -2.0 * F.greatest(1.0 - z, F.lit(0.0)), True))


def nb_counts_sql(model: str, sql: str, scored: str) -> str:
    """Confusion counts of a naive Bayes model on one training set."""
    body = sql[:sql.rindex("SELECT id, label AS type")]
    if scored == "train1":  # score the rows that it was fitted on
        body = body.replace("FROM t2 CROSS JOIN classes", "FROM t1 AS t2 CROSS JOIN classes")
    return f"""SELECT * FROM ({body}, p AS (
  SELECT label, CASE WHEN max(r) FILTER (WHERE cls = 'reliable') < max(r) FILTER (WHERE cls = 'fake') THEN 'fake'
                     ELSE 'reliable' END AS pred FROM raw GROUP BY id, label)
SELECT '{scored}' AS dataset, '{model}' AS model,
       count(*) FILTER (WHERE pred = 'fake' AND label = 'fake') AS tp, count(*) FILTER (WHERE pred = 'fake' AND label <> 'fake') AS fp,
       count(*) FILTER (WHERE pred <> 'fake' AND label = 'reliable') AS tn, count(*) FILTER (WHERE pred <> 'fake' AND label <> 'reliable') AS fn,
       count(*) AS n, round((count(*) FILTER (WHERE pred = label)) / count(*), 6) AS accuracy FROM p) x"""


@register("nb_train_test_metrics", " UNION ALL ".join(
    nb_counts_sql(m, sql, d) for m, sql in (("multi_nb", NB_SQL), ("compl_nb", CNB_SQL)) for d in ("train1", "train2")))
def q_nb_train_test_metrics(spark, sf_dir):
    """Matrix and accuracy of both naive Bayes models on the set that they were
    fitted on and on the other one, one row each (A15, M11)."""
    mi = _unstemmed_inputs(spark, sf_dir)
    fitted = MD.fit_all(mi, ("multi_nb", "compl_nb"))
    scored = MD.scores_of(fitted, mi.bags.filter("trn_split IN (1, 2)")).join(
        mi.bags.select("id", F.concat(F.lit("train"), "trn_split").alias("dataset")), "id")
    m = EV.evaluate(scored, "score", "type", ["dataset", "model"])
    return m.select("dataset", "model", "tp", "fp", "tn", "fn", "n", F.round("accuracy", 6).alias("accuracy"))


@register("stream_clean_labels", "WITH " + CORPUS_SQL + """
SELECT id, orig_type,
       CASE WHEN orig_type IN ('fake', 'bias', 'junksci', 'hate') THEN 'fake'
            WHEN orig_type = 'reliable' THEN 'reliable' END AS type,
       CASE WHEN orig_type IN ('satire','conspiracy','clickbait','unreliable','political',
                               'state','unknown','rumor','') THEN 'excluded'
            WHEN orig_type IN ('fake','bias','junksci','hate','reliable') THEN 'included'
            ELSE 'skipped' END AS status,
       """ + C.clean_sql("content") + """ AS clean
FROM corpus""")
def q_stream_clean_labels(spark, sf_dir):
    """Labelling and cleaning on a stream (P1, P2, F1 as a Structured
    Streaming projection): documents read as a file stream, left-joined
    to the static labels table, written to a Parquet sink and run to
    completion."""
    schema = tables.read_table(spark, sf_dir, "documents").schema
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(documents_glob(sf_dir))
    lab = tables.read_table(spark, sf_dir, "labels").select(
        "doc_id", "quality", "toxic", F.lit(True).alias("_has_label"))
    stream = docs.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        tables.orig_type_from_labels(F.col("_has_label"), F.col("quality"), F.col("toxic"))
        .alias("orig_type"),
        F.col("text").alias("content"))
    out = SS.label_stream(stream).select("id", "orig_type", "type", "status", "clean")
    sink, ckpt = scratch_path(spark, "stream-clean"), scratch_path(spark, "stream-clean-ckpt")
    q = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


STATEMENTS_SQL = """,
st AS (
  SELECT d.doc_id AS id, d.text AS content,
         CASE WHEN l.doc_id IS NULL THEN 'half-true' WHEN l.toxic = 1 THEN 'pants-fire'
              WHEN l.quality = 0 THEN 'false' ELSE 'true' END AS orig_type
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
stk AS (
  SELECT id, CASE WHEN orig_type IN ('true', 'mostly-true') THEN 'reliable' ELSE 'fake' END AS type,
         content
  FROM st WHERE orig_type IN ('true', 'mostly-true', 'false', 'pants-fire')
),
sterms AS (
  SELECT id, word, CAST(count(*) AS INTEGER) AS n FROM (
    SELECT id, unnest(""" + TOKS_EXPR + """) AS word FROM stk) GROUP BY id, word
),
scores2 AS (
  SELECT s.id, s.type,
         coalesce(sum(t.n * l.idf_weight * l.fakeness_score) / (0.1 + sum(t.n * l.idf_weight)), 0.0)
           AS score
  FROM stk s LEFT JOIN sterms t ON s.id = t.id LEFT JOIN lex l ON t.word = l.word
  GROUP BY s.id, s.type
),
lab2 AS (SELECT *, CASE WHEN isnan(score) THEN NULL WHEN score < 0 THEN 'fake' ELSE 'reliable' END
           AS pred FROM scores2)"""


@register("statements_evaluate", "WITH " + LEX_SQL + STATEMENTS_SQL + """
SELECT count(*) FILTER (WHERE pred = 'fake' AND type = 'fake') AS tp,
       count(*) FILTER (WHERE pred = 'fake' AND type <> 'fake') AS fp,
       count(*) FILTER (WHERE coalesce(pred, '') <> 'fake' AND type = 'reliable') AS tn,
       count(*) FILTER (WHERE coalesce(pred, '') <> 'fake' AND type <> 'reliable') AS fn
FROM lab2""")
def q_statements_evaluate(spark, sf_dir):
    """Lexicon model scored and evaluated on the second corpus (C4, M14
    third dataset, A13): confusion counts."""
    lex = fitted_lexicon(spark, sf_dir)
    st = labels.statement_labels(tables.statements(spark, sf_dir))
    long = FE.terms(st.select("id", "content"), ("id",), stem=False)
    scored = LX.score_lexicon(long, lex, st.select("id", "type"))
    return EV.confusion(scored.withColumn("pred", EV.to_label("score")))


@register("box_stats_bag_size", "WITH " + SUMMARY_SQL + """,
sizes AS (
  SELECT s.id, s.orig_type, CAST(count(v.word) AS DOUBLE) AS bow_len
  FROM summary s LEFT JOIN vterms v ON s.id = v.id GROUP BY s.id, s.orig_type
),
q AS (
  SELECT orig_type, count(*) AS n, avg(bow_len) AS mean, quantile_cont(bow_len, 0.25) AS q1,
         quantile_cont(bow_len, 0.5) AS median, quantile_cont(bow_len, 0.75) AS q3
  FROM sizes GROUP BY orig_type
)
SELECT q.orig_type, q.n, round(q.mean, 6) AS mean, round(q.q1, 6) AS q1,
       round(q.median, 6) AS median, round(q.q3, 6) AS q3,
       min(s.bow_len) FILTER (WHERE s.bow_len >= q.q1 - (q.q3 - q.q1)) AS whisker_low,
       max(s.bow_len) FILTER (WHERE s.bow_len <= q.q3 + (q.q3 - q.q1)) AS whisker_high
FROM q JOIN sizes s ON q.orig_type = s.orig_type GROUP BY ALL""")
def q_box_stats_bag_size(spark, sf_dir):
    """Box-plot summary and mean of bag size (distinct vocabulary words)
    per source label (A16, A17, F11)."""
    vocab = V.cut(train_wide(spark, sf_dir), 0.5, 0.05)
    s = SU.summarize(split_corpus(spark, sf_dir), vocab, PLAN, stem=False)
    b = PR.box_stats(s.withColumn("bow_len", F.size("words")), "bow_len", "orig_type", whis=1.0)
    return b.select("orig_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "q1", "median", "q3")],
                    "whisker_low", "whisker_high")



@register("word_table_roundtrip", "WITH " + TRAIN_SQL + " SELECT * FROM wide")
def q_word_table_roundtrip(spark, sf_dir):
    """Word table sink and source (S10, S11, S6): counts and the article
    count written as tables (a second write-if-absent leaves them alone),
    read back and widened."""
    long = FE.terms(train_corpus(spark, sf_dir), ("type", "id"), stem=False)
    counts = V.word_counts(long)
    path = scratch_path(spark, "word-table")
    FI.write_word_table(counts, train_count(spark, sf_dir), path)
    FI.write_if_absent(counts.limit(0), f"{path}/words")
    return V.to_wide(spark.read.parquet(f"{path}/words"))


@register("whole_run_metrics")
def q_whole_run_metrics(spark, sf_dir):
    """The whole run (C6): reduce, dedup, split, word table, cut, summary,
    evaluation sets, lexicon, six base models and the meta model, with
    Parquet between stages, predictions partitioned by model (S12) and
    metrics written as JSON (S14); evaluated on validation, test and the
    second corpus."""
    from sifter.plans import jobs
    cfg = jobs.PipelineConfig(out=scratch_path(spark, "whole-run"), stem=True)
    return jobs.run_pipeline(
        spark, tables.corpus(spark, sf_dir), cfg,
        narrow=tables.corpus(spark, sf_dir, distribute=False, text_key=dedup.prefix_digest),
        statements=tables.statements(spark, sf_dir))



@register("lexicon_scores_stemmed", "WITH " + stemmed_sql(LEX_SQL) + "," + EVAL_METRICS_SQL)
def q_lexicon_scores_stemmed(spark, sf_dir):
    """The lexicon model as the reference runs it (A6-A12 on stems): a
    stemmed, cut vocabulary over all training splits, scoring stemmed
    validation and test bags, evaluated in one pass (M14)."""
    s = lexicon_scored(spark, sf_dir, stem=True).withColumn(
        "dataset", F.when(F.col("split") == PLAN.test, "test").otherwise("validation"))
    return metric_columns(EV.evaluate(s, "score", "type", ["dataset"]), ["dataset"])
