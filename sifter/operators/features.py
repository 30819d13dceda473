"""Bags of words, per-article text features and vectorising.

Long form ``(id, word, n)`` is the working shape: it comes from
``explode`` + a hash aggregate on ``(id, word)``, whose key includes the
article id, so a frequent word never concentrates in one task.  The map
form ``MAP<STRING,INT>`` per article is built from it only where an
article-level column is the output (summary, evaluation sets), and is
bounded by the article's own length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions import clean as C
from sifter.functions.stem import stem_table
from sifter.operators import bitset
from sifter.session import checkpoint, stage


def with_tokens(df: DataFrame, text_col: str = "content", out_col: str = "tokens",
                opts: C.CleanOptions = C.DEFAULT) -> DataFrame:
    return df.withColumn(out_col, C.tokenize(C.clean_text(text_col, opts)))


def terms(df: DataFrame, id_cols: Sequence[str] = ("id",), text_col: str = "content",
          stem: bool = True, vocab: DataFrame | None = None,
          opts: C.CleanOptions = C.DEFAULT) -> DataFrame:
    """Long bag: (*id_cols, word, n) -- clean, tokenise, count per
    article, [stem], [keep only vocabulary words].

    Stemming runs once per distinct token (``stem_table``), joined back on
    the token and re-counted per stem: the stem table grows with the
    vocabulary, not with the text.  The stem table is written with a
    reliable checkpoint: that cuts its lineage, and it keeps the
    optimizer from pushing inferred filters through the stemming
    projections (each step reads the word many times, so substituting
    step into step grows the expression exponentially).  The per-article
    counts are persisted so the text is cleaned once for both uses.  AQE
    broadcasts the stem table when its measured size allows and splits
    hot-token partitions otherwise.
    """
    cleaned = C.with_clean(df.select(*id_cols, text_col), text_col, "_clean", opts)
    toks = cleaned.select(*id_cols, F.explode(C.tokenize("_clean")).alias("word"))
    counted = toks.groupBy(*id_cols, "word").agg(F.count(F.lit(1)).cast("int").alias("n"))
    if stem:
        counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
        stems = checkpoint(stem_table(counted.select("word"), "word"))
        counted = (counted.join(stems, "word")
                   .groupBy(*id_cols, F.col("stem").alias("word"))
                   .agg(F.sum("n").cast("int").alias("n")))
    return counted if vocab is None else in_vocabulary(counted, vocab)


def in_vocabulary(long: DataFrame, vocab: DataFrame) -> DataFrame:
    """The rows whose word is in the vocabulary (J6).  A bit set of its words
    drops most others inside the article, so the semi join on the word, which
    decides, exchanges the kept rows and the false hits only."""
    words = stage(vocab.select("word"), "vocabulary")
    return bitset.prefilter(long, "word", words).join(words, "word", "left_semi")


def bag_map(long: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, words MAP<STRING,INT>) from the long bag."""
    return long.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("words"))


def with_bags(df: DataFrame, id_col: str = "id", text_col: str = "content",
              stem: bool = True, vocab: DataFrame | None = None,
              long: DataFrame | None = None) -> DataFrame:
    """Add ``words`` to every article; articles without tokens get an
    empty map (left join on the unique id).  ``long``: an already
    computed long bag of these articles (then only the vocabulary filter
    is applied to it)."""
    if long is None:
        long = terms(df, (id_col,), text_col, stem, vocab)
    elif vocab is not None:
        long = in_vocabulary(long, vocab)
    bags = bag_map(long.select(id_col, "word", "n"), id_col)
    empty = F.create_map().cast("map<string,int>")
    return (df.join(bags, id_col, "left")
            .withColumn("words", F.coalesce(F.col("words"), empty)))


def bow_entropy(words: Column | str, length: Column | None = None) -> Column:
    """-sum(f/L * log2(f/L)) over the bag, written as sum(f/L * log2(L/f));
    L defaults to the token count.  L is the element of a list of one, so that
    it is computed once for a bag and not once for each of its words."""
    w = F.col(words) if isinstance(words, str) else words
    vals = F.map_values(w)
    L = length if length is not None else F.aggregate(vals, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(F.array(L), lambda l: F.aggregate(vals, F.lit(0.0), lambda a, f: a + (f / l) * F.log2(l / f)))[0]


def bag_size(words: Column | str) -> Column:
    """Distinct words of a bag."""
    w = F.col(words) if isinstance(words, str) else words
    return F.size(w)


def add_feature(words: Column | str, name: str, value: Column) -> Column:
    """Put a scalar under key ``name`` in the bag (new value wins); values
    become doubles."""
    w = F.col(words) if isinstance(words, str) else words
    as_double = F.transform_values(w, lambda k, v: v.cast("double"))
    kept = F.map_filter(as_double, lambda k, v: k != F.lit(name))
    return F.map_concat(kept, F.create_map(F.lit(name), value.cast("double")))


def row_map(df: DataFrame, cols: Sequence[str]) -> Column:
    """All given columns of a row as one map (column name -> value)."""
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("double"))])


def token_arrays(words: Column | str) -> Column:
    """The bag back as a token array (each word repeated n times), the
    input shape of ``CountVectorizerModel``."""
    w = F.col(words) if isinstance(words, str) else words
    return F.flatten(F.transform(F.map_entries(w), lambda e: F.array_repeat(e["key"], e["value"])))


def token_lengths(tokens: Column | str) -> tuple[Column, Column]:
    """(mean, median) token length of a token array; null for no tokens."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    lens = F.sort_array(F.transform(t, lambda x: F.length(x)))
    n = F.size(t)
    # total characters without a lambda: the tokens joined end to end
    mean = F.when(n > 0, F.length(F.array_join(t, "")) / n)
    lo = F.element_at(lens, ((n + 1) / 2).cast("int"))
    hi = F.element_at(lens, (n / 2).cast("int") + 1)
    median = F.when(n > 0, (lo + hi) / 2.0)
    return mean, median
