"""Quality rules: a threshold table compiled into one Spark projection.

A rule bounds one measure of the text (its length, symbol, stop-word and
line ratios).  ``compile_rules`` turns the table into column expressions,
so a scan with one projection judges a document: no shuffle, no user
function, and only the text is read.

Repeated 5-word windows are found inside the row: windows are hashed to
64 bits, (hash bits, position) longs are sorted, neighbours with equal
bits are compared by their whole hashes, and the words that repeated
windows cover are counted once each -- n log n in the text's words.

Results defined for odd input: a null or empty text has zero counts and
fails the base rule; ratios without a denominator are 0; extra columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.columns import at, has_word, let, packed, position, same_bits, split_words, window_hashes

SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-Z\u00c0-\u00d6\u00d8-\u00de]"
WINDOW = 5

# Frequent function words of four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "at",
    "by", "this", "from", "or", "an", "not", "have",
    "der", "die", "das", "und", "in", "zu", "den", "mit", "von", "für", "ist", "im", "des", "auf", "ein", "eine",
    "dem", "nicht",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "pour", "dans", "est", "sur", "pas",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "para", "no", "es", "al",
)


@dataclass(frozen=True)
class Rule:
    """Keeps a document whose measure lies between the bounds, included;
    a text of fewer than ``from_words`` words is too short for the rule."""
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: Bounds well outside what clean prose has.
RULES = (
    Rule("n_words", least=10, most=10_000_000),
    Rule("mean_word_chars", least=2.0, most=20.0),
    Rule("symbols_per_word", most=0.25),
    Rule("stop_word_share", least=0.02, from_words=50),
    Rule("dup_line_share", most=0.5, from_words=50),
    Rule("capital_share", most=0.6, from_words=20),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def repeat_words(words: Column, k: int = WINDOW) -> Column:
    """Words in k-word windows that the text has twice or more."""
    hashes = window_hashes(F.transform(words, lambda w: F.xxhash64(w)), k)

    def covered(h: Column) -> Column:
        def alike(s: Column) -> Column:  # neighbours by leading bits
            return F.filter(s, lambda x, i: F.coalesce(same_bits(x, at(s, i - 1)), F.lit(False))
                            | F.coalesce(same_bits(x, at(s, i + 1)), F.lit(False)))

        def repeated(s: Column) -> Column:  # neighbours by whole hashes
            return F.filter(s, lambda x, i: F.coalesce(x["h"] == at(s, i - 1)["h"], F.lit(False))
                            | F.coalesce(x["h"] == at(s, i + 1)["h"], F.lit(False)))

        # most texts repeat no window and need no sort
        close = F.transform(let(packed(h), alike), lambda x: F.struct(at(h, position(x)).alias("h"), position(x).alias("p")))
        starts = F.sort_array(F.transform(let(F.sort_array(close), repeated), lambda x: x["p"]))
        total = let(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, i: F.least(F.lit(k), F.coalesce(p - at(s, i - 1), F.lit(k)))),
            F.lit(0), lambda acc, n: acc + n))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(total)

    return let(hashes, covered)


def measures(text: Column) -> dict[str, Column]:
    """The counts of one text, each a column."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), has_word)
    counts = let(split_words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words")))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return {"_counts": counts, "_lines": line_counts,
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "_capitals": F.regexp_count(text, F.lit(CAPITALS)).cast("long")}


def compile_rules(rules: tuple[Rule, ...], measured: dict[str, Column]) -> Column:
    """One condition that holds where every rule does."""
    kept = F.lit(True)
    for r in rules:
        short = measured["n_words"] < r.from_words
        if r.least is not None:
            kept &= short | (measured[r.measure] >= r.least)
        if r.most is not None:
            kept &= short | (measured[r.measure] <= r.most)
    return kept


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
          keep_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep_cols`` and, of every document: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, the measures of the rules, base_failed and
    kept."""
    m = measures(F.col(text_col))
    measured = docs.select(*[F.col(c) for c in keep_cols], *[v.alias(k) for k, v in m.items()])
    measured = measured.select(
        *keep_cols, "_counts.n_words", "_counts.word_chars", "n_symbols", "_lines.n_dup_lines", "_counts.n_repeat_words",
        _ratio(F.col("_counts.word_chars"), F.col("_counts.n_words")).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), F.col("_counts.n_words")).alias("symbols_per_word"),
        _ratio(F.col("_counts.n_stop_words"), F.col("_counts.n_words")).alias("stop_word_share"),
        _ratio(F.col("_lines.n_dup_lines"), F.col("_lines.n_lines")).alias("dup_line_share"),
        _ratio(F.col("_capitals"), F.col("_counts.word_chars")).alias("capital_share"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (measured.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & compile_rules(rules, {c: F.col(c) for c in measured.columns})))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return judge(rows, rules, "text", ("row",)).filter("kept").select("row.*")


_STOP_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), wins AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3]
                    || ' ' || words[i + 4] AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM t WHERE len(words) >= 5) x
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins) x WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, generate_series(0, 4) g(j) GROUP BY doc_id
), one_word AS (
  SELECT doc_id, unnest(words) AS w FROM t
), per_word AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars,
         count(*) FILTER (WHERE lower(w) IN ({_STOP_LIST})) AS n_stop
  FROM one_word GROUP BY doc_id
), one_line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t
), per_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM one_line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counted AS (
  SELECT t.doc_id, CAST(coalesce(w.n_words, 0) AS BIGINT) AS n_words,
         CAST(coalesce(w.word_chars, 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n_dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(w.n_stop, 0) AS n_stop, coalesce(l.n_lines, 0) AS n_lines,
         len(regexp_extract_all(t.text, '[A-ZÀ-ÖØ-Þ]')) AS n_capitals
  FROM t LEFT JOIN per_word w ON t.doc_id = w.doc_id LEFT JOIN per_line l ON t.doc_id = l.doc_id
         LEFT JOIN covered c ON t.doc_id = c.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND n_words BETWEEN 10 AND 10000000
       AND word_chars BETWEEN 2 * n_words AND 20 * n_words
       AND n_symbols <= 0.25 * n_words
       AND (n_words < 50 OR n_stop >= 0.02 * n_words)
       AND (n_words < 50 OR n_dup_lines <= 0.5 * n_lines)
       AND (n_words < 20 OR n_capitals <= 0.6 * word_chars) AS kept
FROM counted
"""
