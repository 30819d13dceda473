"""Porter stemming (Porter 1980, with the common NLTK-mode extensions) as
Spark column expressions.

Each step is a ``CASE`` over suffixes evaluated by the JVM; the Porter
conditions (measure ``m``, ``*v*``, ``*d``, ``*o``) are read off a
consonant/vowel string of the word ("C"/"V" per letter).  The CV string
of a stem is the prefix of the word's CV string, so one CV string per
step serves every condition of that step.  Between steps the word is
materialised in its own projection (``with_stem``), so Catalyst does
not inline a step's expression into every reference of the next one.

NLTK-mode extras: words of at most two letters are left alone; a fixed
list of irregular forms; ``-ies``/``-ied`` of four letters keep ``ie``;
``y -> i`` only after a consonant that is not the first letter; the
``alli``, ``fulli``, ``logi`` and ``bli`` rules; ``*o`` also for
two-letter stems.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (irregular forms of the NLTK-mode stemmer) -------------
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# Step 2 and 3 and 4 suffix rules, in the published order: (suffix, replacement).
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
         ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
         ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
         ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
         ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
         ("logi", "log")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
         ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
         "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]
# --- end of fixed values -------------------------------------------------


def _cut(w: Column, k: int) -> Column:
    """``w`` without its last ``k`` characters."""
    return w.substr(F.lit(1), F.length(w) - k)


def _pre(cv: Column, n: Column) -> Column:
    """First ``n`` letters of a CV string."""
    return cv.substr(F.lit(1), n)


def _measure(cvp: Column) -> Column:
    """Porter's m: the number of V->C transitions."""
    return (F.length(cvp) - F.length(F.replace(cvp, F.lit("VC"), F.lit("")))) / 2


def _has_vowel(cvp: Column) -> Column:
    return F.instr(cvp, "V") > 0


def _last(c: Column, k: int = 1) -> Column:
    """k-th character from the end."""
    return F.substring(c, -k, 1)


def _ends_cvc(stem: Column, cvp: Column) -> Column:
    n = F.length(stem)
    return (((n >= 3) & (F.substring(cvp, -3, 3) == "CVC") & ~_last(stem).isin("w", "x", "y"))
            | ((n == 2) & (cvp == "VC")))


def cv_string(w: Column) -> Column:
    """'V' for a vowel, 'C' for a consonant.  ``y`` is a consonant at the
    start or after a vowel, else a vowel.  Runs of ``yy`` need the letter
    before, so those (rare) words take an exact left fold."""
    s = F.regexp_replace(w, "[aeiou]", "V")
    s = F.regexp_replace(s, "^y|(?<=V)y", "C")
    s = F.regexp_replace(s, "y", "V")
    simple = F.regexp_replace(s, "[^VC]", "C")
    fold = F.aggregate(
        F.split(w, ""), F.lit(""),
        lambda acc, ch: F.concat(acc, F.when(ch.isin("a", "e", "i", "o", "u"), F.lit("V"))
                                 .when(ch == "y", F.when((acc == "") | acc.endswith("V"), F.lit("C"))
                                       .otherwise(F.lit("V")))
                                 .otherwise(F.lit("C"))))
    return F.when(F.instr(w, "yy") > 0, fold).otherwise(simple)


def _rule_list(w: Column, cv: Column, rules, cond, default: Column | None = None) -> Column:
    """First rule whose suffix matches decides: replace if ``cond`` holds
    on the stem, else keep the word."""
    expr = None
    for suf, rep in rules:
        k = len(suf)
        stem = _cut(w, k)
        cvp = _pre(cv, F.length(w) - k)
        ok = cond(suf, stem, cvp)
        val = F.when(ok, F.concat(stem, F.lit(rep))).otherwise(w)
        expr = (F.when(w.endswith(suf), val) if expr is None
                else expr.when(w.endswith(suf), val))
    return expr.otherwise(w if default is None else default)


def step1a(w: Column) -> Column:
    return (F.when((F.length(w) == 4) & w.endswith("ies"), _cut(w, 1))
            .when(w.endswith("sses"), _cut(w, 2))
            .when(w.endswith("ies"), _cut(w, 2))
            .when(w.endswith("ss"), w)
            .when(w.endswith("s"), _cut(w, 1))
            .otherwise(w))


def _step1b_tail(s: Column, cvs: Column) -> Column:
    """Rules after removing -ed/-ing from stem ``s`` (CV prefix ``cvs``)."""
    double = ((F.length(s) >= 2) & (_last(s) == _last(s, 2)) & (_last(cvs) == "C"))
    return (F.when(s.endswith("at") | s.endswith("bl") | s.endswith("iz"), F.concat(s, F.lit("e")))
            .when(double, F.when(~_last(s).isin("l", "s", "z"), _cut(s, 1)).otherwise(s))
            .when((_measure(cvs) == 1) & _ends_cvc(s, cvs), F.concat(s, F.lit("e")))
            .otherwise(s))


def step1b(w: Column, cv: Column) -> Column:
    n = F.length(w)
    s_ed, cv_ed = _cut(w, 2), _pre(cv, n - 2)
    s_ing, cv_ing = _cut(w, 3), _pre(cv, n - 3)
    return (F.when(w.endswith("ied"), F.when(n == 4, _cut(w, 1)).otherwise(_cut(w, 2)))
            .when(w.endswith("eed"), F.when(_measure(_pre(cv, n - 3)) > 0, _cut(w, 1)).otherwise(w))
            .when(w.endswith("ed") & _has_vowel(cv_ed), _step1b_tail(s_ed, cv_ed))
            .when(w.endswith("ing") & _has_vowel(cv_ing), _step1b_tail(s_ing, cv_ing))
            .otherwise(w))


def step1c(w: Column, cv: Column) -> Column:
    n = F.length(w)
    return (F.when(w.endswith("y") & (n > 2) & (_last(_pre(cv, n - 1)) == "C"),
                   F.concat(_cut(w, 1), F.lit("i")))
            .otherwise(w))


def _step2_rules(w: Column, cv: Column) -> Column:
    def cond(suf, stem, cvp):
        if suf == "logi":  # the 'l' stays with the stem for the measure
            return _measure(_pre(cv, F.length(w) - 3)) > 0
        return _measure(cvp) > 0
    return _rule_list(w, cv, STEP2, cond)


def step2(w: Column, cv: Column) -> Column:
    n = F.length(w)
    alli = w.endswith("alli") & (_measure(_pre(cv, n - 4)) > 0)
    w2 = F.concat(_cut(w, 4), F.lit("al"))
    cv2 = F.concat(_pre(cv, n - 4), F.lit("VC"))
    return F.when(alli, _step2_rules(w2, cv2)).otherwise(_step2_rules(w, cv))


def step3(w: Column, cv: Column) -> Column:
    return _rule_list(w, cv, STEP3, lambda suf, stem, cvp: _measure(cvp) > 0)


def step4(w: Column, cv: Column) -> Column:
    def cond(suf, stem, cvp):
        base = _measure(cvp) > 1
        if suf == "ion":
            return base & _last(stem).isin("s", "t")
        return base
    return _rule_list(w, cv, [(s, "") for s in STEP4], cond)


def step5(w: Column, cv: Column) -> Column:
    """5a (-e) then 5b (-ll)."""
    n = F.length(w)
    stem, cvp = _cut(w, 1), _pre(cv, n - 1)
    m = _measure(cvp)
    a = F.when(w.endswith("e") & ((m > 1) | ((m == 1) & ~_ends_cvc(stem, cvp))), stem).otherwise(w)
    # 5b on 5a's result ``a``, a prefix of ``w``: its CV string is a prefix of ``cv``
    return (F.when(a.endswith("ll") & (_measure(_pre(cv, F.length(a) - 1)) > 1), _cut(a, 1))
            .otherwise(a))


def with_stem(df: DataFrame, token_col: str, out_col: str = "stem") -> DataFrame:
    """Add ``out_col`` = Porter stem of ``token_col`` (lower-cased)."""
    w = "_w"
    cv = "_cv"
    irregular = F.create_map(*[F.lit(x) for kv in IRREGULAR.items() for x in kv])
    d = df.withColumn(w, F.lower(F.col(token_col)))
    d = d.withColumn("_short", (F.length(w) <= 2) | irregular[F.col(w)].isNotNull())
    d = d.withColumn(w, F.when(F.col("_short"), F.coalesce(irregular[F.col(w)], F.col(w)))
                     .otherwise(step1a(F.col(w))))
    for step in (step1b, step1c, step2, step3, step4, step5):
        d = d.withColumn(cv, cv_string(F.col(w)))
        d = d.withColumn(w, F.when(F.col("_short"), F.col(w)).otherwise(step(F.col(w), F.col(cv))))
    d = d.drop(cv, "_short")
    if out_col == token_col:
        d = d.drop(token_col)
    return d.withColumnRenamed(w, out_col)


def stem_table(tokens: DataFrame, token_col: str = "token",
               partitions: int | None = None) -> DataFrame:
    """(token, stem) for the distinct tokens of a token table.

    The distinct-token table is small in bytes but costly per row, so it
    is spread over a fixed number of tasks (default: the cluster's
    parallelism) before stemming; by bytes alone AQE would pack it into
    one or two partitions.
    """
    n = partitions or tokens.sparkSession.sparkContext.defaultParallelism
    distinct = tokens.select(token_col).distinct().repartition(n)
    return with_stem(distinct, token_col, "stem")
