"""Text cleaning and tokenising as Spark column expressions.

Our cleaning contract (fixed order):

  currency -> ASCII fold -> URL -> e-mail -> phone -> number -> digit
  -> emoji -> punctuation -> any non-ASCII run to one space
  -> whitespace collapse -> lower -> trim

Every step is ``translate``/``replace``/``regexp_replace``/``lower``, so
the chain stays inside whole-stage codegen and no Python worker runs.
The regexes use no look-around and no back-reference, and spell out
character classes instead of ``\\s``/``\\d``, so Java regex (Spark) and
RE2 (the DuckDB oracle) read them the same way.  ``clean_sql`` renders
the identical chain as DuckDB SQL.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------
# Default placeholders of the cleaning library the reference calls.
PLACEHOLDERS = {"url": "<URL>", "email": "<EMAIL>", "phone": "<PHONE>",
                "number": "<NUMBER>", "digit": "0", "currency": "<CUR>"}
# Placeholders of the reference's notebook variant.
VISIBLE_PLACEHOLDERS = {"url": "<URL>", "email": "<EMAIL>", "phone": "<PHONE>",
                        "number": "<NUM>", "digit": "0", "currency": "<CUR>"}
# Letters that have no decomposition, folded one for one.
FOLD_STROKES = (("Ø", "O"), ("ø", "o"), ("Đ", "D"), ("đ", "d"), ("Ł", "L"), ("ł", "l"), ("Ħ", "H"), ("ħ", "h"),
                ("Ŧ", "T"), ("ŧ", "t"), ("ı", "i"), ("Ð", "D"), ("ð", "d"))
# Letters folded to several letters (``replace``).
FOLD_MULTI = (("ß", "ss"), ("ẞ", "SS"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"),
              ("þ", "th"), ("Þ", "Th"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))
CURRENCY_RE = "[$¢£¤¥֏؋৲৳৻૱௹฿៛₠-₿﷼﹩＄￠￡￥￦]"
# The same characters for Java alone: those beyond Latin-1 stand behind one test of
# their range, where a plain class tries them one by one on every character.
CURRENCY_CLASS = "[" + CURRENCY_RE[1:6] + "[\\x{58F}-\\x{FFE6}&&[" + CURRENCY_RE[6:-1] + "]]]"
URL_RE = r"(?:https?://|ftp://|www\.)[^ \t\n\r\f<>\"]+"
EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
PHONE_RE = (r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?"
            r"[0-9]{3}[ .-]?[0-9]{4}")
NUMBER_RE = r"[0-9]+(?:[.,][0-9]+)*"
DIGIT_RE = r"[0-9]"
EMOJI_RE = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0E}\x{FE0F}\x{200D}]"
PUNCT_RE = r"\p{P}"
NON_ASCII_RE = r"[^\x00-\x7F]+"
SPACE_RE = r"[ \t\n\r\f\x0B]+"
# --- end of fixed values -------------------------------------------------

def _decomposed() -> dict[str, str]:
    """Letters of the Latin blocks whose canonical decomposition is an ASCII
    letter with marks, with that letter."""
    blocks = (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))
    bases = {chr(c): "".join(x for x in unicodedata.normalize("NFD", chr(c)) if not unicodedata.combining(x))
             for c in blocks}
    return {c: b for c, b in bases.items() if len(b) == 1 and b.isascii() and b.isalpha()}


# Letters folded one for one (``translate``).
_FOLD = _decomposed() | dict(FOLD_STROKES)
FOLD_FROM, FOLD_TO = "".join(_FOLD), "".join(_FOLD.values())


@dataclass(frozen=True)
class CleanOptions:
    urls: bool = True
    emails: bool = True
    phones: bool = True
    numbers: bool = True
    digits: bool = True
    currency: bool = True
    emoji: bool = True
    punct: bool = True
    placeholders: tuple = tuple(PLACEHOLDERS.items())

    def ph(self, key: str) -> str:
        return dict(self.placeholders)[key]


DEFAULT = CleanOptions()
# the notebook variant: only punctuation removal is switched on
LIGHT = CleanOptions(urls=False, emails=False, phones=False, numbers=False, digits=False,
                     currency=False, emoji=False,
                     placeholders=tuple(VISIBLE_PLACEHOLDERS.items()))


def _steps(opts: CleanOptions):
    """(kind, a, b, guard) steps; shared by the Spark and the SQL rendering.

    ``guard`` is a literal substring without which the step cannot match;
    Spark skips the regex for such rows (a cheap ``instr``), SQL ignores it.
    Merged passes are exact rewrites of the contract: numbers leave no
    digit behind, so the digit step runs only when numbers are kept;
    emoji and punctuation are both deleted, so they share one class;
    non-ASCII runs and whitespace runs both end as one space.
    """
    steps = []
    if opts.currency:
        steps.append(("re", CURRENCY_RE, opts.ph("currency"), None))
    steps.append(("translate", FOLD_FROM, FOLD_TO, None))
    for a, b in FOLD_MULTI:
        steps.append(("replace", a, b, None))
    if opts.urls:
        steps.append(("re", URL_RE, opts.ph("url"), ("://", "www.")))
    if opts.emails:
        steps.append(("re", EMAIL_RE, opts.ph("email"), ("@",)))
    if opts.phones:
        steps.append(("re", PHONE_RE, opts.ph("phone"), None))
    if opts.numbers:
        steps.append(("re", NUMBER_RE, opts.ph("number"), None))
    elif opts.digits:
        steps.append(("re", DIGIT_RE, opts.ph("digit"), None))
    drop = [r for on, r in ((opts.emoji, EMOJI_RE[1:-1]), (opts.punct, PUNCT_RE)) if on]
    if drop:
        steps.append(("re", "[" + "".join(drop) + "]", "", None))
    steps.append(("re", "(?:" + NON_ASCII_RE + "|" + SPACE_RE + ")+", " ", None))
    steps.append(("lower", None, None, None))
    steps.append(("trim", None, None, None))
    return steps


def _apply(c: Column, kind: str, a, b) -> Column:
    if kind == "re":
        return F.regexp_replace(c, a, b)
    if kind == "translate":
        return F.translate(c, a, b)
    if kind == "replace":
        return F.replace(c, F.lit(a), F.lit(b))
    if kind == "lower":
        return F.lower(c)
    return F.trim(c)


def _once(c: Column, then) -> Column:
    """``then(c)`` with ``c`` computed once, however often ``then`` names it."""
    return F.transform(F.array(c), then)[0]


def _where(x: Column, test: Column, kind: str, a, b) -> Column:
    return F.when(test, _apply(x, kind, a, b)).otherwise(x)


def clean_text(col: Column | str, opts: CleanOptions = DEFAULT) -> Column:
    """Cleaned text as one column expression; null text cleans to ''.

    A step that needs a literal, a digit or a letter beyond ASCII is skipped for
    texts without one, which it can't change; each step's text is computed once
    for the test and the step."""
    c = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    steps, beyond = _steps(opts), ("translate", "replace")
    ascii_only = lambda x: F.octet_length(x) == F.length(x)
    digits = [(k, a, b) for k, a, b, _ in steps if a in (PHONE_RE, NUMBER_RE, DIGIT_RE)]
    for i, (kind, a, b, guard) in enumerate(steps):
        if a == CURRENCY_RE:
            c = _once(c, lambda x: F.when(~ascii_only(x) | (F.instr(x, "$") > 0), F.regexp_replace(x, CURRENCY_CLASS, b)).otherwise(x))
        elif kind in beyond:
            if steps[i - 1][0] not in beyond:  # the fold is a run of steps
                fold = [(k, y, z) for k, y, z, _ in steps if k in beyond]
                c = _once(c, lambda x: F.when(ascii_only(x), x).otherwise(_chain(x, fold)))
        elif guard:
            c = _once(c, lambda x: _where(x, reduce(lambda p, q: p | q, [F.instr(x, g) > 0 for g in guard]), kind, a, b))
        elif digits and (kind, a, b) in digits:
            if (kind, a, b) == digits[0]:
                c = _once(c, lambda x: F.when(x.rlike(DIGIT_RE), _chain(x, digits)).otherwise(x))
        else:
            c = _apply(c, kind, a, b)
    return c


def _chain(c: Column, steps) -> Column:
    return reduce(lambda x, step: _apply(x, *step), steps, c)


def with_clean(df: DataFrame, text_col: str, out_col: str = "clean",
               opts: CleanOptions = DEFAULT) -> DataFrame:
    """Add ``out_col`` = cleaned text."""
    return df.withColumn(out_col, clean_text(text_col, opts))


def tokenize(col: Column | str) -> Column:
    """Split cleaned text on spaces; no empty tokens."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_remove(F.split(c, " "), "")


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(expr: str, opts: CleanOptions = DEFAULT) -> str:
    """The same chain as DuckDB SQL over the text expression ``expr``."""
    c = f"coalesce({expr}, '')"
    for kind, a, b, _ in _steps(opts):
        if kind == "re":
            c = f"regexp_replace({c}, {_sql_lit(a)}, {_sql_lit(b)}, 'g')"
        elif kind == "translate":
            c = f"translate({c}, {_sql_lit(a)}, {_sql_lit(b)})"
        elif kind == "replace":
            c = f"replace({c}, {_sql_lit(a)}, {_sql_lit(b)})"
        elif kind == "lower":
            c = f"lower({c})"
        elif kind == "trim":
            c = f"trim({c})"
    return c


def tokens_sql(expr: str) -> str:
    return f"list_filter(string_split({expr}, ' '), lambda x: x <> '')"
