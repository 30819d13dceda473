"""The Porter stemmer in SQL, for the oracles of the stemmed queries.

Written from the published rules as a chain of CTEs, a step each, over a
table of distinct words; it shares nothing with ``functions.stem`` but the
rule lists, which are fixed values.  ``c`` is the word's string of
consonants and vowels, folded letter by letter.
"""

from __future__ import annotations

from sifter.functions.stem import IRREGULAR, STEP2, STEP3, STEP4

CLASSES = """list_reduce(list_prepend('', string_split(w, '')), lambda a, x: a || CASE
    WHEN x IN ('a', 'e', 'i', 'o', 'u') THEN 'V'
    WHEN x = 'y' AND a <> '' AND NOT ends_with(a, 'V') THEN 'V'
    ELSE 'C' END)"""


def measure(c: str) -> str:
    return f"((length({c}) - length(replace({c}, 'VC', ''))) // 2)"


def short_end(s: str, c: str) -> str:
    return (f"((length({s}) >= 3 AND right({c}, 3) = 'CVC' AND right({s}, 1) NOT IN ('w', 'x', 'y'))"
            f" OR (length({s}) = 2 AND {c} = 'VC'))")


def without(k: int, of: str = "w") -> str:
    return f"left({of}, greatest(length(w) - {k}, 0))"


def after_ending(s: str, c: str) -> str:
    """What follows the removal of -ed or -ing."""
    return f"""CASE
      WHEN ends_with({s}, 'at') OR ends_with({s}, 'bl') OR ends_with({s}, 'iz') THEN {s} || 'e'
      WHEN length({s}) >= 2 AND right({s}, 1) = left(right({s}, 2), 1) AND right({c}, 1) = 'C'
        THEN CASE WHEN right({s}, 1) IN ('l', 's', 'z') THEN {s} ELSE left({s}, length({s}) - 1) END
      WHEN {measure(c)} = 1 AND {short_end(s, c)} THEN {s} || 'e'
      ELSE {s} END"""


def suffixes(rules: list[tuple[str, str]], least: int) -> str:
    """The first suffix that matches decides."""
    cases = []
    for suffix, new in rules:
        counted = len(suffix) - 1 if suffix == "logi" else len(suffix)  # its l stays with the stem
        met = f"{measure(without(counted, 'c'))} > {least}"
        if suffix == "ion":
            met += f" AND right({without(3)}, 1) IN ('s', 't')"
        cases.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {met} THEN {without(len(suffix))} || '{new}' ELSE w END")
    return "CASE " + "\n      ".join(cases) + " ELSE w END"


STEPS = (
    """CASE WHEN length(w) = 4 AND ends_with(w, 'ies') THEN left(w, 3)
      WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, length(w) - 2)
      WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN left(w, length(w) - 1) ELSE w END""",
    f"""CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN left(w, 3) ELSE {without(2)} END
      WHEN ends_with(w, 'eed') THEN CASE WHEN {measure(without(3, 'c'))} > 0 THEN {without(1)} ELSE w END
      WHEN ends_with(w, 'ed') AND contains({without(2, 'c')}, 'V') THEN {after_ending(without(2), without(2, 'c'))}
      WHEN ends_with(w, 'ing') AND contains({without(3, 'c')}, 'V') THEN {after_ending(without(3), without(3, 'c'))}
      ELSE w END""",
    f"CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND right({without(1, 'c')}, 1) = 'C' THEN {without(1)} || 'i' ELSE w END",
    f"CASE WHEN ends_with(w, 'alli') AND {measure(without(4, 'c'))} > 0 THEN {without(4)} || 'al' ELSE w END",
    suffixes(STEP2, 0),
    suffixes(STEP3, 0),
    suffixes([(s, "") for s in STEP4], 1),
    f"""CASE WHEN ends_with(w, 'e') AND ({measure(without(1, 'c'))} > 1
        OR ({measure(without(1, 'c'))} = 1 AND NOT {short_end(without(1), without(1, 'c'))})) THEN {without(1)} ELSE w END""",
    f"CASE WHEN ends_with(w, 'll') AND {measure(without(1, 'c'))} > 1 THEN {without(1)} ELSE w END",
)


def stems_cte(words: str) -> str:
    """CTEs that end with ``stems`` (word, stem) for the words of a query with
    one column ``word``."""
    known = ", ".join(f"('{a}', '{b}')" for a, b in IRREGULAR.items())
    ctes = [f"porter_words AS ({words})",
            f"""porter_0 AS (
  SELECT p.word, coalesce(i.stem, p.word) AS w, i.stem IS NOT NULL OR length(p.word) <= 2 AS done
  FROM porter_words p LEFT JOIN (VALUES {known}) i(form, stem) ON p.word = i.form
)"""]
    for n, step in enumerate(STEPS, 1):
        ctes.append(f"""porter_{n} AS (
  SELECT word, CASE WHEN done THEN w ELSE {step} END AS w, done FROM (SELECT *, {CLASSES} AS c FROM porter_{n - 1}) x
)""")
    return ",\n".join(ctes) + f",\nstems AS (SELECT word, w AS stem FROM porter_{len(STEPS)})"
