import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, key int, n int, "
          "size int, kept string, row string, doc string, cut int, sid string, _doc string")


def sentence(rnd: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, copies, near copies, ties, repeated ids."""
    rnd = random.Random(5)
    base = sentence(rnd, 60)
    near = base.split()
    near[30] = "changed"
    long = "\n".join(sentence(rnd, 40, 5000) for _ in range(300))
    lines = [sentence(rnd, 8) for _ in range(6)]
    texts = [None, "", " \n\t", "one", "two words", "Three small words", base, base, base, " ".join(near), base.upper(),
             long, long + " end", "\n".join(lines), "\n".join([lines[3], "new line here of six words", *lines[:3]]),
             "same line of five words\n" * 7, "é日本 ß🙂 " * 30, "a" * 3000, "x\x0by\x1cz w", "the of and to " * 20]
    rows = [(i, t, "en", None if i % 5 == 4 else f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(3, base, "en", "s0"), (3, "one", "en", "s1"), (3, "one", "en", "s1"), (None, base, None, None),
             (None, None, None, None), (None, "a null id with words", None, "s2")]
    return [(*r, None if r[1] is None else len(r[1]), "id", 1, 2, 3, "kept", "row", "doc", 4, "sid", "_doc") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
