import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sifter.operators import vocab as V


def loop_cut(totals, head, tail):
    """Position-by-position cut over totals sorted descending (brute
    force); None where the walk runs off the end."""
    f = sorted(totals, reverse=True)
    T = sum(f)
    i, acc = 0, 0
    try:
        while acc < head * T:
            acc += f[i]
            i += 1
        up = f[i]
        while f[i] == up:
            acc += f[i]
            i += 1
        upper_i = i
        while acc < (1 - tail) * T:
            acc += f[i]
            i += 1
        lo = f[i]
        while i < len(f) and f[i] == lo:
            i += 1
    except IndexError:
        return None
    return sorted(f[upper_i:i])


def wide_of(spark, totals):
    return spark.createDataFrame([(f"w{i}", t) for i, t in enumerate(totals)],
                                 "word string, freq_total long")


def kept(spark, totals, head, tail):
    return sorted(r.freq_total for r in V.cut(wide_of(spark, totals), head, tail).collect())


def test_cut_fixtures(spark):
    t = [10, 5, 5, 3, 1, 1]
    assert kept(spark, t, 0.4, 0.25) == [3]
    assert kept(spark, t, 0.4, 0.1) == [1, 1, 3]
    assert kept(spark, t, 0.0, 0.1) == [1, 1, 3, 5, 5]
    assert kept(spark, [4, 4], 0.5, 0.05) == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=30), min_size=3, max_size=40),
       st.sampled_from([0.1, 0.3, 0.5]), st.sampled_from([0.05, 0.2]))
def test_cut_equals_loop(spark, totals, head, tail):
    expect = loop_cut(totals, head, tail)
    if expect is not None:
        assert kept(spark, totals, head, tail) == expect


def test_cut_stats(spark):
    s = V.cut_stats(wide_of(spark, [10, 5, 5, 3, 1, 1]), 0.4, 0.25).first()
    assert (s.words_before, s.words_after, s.removed_head, s.removed_tail, s.min_level) == \
        (6, 1, 3, 2, 3)


def _long(spark, rows):
    return spark.createDataFrame(rows, "type string, id long, word string, n int")


def test_word_counts_and_wide(spark):
    long = _long(spark, [("fake", 1, "a", 2), ("fake", 2, "a", 1), ("reliable", 3, "b", 4)])
    wide = {r.word: r for r in V.to_wide(V.word_counts(long)).collect()}
    assert (wide["a"].fake_docs, wide["a"].fake_total, wide["a"].reliable_docs) == (2, 3, 0)
    assert (wide["b"].reliable_total, wide["b"].freq_total, wide["b"].fake_docs) == (4, 4, 0)


def test_stem_merge_modes(spark):
    # one article with 'run' once and 'runs' once; another with 'runs' twice
    long = _long(spark, [("fake", 1, "run", 1), ("fake", 1, "runs", 1), ("fake", 2, "runs", 2)])
    counts = V.word_counts(long)
    stems = spark.createDataFrame([("run", "run"), ("runs", "run")], "word string, stem string")
    s = V.merge_stems(counts, stems, "sum").first()
    assert (s.n_docs, s.n_total) == (3, 4)
    first = long.groupBy("word").agg({"id": "min"}).withColumnRenamed("min(id)", "first_pos")
    f = V.merge_stems(counts, stems, "first_form", first).first()
    assert (f.n_docs, f.n_total) == (1, 1)
    # exact mode: stem first, then count -- article 1 counts once
    exact = V.word_counts(_long(spark, [("fake", 1, "run", 2), ("fake", 2, "run", 2)])).first()
    assert (exact.n_docs, exact.n_total) == (2, 4)


def test_top_and_slice(spark):
    random.seed(1)
    rows = [("fake", i, f"w{i % 7}", i % 5 + 1) for i in range(60)]
    long = _long(spark, rows)
    top = [r.word for r in V.top_words(long, 3).collect()]
    tot = {}
    for _, _, w, n in rows:
        tot[w] = tot.get(w, 0) + n
    assert top == [w for w, _ in sorted(tot.items(), key=lambda x: (-x[1], x[0]))][:3]
    wide = V.to_wide(V.word_counts(long))
    sl = [r.word for r in V.word_slice(wide, 2, 3).collect()]
    assert sl == [w for w, _ in sorted(tot.items(), key=lambda x: (-x[1], x[0]))][2:5]
