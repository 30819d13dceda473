"""Token counts, the filter audit and lexical search against brute force."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sifter.llm import filter_audit, lexical_search, token_count
from tests.llm.conftest import odd_rows

JSON = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -------------------------------------------------------------- token counts


def odd_texts():
    rnd = random.Random(7)
    points = [rnd.choice([rnd.randrange(1, 0xD800), rnd.randrange(0xE000, 0x110000)]) for _ in range(20_000)]
    texts = [r[1] or "" for r in odd_rows()] + ["a<|endoftext|>b <|endoftext|><|endoftext|> c<|endoftext", "²³¼ ǅΩ", " " * 999]
    texts += ["".join(map(chr, points[i:i + 40])) for i in range(0, len(points), 40)]
    texts += [chr(a) * 3 + "x" + chr(b) for a, b in token_count.SINCE_UNICODE_16]
    return texts + ["".join(rnd.choice("abcdeé ñ\n1!\x1c\x85\xa0²'st_") for _ in range(rnd.randint(0, 300))) for _ in range(200)]


def test_counts_equal_the_library():
    ours, theirs = token_count.Counter(token_count.load_merges(JSON)), Tokenizer.from_file(JSON)
    texts = odd_texts()
    expected = [len(e.ids) for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert [ours.count(t) for t in texts] == expected


def test_a_piece_loses_one_symbol_a_merge():
    symbols = tuple(range(256))
    a, b, c = b"abc"
    merges = token_count.Merges(symbols, {(a, b): (1, 300), (b, c): (0, 301), (300, 300): (2, 302)}, ())
    assert token_count.count_piece(b"", merges) == 0
    assert token_count.count_piece(b"abc", merges) == 2       # bc first, so ab can't be joined
    assert token_count.count_piece(b"abab", merges) == 1      # ab, ab, then both
    assert token_count.count_piece(b"ababab", merges) == 2    # the leftmost of equal pairs first


def test_a_word_of_a_million_letters():
    word = "ab" * 300_000
    ours = token_count.Counter(token_count.load_merges(JSON))
    assert ours.count(word) == len(Tokenizer.from_file(JSON).encode(word, add_special_tokens=False).ids)


def test_counting_goes_on_when_it_forgets(monkeypatch):
    monkeypatch.setattr(token_count, "KEPT_PIECES", 2)
    ours = token_count.Counter(token_count.load_merges(JSON))
    assert ours.count("one two three") == ours.count("one two three") == 3


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_count.load_merges(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts_of_odd_rows(spark, odd, none):
    theirs = Tokenizer.from_file(JSON)
    got = Counter(map(tuple, token_count.token_counts(odd, JSON, limit=20).collect()))
    expected = Counter()
    for r in odd_rows():
        n = len(theirs.encode(r[1] or "", add_special_tokens=False).ids)
        expected[r[0], len((r[1] or "").encode()), n, n > 20] += 1
    assert got == expected
    assert token_count.token_counts(none, JSON).collect() == []


# --------------------------------------------------------------------- audit


def test_galloping_merges(monkeypatch):
    rnd = random.Random(3)
    for step in (1, 2, 7, 4096):
        monkeypatch.setattr(filter_audit, "STEP", step)
        for _ in range(60):
            lists = [np.array(sorted(rnd.sample(range(rnd.choice([5, 60, 4000])), rnd.choice([0, 1, 4]))), np.int64)
                     for _ in range(rnd.randint(1, 5))]
            lists.append(np.array(sorted(rnd.sample(range(4000), rnd.randint(0, 900))), np.int64))
            a, b = lists[0], lists[-1]
            assert filter_audit.union(lists).tolist() == sorted(set().union(*map(set, map(np.ndarray.tolist, lists))))
            assert filter_audit.difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
            assert filter_audit.shared(a, b) == len(set(a.tolist()) & set(b.tolist()))
    ids = np.arange(0, 100_000, 3)
    for at, bound in ((0, -1), (0, 0), (5, 14), (5, 15), (7, 99_999), (10, 10**9), (len(ids), 5)):
        assert filter_audit.gallop(ids, at, bound) == max(at, int(np.searchsorted(ids, bound, "right")))
    assert filter_audit.union([]).tolist() == []


def brute_audit(docs, labels):
    fails = {}
    for i, (doc, text, part) in enumerate(docs):
        text = text or ""
        words = WORD.findall(text)
        smaller = doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in docs)
        fails[i] = {f for f, x in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in text) > 3 * len(text),
            any(c in "#$%&*|" for c in text), smaller)) if x}
    out = []
    for part in {p or "" for _, _, p in docs}:
        rows = [i for i, d in enumerate(docs) if (d[2] or "") == part]
        sums = Counter()
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = set(rows)
            for step, f in enumerate(order, 1):
                gone = {i for i in left if f in fails[i]}
                early = sum(f in fails[i] for i in rows) - len(gone)
                left -= gone
                sums[f] += len(gone)
                marked = [sum(docs[i][0] in labels[k] for i in gone) for k in ("good", "toxic")]
                lines.append(["".join(order), step, len(left), len(gone), early,
                              sum(fails[i] == {f} for i in rows), *marked, f])
        out += [(part, *line[:-1], sums[line[-1]]) for line in lines]
    return sorted(out)


def audit_rows():
    rnd = random.Random(11)
    rows = [(r[0], r[1], r[2]) for r in odd_rows()]
    texts = ["Some NICE text", "a b c d e " * 60, " ".join(f"w{i}" for i in range(250)), "# hash", None, "",
             " ".join(f"W{i}" for i in range(250)) + " $"]
    return rows + [(100 + i // 2, rnd.choice(texts), rnd.choice(["en", "fr", None, ""])) for i in range(60)]


@pytest.mark.parametrize("piece", [1 << 16, 4])
def test_audit_of_odd_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(filter_audit, "RANGE", piece)
    docs = audit_rows()
    marks = [(3, 1, 0), (3, 0, 1), (101, 1, 1), (110, 0, None), (None, 1, 1), (5, None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([(*d, "x", 1, "y") for d in docs],
                                  "doc_id long, text string, lang string, part string, row int, bits string").repartition(3)
    known = {"good": {i for i, q, _ in marks if q == 1 and i is not None},
             "toxic": {i for i, _, t in marks if t == 1 and i is not None}}
    got = sorted(tuple(r) for r in filter_audit.audit(frame, labels).collect())
    assert got == brute_audit(docs, known)


def test_audit_of_an_empty_table(none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, labels).collect() == []


# -------------------------------------------------------------------- search


def brute_search(docs, items, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bags = [(d, Counter(TERM.findall((t or "").translate(lower)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    total, n_docs = sum(sum(b.values()) for _, b in bags), len(bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // total
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t, k in Counter(TERM.findall((text or "").translate(lower))).items() if t in b)
            if s > 0:
                scores.append((-s, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(scores[:top], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "w1 w2 W3 w3 w399 unheard"), (2, "日本 ß the"), (3, None), (4, ""), (4, "one two"), (4, "one two"),
         (None, "Three small words of five"), (6, " ".join(f"w{i}" for i in range(400)))]


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 3, "bundle": 2}, {"block_bytes": 500, "owners": 1}, {"slots": 64}])
def test_search_of_odd_rows(spark, odd, monkeypatch, sizes):
    monkeypatch.setattr(lexical_search, "BLOCKS_A_COPY", 2)
    items = spark.createDataFrame([(*i, "x", 0) for i in ITEMS], "item_id long, text string, term string, rank int").repartition(2)
    got = lexical_search.search(odd, items, **sizes).select("item_id", "rank", "doc_id", "score")
    expected = brute_search([(r[0], r[1]) for r in odd_rows()], ITEMS)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected


def test_search_without_documents_or_items(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(none, items).collect() == []
    assert lexical_search.search(odd, items.limit(0)).collect() == []


def test_pruning_keeps_the_best():
    rnd = np.random.RandomState(0)
    for _ in range(200):
        scores, left = rnd.randint(0, 30, (4, 25)), rnd.randint(0, 10, 4)
        open_ = lexical_search.still_open(scores, left, 5)
        added = scores + rnd.randint(0, left.max() + 1, scores.shape) % (left[:, None] + 1)
        for row in range(4):
            best = np.sort(added[row])[::-1][:5]
            assert set(np.flatnonzero((added[row] >= best[-1]) & (scores[row] > 0))) <= set(np.flatnonzero(open_[row]))


def test_terms_are_those_of_the_pattern():
    texts = [r[1] for r in odd_rows()]
    n, row, term, times, _ = lexical_search.term_counts(pa.array(texts))
    found = defaultdict(Counter)
    for r, t, k in zip(row, term.to_pylist(), times):
        found[r][t] += k
    for i, t in enumerate(texts):
        expected = Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
        assert found[i] == expected and n[i] == sum(expected.values())


def test_queries_read_whole_tables(spark):
    from sifter.llm import queries
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    theirs = Tokenizer.from_file(JSON)
    counted = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op11_heap_token_counts"](spark, SF).collect()}
    assert counted == {d: (len(t.encode()), n := len(theirs.encode(t, add_special_tokens=False).ids), n > 512)
                       for d, t in texts.items()}
    found = queries.QUERIES["op13_term_pipeline_search"](spark, SF).filter(F.col("item_id") % 8 == 0).collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if r.item_id % 8 == 0]
    assert sorted(map(tuple, found), key=repr) == brute_search(list(texts.items()), items)
