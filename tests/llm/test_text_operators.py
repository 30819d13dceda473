"""Operators that work on one document at a time, against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

from sifter.llm import bpe, order_minhash, pii_crf, quality_model, quality_rules, textkit, url_filter
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_words_and_shingles_cover_whole_texts():
    texts = [r[1] for r in odd_rows()]
    hashes, counts = textkit.words(pa.array(texts), lower=True)
    expected = [(t or "").encode().lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))
    flat_shingles, n = textkit.shingles(hashes, counts, 3)
    assert n.tolist() == [max(len(w) - 2, 1 if w else 0) for w in expected]
    assert len(flat_shingles) == n.sum()


def test_long_words_are_hashed_whole():
    a, b = "x" * (3 * textkit.SEGMENT), "x" * (3 * textkit.SEGMENT - 1) + "y"
    hashes, _ = textkit.words(pa.array([a, b, a]))
    assert hashes[0] == hashes[2] != hashes[1]


def test_bpe_equals_the_library():
    ranks = bpe.load_ranks(RANKS)
    ours = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    texts = [r[1] or "" for r in odd_rows()] + ["<|endoftext|>", "²³¼ ǅΩ", "ab" * 700, "日" * 400, " " * 999]
    texts += ["".join(rnd.choice("abcdeé ñ\n1!\x1c\x85\xa0²'st_") for _ in range(rnd.randint(0, 300))) for _ in range(200)]
    ids, at = ours.encode(texts)
    decoded, sizes = ours.decode(ids)
    ends = np.concatenate([[0], np.cumsum(sizes)])[at]
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == theirs.encode_ordinary(t)
        assert decoded[ends[i]:ends[i + 1]].tobytes() == t.encode()


def test_bpe_forgets_pieces_and_goes_on(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    ours = bpe.ByteBpe(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    first = ours.encode(["one two three four five six"])[0].tolist()
    assert ours.encode(["one two three four five six"])[0].tolist() == first


def test_bpe_round_trip_on_odd_rows(odd, none):
    rows = bpe.encode_decode(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((r[1] or "").encode() for r in odd_rows())
    assert bpe.encode_decode(none, RANKS, public_tokenizers.PATTERN).collect() == []


def test_quality_rules_counts(odd, none):
    judged = quality_rules.judge(odd, keep_cols=("doc_id", "text")).collect()
    assert len(judged) == len(odd_rows())
    for r in judged:
        text = r.text or ""
        words = WORD.findall(text)
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        twice = Counter(windows)
        covered = {i + j for i, w in enumerate(windows) if twice[w] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(none).collect() == []


def test_quality_rules_keep_whole_rows(odd):
    kept = quality_rules.keep(odd)
    assert kept.columns == odd.columns
    assert 0 < kept.count() < odd.count()


def test_windows_alike_by_leading_bits_only_are_not_repeats(spark, monkeypatch):
    monkeypatch.setattr("sifter.llm.columns.POSITION_BITS", 62)  # two bits of hash are left
    df = spark.createDataFrame([(1, " ".join(f"v{i}" for i in range(50)))], "doc_id long, text string")
    assert quality_rules.judge(df).first().n_repeat_words == 0


URLS = ["http://A.Example.com/en/x?y#z", "https://www.example.com/en/", "ftp://x.net/es/1", "http://net/fr/", None, "",
        "no scheme/en", "http://", "http://example.com", "http://notexample.com/en/", "http://q.org?a=1&b=2#f",
        "http://x.net/de/", "http://x.net/de/", "https://é.com/ß"]
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def judged_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fit = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
           and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fit, key=len) if fit else None


def test_url_rules_and_trees(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, label int")
    model = url_filter.fit(url_filter.labelled_by_rules(pages, RULES))
    rows = {r.page_id: r for r in url_filter.judge(pages, RULES, model).collect()}
    assert len(rows) == len(URLS)
    for i, u in enumerate(URLS):
        assert (rows[i].host, rows[i].path, rows[i].rule) == judged_by_hand(u)
        if rows[i].rule:
            assert rows[i].verdict == RULES[rows[i].rule]
        assert rows[i].verdict in ("allow", "block")


def test_url_trees_learn_and_defaults(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        bad = i % 2
        path = "".join(rnd.choice("0123456789") for _ in range(12)) if bad else "a/story"
        rows.append((f"http://s{i % 7}.org/{path}", bad))
    data = spark.createDataFrame(rows, "url string, label int")
    model = url_filter.fit(data.filter("crc32(cast(url AS binary)) % 3 <> 0"))
    held = model.score(data.filter("crc32(cast(url AS binary)) % 3 = 0")).select("label", "blocked").collect()
    assert sum(r.label == r.blocked for r in held) > 0.97 * len(held)
    empty = url_filter.fit(data.limit(0))
    pages = data.limit(1).selectExpr("1L AS page_id", "url")
    assert url_filter.judge(pages, {}, empty).first().verdict == "allow"
    assert url_filter.judge(pages, {}, url_filter.fit(data.filter("label = 1"))).first().verdict == "block"
    assert url_filter.judge(pages.limit(0), RULES, model).collect() == []


def brute_spans(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(spans)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(3)
    for _ in range(20_000):
        text = "".join(rnd.choice("a.@-+ 1234%é_") for _ in range(rnd.randint(0, 40)))
        assert pii_crf.base_spans(text)[0] == brute_spans(text)


def test_base_spans_of_long_runs_end_soon():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 100_000, "+1(" * 50_000, "1 " * 100_000):
        pii_crf.base_spans(text)


PII = [(1, "call +1 (988) 555-2485 or 1 (988) 555-2485, ref 12345678"), (2, "mail jo.doe7@mail8.example.com, jo.doe7 says"),
       (3, "card 4111 1111 1111 1111 also 4111.1111.1111.1111"), (4, "clean text of 2019, 1234567 twice 1234567"), (5, None),
       (6, ""), (7, "é🙂 a@b.cd"), (7, "again 10.0.0.1")]


def test_field_adds_repeats_and_leaves_clean_texts_alone(spark):
    docs = spark.createDataFrame([(*r, "clash") for r in PII * 5], "doc_id long, text string, spans string")
    found = pii_crf.find(docs, pii_crf.train(docs)).collect()
    assert len(found) == len(docs.collect())
    added = {(r.doc_id, s.kind, s.start) for r in found for s in r.spans if not s.base}
    assert (1, "phone", PII[0][1].index("1 (988)", 10)) in added
    assert (2, "email", PII[1][1].index("jo.doe7 says")) in added
    assert (3, "card", PII[2][1].index("4111.")) in added
    assert not {d for d, *_ in added} - {1, 2, 3} and len(added) == 3
    for r in found:
        if r.doc_id != 7:
            text = dict(PII)[r.doc_id] or ""
            assert [(s.start, pii_crf.KINDS.index(s.kind), s.end) for s in r.spans if s.base] == brute_spans(text)


def test_pii_of_an_empty_table(none):
    assert pii_crf.find(none, pii_crf.train(none)).collect() == []


def test_messages_agree_with_enumeration():
    """On a tree, message passing gives the exact marginals."""
    counts = np.random.RandomState(0).randint(0, 9, pii_crf.TEMPLATES * pii_crf.FEATURES * 5 + 50).astype(float)
    model = pii_crf.Crf(counts)
    rows = np.random.RandomState(1).randint(0, pii_crf.FEATURES, (3, pii_crf.TEMPLATES))
    edges = np.array([(0, 1, 0), (1, 2, 1)])
    got = model.posteriors(rows, np.zeros(3, int), edges)
    unary = model.unary[rows].mean(1)
    joint = (unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None, :]
             + model.edge[0][:, :, None] + model.edge[1][None, :, :])
    p = np.exp(joint - joint.max())
    p /= p.sum()
    assert np.allclose(got, [p.sum((1, 2)), p.sum((0, 2)), p.sum((0, 1))], atol=1e-3)


def test_quality_network_learns_and_takes_odd_rows(spark, odd, none):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(("good", "fine", "prose") if i % 2 else ("$$$", "!!", "BUY")) for _ in range(30)), i % 2)
            for i in range(300)]
    data = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = data.filter("doc_id % 3 <> 0").select("doc_id", "label")
    model = quality_model.fit(data, labels)
    held = quality_model.score(data, model).join(data.select("doc_id", "label"), "doc_id").filter("doc_id % 3 = 0").collect()
    assert sum(r.predicted == r.label for r in held) > 0.95 * len(held)
    scored = quality_model.score(odd, model).collect()
    assert len(scored) == len(odd_rows()) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (0, 1)}) == 1
    assert quality_model.score(none, model).collect() == []
    assert quality_model.fit(none, labels.limit(0)).constant == 0.5


def _long(x):
    return x - (1 << 64) if x >> 63 else x


def _xx(values, seed=42):
    for v in values:
        raw = v if isinstance(v, bytes) else int(v).to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return _long(seed)


def brute_entries(text):
    words = [w.encode() for w in WORD.findall(text)]
    if not words:
        return []
    hashes = [_xx([w]) for w in words]
    kmers = [_xx(hashes[i:i + 3]) for i in range(len(hashes) - 2)] or [_xx([b" ".join(words)])]
    kmers = [h >> 28 for h in kmers]
    seen, numbered = Counter(), []
    for p, h in enumerate(kmers):
        numbered.append((_long(xxhash.xxh64_intdigest(seen[h].to_bytes(4, "little"), _xx([h]) % (1 << 64))) >> 28, p))
        seen[h] += 1
    out = {}
    for h, p in sorted(numbered):
        out.setdefault(h >> (36 - order_minhash.BIN_BITS), []).append((p, h))
    return [_long((_xx([h for _, h in sorted(x[:order_minhash.L])]) << 5) % (1 << 64) & ~31 | (b & 31)) for b, x in sorted(out.items())]


@pytest.fixture(scope="module")
def compared(odd):
    return order_minhash.compare_edited(odd).collect()


def test_fingerprints_equal_brute_force(spark):
    texts = [r[1] for r in odd_rows()]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(order_minhash.entries(df.text).alias("e")).collect()
    assert [r.e for r in got] == [brute_entries(t or "") for t in texts]


def test_edited_texts_and_likeness(compared):
    rows = odd_rows()
    key = lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, _xx([(r[1] or "").encode()]))
    order = sorted({(r[0], r[1] or "") for r in rows}, key=key, reverse=True)
    expected = Counter()
    for i, (doc, text) in enumerate(order):
        given = order[(i + 1) % len(order)][1][:len(text) // 3]
        edited = text[:len(text) - len(text) // 3] + given
        times = sum((r[0], r[1] or "") == (doc, text) for r in rows)
        expected[doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), text == edited or None] += times
    got = Counter((r.doc_id, r.n_chars, r.edited, True if r.near_edited == 1 else None) for r in compared)
    assert {k[:3]: v for k, v in got.items()} == {k[:3]: v for k, v in expected.items()}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in compared)


def test_no_documents_have_no_fingerprints(none):
    assert order_minhash.compare_edited(none).collect() == []
