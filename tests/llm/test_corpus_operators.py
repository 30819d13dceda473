"""Operators over the whole corpus, against brute force on a small one."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sifter.llm import line_dedup, lm, mixing, ngram_join
from sifter.llm.components import components
from tests.llm.conftest import odd_rows, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    edges += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    rnd.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_join(rows, num, den, k):
    """(id, size, component, links) of (id, text) rows."""
    sets = [shingle_set(t, k) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    found = roots(range(len(rows)), links)
    members = defaultdict(list)
    for i, r in found.items():
        members[r].append(rows[i][0])
    degree = Counter(x for e in links for x in e)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in members.items()}
    return Counter((rows[i][0], len(sets[i]), least[found[i]], degree[i]) for i in range(len(rows)))


def near_copies():
    """Families of copies with some words changed, of several sizes; some long
    enough that a part of the columns is counted."""
    rnd = random.Random(8)
    rows = []
    for size, copies in ((12, 8), (60, 25), (150, 12), (700, 8), (1500, 5)):
        base = sentence(rnd, size, 3000).split()
        for c in range(copies):
            text = list(base)
            for _ in range(rnd.randrange(0, 1 + size // 25) if c else 0):
                text[rnd.randrange(size)] = f"x{rnd.random()}"
            rows.append(" ".join(text[:size - rnd.randrange(3) * (c % 4 == 3)]))
    rows += [sentence(rnd, rnd.randrange(1, 200), 60) for _ in range(60)] + rows[:6]
    rnd.shuffle(rows)
    return list(enumerate(rows, 1000))


@pytest.mark.parametrize("num,den,k", [(90, 100, 3), (80, 100, 5), (50, 100, 1)])
def test_join_equals_all_pairs(spark, monkeypatch, num, den, k):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 9)  # clusters of several blocks
    monkeypatch.setattr(ngram_join, "RANGE", 64)
    rows = near_copies()
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), num, den, k).collect()
    assert Counter(tuple(r) for r in got) == brute_join(rows, num, den, k)


def test_join_of_odd_rows(odd, none):
    got = ngram_join.join(odd, 90, 100, 3).collect()
    assert Counter(tuple(r) for r in got) == brute_join([r[:2] for r in odd_rows()], 90, 100, 3)
    assert ngram_join.join(none, 90, 100, 3).collect() == []
    assert ngram_join.representatives(none).collect() == []


def test_tested_parts_exceed_what_a_set_may_miss():
    for num in (90, 80, 50):
        t = ngram_join.Threshold(num, 100)
        n = np.arange(1, 20_000)
        d = t.density(n)
        assert (np.diff(d) <= 0).all()
        assert ((d == 32) | (d / 32 * n - t.may_miss(n) > 6.9 * np.sqrt(d / 32 * (1 - d / 32) * n))).all()


def test_one_of_each_group_stays(spark, odd):
    rows = near_copies()
    kept = ngram_join.representatives(spark.createDataFrame(rows, "doc_id long, text string"), 80, 100, 5)
    want = Counter(c for _, _, c, _ in brute_join(rows, 80, 100, 5))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    left = ngram_join.representatives(odd)
    assert left.columns == odd.columns
    assert {r.doc_id for r in left.collect()} >= {0, 1, 2, 11}


def brute_cuts(rows, least_words=5):
    """Positions cut of each (id, text), rows ordered by id, ids unique."""
    first, out = {}, {}
    where = {i: defaultdict(list) for i, _ in rows}
    for i, text in sorted(rows):
        groups = defaultdict(list)
        for p, line in enumerate((text or "").split("\n")):
            if len(WORD.findall(line)) >= least_words:
                where[i][line].append(p)
        for line, at in where[i].items():
            owner = first.setdefault(line, i)
            if owner != i:
                groups[owner] += list(zip(at, where[owner][line], strict=False))
        for pairs in groups.values():
            pairs.sort()
            best = [[] for _ in pairs]
            for a in range(len(pairs)):
                best[a] = max((best[b] for b in range(a) if pairs[b][1] < pairs[a][1]), key=len, default=[]) + [pairs[a]]
            out.setdefault((i, "lengths"), []).append(max(map(len, best)))
        out[i] = (sum(out.pop((i, "lengths"), [])), {p for g in groups.values() for p, _ in g})
    return out


def test_line_dedup(spark):
    rnd = random.Random(6)
    pool = [sentence(rnd, 7) for _ in range(25)] + ["too short", ""]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 9)))) for i in range(60)]
    rows += [(60, rows[3][1]), (61, "\n".join(sentence(rnd, 9) for _ in range(5))), (62, None), (63, "")]
    got = {r.row.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_cuts(rows)
    for i, text in rows:
        cut = set(got[i].cut)
        assert len(cut) == want[i][0] and cut <= want[i][1]  # as long an alignment, of shared lines only
        left = None if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if p not in cut)
        assert got[i].row.text == left
    assert got[61].cut == [] and not got[60].row.text or "too short" in rows[3][1]


def test_line_dedup_moved_blocks():
    # the longest ascending run stays aligned, the block that moved does not
    assert line_dedup.aligned([([0], [3]), ([1], [4]), ([2], [5]), ([3], [0])]) == [0, 1, 2]
    assert line_dedup.aligned([([0, 4], [1]), ([2], [2])]) == [0, 2]
    assert line_dedup.aligned([]) == []


def test_line_dedup_of_odd_rows(odd, none):
    rows = line_dedup.dedup(odd).select("row.*", "cut").collect()
    assert len(rows) == len(odd_rows())
    assert {r["id"] for r in rows} == {"id"} and sum(r.text is None for r in rows) == 2
    texts = Counter(r.text for r in rows)
    assert texts[odd_rows()[6][1]] == 1  # the null id is first, its copies are cut
    assert line_dedup.dedup(none).collect() == []


def brute_mix(rows):
    """taken of (id, text, source) rows, as the SQL has it."""
    import hashlib
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, full = 1.5 * sum(size), set()
    while True:
        free = [s for s in order if s not in full]
        level = (budget - sum(2 * total[s] for s in full)) / max(sum(weight[s] for s in free), 1)
        more = {s for s in free if weight[s] * level >= 2 * total[s]}
        if not more:
            break
        full |= more
    target = {s: 2.0 * total[s] if s in full else weight[s] * level for s in order}
    entries, at = [], Counter()
    keyed = sorted(((hashlib.md5(f"mix-{'' if i is None else i}".encode()).hexdigest(), n, j) for j, ((i, _, _), n)
                    in enumerate(zip(rows, size, strict=True))))
    for key, n, j in keyed:
        s = rows[j][2]
        at[s] += n
        for again in (0, 1):
            if n:
                entries.append(((at[s] + again * total[s]) / target[s], order.index(s), key, n, j))
    taken, used = Counter(), 0
    for finish, _, _, n, j in sorted(entries):
        used += n
        if used > budget:
            break
        taken[j] += n
    return target, total, Counter((rows[j][0], size[j], total[rows[j][2]], round(target[rows[j][2]], 6), taken[j])
                                  for j in range(len(rows)))


@pytest.mark.parametrize("hot", [False, True])
def test_mix_equals_brute_force(spark, hot):
    rnd = random.Random(3)
    rows = [(i, sentence(rnd, rnd.randrange(0, 60)), "s0" if hot and i % 3 else rnd.choice([None, "b", "a", "é", "z9"]))
            for i in range(400)]
    target, total, want = brute_mix(rows)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got) == want
    by_source = Counter()
    for r, (_, _, s) in zip(sorted(got), rows, strict=True):
        by_source[s] += r.taken
        assert r.taken <= 2 * r["size"]
    assert all(abs(by_source[s] - target[s]) <= 130 for s in target)


def test_mix_of_odd_rows(odd, none):
    got = mixing.mix(odd)
    assert got.count() == len(odd_rows())
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, mixing.mix(odd.repartition(7)).collect()), key=str)
    assert mixing.mix(none).collect() == []
    taken = mixing.apply(odd)
    assert taken.columns == odd.columns and all(WORD.search(r.text) for r in taken.collect())
    assert mixing.apply(none).collect() == []
    assert mixing.mix(odd.withColumn("text", F.lit(""))).agg(F.max("taken")).first()[0] == 0


def test_language_model_base_and_totals(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_CHARS", 1500)  # many chunks and parts
    monkeypatch.setattr(lm, "PART_CHARS", 1000)
    rnd = random.Random(9)
    rows = [(i, None if i == 3 else sentence(rnd, rnd.randrange(0, 40), 30).replace("w1", "W1")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in lm.score(docs, F.col("doc_id") % 4 != 0).collect()}
    tokens = {i: (t or "").lower().split() + [None] for i, t in rows}
    counts = Counter(w for i, ws in tokens.items() if i % 4 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(got[i].base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert got[i].score < 0
    held = [got[i] for i in got if i % 4 == 0]
    assert sum(r.score for r in held) > 1.2 * sum(r.base_score for r in held)


def test_language_model_equals_the_formula(spark, monkeypatch):
    weights = np.tile([0.5, 0.3, 0.2], (lm.BUCKETS, 1))
    monkeypatch.setattr(lm, "learn_weights", lambda *a: weights)
    rows = [(1, "a b a b"), (2, "a c"), (3, "b d"), (4, "")]
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") != 3).collect()}
    tokens = {i: t.split() + ["</s>"] for i, t in rows}
    uni = Counter(w for i in (1, 2, 4) for w in tokens[i])
    bi = Counter(p for i in (1, 2, 4) for p in zip(["<s>", *tokens[i]], tokens[i], strict=False))
    n, v, context = sum(uni.values()), len(uni), Counter(uni) | Counter({"<s>": 3})
    for i, ws in tokens.items():
        p = [0.5 * bi[x, w] / max(context[x], 1) + 0.3 * uni[w] / n + 0.2 / (v + 1) for x, w in zip(["<s>", *ws], ws, strict=False)]
        assert math.isclose(got[i], sum(map(math.log10, p)))


def test_em_finds_the_weights_of_a_mixture():
    rnd = np.random.RandomState(0)
    p = rnd.choice([-1, 4, 8, 20], (4000, 2))
    cell = (3 << 20) + (p[:, 0] + 1) * 1024 + p[:, 1] + 1
    weights = lm.learn_weights(cell, np.ones(len(cell)), 50)
    q = np.stack([np.where(p[:, 0] >= 0, 2.0 ** (-p[:, 0] / lm.STEP), 0), np.where(p[:, 1] >= 0, 2.0 ** (-p[:, 1] / lm.STEP), 0),
                  np.full(len(p), 1 / 51)], 1)
    best = np.log(q @ weights[3]).sum()
    for other in ([1 / 3] * 3, [0.6, 0.2, 0.2], [0.2, 0.6, 0.2], [0.45, 0.45, 0.1]):
        assert best >= np.log(q @ np.array(other)).sum() - 1e-6


def test_language_model_of_odd_rows(odd, none):
    assert lm.score(odd, F.col("doc_id") % 7 != 2).count() == len(odd_rows())
    assert lm.score(none, F.lit(True)).collect() == []
    assert {r.score for r in lm.score(odd, F.lit(False)).collect()} == {0.0}


def test_pipeline_stages(spark, tmp_path):
    rnd = random.Random(12)
    clean = ["\n".join("the of " + sentence(rnd, 20, 5000) for _ in range(4)) for _ in range(30)]
    near = clean[2].split(" ")
    near[10] = "other"
    texts = [*clean, clean[0], " ".join(near), "junk " * 50, "### " * 40, "", None, clean[1].split("\n")[0] + "\nthe of " + sentence(rnd, 30, 9999)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, str(tmp_path))
        seen[name] = [r.asDict() for r in rows.collect()]
        if name != "byte_bpe":
            assert rows.columns == docs.columns
            rows = spark.createDataFrame(seen[name], docs.schema)
    assert {r["doc_id"] for r in seen["quality_rules"]} == {*range(32), 36}
    left = {r["doc_id"]: r["text"] for r in seen["line_dedup"]}
    assert left[30] == "" and left[36] == texts[36].split("\n")[1] and all(left[i] == texts[i] for i in range(30))
    assert len({r["doc_id"] for r in seen["ngram_jaccard_join"]}) == len(seen["ngram_jaccard_join"]) >= 31
    times = Counter(r["doc_id"] for r in seen["source_mix"])
    assert set(times) <= {*range(32), 36} - {30} and max(times.values()) <= 2
    assert Counter(r["doc_id"] for r in seen["byte_bpe"]) == times
    text = {r["doc_id"]: r["text"] for r in seen["ngram_jaccard_join"]}
    assert all(r["decoded"] == text[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in seen["byte_bpe"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["byte_bpe"])
