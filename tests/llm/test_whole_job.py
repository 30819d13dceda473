"""Results that a cut of the work would change."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sifter.llm import line_dedup, pii_crf
from tests.llm.conftest import sentence
from tests.llm.test_text_operators import PII


def left_by_blocks(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.row.doc_id: r.row.text for r in line_dedup.dedup(docs, find=line_dedup.blocks).collect()}


def test_exact_copies_go_whole_and_short_lines_with_their_block(spark):
    rnd = random.Random(2)
    a, b, c, d, e = (sentence(rnd, 8) for _ in range(5))
    first = f"Title\n\n{a}\nOf.\n{b}\nAll rights reserved."
    left = left_by_blocks(spark, [first, first, f"Title\n{c}\n{a}\nOf.\nNew.\n{b}\nEnd", f"Of.\n{d}\n\n{e}", None, ""])
    assert left == {0: first, 1: "", 2: f"Title\n{c}\nNew.\nEnd", 3: f"Of.\n{d}\n\n{e}", 4: None, 5: ""}


def test_blocks_of_two_texts():
    short = {"x", "y", ""}
    block = lambda own, other: line_dedup.block(list(own), list(other), [w not in short for w in own])
    assert block("xAxyBy", "xAxyBy") == [0, 1, 2, 3, 4, 5]
    assert block("xyxAPyB", "yyxAQyB") == [1, 2, 3, 5, 6]  # runs at the ends, all equal lines between
    assert block("xy", "xy") == [] and block("xAy", "yAx") == [1]


def test_blocks_are_those_of_all_earlier_documents(spark):
    rnd = random.Random(4)
    pool = [sentence(rnd, 7) for _ in range(9)] + ["too short", "", "By us"]
    x, y = pool[:2]
    texts = [f"{y}\n{x}", f"{x}\n{y}", f"{x}\n{y}"]  # the first holder of x and y has another order
    texts += ["\n".join(rnd.choice([*pool, f"only {i}"]) for _ in range(rnd.randrange(1, 9))) for i in range(150)]
    texts += [texts[9], texts[30], None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc.id: set(r.cut) for r in line_dedup.blocks(docs).collect()}
    lines = [(t or "").split("\n") for t in texts]
    for i, own in enumerate(lines):
        long = [len(w.split()) >= 5 for w in own]
        assert got.get(i, set()) == {p for other in lines[:i] for p in line_dedup.block(own, other, long)}
    assert got[2] == {0, 1}


def test_blocks_of_odd_rows(odd, none):
    rows = line_dedup.dedup(odd, find=line_dedup.blocks).select("row.*").collect()
    assert len(rows) == odd.count() and sum(r.text is None for r in rows) == 2
    assert line_dedup.dedup(none, find=line_dedup.blocks).collect() == []


def spans_added(text, training):
    counts = np.zeros(pii_crf.TEMPLATES * pii_crf.FEATURES * pii_crf.LABELS + 2 * pii_crf.LABELS ** 2)
    for cells in pii_crf.count_cells(iter([pa.RecordBatch.from_pydict({"id": range(len(training)), "text": pa.array(training, pa.string())})])):
        counts[cells.column(0).to_numpy()] = cells.column(1).to_numpy()
    found = pii_crf.spans_of(pa.RecordBatch.from_pydict({"id": [1], "text": [text]}), pii_crf.Crf(counts))
    return [s for s in found.get(0, []) if not s[3]]


FULL, BARE = "+1 (988) 555-2485", "1 (988) 555-2485"
TRAINING = [f"call {FULL} or {BARE}, ref 12345678", "mail jo.doe7@mail8.example.com, jo.doe7 says"] * 5


@pytest.mark.parametrize("training", [TRAINING, [t for _, t in PII] * 5])
def test_every_one_of_fifty_repeats_is_labelled(training):
    gap = " words that keep the repeats from being neighbours of each other "
    for text in (FULL + (gap + BARE) * 50, (BARE + gap) * 50 + FULL):
        assert len(spans_added(text, training)) == 50


def test_messages_travel_as_far_as_the_chain():
    counts = np.zeros(pii_crf.TEMPLATES * pii_crf.FEATURES * pii_crf.LABELS + 2 * pii_crf.LABELS ** 2)
    n = 40
    edges = np.array([(i, i + 1, 1) for i in range(n - 1)])
    rows = np.zeros((n, pii_crf.TEMPLATES), int)
    p = pii_crf.Crf(counts).posteriors(rows, np.array([4] + [0] * (n - 1)), edges)
    assert (p[:, 4] > 0.5).all() and (np.diff(p[:, 4]) < 0).all()


def test_failed_matches_count_in_long_texts_too():
    rnd = random.Random(3)
    spans = [(a, a + rnd.randrange(1, 30)) for a in (rnd.randrange(400) for _ in range(60))]
    overlap = pii_crf.Overlap(spans)
    for a in range(440):
        for b in (a + 1, a + 7, a + 60):
            assert overlap(a, b) == any(x < b and a < y for x, y in spans)
    text = "card 4111 1111 1111 1112 "
    row = lambda text: pii_crf.graph(text, pii_crf.nodes(text, pii_crf.base_spans(text)[0]), pii_crf.base_spans(text)[1])[0][0]
    assert row(text) == row(text * 60)


def test_documents_without_a_base_span_are_decoded():
    # no label is observed, but the features alone are sure
    model = pii_crf.Crf(np.zeros(pii_crf.TEMPLATES * pii_crf.FEATURES * pii_crf.LABELS + 2 * pii_crf.LABELS ** 2))
    model.unary[:] = np.log([0.01, 0.01, 0.01, 0.96, 0.01])
    assert pii_crf.spans_of(pa.RecordBatch.from_pydict({"id": [1], "text": ["ref 12345678"]}), model) == {0: [(4, 2, 12, False)]}
