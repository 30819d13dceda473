r"""Line dedup by pairwise alignment.

Documents that share a line of ``LEAST_WORDS`` words or more (an anchor)
overlap.  Each later document is aligned with the earlier ones it overlaps
(documents in order of id) by patience: the common anchors, a repeated line
told apart by its occurrence number, are put in the later document's order
and the longest run of them that ascends in the earlier one is kept.  All
equal lines between two kept anchors, whatever their length, and the runs
of equal lines beside the outer ones align too.  ``blocks`` deletes what
aligns with any earlier document; ``cuts`` the anchors alone, from the
first document of each line.

Pairs: lines of one document align with none, so documents whose shared
lines and gaps are the same (a form) are compared once.  A form is aligned
with the first holder of each anchor, of each run from anchor to anchor and
of each run from an anchor to a short line beside it.  Lines that this
leaves but that an earlier document has are then tried with a hashed share
of the other holders of their line or run, about ``TRIES`` of them, eight
times as many in each round, and with all in the last; a short line between
two anchors with the earlier documents that have one of its anchors before
it and one after it.  The result is that of all pairs; few lines outlast
the first rounds, and those are mostly lines with few earlier holders.

Scale: the text is read twice and shuffled once, when the deletions meet it;
everything else moves line hashes.  A line's first holder and their
number come from one aggregate; joins on line hashes are sort-merge joins that
adaptive execution may split at a hot line, so the holders of a line are never
in one task together.  The work on one row is bounded by the lines of two
documents.

Results defined for odd input: a null text stays null and an empty one
empty; a null id is ordered first; rows equal in id and text are one
document and stay alike; rows that repeat an id with other texts are
documents of their own, in the order of a hash of the text; lines end at
``\n``, and what remains is joined by ``\n``; all columns of the input are
kept as they are, but for the text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.columns import at, document, let, split_words, upto
from sifter.llm.stage import staged

#: Words of a line that counts as shared content.
LEAST_WORDS = 5
#: Holders of a line that the first round of the search tries.
TRIES = 8


def longest_ascent(values: list[int]) -> list[int]:
    """Indices of a longest strictly ascending subsequence (patience sorting)."""
    tops, piles, back = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
        back[i] = piles[k - 1] if k else -1
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def aligned(shared: list[tuple[list[int], list[int]]]) -> list[int]:
    """Lines of the later document that align with the earlier one; per
    common line, its positions in the later and in the earlier document."""
    pairs = sorted((p, q) for own, other in shared for p, q in zip(sorted(own), sorted(other), strict=False))
    return [pairs[i][0] for i in longest_ascent([q for _, q in pairs])]


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cuts = []
        for shared in batch.column(1).to_pylist():
            by_first: dict[tuple, list] = {}
            for s in shared:
                by_first.setdefault((s["first"]["id"], s["first"]["key"]), []).append((s["at"], s["first_at"]))
            cuts.append(sorted({p for group in by_first.values() for p in aligned(group)}))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cuts, pa.list_(pa.int32()))], ["doc", "cut"])


def shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, h, g, at, first, first_at): a line that a document shares with an
    earlier one, by its hashes; its positions in both."""
    lines = (docs.select(document(id_col, text_col).alias("doc"), F.posexplode(F.split(text_col, "\n", -1)))
             .filter(F.size(split_words(F.col("col"))) >= least_words)
             .select("doc", F.col("pos").alias("at"), F.xxhash64("col").alias("h"), F.hash("col").alias("g"))
             .groupBy("doc", "h", "g").agg(F.sort_array(F.collect_set("at")).alias("at")))
    # a stage table: a join of two plain exchanges can be split at a hot line
    first = staged(
        lines.groupBy("h", "g").agg(F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("last"))
        .filter(F.col("first.doc") != F.col("last"))
        .select("h", "g", F.col("first.doc").alias("first"), F.col("first.at").alias("first_at")), "line-firsts")
    return lines.join(first, ["h", "g"]).filter(F.col("doc") != F.col("first"))


def cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, cut): the positions of the lines to delete, of documents that have any."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (shared_lines(docs, id_col, text_col, least_words)
            .groupBy("doc").agg(F.collect_list(F.struct("first", "at", "first_at")).alias("shared"))
            .mapInArrow(_align, f"doc struct<id:{kind},key:bigint>, cut array<int>"))


def block(own: list, other: list, long: list[bool]) -> list[int]:
    """Positions of ``own`` that align with ``other``: the common lines that
    are ``long`` (anchors), all equal lines between two anchors, and the equal
    lines in a run before the first and after the last one."""
    def common(a: int, b: int, c: int, d: int, anchors: bool) -> list[tuple[int, int]]:
        there: dict = {}
        for q in range(c, d):
            there.setdefault(other[q], []).append(q)
        taken: dict = {}
        pairs = []
        for p in range(a, b):
            k = taken.get(own[p], 0)
            if (long[p] or not anchors) and k < len(there.get(own[p], ())):
                pairs.append((p, there[own[p]][k]))
                taken[own[p]] = k + 1
        return [pairs[i] for i in longest_ascent([q for _, q in pairs])]

    anchors = common(0, len(own), 0, len(other), True)
    if not anchors:
        return []
    out = [p for p, _ in anchors]
    p, q = anchors[0]
    while p and q and own[p - 1] == other[q - 1]:
        p, q = p - 1, q - 1
        out.append(p)
    for (a, c), (b, d) in zip(anchors, anchors[1:], strict=False):
        a, c = a + 1, c + 1
        while a < b and c < d and own[a] == other[c]:  # the same ends first, as in a diff
            out.append(a)
            a, c = a + 1, c + 1
        while a < b and c < d and own[b - 1] == other[d - 1]:
            b, d = b - 1, d - 1
            out.append(b)
        out += [p for p, _ in common(a, b, c, d, False)]
    p, q = anchors[-1]
    while p + 1 < len(own) and q + 1 < len(other) and own[p + 1] == other[q + 1]:
        p, q = p + 1, q + 1
        out.append(p)
    return sorted(out)


def _coded(x: list[dict], gap: int) -> list:
    """The lines of a profile, with ``gap`` where lines of one document only were."""
    out, last = [], None
    for e in x:
        if last is not None and e["at"] != last + 1:
            out.append(gap)
        out.append((e["h"], e["g"]))
        last = e["at"]
    return out


def _spread(x: list[dict]) -> list[dict | None]:
    """A profile's entries, with None at its gaps."""
    it = iter(x)
    return [None if c == 0 else next(it) for c in _coded(x, 0)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cuts = []
        for x, other in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            own = _spread(x)
            cut = block(_coded(x, 0), _coded(other, 1), [e is not None and e["long"] for e in own])
            cuts.append([own[p]["at"] for p in cut])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cuts, pa.list_(pa.int32()))], ["doc", "cut"])


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines (h, g, long) of a document that an earlier one has, that are
    not cut and that another pair could still cut: any anchor, and a short line
    between two anchors or in a run with one."""
    for batch in batches:
        docs, rest = [], []
        for i, (x, held, cut) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
            own, cut, held = _spread(x), set(cut or ()), {(e["h"], e["g"]) for e in held}
            is_held = [e is not None and (e["h"], e["g"]) in held for e in own]
            anchors = [p for p, e in enumerate(own) if is_held[p] and e["long"]]
            if not anchors:
                continue
            low, high = anchors[0], anchors[-1]
            while low and is_held[low - 1]:
                low -= 1
            while high + 1 < len(own) and is_held[high + 1]:
                high += 1
            left = {(e["h"], e["g"], e["long"]) for p, e in enumerate(own[low:high + 1], low)
                    if is_held[p] and e["at"] not in cut}
            docs += [i] * len(left)
            rest += left
        cols = [pa.array([r[k] for r in rest], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs, pa.int64())), *cols], ["doc", "h", "g", "long"])


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, x, rep): the lines (at, h, g, long) that a document shares with any
    other, in order, ``long`` for anchors, of documents that share an anchor;
    and the first document with such lines and gaps."""
    line = F.struct(F.xxhash64("col").alias("h"), F.hash("col").alias("g"),
                    (F.size(split_words(F.col("col"))) >= least_words).alias("long"))
    # stage tables: texts are split once, and joins of two plain exchanges can be split at a hot line or profile
    lines = staged(docs.select(document(id_col, text_col).alias("doc"), F.posexplode(F.split(text_col, "\n", -1)))
                   .select("doc", F.col("pos").alias("at"), line.alias("e")).select("doc", "at", "e.*"), "line-hashes")
    ends = [f(f"doc.{c}").alias(f"{f.__name__}_{c}") for c in ("id", "key") for f in (F.min, F.max)]
    shared = staged(lines.groupBy("h", "g").agg(*ends, F.count("doc.id").alias("ids"), F.count("*").alias("n"))
                    .filter("min_id != max_id OR min_key != max_key OR ids > 0 AND ids < n").select("h", "g"), "line-shared")
    found = (lines.join(shared.hint("merge"), ["h", "g"])
             .groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("at", "h", "g", "long"))).alias("x"))
             .filter(F.exists("x", lambda e: e["long"])))
    form = F.transform("x", lambda e, i: F.struct(
        e["h"], e["g"], F.when(i > 0, e["at"] != at(F.col("x"), i - 1)["at"] + 1).otherwise(False)))
    found = staged(found.select("doc", "x", F.xxhash64(form).alias("p"), F.hash(form).alias("r")), "line-profiles")
    first = staged(found.groupBy("p", "r").agg(F.min("doc").alias("rep")), "line-forms")
    return staged(found.join(first.hint("merge"), ["p", "r"]).select("doc", "x", "rep"), "line-classes")


def aligned_cuts(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(doc, at) that the pairs (doc, other) cut."""
    other = reps.select(F.col("doc").alias("other"), F.col("x").alias("other_x"))
    return (pairs.join(reps.hint("merge"), "doc").join(other.hint("merge"), "other").select("doc", "x", "other_x")
            .mapInArrow(_blocks, f"doc {reps.schema['doc'].dataType.simpleString()}, cut array<int>")
            .select("doc", F.explode("cut").alias("at")).distinct())


#: What a key stands for: a short line, an anchor, the lines from an anchor to
#: the next one, the lines from an anchor to a short line beside it.
SHORT, ANCHOR, BETWEEN, BESIDE = range(4)


def _chain(before: bytes, line: tuple[int, int] | int) -> bytes:
    return blake2b(before + repr(line).encode(), digest_size=12).digest()


def keys_of(x: list[dict]) -> set[tuple[int, int, int, int, int]]:
    """(kind, h, g, and the line at its end) of the lines of a profile and of
    the runs of lines that begin at an anchor, gaps included."""
    lines, long = _coded(x, 0), [e is not None and e["long"] for e in _spread(x)]
    found = {(ANCHOR if is_long else SHORT, *line, *line) for line, is_long in zip(lines, long, strict=True) if line != 0}
    for way in (1, -1):
        run = None
        for line, is_long in zip(lines[::way], long[::way], strict=True):
            run = run and _chain(run, line)
            if run and line != 0 and (way == 1 or not is_long):
                h, g = (int.from_bytes(part, "little", signed=True) for part in (run[:8], run[8:]))
                found.add((BETWEEN if is_long else BESIDE, h, g, *line))
            if is_long:
                run = _chain(b"%d" % way, line)
    return found


KEYS = (("kind", pa.int32()), ("h", pa.int64()), ("g", pa.int32()), ("line_h", pa.int64()), ("line_g", pa.int32()))


def _rows(batch: pa.RecordBatch, found: list, fields: tuple) -> pa.RecordBatch:
    """A row for each tuple found in each row, after the row's document."""
    docs = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int64())
    cols = [pa.array([r[k] for rows in found for r in rows], kind) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays([batch.column(0).take(docs), *cols], ["doc", *(name for name, _ in fields)])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _rows(batch, [keys_of(x) for x in batch.column(1).to_pylist()], KEYS)


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors (h, g) before and after each short line asked for."""
    for batch in batches:
        found = []
        for x, asked in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            at_of: dict = {(s["h"], s["g"]): [] for s in asked}
            for e in x:
                if (e["h"], e["g"]) in at_of:
                    at_of[e["h"], e["g"]].append(e["at"])
            found.append({(side, e["h"], e["g"], *s) for s, own in at_of.items() for e in x if e["long"]
                          for side in (0, 1) if (e["at"] < own[-1] if side == 0 else e["at"] > own[0])})
        yield _rows(batch, found, KEYS)


def between_anchors(short: DataFrame, lines: DataFrame, reps: DataFrame) -> DataFrame:
    """(doc, other): for each short line (doc, h, g), the earlier documents that
    have it after one and before another of the document's anchors around it,
    found through the side whose anchors are rarer."""
    kind, line, anchor = reps.schema["doc"].dataType.simpleString(), ["line_h", "line_g"], ["h", "g"]
    asked = (lines.filter(F.col("kind") == SHORT).join(short.select(*anchor).distinct(), anchor, "left_semi")
             .groupBy("doc").agg(F.collect_list(F.struct(*anchor)).alias("asked")))
    sides = staged(reps.join(asked, "doc").select("doc", "x", "asked")
                   .mapInArrow(_sides, f"doc {kind}, kind int, h long, g int, line_h long, line_g int"), "line-sides")
    own = sides.join(short.select("doc", F.col("h").alias("line_h"), F.col("g").alias("line_g")), ["doc", *line], "left_semi")
    holders = sides.groupBy("kind", *anchor, *line).agg(F.count("*").alias("n"))
    rarer = (own.join(holders, ["kind", *anchor, *line]).groupBy("doc", *line, "kind").agg(F.sum("n").alias("n"))
             .groupBy("doc", *line).agg(F.min(F.struct("n", "kind")).alias("side"), F.count("*").alias("sides"))
             .filter("sides = 2").select("doc", *line, F.col("side.kind").alias("kind")))
    there = sides.withColumnRenamed("doc", "other")
    one = (own.join(rarer, ["doc", *line, "kind"]).join(there, ["kind", *anchor, *line])
           .filter(F.col("other") < F.col("doc")).select("doc", *line, "kind", "other").distinct())
    both = one.withColumn("kind", 1 - F.col("kind")).join(own, ["doc", *line, "kind"])
    return both.join(there, ["other", "kind", *anchor, *line], "left_semi").select("doc", "other").distinct()


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, cut): the positions of the lines that align with any earlier
    document's, of documents that have any."""
    classes = profiles(docs, id_col, text_col, least_words)
    # lines of one document only align with none: a document aligns alike with all of a form
    reps = staged(classes.filter(F.col("doc") == F.col("rep")).select("doc", "x"), "line-reps")
    kind = reps.schema["doc"].dataType.simpleString()
    again = (classes.filter(F.col("doc") != F.col("rep")).select("doc", "x", F.col("x").alias("same"))
             .mapInArrow(_blocks, f"doc {kind}, cut array<int>")
             .select("doc", F.explode("cut").alias("at")))

    key = ["kind", "h", "g"]
    keys = staged(reps.mapInArrow(_keys, f"doc {kind}, kind int, h long, g int, line_h long, line_g int"), "line-keys")
    firsts = staged(keys.groupBy(*key).agg(F.min("doc").alias("first"), F.count("*").alias("n")).filter("n > 1"), "line-firsts")
    held = staged(keys.join(firsts.hint("merge"), key), "line-holders")
    later = held.filter(F.col("first") < F.col("doc"))
    cut = staged(aligned_cuts(later.filter(F.col("kind") != SHORT).select("doc", F.col("first").alias("other")).distinct(),
                              reps), "line-cuts")

    # what the first holders leave is tried with more and more of the others
    asks = later.filter(F.col("kind").isin(ANCHOR, BESIDE)).select("doc", *key, "n", "line_h", "line_g")
    others = held.filter(F.col("kind").isin(ANCHOR, BESIDE)).select(
        F.col("doc").alias("other"), *key, (F.pmod(F.xxhash64("doc", *key), F.lit(1 << 30)) / (1 << 30) * F.col("n")).alias("turn"))
    lines = later.filter(F.col("kind").isin(SHORT, ANCHOR)).groupBy("doc").agg(F.collect_list(F.struct("h", "g")).alias("held"))
    open_docs, tried = reps.join(lines, "doc"), 0
    while True:
        done = cut.groupBy("doc").agg(F.collect_set("at").alias("cut"))
        rest = staged(open_docs.join(done, "doc", "left").select("doc", "x", "held", "cut")
                      .mapInArrow(_rest, f"doc {kind}, h long, g int, long boolean"), "line-rest")
        asked = asks.join(rest.select("doc", F.col("h").alias("line_h"), F.col("g").alias("line_g")), ["doc", "line_h", "line_g"])
        most = asked.agg(F.max("n")).first()[0] or 0
        if tried >= most:
            break
        upto_turn = tried * 8 or TRIES
        pairs = (asked.select("doc", *key).join(others.filter(F.col("turn").between(tried, upto_turn)).hint("merge"), key)
                 .filter(F.col("other") < F.col("doc")).select("doc", "other").distinct())
        cut = staged(cut.union(aligned_cuts(staged(pairs, "line-pairs"), reps)).distinct(), "line-cuts")
        open_docs, tried = open_docs.join(rest.select("doc").distinct(), "doc", "left_semi"), upto_turn
    gaps = between_anchors(rest.filter("NOT long").select("doc", "h", "g"), keys, reps)
    return (cut.union(aligned_cuts(staged(gaps, "line-gap-pairs"), reps)).union(again)
            .groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("cut")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          least_words: int = LEAST_WORDS, find: Callable[..., DataFrame] = cuts) -> DataFrame:
    """(row, n_lines, cut): a struct of all columns with the text that is left,
    the lines before, and the positions of the deleted ones, as ``find`` has
    them: ``blocks`` for the whole job, ``cuts`` for anchors alone."""
    found = find(docs, id_col, text_col, least_words)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), document(id_col, text_col).alias("doc"))
    joined = rows.join(found, "doc", "left").withColumn("cut", F.coalesce("cut", F.array().cast("array<int>")))
    text = F.col("row")[text_col]
    lines = F.split(text, "\n", -1)
    left = F.when(F.size("cut") > 0, let(lines, lambda x: F.array_join(
        F.transform(F.array_except(upto(F.size(x)), F.col("cut")), lambda i: at(x, i)), "\n"))).otherwise(text)
    return joined.select(
        F.struct(*[left.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]).alias("row"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), "cut")
