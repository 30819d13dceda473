"""Document fingerprints by Order MinHash.

A text's k-mers are its windows of ``K`` words; a repeated one is told
apart by its occurrence number.  Each (k-mer, occurrence) is hashed to one
of ``BINS`` bins; of every bin the ``L`` least hashes are selected and, in
the order in which they stand in the text, hashed to the bin's entry.  An
entry depends on which k-mers a text has and on their order, so the share
of equal entries falls with edit distance, not only with overlap.

Everything is column expressions on arrays inside one row (sorted longs
of hash bits and position): n log n in the words of a text, no shuffle, no
Python.

Results defined for odd input: a null text is an empty one, whose
fingerprint is the empty string; a text of fewer than ``K`` words has one
k-mer, its whole word sequence; texts without any entry are alike (1.0),
and unlike any other (0.0); equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.columns import (POSITION_BITS, at, document, let, packed, position, same_bits, split_words,
                                upto, window_hashes)
from sifter.llm.stage import staged

#: Words of a k-mer, k-mers of an entry, bits of a bin's number.
K, L, BIN_BITS = 3, 2, 5
BINS = 1 << BIN_BITS


def _bits(x: Column) -> Column:
    return F.shiftright(x, POSITION_BITS)


def _bin(x: Column) -> Column:
    return F.shiftright(x, 64 - BIN_BITS)


def entries(text: Column, k: int = K, size: int = L) -> Column:
    """The fingerprint as an array of longs, at most one for each bin: an
    entry's hash with the bin's number in its last bits."""
    def kmers(words: Column) -> Column:
        few = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(
            F.array().cast("array<bigint>"))
        return F.when(F.size(words) < k, few).otherwise(
            window_hashes(F.transform(words, lambda w: F.xxhash64(w)), k))

    def numbered(s: Column) -> Column:
        """Hash of every (k-mer, occurrence), packed with its position."""
        def pack(x: Column, occurrence: Column) -> Column:
            h = F.xxhash64(_bits(x), occurrence)
            return F.shiftleft(_bits(h), POSITION_BITS).bitwiseOR(position(x).cast("long"))

        def by_run(starts: Column) -> Column:
            numbers = F.flatten(F.transform(starts, lambda a, i: F.sequence(
                F.lit(0), F.coalesce(at(starts, i + 1), F.size(s)) - a - 1)))
            return F.when(F.size(starts) == F.size(s), F.transform(s, lambda x: pack(x, F.lit(0)))).otherwise(
                F.zip_with(s, numbers, pack))

        starts = F.filter(upto(F.size(s)), lambda i: (i == 0) | ~same_bits(at(s, i), at(s, i - 1)))
        return F.when(F.size(s) > 0, let(starts, by_run)).otherwise(s)

    def least(s: Column) -> Column:  # the least of every bin, bins in order
        return F.filter(s, lambda x, i: (i < size) | (_bin(x) != _bin(at(s, F.greatest(i - size, F.lit(0))))))

    def entry_of(s: Column) -> Column:
        firsts = F.filter(upto(F.size(s)), lambda i: (i == 0) | (_bin(at(s, i)) != _bin(at(s, F.greatest(i - 1, F.lit(0))))))

        def entry(i: Column) -> Column:
            members = F.filter(F.slice(s, i + 1, size), lambda x: _bin(x) == _bin(at(s, i)))
            in_text_order = F.sort_array(F.transform(members, lambda x: F.struct(position(x).alias("p"), _bits(x).alias("h"))))
            h = F.xxhash64(F.transform(in_text_order, lambda m: m["h"]))
            return F.shiftleft(h, BIN_BITS).bitwiseOR(_bin(at(s, i)).bitwiseAND(F.lit(BINS - 1).cast("long")))

        return F.transform(firsts, entry)

    words = split_words(text)
    return let(words, lambda w: let(packed(kmers(w)), lambda s: let(
        F.sort_array(numbered(s)), lambda t: let(least(t), entry_of))))


def written(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.hex(x))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Equal entries as a share of the bins that either has."""
    def number(x: Column) -> Column:
        return x.bitwiseAND(F.lit(BINS - 1).cast("long"))

    both = F.size(F.array_union(F.transform(a, number), F.transform(b, number)))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def successors(docs: DataFrame) -> DataFrame:
    """(doc, n, m, next): of rows (doc, n) the distinct documents, how many
    rows each has, and the document after it in descending order (after the
    last, the first).

    Documents are range-sorted; neighbours are found inside the ranges, and
    between ranges from one row for each range.
    """
    ranged = staged(docs.groupBy("doc").agg(F.max("n").alias("n"), F.count("*").alias("m"))
                    .orderBy(F.desc("doc")).withColumn("range", F.spark_partition_id()), "omh-order")
    order = Window.orderBy("range")  # one row for each range of the sort
    heads = (ranged.groupBy("range").agg(F.max("doc").alias("head"))
             .withColumn("after", F.coalesce(F.lead("head").over(order), F.first("head").over(
                 order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
             .select("range", "after"))
    inside = Window.partitionBy("range").orderBy(F.desc("doc"))
    return (ranged.withColumn("next", F.lead("doc").over(inside)).join(heads, "range")
            .select("doc", "n", "m", F.coalesce("next", "after").alias("next")))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text (its last third replaced
    by the beginning of the next document, ids descending, rows that share an
    id in the order of a hash of their texts) and their likenesses:
    (id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next); ``edited`` is a SHA-256, fingerprints are arrays."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(document(id_col, text_col).alias("doc"), text.alias("text"))
    links = staged(successors(base.select("doc", F.char_length("text").alias("n"))), "omh-links")
    texts = base.groupBy("doc").agg(F.any_value("text").alias("text"))
    # what each document gives to the one before it
    given = (texts.join(links.select(F.col("next").alias("doc"), F.col("doc").alias("to"), "n"), "doc")
             .select(F.col("to").alias("doc"), F.expr("left(text, n div 3)").alias("given")))
    edited = F.concat(F.expr("left(text, n - n div 3)"), F.col("given"))
    prints = staged(
        texts.join(given, "doc").join(links, "doc")
        .select("doc", "next", "m", F.col("n").cast("long").alias("n_chars"), "text", edited.alias("edited"))
        .select("doc", "next", "m", "n_chars", F.sha2(F.col("edited"), 256).alias("edited"),
                entries(F.col("text")).alias("fingerprint"), entries(F.col("edited")).alias("edited_fingerprint")),
        "omh-prints")
    after = prints.select(F.col("doc").alias("next"), F.col("fingerprint").alias("next_fingerprint"))
    return (prints.join(after, "next")
            .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
            .select(F.col("doc.id").alias(id_col), "n_chars", "edited", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")))
