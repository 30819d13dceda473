"""Small column helpers for array work inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Space and \x09-\x0D, the characters between words.
SPACES = " \t\n\x0b\x0c\r"


def free(docs: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``docs`` has."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def document(id_col: str, text_col: str) -> Column:
    """(id, key) that tells documents apart and orders them: by id, rows that
    share an id by a hash of their texts.

    ``key`` is nullable like any column that is read back, so that a join
    with a stage table needs no cast and keeps the partitioning.
    """
    key = F.nullif(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(-(1 << 63)))
    return F.struct(F.col(id_col).alias("id"), key.alias("key"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A column used inside a lambda may be inlined there and computed for
    every element; as a lambda variable it is computed before.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def at(array: Column, index: Column) -> Column:
    """Element at a 0-based index, null outside."""
    return F.get(array, index)


def upto(n: Column) -> Column:
    """0, 1, ... n - 1 (empty for n < 1)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def split_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def has_word(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES)) != ""


def window_hashes(hashes: Column, k: int) -> Column:
    """64-bit hash of every k consecutive elements of an array of hashes."""
    return let(hashes, lambda h: F.transform(
        upto(F.size(h) - (k - 1)), lambda i: F.xxhash64(*[at(h, i + j) for j in range(k)])))


#: Bits of a position in a packed (hash, position) long.
POSITION_BITS = 28


def packed(hashes: Column) -> Column:
    """Sorted longs of each element's leading hash bits and its position."""
    return F.sort_array(F.transform(
        hashes, lambda h, i: F.shiftleft(F.shiftright(h, POSITION_BITS), POSITION_BITS).bitwiseOR(i.cast("long"))))


def position(pack: Column) -> Column:
    return pack.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")


def same_bits(a: Column, b: Column) -> Column:
    return F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)
