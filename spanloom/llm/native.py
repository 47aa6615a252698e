"""Column helpers shared by the operators that stay inside DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The ASCII letters.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.transform(F.array(value), body)[0]


#: The white space that separates words, as a pattern.
GAP = r"[ \t\n\x0B\f\r]+"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def ascii_lower(text: Column) -> Column:
    """ASCII letters in lower case, all other characters as they are."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def run_keys(hashes: Column, size: int) -> Column:
    """A hash of each run of ``size`` neighbours of an array of longs, made of two
    overlapping shorter runs each time; empty where there are too few."""

    def grown(keys: Column, have: int) -> Column:
        if have == size:
            return F.slice(keys, F.lit(1), F.greatest(F.size(keys) - size + 1, F.lit(0)))
        step = min(have, size - have)
        return let(keys, lambda k: grown(F.zip_with(k, F.slice(k, F.lit(step + 1), F.size(k)), lambda a, b: F.xxhash64(a, b)), have + step))

    return grown(hashes, 1) if size > 1 else hashes
