"""Words of a text as built-in Spark expressions, for the operators that run without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Between words, after lower-casing A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word in a text that has not been lower-cased.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. For pure ASCII text ``lower`` is the same and much cheaper."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text; null: none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_ANY_CASE)).cast("long")


def row_key(text: Column) -> Column:
    """With the id, tells rows apart that repeat an id with another text."""
    return F.xxhash64(text)
