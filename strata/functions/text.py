"""Column expressions for identifiers, untidy text and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: texts that stand for "missing" after trimming and upper-casing
NULL_TOKENS = ["", "NULL", "UNK", "NA", "N/A", "-9", "999", "NONE"]


def is_missing(c: Column) -> Column:
    """Null, or one of NULL_TOKENS after trimming and upper-casing. Never null itself."""
    return c.isNull() | F.upper(F.trim(c)).isin(NULL_TOKENS)


def present(c: Column) -> Column:
    """The value, or null where it is missing."""
    return F.when(~is_missing(c), c)


def id_of(c: Column) -> Column:
    """Canonical identifier: trimmed, upper case; null where missing."""
    return F.when(~is_missing(c), F.upper(F.trim(c)))


def key_of(c: Column) -> Column:
    """Canonical identifier where only null and blank mean "no reference"."""
    k = F.upper(F.trim(c))
    return F.when(F.length(k) > 0, k)


def attribute_of(c: Column) -> Column:
    """Canonical attribute text: trimmed, lower case; null where missing."""
    return F.when(~is_missing(c), F.lower(F.trim(c)))


def micros(c: Column) -> Column:
    """Timestamp (with or without zone, read as UTC) to epoch microseconds."""
    return F.unix_micros(c.cast("timestamp"))


def seconds(c: Column) -> Column:
    """Timestamp (with or without zone, read as UTC) to epoch seconds (bigint)."""
    return F.unix_seconds(c.cast("timestamp"))
