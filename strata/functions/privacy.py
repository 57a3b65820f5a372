"""Pseudonymous keys, date shifting and generalisation, all as native expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unit-separator symbol between the parts of a hashed record.
SEP = "␟"
# fixed values: three-digit postal areas with few inhabitants
SMALL_ZIP3 = ["036", "059", "063", "102", "203", "556", "692", "878", "879", "884"]


def hmac_blocks(pepper: str) -> tuple[bytes, bytes]:
    """Inner and outer key block of HMAC-SHA256."""
    key = pepper.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_hex(c: Column, pepper: str) -> Column:
    """HMAC-SHA256 as hex text; null for null or empty text. Two nested sha2 over binary, inside
    generated code, equal to Python's hmac."""
    inner, outer = hmac_blocks(pepper)
    msg = F.encode(c, "UTF-8")
    digest = F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), msg), 256))), 256)
    return F.when(c.isNotNull() & (c != ""), digest)


def record_hash(columns: list[Column]) -> Column:
    """Hash of a whole record: texts of all columns, nulls as empty, joined by SEP."""
    return F.sha2(F.concat_ws(SEP, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)


def record_hash_marked(columns: list[Column]) -> Column:
    """As `record_hash`, with null and empty both as "<NULL>"."""
    return F.sha2(F.concat_ws(SEP, *[F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("<NULL>")) for c in columns]), 256)


def row_fingerprint(columns: list[Column]) -> Column:
    """Hash of the non-null values joined by a pipe. Positions of nulls don't count."""
    return F.sha2(F.concat_ws("|", *columns), 256)


def day_offset(key: Column, pepper: str, most: int = 365) -> Column:
    """Whole days in [-most, most], fixed per key."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{pepper}|shift|"), key), 256), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % (2 * most + 1) - most).cast("int")


def shifted_date(date: Column, key: Column, pepper: str) -> Column:
    """The date moved by its key's offset; intervals within a key stay the same."""
    return F.date_add(date.cast("date"), day_offset(key, pepper))


def zip3(c: Column) -> Column:
    """First three digits of a postal code; null where few people live there."""
    head = F.substring(F.trim(c), 1, 3)
    return F.when(~head.isin(SMALL_ZIP3), head)


def age_band(birth_year: Column, as_of_year: int = 2024) -> Column:
    """Decade of age ("00s" to "80s"), "90+" above 89, "unknown" for null or negative ages."""
    age = F.lit(as_of_year) - birth_year
    decade = F.concat((F.floor(age / 10) * 10).cast("int").cast("string"), F.lit("s"))
    return (
        F.when(age.isNull() | (age < 0), F.lit("unknown")).when(age > 89, F.lit("90+"))
        .when(age < 10, F.lit("00s")).otherwise(decade)
    )


def truthy(c: Column) -> Column:
    """true and 1 are true; everything else, null included, is false."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1"), F.lit(False))


def digest_bucket(text: Column, buckets: int) -> Column:
    """The first eight hex digits of the text's SHA-256, modulo `buckets`."""
    return (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def without_free_text(df, columns: list[str]):
    """`df` with the named columns nulled."""
    return df.select(*[F.lit(None).cast(t).alias(c) if c in columns else F.col(c) for c, t in df.dtypes])


def guard_identifiers(df, forbidden: set[str]):
    """`df`, or an error if a direct identifier is among its columns."""
    leaked = sorted(forbidden & set(df.columns))
    if leaked:
        raise ValueError(f"direct identifiers in output: {leaked}")
    return df


def masked_view(df, masks: dict[str, Column]):
    """`df` with columns replaced by what the reader may see."""
    return df.select(*[masks[c].alias(c) if c in masks else F.col(c) for c in df.columns])
