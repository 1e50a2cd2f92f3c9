"""Column expressions. All are built-ins, so they stay inside generated code on the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicklake.schemas import DEVICE_TYPES, HASHED_IP_PATTERN, WATERMARK_DIGITS

_PRIME = 2147483647


def date_key(day: Column) -> Column:
    """2026-09-19 -> 20260919."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def padded_name(day: Column, pattern: str) -> Column:
    """Day or month name, padded with blanks to the nine characters of the longest name."""
    return F.rpad(F.date_format(day, pattern), 9, " ")


def url_host(url: Column) -> Column:
    """Host of a URL; NULL when the text is not a URL."""
    return F.try_parse_url(url, F.lit("HOST"))


def known_device(raw: Column) -> Column:
    """Lower-case, trimmed device name; anything outside the known list is ``unknown``."""
    name = F.trim(F.lower(raw))
    return F.when(name.isin(DEVICE_TYPES), name).otherwise("unknown")


def valid_digest(raw: Column) -> Column:
    """A trimmed SHA-256 hex digest, or NULL for any other text."""
    digest = F.trim(raw)
    return F.when(digest.rlike(HASHED_IP_PATTERN), digest)


def zero_padded(number: Column, width: int = WATERMARK_DIGITS) -> Column:
    """Fixed-width decimal text; numbers wider than ``width`` keep all their digits."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def full_key(table: Column, day: Column) -> Column:
    """Storage key of a full snapshot."""
    return F.concat(F.lit("bronze/"), table, F.lit("/ingestion_date="), F.date_format(day, "yyyy-MM-dd"))


def incremental_key(table: Column, start: Column, end: Column) -> Column:
    """Storage key of an incremental batch."""
    return F.concat(
        F.lit("bronze/"), table, F.lit("/incremental/watermark_start="), zero_padded(start),
        F.lit("/watermark_end="), zero_padded(end),
    )


def scatter(number: Column, seed: int) -> Column:
    """Well-spread integer in [0, 2^31 - 1) that depends only on the row number and the seed.

    Integer arithmetic only, so a retried task and any other SQL engine give the same value.
    """
    base = number % F.lit(_PRIME).cast("bigint")
    first = (base * 48271 + (seed * 69621 + 11) % _PRIME) % _PRIME
    second = (first * first + seed + 1) % _PRIME
    return (second * 16807 + first) % _PRIME


def weighted_choice(draw: Column, choices: Sequence[tuple[str, int]]) -> Column:
    """Pick a value with integer weights from an evenly spread draw."""
    total = sum(weight for _, weight in choices)
    bucket = draw % total
    upper = 0
    picked = None
    for value, weight in choices[:-1]:
        upper += weight
        hit = bucket < upper
        picked = F.when(hit, value) if picked is None else picked.when(hit, value)
    last = choices[-1][0]
    return F.lit(last) if picked is None else picked.otherwise(last)
