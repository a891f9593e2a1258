"""Money, number and null expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dollars(cents: Column) -> Column:
    """Integer cents as currency units, in double."""
    return cents.cast("double") / F.lit(100.0)


def money_text(value: Column, precision: int = 17, scale: int = 2) -> Column:
    """Free-form money text to decimal: drops `$` and `,`, reads `..` as `.`; blank or unreadable text is null."""
    cleaned = F.replace(value, F.lit("$"), F.lit(""))
    cleaned = F.replace(cleaned, F.lit(","), F.lit(""))
    cleaned = F.replace(cleaned, F.lit(".."), F.lit("."))
    return F.nullif(F.trim(cleaned), F.lit("")).try_cast(f"decimal({precision},{scale})")


def fixed_point(value: Column, precision: int = 17, scale: int = 2) -> Column:
    return value.cast(f"decimal({precision},{scale})")


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def sum_when(condition: Column, value: Column, otherwise: Column | None = None) -> Column:
    """Conditional sum; rows that fail the condition add `otherwise`, or nothing at all when it is left out."""
    picked = F.when(condition, value)
    return F.sum(picked if otherwise is None else picked.otherwise(otherwise))
