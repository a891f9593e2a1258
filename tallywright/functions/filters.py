"""Predicates that depend on optional or coded parameters: decided in Python, so an unset one never reaches the plan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Country and state spellings used by the region modes.
CANADA = "CA"
UNITED_STATES = ("US", "United States")
OUTSIDE_STATES = ("British Columbia", "BC", "VIC", "PR")


def all_of(tests: Sequence[Column | None]) -> Column:
    """Conjunction of the tests that are set."""
    return reduce(lambda a, b: a & b, [t for t in tests if t is not None], F.lit(True))


def equals_if_set(column: Column, value: object | None) -> Column | None:
    return None if value is None else column == F.lit(value)


def in_if_set(column: Column, values: Sequence[object] | None) -> Column | None:
    return None if values is None else column.isin(list(values))


def same_text(column: Column, values: Sequence[str]) -> Column:
    """Membership that ignores case and trailing blanks, as the source servers compare text."""
    return F.lower(F.rtrim(column)).isin([v.rstrip(" ").lower() for v in values])


def region_mode(country: Column, state: Column, mode: int | None) -> Column | None:
    """1: Canada only. 2: anything but Canada. 3: United States or unknown country, outlying states left out."""
    if mode is None:
        return None
    if mode == 1:
        return same_text(country, [CANADA])
    if mode == 2:
        return ~same_text(country, [CANADA]) | country.isNull()
    if mode == 3:
        return (same_text(country, UNITED_STATES) | country.isNull()) & ~same_text(state, OUTSIDE_STATES)
    return F.lit(False)


def tender_switch(tender: Column, columns: str, card_code: int = 1, echeck_code: int = 6) -> Column:
    """Tenders chosen by a free-text switch holding `all`, `cc` and/or `ec`."""
    switch = columns.lower()
    if "all" in switch:
        return F.lit(True)
    wanted = [code for word, code in (("cc", card_code), ("ec", echeck_code)) if word in switch]
    return tender.isin(wanted) if wanted else F.lit(False)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; rows where it is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
