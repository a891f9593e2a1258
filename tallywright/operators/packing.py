"""Narrower rows for the time they are shuffled: texts joined into one, times as spans, small numbers side by side in one.

Every text column of a row costs a word for its place and length and is padded to whole words, which change from row to row
and compress badly; one text holds the same values in little more than half the bytes. Values come back as they were, whatever
they hold. So do numbers: each of its own takes a word, of which the few bytes that differ compress apart from the next.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Control characters; where a value holds one itself, it is written as the escape and a digit.
SEPARATOR, ESCAPE = "\x1f", "\x1e"
_WRITTEN = ((ESCAPE, ESCAPE + "0"), (SEPARATOR, ESCAPE + "1"))
_NULL = ESCAPE + "2"


def packed(values: Sequence[Column]) -> Column:
    """The texts in one text."""

    def written(value: Column) -> Column:
        value = value.cast("string")
        for raw, escaped in _WRITTEN:
            value = F.replace(value, F.lit(raw), F.lit(escaped))
        return F.coalesce(value, F.lit(_NULL))

    return F.concat_ws(SEPARATOR, *[written(v) for v in values])


def packed_again(*columns: str) -> Column:
    """Packed texts, none of them null, as one packed text with the places of all of them."""
    return F.concat_ws(SEPARATOR, *columns)


def parts(text: Column) -> Column:
    """What `unpacked` takes values from; to be a column of its own, so that a text is split once."""
    return F.split(text, SEPARATOR)


def _restored(part: Column) -> Column:
    value = part
    for raw, escaped in reversed(_WRITTEN):
        value = F.replace(value, F.lit(escaped), F.lit(raw))
    return F.when(part != _NULL, value)


def unpacked(of_parts: Column, place: int) -> Column:
    """The value at a place, counted from 0."""
    return _restored(F.get(of_parts, F.lit(place)))


def last_value(text: Column) -> Column:
    """The last value of a packed text, which needs no splitting."""
    return _restored(F.substring_index(text, SEPARATOR, -1))


def _origin(since: str) -> Column:
    return F.coalesce(since, F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz"))


def spanned(column: str, since: str) -> Column:
    """A time without zone as the span since another of its row, to the microsecond; near times make similar spans."""
    return (F.col(column) - _origin(since)).alias(column)


def unspanned(column: str, since: str) -> Column:
    return (_origin(since) + F.col(column)).alias(column)


def folded(bits: Mapping[str, int], name: str) -> list[Column]:
    """Whole numbers as one of 63 bits at most, null where a number needs more bits than it has or is below 0; the numbers are
    then in a text beside it, which is null otherwise. A null number takes the largest value of its bits."""
    assert sum(bits.values()) <= 63
    whole, at = F.lit(0).cast("long"), 0
    for column, width in bits.items():
        value, none = F.col(column).cast("long"), F.lit((1 << width) - 1).cast("long")
        piece = F.when(value.isNull(), none).when(value.between(F.lit(0), none - 1), value)
        whole, at = whole.bitwiseOR(F.shiftleft(piece, at)), at + width
    return [whole.alias(name), F.when(whole.isNull(), packed([F.col(c) for c in bits])).alias(f"{name}_rest")]


def unfolded(bits: Mapping[str, int], name: str) -> dict[str, Column]:
    """The numbers of a folded one by name; all null where there is neither the one nor the text."""
    found, at = {}, 0
    of_rest = parts(F.col(f"{name}_rest"))
    for place, (column, width) in enumerate(bits.items()):
        none = F.lit((1 << width) - 1).cast("long")
        piece = F.shiftright(name, at).bitwiseAND(none)
        found[column] = F.when(F.col(name).isNotNull(), F.nullif(piece, none)).otherwise(unpacked(of_rest, place).cast("long"))
        at += width
    return found


def day_number(column: str) -> Column:
    """The day of a time without zone, counted from 1970."""
    return F.unix_date(F.col(column).cast("date"))


def of_day(column: str) -> Column:
    """The span since the begin of a time's day."""
    return F.col(column) - F.col(column).cast("date").cast("timestamp_ntz")


def day_and_span(day: Column, span: Column) -> Column:
    return F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz") + span
