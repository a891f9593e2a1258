"""Text expressions. All are built-in Spark expressions, so they stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def clean_string(value: Column) -> Column:
    """Letters, digits and white space only, lower case, no white space at the ends."""
    kept = F.regexp_replace(value, r"(?U)[^a-zA-Z0-9\s]", "")
    return F.lower(F.regexp_replace(kept, r"(?U)^\s+|\s+$", ""))


def safe_file_name(value: Column) -> Column:
    """Remove the characters that file systems forbid."""
    return F.regexp_replace(value, r'[<>:"/\\|?*]', "")


def base_name(path: Column) -> Column:
    """Last part of a path with either kind of separator."""
    return F.element_at(F.split(path, r"[/\\]"), -1)


def blank_to(value: Column, marker: str) -> Column:
    """Null and empty text become the marker."""
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(marker)).otherwise(value)


def trimmed(value: Column) -> Column:
    """Trimmed text, empty when null."""
    return F.trim(F.coalesce(value, F.lit("")))


def address_line(street: Column, city: Column, state: Column, postcode: Column) -> Column:
    """`street city, state postcode`; the comma is left out when there is no state."""
    gap = F.when(F.trim(F.coalesce(state, F.lit(""))) == "", F.lit(" ")).otherwise(F.lit(", "))
    return F.concat(trimmed(street), F.lit(" "), trimmed(city), gap, trimmed(state), F.lit(" "), trimmed(postcode))


def mapped(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace known values, ignoring case; other values stay as they are."""
    chain = None
    for source, target in mapping.items():
        test = F.lower(value) == source.lower()
        chain = F.when(test, F.lit(target)) if chain is None else chain.when(test, F.lit(target))
    return value if chain is None else chain.otherwise(value)


def any_like(value: Column, patterns: Sequence[str]) -> Column:
    """True when the text matches one of the LIKE patterns, ignoring case."""
    test = value.ilike(patterns[0])
    for pattern in patterns[1:]:
        test = test | value.ilike(pattern)
    return test


def split_list(param: str) -> list[str]:
    """A comma list parameter as values: blanks around a value, empty items and repeats are dropped."""
    return list(dict.fromkeys(part.strip() for part in param.split(",") if part.strip()))


def number_list(param: str | Sequence[int] | None) -> tuple[int, ...] | None:
    """A parameter of numbers, given as a comma list or as values; None stays None."""
    if param is None:
        return None
    return tuple(int(part) for part in (split_list(param) if isinstance(param, str) else param))


def list_relation(spark: SparkSession, param: str, name: str = "value", place: str = "place") -> DataFrame:
    """A comma list as a relation, to be joined: its values with their places from 1. Blanks around a value are dropped, and
    so are empty items; a value that repeats stays at its first place. Text without any value gives no rows."""
    items = spark.range(1).select(F.posexplode(F.split(F.lit(param), ",")).alias("_at", "_item"))
    values = items.select(F.trim("_item").alias(name), "_at").filter(F.col(name) != "")
    firsts = values.groupBy(name).agg(F.min("_at").alias("_at"))
    # a parameter is a short text: its places are counted in one task
    return firsts.select(name, F.row_number().over(Window.orderBy("_at")).alias(place))


def listed_values(
    df: DataFrame, group_by: Sequence[str], column: str, name: str, separator: str = ",", most: int = 10_000
) -> DataFrame:
    """Per group, or over everything, the distinct values in order, joined by the separator.

    Values are made distinct first, and no task sends more than `most` + 1 of a group; a group with more than `most` is an
    error, as its list would be a value without bound. Nulls are left out; a group without values has an empty text.
    """
    distinct = df.select(*group_by, F.col(column).alias("_value")).distinct()
    place = F.row_number().over(Window.partitionBy(*group_by).orderBy(F.col("_value").asc_nulls_last()))
    ranked = distinct.withColumn("_place", place).filter(F.col("_place") <= most + 1)
    few = F.assert_true(F.count("_value") <= most, F.lit(f"more than {most} values of {column} in one list"))
    joined = F.array_join(F.sort_array(F.collect_list("_value")), separator)
    return ranked.groupBy(*group_by).agg(joined.alias(name), few.alias("_few")).filter(F.col("_few").isNull()).drop("_few")
