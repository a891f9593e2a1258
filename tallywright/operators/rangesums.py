"""Sums of dated facts over many date ranges of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

EXACT = (T.IntegralType, T.DecimalType)


def valid_ranges(ranges: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Distinct ranges of dates that hold at least a day."""
    return ranges.select(key, start, end).filter(F.col(key).isNotNull() & (F.col(start) <= F.col(end))).distinct()


def covered_days(ranges: DataFrame, key: str, start: str, end: str, day: str = "day") -> DataFrame:
    """The days that any range of a key holds, each once: ranges that overlap or touch are merged into disjoint ones before
    they are spread into days, so a day is not repeated per range."""
    in_order = Window.partitionBy(key).orderBy(start, end)
    reached = F.max(end).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    parted = F.coalesce(F.col(start) > F.date_add(reached, 1), F.lit(True)).cast("int")
    marked = valid_ranges(ranges, key, start, end).withColumn("_parted", parted)
    merged = (
        marked.withColumn("_island", F.sum("_parted").over(in_order))
        .groupBy(key, "_island")
        .agg(F.min(start).alias("_first"), F.max(end).alias("_last"))
    )
    return merged.select(key, F.explode(F.sequence("_first", "_last")).alias(day))


def range_sums(
    facts: DataFrame,
    ranges: DataFrame,
    key: str,
    day: str,
    start: str,
    end: str,
    measures: Sequence[str],
) -> DataFrame:
    """For each distinct (key, start, end): the sum of every measure over facts with start <= day <= end.

    A sum is null when no fact in the range has a value. Facts on days that no range of their key holds are dropped first,
    by an equi-join on key and day that spreads a hot key over its days. The rest are added up per key and day, so what a
    key holds from then on is bounded by the calendar. A running total per key then answers every range as `total up to
    end` minus `total up to the day before start`; facts and ranges are never paired. Such differences are right for exact
    numbers only, so other measures are an error: cast them to a decimal.
    """
    inexact = [m for m in measures if not isinstance(facts.schema[m].dataType, EXACT)]
    if inexact:
        raise TypeError(f"range sums need integers or decimals, not {inexact}: cast them first")
    bounds = valid_ranges(ranges, key, start, end)
    covered = covered_days(ranges, key, start, end, "_day")
    inside = (
        facts.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
        .withColumn("_day", F.col(day).cast("date"))
        .join(covered, [key, "_day"], "left_semi")
        .select(key, "_day", *measures)
    )
    return tagged_range_sums(inside.unionByName(bounds, allowMissingColumns=True), key, "_day", start, end, measures)


def tagged_range_sums(rows: DataFrame, key: str, day: str, start: str, end: str, measures: Sequence[str]) -> DataFrame:
    """As `range_sums`, of one table: a row with a day is a fact, one with a start and an end is a range, or both at once.

    Facts are added up per key and day and ranges made distinct by one grouping. The caller leaves out facts that no range
    needs.
    """
    nothing = [F.lit(None).cast(rows.schema[m].dataType).alias(m) for m in measures]
    edge = lambda at, sign: F.struct(
        at.alias("_day"), F.lit(1).alias("_order"), F.lit(sign).alias("_sign"), F.col(start).alias(start), F.col(end).alias(end), *nothing
    )
    fact = F.struct(
        F.col(day).cast("date").alias("_day"),
        F.lit(0).alias("_order"),
        F.lit(0).alias("_sign"),
        F.lit(None).cast(rows.schema[start].dataType).alias(start),
        F.lit(None).cast(rows.schema[end].dataType).alias(end),
        *[F.col(m).alias(m) for m in measures],
    )
    holds = F.col(start) <= F.col(end)
    tagged = F.array(
        F.when(F.col(day).isNotNull(), fact),
        F.when(holds, edge(F.col(end).cast("date"), 1)),
        F.when(holds, edge(F.date_sub(F.col(start), 1), -1)),
    )
    reduced = (
        rows.filter(F.col(key).isNotNull())
        .select(key, F.explode(F.array_compact(tagged)).alias("_t"))
        .select(key, "_t.*")
        .groupBy(key, "_day", "_order", "_sign", start, end)
        .agg(*[F.sum(m).alias(m) for m in measures], *[F.count(m).alias(f"_n_{m}") for m in measures])
    )
    so_far = Window.partitionBy(key).orderBy("_day", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = [c for m in measures for c in (m, f"_n_{m}")]
    totals = reduced.select(
        key, start, end, "_order", "_sign", *[F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(c) for c in columns]
    )
    per_range = (
        totals.filter(F.col("_order") == 1)
        .groupBy(key, start, end)
        .agg(*[F.sum(F.col(c) * F.col("_sign")).alias(c) for c in columns])
    )
    return per_range.select(key, start, end, *[F.when(F.col(f"_n_{m}") > 0, F.col(m)).alias(m) for m in measures])
