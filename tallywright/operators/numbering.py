"""Row numbers, running totals, batches and per-group flags that never put a whole group on one task.

Numbers in an order need to know what stands before a row. The order is cut into at most `SLICES` slices by bounds taken
from the data: a row's number is its place in its slice plus the rows of its group in earlier slices. The bounds are a sample
of the whole keys (group, then all order columns), so they follow the data whatever the keys look like: a common head, a
hot group, a hot first column. They reach the rows as a scalar subquery; no job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICES = 4096
#: One key in 2^5 can become a bound; of those, one for each of so many buckets of their hashes.
RARITY_BITS, BUCKETS = 5, 2 * SLICES


def _key(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def slice_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the keys at which slices 1 to `SLICES` - 1 begin, in order.

    The keys with the least hash of each bucket are the sample, so at most `BUCKETS` keys meet at any size of the data, each
    task passes on no more than that, and the same data always give the same bounds. A slice holds some tens of different
    keys, or more once there are a few hundred thousand.
    """
    hash = F.xxhash64(*columns)
    keys = df.select(_key(columns).alias("key"), hash.alias("hash")).where(F.col("hash").bitwiseAND(F.lit((1 << RARITY_BITS) - 1)) == 0)
    bucket = F.pmod(F.shiftright("hash", RARITY_BITS), F.lit(BUCKETS))
    least = keys.groupBy(bucket.alias("bucket")).agg(F.min(F.struct("hash", "key")).alias("least"))
    sample = least.agg(F.sort_array(F.collect_list("least.key")).alias("sample"))
    places = F.sequence(F.lit(1), F.lit(SLICES - 1))
    at = lambda n: F.get("sample", F.floor(n * F.size("sample") / SLICES).cast("int"))
    return sample.select(F.transform(places, at).alias("bounds"))


def with_slices(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The slice of each row: how many bounds its key has reached, found by halving.

    The bounds are one value that all rows refer to; they are dropped before rows are written anywhere.
    """
    bounds = slice_bounds(df, columns).scalar()
    rows = df.withColumns({"_key": _key(columns), "_bounds": bounds})
    # one select whose columns build on one another, as each further one would analyse the whole plan again
    halves = [SLICES >> (n + 1) for n in range(SLICES.bit_length() - 1)]
    found = [F.expr(f"_s{n} + if(get(_bounds, _s{n} + {half - 1}) <= _key, {half}, 0)").alias(f"_s{n + 1}") for n, half in enumerate(halves)]
    rows = rows.select(*(F.col(f"`{c}`") for c in rows.columns), F.lit(0).alias("_s0"), *found)
    return rows.select(*(F.col(f"`{c}`") for c in df.columns), F.col(f"_s{len(halves)}").alias(name))


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    totals: Mapping[str, Column],
    group_by: Sequence[str] = (),
    ties_by: Sequence[str] = (),
) -> DataFrame:
    """For each name the sum of its column over the group's rows up to and including this one. Nulls count as zero.

    Rows are sorted per group and slice. Sums per group and slice, of which a group has at most `SLICES`, are added up on their
    own; what stands before a group's later slices comes as one more row at their head, so that rows are shuffled once.
    `order_by` should tell nearly all rows of a group apart: rows that tie stay in one slice, ordered by `ties_by`, which the
    passes for bounds and sums need not read. Nulls come first.
    """
    sliced = with_slices(df, [*group_by, *order_by], "_slice")
    sliced = sliced.withColumns({f"_of_{n}": F.coalesce(value, F.lit(0)) for n, value in totals.items()})
    sums = sliced.groupBy(*group_by, "_slice").agg(*[F.sum(f"_of_{n}").alias(f"_sum_{n}") for n in totals])
    earlier = Window.partitionBy(*group_by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *group_by, "_slice", F.lit(True).alias("_before"), *[F.sum(f"_sum_{n}").over(earlier).alias(f"_of_{n}") for n in totals]
    ).filter(" or ".join(f"`_of_{n}` is not null" for n in totals))
    within = Window.partitionBy(*group_by, "_slice").orderBy(F.col("_before").desc_nulls_last(), *[F.col(k).asc() for k in (*order_by, *ties_by)])
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sliced.unionByName(offsets, allowMissingColumns=True)
    placed = rows.withColumns({f"_in_{n}": F.sum(f"_of_{n}").over(within) for n in totals}).filter(F.col("_before").isNull())
    kinds = sums.agg(*[(F.max(f"_sum_{n}") + F.sum(f"_sum_{n}")).alias(n) for n in totals]).schema
    return placed.select(*df.columns, *[F.col(f"_in_{n}").cast(kinds[n].dataType).alias(n) for n in totals])


def number_rows(
    df: DataFrame, order_by: Sequence[str], group_by: Sequence[str] = (), name: str = "row_no", ties_by: Sequence[str] = ()
) -> DataFrame:
    """`row_number()` over the order, within each group if groups are given, one plan for every size; see running_totals."""
    return running_totals(df, order_by, {name: F.lit(1).cast("long")}, group_by, ties_by)


def batch_numbers(df: DataFrame, order_by: Sequence[str], size: int, name: str = "batch_no") -> DataFrame:
    """Consecutive batches of `size` rows in the given order, numbered from 1."""
    numbered = number_rows(df, order_by, name="_position")
    batch = F.floor((F.col("_position") - 1) / F.lit(size)) + 1
    return numbered.withColumn(name, batch.cast("long")).drop("_position")


def first_in_group(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """Flag the first row of each group: a grouped minimum joined back, so no group is sorted as a whole."""
    key = F.struct(*[F.col(c) for c in order_by])
    firsts = df.groupBy(*[F.col(g).alias(f"_of_{g}") for g in group_by]).agg(F.min(key).alias("_first"))
    match = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group_by]
    return (
        df.join(firsts, match, "left")
        .withColumn(name, key == F.col("_first"))
        .drop("_first", *[f"_of_{g}" for g in group_by])
    )


def occurrence_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """How often each row's key occurs, counted by key and joined back."""
    counts = df.groupBy(F.col(key).alias("_of_key")).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, F.col(key).eqNullSafe(F.col("_of_key")), "left").drop("_of_key")
