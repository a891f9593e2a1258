"""Rendezvous hashing of record keys over weighted shards, and gapless places inside each shard.

Each shard draws a number u in (0, 1) for a key from a hash of key and shard; the key goes to the shard with the least
`-ln(u) / weight`. A shard gets keys in proportion to its weight. A further shard only takes keys to itself, and one that
goes only gives its own away: no other key moves.

Places number a shard's rows from 0 without gaps. No shard is sorted as a whole: rows fall into `slices` by a hash of the
key, slices are counted (from the key column alone), and a running total of the counts is the first place of each slice.

Everything here is built-in SQL functions. Defined results: a null key is a key like any other. Null sizes and texts are
up to the caller. Rows that repeat a key share its shard and have places next to each other, in the order of `ties`.
Shards with weight 0 get nothing; negative weights and an empty list are errors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of the hash that become the drawn number: 52 bits fit a double.
DIGITS = 13


def hashed(key: str, *, before: str = "", after: str = "") -> Column:
    """52 bits of a hash of the key between two texts."""
    text = F.concat(F.lit(before), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null")), F.lit(after))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def drawn(key: str, shard: int) -> Column:
    """The shard's number for the key, in (0, 1)."""
    return (hashed(key, after=f":{shard}").cast("double") + 0.5) / float(16**DIGITS)


def shard_of(key: str, weights: Sequence[float]) -> Column:
    """Shard (from 0) of the key column; shard i has weights[i]."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be positive numbers or 0, at least one above 0")
    bids = [
        F.struct((-F.log(drawn(key, i)) / F.lit(float(w))).alias("bid"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    return (F.least(*bids) if len(bids) > 1 else bids[0])["shard"]


def sharded(rows: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    return rows.withColumn(name, shard_of(key, weights))


def placed(rows: DataFrame, key: str, weights: Sequence[float], ties: Sequence[str] = (), slices: int = 4096) -> DataFrame:
    """rows with `shard` and `slot`, the row's place in its shard. slices: hash slices per shard; a task numbers whole
    slices, each about `rows / (shards * slices)` long."""
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    keys = {f"k{n}": F.col(f"`{c}`") for n, c in enumerate((key, *ties))}
    part = lambda frame: sharded(frame, "k0", weights).withColumn(
        "slice", (hashed("k0", before="slice:") % slices).cast("int")
    )
    counted = part(rows.select(keys["k0"].alias("k0"))).groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("rows"))
    first = counted.withColumn(
        "first",
        F.expr("coalesce(sum(rows) over (partition by shard order by slice rows between unbounded preceding and 1 preceding), 0)"),
    ).drop("rows")
    # the caller's columns travel in one struct, so that no name of theirs meets one of these
    carried = rows.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *(value.alias(k) for k, value in keys.items()))
    inside = part(carried).withColumn("place", F.expr(f"row_number() over (partition by shard, slice order by {', '.join(keys)})"))
    slot = (F.col("first") + F.col("place") - 1).alias("slot")
    return inside.join(first, ["shard", "slice"]).select(*(F.col(f"row.`{c}`") for c in names), "shard", slot)
