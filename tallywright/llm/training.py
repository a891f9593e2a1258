"""What the trained operators share: the bounded sample of labelled rows, and fitting a model in one task.

The sample holds at most `rows` labelled rows, those with the smallest hash of their id, so it does not depend on order,
partitions or retries. It is a few bytes a row and is therefore broadcast to the documents, of which only the sampled
ones are turned into features and moved to the fitting task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Rows kept back from training: crc32 of the key's text, modulo `parts`, is `part`. Rows without a key are not."""
    remainder = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % parts
    return F.coalesce(remainder == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """docs, given with the columns that are needed alone, of the sample, with `_y` (0 or 1) and `_order`."""
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull() & ~held_out(key))
    order = F.xxhash64(F.lit("sample"), F.col(f"`{key}`"))
    sample = known.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("_y"), order.alias("_order"))
    sample = sample.orderBy("_order", "_key", "_y").limit(rows)
    return docs.join(F.broadcast(sample), F.col(f"`{key}`") == F.col("_key")).drop("_key")


def fitted(examples: DataFrame, fit: Callable[[pd.DataFrame], bytes]) -> bytes:
    """The model that fit() makes of all examples in the sample's order, in one task; None where there are none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [batch for batch in batches if len(batch)]
        if parts:
            yield pd.DataFrame({"model": [fit(pd.concat(parts).sort_values(["_order", "_y"], kind="stable"))]})

    row = examples.repartition(1).mapInPandas(run, "model binary").first()
    return bytes(row.model) if row else None


def sigmoid(x: float) -> float:
    return 1 / (1 + 2.718281828459045 ** -min(max(x, -35.0), 35.0))
