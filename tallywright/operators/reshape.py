"""Long-to-wide, wide-to-long and rule-labelled aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


LABELS_PER_WORD = 62


def labelled_sums(
    df: DataFrame,
    group_by: Sequence[str],
    rules: Sequence[tuple[str, Column, str]],
    measures: Mapping[str, Column],
    label: str,
    amount: str,
    amount_type: str,
) -> DataFrame:
    """Sum per group and label, where a row may carry any number of labels.

    Each rule is (label, condition, name of the measure it adds up). A row's labels are first written as bits of a
    number; rows are then added up per group and bit pattern, of which a group has few, and only those sums are
    repeated per label. The table is read once and no row is multiplied. (Rows without a label are not filtered out
    before the sum: the filter would be moved below the conditions and make Spark work them out twice.)
    """
    words = [rules[i : i + LABELS_PER_WORD] for i in range(0, len(rules), LABELS_PER_WORD)]
    patterns = {
        f"_labels{w}": reduce(
            lambda a, b: a.bitwiseOR(b),
            [F.when(condition, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, condition, _) in enumerate(word)],
        )
        for w, word in enumerate(words)
    }
    marked = df.select(*group_by, *[c.alias(n) for n, c in patterns.items()], *[c.alias(f"_m_{n}") for n, c in measures.items()])
    reduced = marked.groupBy(*group_by, *patterns).agg(*[F.sum(f"_m_{n}").alias(f"_m_{n}") for n in measures])
    entries = F.array(
        *[
            F.when(
                F.col(f"_labels{w}").bitwiseAND(F.lit(1 << i).cast("long")) != 0,
                F.struct(
                    F.lit(w * LABELS_PER_WORD + i).alias("_rule"),
                    F.col(f"_m_{measure}").cast(amount_type).alias(amount),
                ),
            )
            for w, word in enumerate(words)
            for i, (_, _, measure) in enumerate(word)
        ]
    )
    lines = reduced.select(*group_by, F.explode(F.array_compact(entries)).alias("_e")).select(*group_by, "_e.*")
    totals = lines.groupBy(*group_by, "_rule").agg(F.sum(amount).cast(amount_type).alias(amount))
    texts = F.array(*[F.lit(text) for text, _, _ in rules])
    return totals.select(*group_by, F.element_at(texts, F.col("_rule") + 1).alias(label), amount)


def unpivot_present(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], label: str, amount: str
) -> DataFrame:
    """One row per id row and column that holds a value; nulls are left out."""
    return df.unpivot(list(ids), list(columns), label, amount).filter(F.col(amount).isNotNull())


#: Columns a pivot may get from the data.
MOST_LABELS = 2000


def distinct_labels(df: DataFrame, label: str, most: int = MOST_LABELS) -> list:
    """The label's values in order; more than `most` are an error. No more than one beyond that are fetched."""
    found = [row[0] for row in df.select(label).filter(F.col(label).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{label} has more than {most} values")
    return sorted(found)


def pivot_sums(
    df: DataFrame,
    ids: Sequence[str],
    label: str,
    amount: str,
    values: Sequence[str] | None = None,
    most: int = MOST_LABELS,
) -> DataFrame:
    """Sum per id row with one column per label value.

    With no list the values are read from the data first, which costs a job; there may be no more than `most`.
    """
    if values is None:
        values = distinct_labels(df, label, most)
    reduced = df.groupBy(*ids, label).agg(F.sum(amount).alias(amount))
    return reduced.groupBy(*ids).pivot(label, list(values)).agg(F.sum(amount))


def column_widths(df: DataFrame, group_by: Sequence[str], columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Widest text per column, no narrower than the heading, plus two; columns may be mapped to their headings."""
    headings = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return df.groupBy(*group_by).agg(
        *[
            (F.greatest(F.max(F.length(F.col(c).cast("string"))), F.lit(len(h))) + 2).alias(c)
            for c, h in headings.items()
        ]
    )
