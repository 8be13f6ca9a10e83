"""Scalars per trial, most of them with a grand-total row next to the per-group rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialstats.operators.ranking import TOTAL, join_on, keep_total_label, total_or

# Fixed value: the label of a missing type or name.
UNSPECIFIED = "Unspecified"


def with_total(
    df: DataFrame, keys: Sequence[str], labels: Sequence[str], aggs: Sequence[Column]
) -> DataFrame:
    """Aggregate per ``keys + labels`` and once more per ``keys`` as the row ``all``.

    The two levels come from one pass of grouping sets; aggregates must be mergeable.
    There is no subtotal per single label. ``all`` is a reserved label.
    """
    grouped = df.groupingSets([[*keys, *labels], [*keys]], *keys, *labels).agg(
        F.grouping(labels[0]).alias("is_total"), *aggs
    )
    return grouped.where(keep_total_label(labels)).selectExpr(
        *keys,
        *[f"{total_or(label)} AS {label}" for label in labels],
        *grouped.columns[len(keys) + len(labels) + 1:],
    )


def specified(df: DataFrame, *labels: str) -> DataFrame:
    """Name missing labels before grouping, so that they form one group."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(UNSPECIFIED)) for c in labels})


def relevant(df: DataFrame, instance_id: str) -> DataFrame:
    """Instances that have an id and are explicitly not to be ignored."""
    return df.where(~F.col("to_ignore") & F.col(instance_id).isNotNull())


def count_with_total(df: DataFrame, keys: Sequence[str], labels: Sequence[str], name: str) -> DataFrame:
    """Number of rows per label and in total."""
    return with_total(df, keys, labels, [F.count(F.lit(1)).alias(name)])


def span_seconds(start: str, end: str) -> Column:
    """Seconds from the earliest start to the latest end; null when either is missing."""
    first, last = F.min(start).cast("timestamp"), F.max(end).cast("timestamp")
    return (F.unix_micros(last) - F.unix_micros(first)) / 1e6


def strict_max(column: str) -> Column:
    """Maximum, or null when any value of the group is missing."""
    return F.when(F.count(column) == F.count(F.lit(1)), F.max(column))


def every(column: str) -> Column:
    """Logical AND over the group in which a missing value counts as false."""
    return F.bool_and(F.coalesce(F.col(column), F.lit(False)))


def throughput(
    execution: DataFrame, counts: DataFrame, keys: Sequence[str], label: str, count: str
) -> DataFrame:
    """Instances per second of the *overall* execution time, per label and for ``all``.

    ``execution`` has ``execution_time`` and ``counts`` has ``count`` per keys and label,
    both with their ``all`` row. An overall time of zero or null gives null.
    """
    overall = execution.where(F.col(label) == TOTAL).select(
        *keys, F.nullif("execution_time", F.lit(0.0)).alias("overall_time")
    )
    counted = join_on(execution.select(*keys, label), counts.select(*keys, label, count), [*keys, label], "left")
    return join_on(counted, overall, keys, "left").select(
        *keys, label, (F.col(count) / F.col("overall_time")).alias("throughput")
    )
