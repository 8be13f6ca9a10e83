"""Removal of the warm-up phase of a trial."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialstats.operators.ranking import join_on

# Instances of one trial are spread over this many parts.
PARTS = 64


def _nth_starts(df: DataFrame, keys: Sequence[str], definition: str, start: Column, n: int) -> DataFrame:
    """Start of the n-th earliest instance per definition that has one, as ``nth``.

    A limited window: every task sends the ``n`` earliest starts of a definition at most, as Spark cuts the
    groups of ``row_number() <= n`` before the shuffle (for an ``n`` up to the threshold in ``SETTINGS``).
    """
    named = [*keys, definition]
    rows = df.select(*named, start.alias("nth")).where(F.col("nth").isNotNull())
    earliest = Window.partitionBy(*named).orderBy("nth")
    return rows.withColumn("no", F.row_number().over(earliest)).where(F.col("no") <= n).where(F.col("no") == n).drop("no")


def trim_warmup(
    df: DataFrame,
    n: int,
    keys: Sequence[str],
    definition: str = "process_definition_id",
    instance: str = "source_process_instance_id",
    start: str = "start_time",
) -> DataFrame:
    """Drop the start of each trial until every definition has run ``n`` times.

    Among the definitions with at least ``n`` instances, take the one whose n-th start is
    latest (of several, the one that gives the smaller id) and, at that instant, its
    smallest instance id. Everything up to and including that instance, in the order
    (start, id), goes. A trial in which no definition has ``n`` instances stays as it is.
    """
    time = F.col(start).cast("timestamp") if dict(df.dtypes)[start].startswith("timestamp") else F.col(start)
    nth = _nth_starts(df, keys, definition, time, n)
    latest = nth.groupBy(*keys).agg(F.max("nth").alias("cut_time"))
    last_definitions = join_on(nth, latest, keys).where(F.col("nth") == F.col("cut_time"))
    # Joining on the instant as well spreads a definition that owns most instances.
    started = df.select(*keys, definition, instance, time.alias("cut_time"))
    cuts = (
        join_on(started, last_definitions.select(*keys, definition, "cut_time"), [*keys, definition, "cut_time"])
        .groupBy(*keys)
        .agg(F.max("cut_time").alias("cut_time"), F.min(instance).alias("cut_id"))
    )
    # One copy of the cut per part of the trial, so that a large trial is not gathered.
    parts = F.sequence(F.lit(0), F.lit(PARTS - 1))
    cuts = cuts.withColumn("part", F.explode(parts))
    later = (time > F.col("cut_time")) | ((time == F.col("cut_time")) & (F.col(instance) > F.col("cut_id")))
    rows = df.withColumn("part", F.pmod(F.xxhash64(instance), F.lit(PARTS)).cast("int"))
    return (
        join_on(rows, cuts, [*keys, "part"], "left")
        .where(F.col("cut_time").isNull() | later)
        .select(*df.columns)
    )
