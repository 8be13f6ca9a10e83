"""Experiment level statistics of the load driver's reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.operators.describe import describe, describe_measures, mode_rows, modes_of, prefixed, summary_of
from trialstats.operators.groups import every
from trialstats.operators.ranking import frequencies, join_on
from trialstats.plans.experiment import measure_modes, measure_results
from trialstats.sources.tables import settle

# Fixed value: the target that marks a custom statistic as an absolute figure.
ABSOLUTE = "absolute"


def _named(df: DataFrame, **columns: str) -> DataFrame:
    """Keep ``experiment_id`` and the given columns under their result names."""
    return df.select("experiment_id", *[F.col(source).alias(target) for target, source in columns.items()])


def total_operations(summary: DataFrame) -> DataFrame:
    """Mean number of operations per host and driver."""
    rows = _named(summary, faban_driver_host="host", faban_driver_name="name", value="total_ops_value")
    return rows.groupBy("experiment_id", "faban_driver_host", "faban_driver_name").agg(
        F.avg("value").alias("faban_total_ops_mean")
    )


OPERATION = ["experiment_id", "faban_driver_host", "faban_driver_name", "faban_op_name"]
MIX = ["successes", "failures", "mix"]


def _mix(mix: DataFrame) -> DataFrame:
    names = {"faban_driver_host": "host", "faban_driver_name": "driver_name", "faban_op_name": "op_name"}
    return _named(mix, **names, **{m: m for m in MIX})


def operation_mix(mix: DataFrame) -> DataFrame:
    """Successes, failures and mix per host, driver and operation."""
    return describe_measures(_mix(mix), OPERATION, MIX, [f"faban_{m}" for m in MIX], modes=True)


def operation_mix_results(mix: DataFrame) -> dict[str, DataFrame]:
    """Summary and modes of the operation mix under the names of their tables, from one scan."""
    stats, modes = measure_results(_mix(mix), OPERATION, MIX, [f"faban_{m}" for m in MIX])
    return {"exp_faban_mix": stats, "exp_faban_mix_modes": modes}


def delay_times(delays: DataFrame) -> DataFrame:
    """Delays per host, driver and operation; the "weighted" average is the plain mean."""
    keys = ["experiment_id", "faban_driver_host", "faban_driver_name", "faban_op_name"]
    rows = _named(
        delays, faban_driver_host="host", faban_driver_name="driver_name", faban_op_name="op_name",
        actual_avg="actual_avg", shortest="min", longest="max",
    )
    return rows.groupBy(*keys).agg(
        F.avg("actual_avg").alias("faban_delay_times_weighted_avg"),
        F.min("shortest").alias("faban_delay_times_min"),
        F.max("longest").alias("faban_delay_times_max"),
    )


def run_info(runs: DataFrame) -> DataFrame:
    """Duration and metric per host, and whether every run passed (unknown means no)."""
    keys = ["experiment_id", "faban_host"]
    measures = ["duration", "metric_value"]
    rows = _named(
        runs, faban_host="host", metric_unit="metric_unit", passed="passed", **{m: m for m in measures}
    )
    flags = rows.groupBy(*keys).agg(
        F.min("metric_unit").alias("faban_metric_unit"), every("passed").alias("faban_passed")
    )
    stats = describe_measures(rows, keys, measures, [f"faban_{m}" for m in measures], modes=True)
    return join_on(stats, flags, keys)


def operation_mix_modes(mix: DataFrame) -> DataFrame:
    """Every most frequent value of the three mix measures."""
    return measure_modes(_mix(mix), OPERATION, MIX)


def run_info_modes(runs: DataFrame) -> DataFrame:
    """Every most frequent duration and metric value."""
    rows = _named(runs, faban_host="host", duration="duration", metric_value="metric_value")
    return measure_modes(rows, ["experiment_id", "faban_host"], ["duration", "metric_value"])


def response_times(times: DataFrame) -> DataFrame:
    """Smallest and largest value of each response time statistic."""
    keys = ["experiment_id", "faban_driver_host", "faban_driver_name", "faban_op_name", "faban_op_stat_name"]
    rows = _named(
        times, faban_driver_host="host", faban_driver_name="driver_name", faban_op_name="op_name",
        faban_op_stat_name="stat_name", value="stat_value",
    )
    return rows.groupBy(*keys).agg(
        F.min("value").alias("faban_op_stat_min"), F.max("value").alias("faban_op_stat_max")
    )


CUSTOM = [
    "experiment_id", "faban_driver_host", "faban_driver_name", "faban_stat_name", "faban_stat_description",
]


def _custom(stats: DataFrame) -> DataFrame:
    return _named(
        stats, faban_driver_host="host", faban_driver_name="driver_name", faban_stat_name="stat_name",
        faban_stat_description="description", target="target", result="result",
    )


def custom_absolute(stats: DataFrame) -> DataFrame:
    """Summary and modes of the custom statistics with an absolute target."""
    rows = _custom(stats).where(F.col("target") == ABSOLUTE)
    return prefixed(describe(rows, CUSTOM, "result", modes=True), CUSTOM, "faban_stat")


def custom_absolute_modes(stats: DataFrame) -> DataFrame:
    """Every most frequent value of the custom statistics with an absolute target."""
    return mode_rows(_custom(stats).where(F.col("target") == ABSOLUTE), CUSTOM, "result")


def custom_statistic(stats: DataFrame) -> DataFrame:
    """Smallest and largest value of the other custom statistics."""
    rows = _custom(stats).where(~F.col("target").eqNullSafe(ABSOLUTE))
    return rows.groupBy(*CUSTOM).agg(
        F.min("result").alias("faban_stat_min"), F.max("result").alias("faban_stat_max")
    )


def custom_stats(stats: DataFrame) -> dict[str, DataFrame]:
    """The results of the custom statistics under the names of their tables, from one scan.

    Readings are counted once per statistic, value and whether the target is absolute; the settled
    counts are routed to the summary and modes of the absolute ones and to the ends of the others.
    """
    rows = _custom(stats).withColumn("is_absolute", F.col("target").eqNullSafe(ABSOLUTE))
    counted = settle(frequencies(rows, [*CUSTOM, "is_absolute"], "result"))
    keys = f"struct({', '.join(f'g.{c}' for c in CUSTOM)}) AS g"
    absolute = counted.where("g.is_absolute").withColumn("g", F.expr(keys.removesuffix(" AS g")))
    others = counted.where("NOT g.is_absolute").groupBy(F.expr(keys)).agg(
        F.min("v").alias("faban_stat_min"), F.max("v").alias("faban_stat_max")
    )
    return {
        "exp_faban_ops_custom_stats_target_absolute": prefixed(summary_of(absolute, modes=True), CUSTOM, "faban_stat"),
        "exp_faban_ops_custom_stats_target_absolute_modes": modes_of(absolute),
        "exp_faban_ops_custom_stats_target_statistic": others.select("g.*", "faban_stat_min", "faban_stat_max"),
    }
