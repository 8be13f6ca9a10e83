"""Experiment level: trial rows (and, for the spread test, raw readings) to one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.operators.arrays import assemble_cores, rollup_cores
from trialstats.operators.describe import (
    describe, describe_measures, measure_frequencies, measures_of, mode_rows, modes_of, prefixed, summary_of,
)
from trialstats.operators.groups import specified
from trialstats.operators.levene import CENTRES, levene
from trialstats.operators.ranking import frequencies, join_on
from trialstats.operators.rollup import rollup, trial_ranking
from trialstats.sources.schemas import CORE_RESULTS
from trialstats.sources.tables import settle

CONTAINER = ["experiment_id", "container_name", "host_id"]
PROCESS = ["experiment_id", "process_definition_id"]
CONSTRUCT = ["experiment_id", "construct_type", "construct_name"]

def _usage(trials: DataFrame, environment: DataFrame, prefix: str, measure: str, **options) -> DataFrame:
    """Roll-up, summary of the trial integrals and spread test of a usage measure."""
    rolled = rollup(trials, CONTAINER, prefix, **options)
    integrals = describe(trials, CONTAINER, f"{prefix}_integral")
    integrals = prefixed(
        integrals.drop("num_data_points", "percentiles", "variance"), CONTAINER, f"{prefix}_integral"
    )
    spread = levene(environment, CONTAINER, "trial_id", measure)
    spread = spread.select(
        *CONTAINER,
        *[F.col(c).alias(f"{prefix}_levene_test_{c}") for c in CENTRES],
        *[F.col(f"{c}_stat").alias(f"{prefix}_levene_test_{c}_stat") for c in CENTRES],
    )
    return join_on(join_on(rolled, integrals, CONTAINER, "left"), spread, CONTAINER, "left")


def exp_cpu(trial_cpu: DataFrame, environment: DataFrame) -> DataFrame:
    """CPU usage per container over the trials."""
    return _usage(
        trial_cpu, environment, "cpu", "cpu_percent_usage", carry=[F.min("cpu_cores").alias("cpu_cores")]
    )


def exp_cpu_core(trial_cpu_core: DataFrame, hosts: DataFrame) -> DataFrame:
    """CPU usage per core over the trials, as arrays with one entry per core of the host."""
    cores = rollup_cores(trial_cpu_core, CONTAINER, "cpu", carry=["cpu_cores"])
    sized = cores.join(hosts.select("host_id", "n_cpu"), "host_id", "left")
    names = {f"cpu_{s}": f"cpu_{s}" for s in CORE_RESULTS}
    wide = assemble_cores(sized, CONTAINER, names, "n_cpu")
    active = cores.groupBy(*CONTAINER).agg(F.min("cpu_cores").alias("cpu_cores"))
    return join_on(wide, active, CONTAINER).select(*CONTAINER, "cpu_cores", *names)


def exp_ram(trial_ram: DataFrame, environment: DataFrame) -> DataFrame:
    """Memory usage per container over the trials."""
    return _usage(trial_ram, environment, "ram", "memory_usage", modes=True)


def exp_io(trial_io: DataFrame) -> DataFrame:
    """Largest reads, writes and totals per device over the trials; nulls skipped per measure."""
    measures = ["reads", "writes", "total"]
    return describe_measures(trial_io, [*CONTAINER, "device"], measures, measures, modes=True)


def _values(trials: DataFrame, keys: Sequence[str], value: str, prefix: str) -> DataFrame:
    """Summary and modes of one number per trial; missing numbers are skipped."""
    present = trials.where(F.col(value).isNotNull())
    return prefixed(describe(present, keys, value, modes=True), keys, prefix)


def exp_byte_size(trial_byte_size: DataFrame) -> DataFrame:
    """Database size over the trials."""
    return _values(trial_byte_size, ["experiment_id"], "size", "size")


def exp_execution_time(trial_execution_time: DataFrame) -> DataFrame:
    """Execution time per process definition over the trials."""
    return _values(trial_execution_time, PROCESS, "execution_time", "execution_time")


def exp_throughput(trial_throughput: DataFrame) -> DataFrame:
    """Throughput per process definition over the trials."""
    return _values(trial_throughput, PROCESS, "throughput", "throughput")


def exp_number_of_process_instances(instances: DataFrame) -> DataFrame:
    """Instances per process definition over the trials."""
    return _values(instances, PROCESS, "number_of_process_instances", "number_of_process_instances")


def exp_number_of_construct_instances(instances: DataFrame) -> DataFrame:
    """Instances per construct type and name over the trials."""
    return _values(
        specified(instances, "construct_type", "construct_name"), CONSTRUCT,
        "number_of_construct_instances", "number_of_construct_instances",
    )


def exp_process_duration(trial_process_duration: DataFrame) -> DataFrame:
    """Durations per process definition over the trials."""
    return rollup(trial_process_duration, PROCESS, "process_duration", modes=True)


def exp_construct_duration(trial_construct_duration: DataFrame) -> DataFrame:
    """Durations per construct type and name over the trials."""
    named = specified(trial_construct_duration, "construct_type", "construct_name")
    return rollup(named, CONSTRUCT, "construct_duration", modes=True)


def measure_modes(trials: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Every most frequent value of several measures as rows ``(keys, measure, mode, mode_freq)``."""
    return _named_modes(modes_of(measure_frequencies(trials, keys, measures)), keys, measures)


def _named_modes(modes: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(m) for m in measures])
    return modes.select(*keys, F.get(names, F.col("measure_no")).alias("measure"), "mode", "mode_freq")


def measure_results(
    trials: DataFrame, keys: Sequence[str], measures: Sequence[str], prefixes: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Summaries and modes of several measures, from one scan."""
    freq = settle(measure_frequencies(trials, keys, measures))
    return measures_of(freq, keys, prefixes, modes=True), _named_modes(modes_of(freq), keys, measures)


def value_results(trials: DataFrame, keys: Sequence[str], value: str, prefix: str) -> dict[str, DataFrame]:
    """Summary and modes of one number per trial under the names of their tables, from one scan.

    For the jobs whose table is ``exp_<prefix>``, with that table and the one of its modes.
    """
    freq = settle(frequencies(trials.where(F.col(value).isNotNull()), keys, value))
    return {f"exp_{prefix}": prefixed(summary_of(freq, modes=True), keys, prefix), f"exp_{prefix}_modes": modes_of(freq)}


def exp_io_results(trial_io: DataFrame) -> dict[str, DataFrame]:
    """Summary and modes of the device figures under the names of their tables, from one scan."""
    measures = ["reads", "writes", "total"]
    stats, modes = measure_results(trial_io, [*CONTAINER, "device"], measures, measures)
    return {"exp_io": stats, "exp_io_modes": modes}


def exp_io_modes(trial_io: DataFrame) -> DataFrame:
    """Every most frequent figure per device."""
    return measure_modes(trial_io, [*CONTAINER, "device"], ["reads", "writes", "total"])


def value_modes(trials: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Every most frequent number over the trials, for the jobs with one number per trial."""
    return mode_rows(trials, keys, value)


def exp_cpu_ranking(trial_cpu: DataFrame) -> DataFrame:
    """Best, worst and average trials by CPU usage, with all ties."""
    return trial_ranking(trial_cpu, CONTAINER, "cpu")


def exp_ram_ranking(trial_ram: DataFrame) -> DataFrame:
    """Best, worst and average trials by memory usage, with all ties."""
    return trial_ranking(trial_ram, CONTAINER, "ram")


def exp_process_duration_ranking(trial_process_duration: DataFrame) -> DataFrame:
    """Best, worst and average trials per process definition, with all ties."""
    return trial_ranking(trial_process_duration, PROCESS, "process_duration")


def exp_construct_duration_ranking(trial_construct_duration: DataFrame) -> DataFrame:
    """Best, worst and average trials per construct, with all ties."""
    named = specified(trial_construct_duration, "construct_type", "construct_name")
    return trial_ranking(named, CONSTRUCT, "construct_duration")
