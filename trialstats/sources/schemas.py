"""Explicit schemas of the raw monitoring tables and of the result tables.

Nothing is inferred. Raw tables list the columns that the jobs read; result tables follow
from a prefix and the list of statistics of their kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from trialstats.operators.arrays import TRIAL_CORE
from trialstats.operators.describe import MODES, SUMMARY
from trialstats.operators.levene import CENTRES
from trialstats.operators.rollup import EXTREMES

# Per-core results of an experiment.
CORE_RESULTS = [
    "min", "max", "q1_min", "q1_max", "q2_min", "q2_max", "q3_min", "q3_max",
    "p90_min", "p90_max", "p95_min", "p95_max", "p99_min", "p99_max",
    "weighted_avg", "combined_variance",
]

# Names of the raw tables, their key columns and their other columns.
RAW = {
    "environment_data": (
        "experiment_id string, trial_id string, container_id string, container_name string, "
        "host_id string, environment_data_id string, read_time string, cpu_percent_usage double, "
        "cpu_percpu_percent_usage array<double>, memory_usage double"
    ),
    "io_data": (
        "experiment_id string, trial_id string, container_id string, container_name string, "
        "host_id string, io_data_id string, device string, reads bigint, writes bigint, total bigint"
    ),
    "database_sizes": "experiment_id string, trial_id string, dbms string, database_name string, size bigint",
    "process": (
        "experiment_id string, trial_id string, source_process_instance_id string, process_name string, "
        "start_time timestamp, end_time timestamp, duration bigint, to_ignore boolean"
    ),
    "construct": (
        "experiment_id string, trial_id string, source_process_instance_id string, "
        "source_construct_instance_id string, construct_type string, construct_name string, "
        "start_time timestamp, end_time timestamp, duration bigint, to_ignore boolean"
    ),
    "container_properties": (
        "experiment_id string, trial_id string, container_id string, host_id string, "
        "cpu_set_cpus string, mem_limit string"
    ),
    "host_properties": "host_id string, n_cpu int, mem_total bigint",
    "faban_details": (
        "experiment_id string, trial_id string, host string, section string, op_name string, "
        "time string, value double"
    ),
    "faban_run_info": (
        "experiment_id string, trial_id string, host string, duration int, metric_unit string, "
        "metric_value double, passed boolean"
    ),
    "faban_driver_summary": (
        "experiment_id string, trial_id string, host string, name string, "
        "total_ops_value double, total_ops_unit string"
    ),
    "faban_driver_mix": (
        "experiment_id string, trial_id string, host string, driver_name string, op_name string, "
        "successes bigint, failures bigint, mix double"
    ),
    "faban_driver_response_times": (
        "experiment_id string, trial_id string, host string, driver_name string, op_name string, "
        "stat_name string, stat_value double"
    ),
    "faban_driver_delay_times": (
        "experiment_id string, trial_id string, host string, driver_name string, op_name string, "
        "actual_avg double, min double, max double"
    ),
    "faban_driver_custom_stats": (
        "experiment_id string, trial_id string, host string, driver_name string, stat_name string, "
        "description string, target string, result double"
    ),
}

_TRIAL = ["experiment_id", "trial_id"]
_CONTAINER = [*_TRIAL, "container_id", "container_name", "host_id"]
_LONG = {"num_data_points", "mode_freq", "mode_ties"}
_LISTS = {"percentiles"}


def _statistic(prefix: str, name: str) -> T.StructField:
    if name in _LISTS:
        kind: T.DataType = T.ArrayType(T.DoubleType())
    else:
        kind = T.LongType() if name in _LONG else T.DoubleType()
    return T.StructField(f"{prefix}_{name}", kind)


def _fields(names: list[str], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


def _modes(keys: list[str], kind: T.DataType) -> T.StructType:
    tail = [T.StructField("mode", kind), T.StructField("mode_freq", T.LongType())]
    return T.StructType([*_fields(keys, T.StringType()), *tail])


def _summary(keys: list[str], prefix: str, names: list[str], extra: list[T.StructField]) -> T.StructType:
    return T.StructType([*_fields(keys, T.StringType()), *[_statistic(prefix, n) for n in names], *extra])


def _trial_tables() -> dict[str, T.StructType]:
    text, number, whole = T.StringType(), T.DoubleType(), T.LongType()
    efficiency = _fields(["relative_efficency", "absolute_efficency"], number)
    cores = T.StructField("cpu_cores", T.IntegerType())
    process, construct = "process_definition_id", ["construct_type", "construct_name"]
    return {
        "trial_cpu": _summary(_CONTAINER, "cpu", [*SUMMARY, "integral"], [cores, *efficiency]),
        "trial_cpu_core": T.StructType([
            *_fields(_CONTAINER, text), cores, T.StructField("cpu_num_data_points", whole),
            *_fields([f"cpu_{s}" for s in TRIAL_CORE], T.ArrayType(number)),
        ]),
        "trial_ram": _summary(_CONTAINER, "ram", [*SUMMARY, *MODES, "integral"], efficiency),
        "trial_io": T.StructType(
            [*_fields([*_CONTAINER, "device"], text), *_fields(["reads", "writes", "total"], whole)]
        ),
        "trial_byte_size": T.StructType([*_fields(_TRIAL, text), *_fields(["size"], whole)]),
        "trial_execution_time": T.StructType(
            [*_fields([*_TRIAL, process], text), *_fields(["execution_time"], number)]
        ),
        "trial_process_duration": _summary([*_TRIAL, process], "process_duration", [*SUMMARY, *MODES], []),
        "trial_number_of_process_instances": T.StructType(
            [*_fields([*_TRIAL, process], text), *_fields(["number_of_process_instances"], whole)]
        ),
        "trial_throughput": T.StructType(
            [*_fields([*_TRIAL, process], text), *_fields(["throughput"], number)]
        ),
        "trial_construct_duration": _summary(
            [*_TRIAL, *construct], "construct_duration", [*SUMMARY, *MODES], []
        ),
        "trial_number_of_construct_instances": T.StructType(
            [*_fields([*_TRIAL, *construct], text), *_fields(["number_of_construct_instances"], whole)]
        ),
        "trial_faban_details": _summary(
            [*_TRIAL, "faban_details_host", "faban_details_section", "faban_details_op_name"],
            "faban_details", [*SUMMARY, *MODES, "integral"], [],
        ),
        "trial_ram_modes": _modes(_CONTAINER, number),
        "trial_process_duration_modes": _modes([*_TRIAL, process], whole),
        "trial_construct_duration_modes": _modes([*_TRIAL, *construct], whole),
        "trial_faban_details_modes": _modes(
            [*_TRIAL, "faban_details_host", "faban_details_section", "faban_details_op_name"], number
        ),
    }


def _rolled(prefix: str, modes: bool) -> list[T.StructField]:
    """Columns of a roll-up in their order."""
    names = [f"{prefix}_min", f"{prefix}_max", *[f"{prefix}_{s}_{end}" for s in EXTREMES for end in ("min", "max")]]
    names += [f"{prefix}_{s}" for s in ("weighted_avg", "variation_coefficient", "combined_variance")]
    fields = _fields(names, T.DoubleType())
    for end in ("min", "max") if modes else ():
        fields += _fields([f"{prefix}_mode_{end}"], T.DoubleType()) + _fields([f"{prefix}_mode_{end}_freq"], T.LongType())
    return fields


def _experiment_tables() -> dict[str, T.StructType]:
    text, number = T.StringType(), T.DoubleType()
    place = ["experiment_id", "container_name", "host_id"]
    process, construct = ["experiment_id", "process_definition_id"], ["experiment_id", "construct_type", "construct_name"]
    driver = ["experiment_id", "faban_driver_host", "faban_driver_name"]
    cores = T.StructField("cpu_cores", T.IntegerType())

    def usage(prefix: str, modes: bool, carried: list[T.StructField]) -> T.StructType:
        integral = [f"{prefix}_integral_{s}" for s in SUMMARY if s not in ("num_data_points", "percentiles", "variance")]
        spread = [f"{prefix}_levene_test_{c}{end}" for end in ("", "_stat") for c in CENTRES]
        return T.StructType([*_fields(place, text), *_rolled(prefix, modes), *carried, *_fields([*integral, *spread], number)])

    def measures(keys: list[str], prefixes: list[str], extra: list[T.StructField]) -> T.StructType:
        stats = [_statistic(p, s) for p in prefixes for s in [*SUMMARY, *MODES]]
        return T.StructType([*_fields(keys, text), *stats, *extra])

    def modes(keys: list[str], kind: T.DataType = number) -> T.StructType:
        return T.StructType([*_fields(keys, text), T.StructField("mode", kind), T.StructField("mode_freq", T.LongType())])

    def ranking(keys: list[str]) -> T.StructType:
        return T.StructType(_fields([*keys, "ranking", "trial_id"], text))

    values = {
        "byte_size": (["experiment_id"], "size", T.LongType()),
        "execution_time": (process, "execution_time", number),
        "throughput": (process, "throughput", number),
        "number_of_process_instances": (process, "number_of_process_instances", T.LongType()),
        "number_of_construct_instances": (construct, "number_of_construct_instances", T.LongType()),
    }
    custom = [*driver, "faban_stat_name", "faban_stat_description"]
    out = {
        "exp_cpu": usage("cpu", False, [cores]),
        "exp_cpu_core": T.StructType([
            *_fields(place, text), cores, *_fields([f"cpu_{s}" for s in CORE_RESULTS], T.ArrayType(number)),
        ]),
        "exp_ram": usage("ram", True, []),
        "exp_io": measures([*place, "device"], ["reads", "writes", "total"], []),
        "exp_process_duration": T.StructType([*_fields(process, text), *_rolled("process_duration", True)]),
        "exp_construct_duration": T.StructType([*_fields(construct, text), *_rolled("construct_duration", True)]),
        "exp_faban_total_ops": T.StructType([*_fields(driver, text), *_fields(["faban_total_ops_mean"], number)]),
        "exp_faban_mix": measures([*driver, "faban_op_name"], ["faban_successes", "faban_failures", "faban_mix"], []),
        "exp_faban_delay_times": T.StructType([
            *_fields([*driver, "faban_op_name"], text),
            *_fields([f"faban_delay_times_{s}" for s in ("weighted_avg", "min", "max")], number),
        ]),
        "exp_faban_run_info": measures(
            ["experiment_id", "faban_host"], ["faban_duration", "faban_metric_value"],
            [T.StructField("faban_metric_unit", text), T.StructField("faban_passed", T.BooleanType())],
        ),
        "exp_faban_response_times": T.StructType([
            *_fields([*driver, "faban_op_name", "faban_op_stat_name"], text),
            *_fields(["faban_op_stat_min", "faban_op_stat_max"], number),
        ]),
        "exp_faban_ops_custom_stats_target_absolute": measures(custom, ["faban_stat"], []),
        "exp_faban_ops_custom_stats_target_statistic": T.StructType([
            *_fields(custom, text), *_fields(["faban_stat_min", "faban_stat_max"], number),
        ]),
        "exp_cpu_ranking": ranking(place),
        "exp_ram_ranking": ranking(place),
        "exp_process_duration_ranking": ranking(process),
        "exp_construct_duration_ranking": ranking(construct),
        "exp_io_modes": modes([*place, "device", "measure"]),
        "exp_faban_mix_modes": modes([*driver, "faban_op_name", "measure"]),
        "exp_faban_run_info_modes": modes(["experiment_id", "faban_host", "measure"]),
        "exp_faban_ops_custom_stats_target_absolute_modes": modes(custom),
    }
    for name, (keys, prefix, kind) in values.items():
        out |= {f"exp_{name}": measures(keys, [prefix], []), f"exp_{name}_modes": modes(keys, kind)}
    return out


def schema(table: str) -> T.StructType:
    """Schema of a raw or result table by name."""
    if table in RAW:
        return T.StructType.fromDDL(RAW[table])
    return {**_trial_tables(), **_experiment_tables()}[table]


def tables() -> list[str]:
    """Names of all tables that ``schema`` knows."""
    return [*RAW, *_trial_tables(), *_experiment_tables()]


# The columns that name a result row, where a table has them.
KEY_COLUMNS = [
    "experiment_id", "trial_id", "container_id", "container_name", "host_id", "device", "process_definition_id",
    "construct_type", "construct_name", "faban_details_host", "faban_details_section", "faban_details_op_name",
    "faban_driver_host", "faban_driver_name", "faban_op_name", "faban_op_stat_name", "faban_host", "faban_stat_name",
    "faban_stat_description", "measure", "ranking",
]


def primary_key(table: str, columns: Sequence[str]) -> list[str]:
    """Key columns of a result: a group of modes or a ranking is replaced as a whole."""
    return [c for c in KEY_COLUMNS if c in columns and not (c == "trial_id" and table.endswith("_ranking"))]
