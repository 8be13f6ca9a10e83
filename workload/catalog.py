"""Registered queries: every operator and job over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialstats.functions.parsing import reading_order
from trialstats.operators import arrays, describe, groups, levene, rollup, warmup
from trialstats.operators.ranking import join_on
from trialstats.plans import driver, experiment, trial
from trialstats.sources.session import configure
from trialstats.sources.tables import read_table, settle, shared_folder, write_table, write_tables
from workload import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
USAGE = ["experiment_id", "trial_id"]
DIGITS = 6
MEBI = 1048576


def report(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rounded numbers, lists as text, curves left out: the form that SQL can compare."""
    out = []
    for name, kind in df.dtypes:
        if name.endswith("percentiles"):
            continue
        if kind == "array<double>":
            text = f"transform({name}, x -> CAST(CAST(round(x, {digits}) AS decimal(30,6)) AS string))"
            out.append(f"array_join({text}, ',') AS {name}")
        elif kind == "array<string>":
            out.append(f"array_join({name}, ',') AS {name}")
        elif kind == "double" or name == "mode":
            out.append(f"round(CAST({name} AS double), {digits}) AS {name}")
        elif kind == "int":
            out.append(f"CAST({name} AS bigint) AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)


def _significant(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers of any size as text with nine significant digits; what is nothing beside the mean is zero."""
    def text(c: str) -> str:
        mean = c.removesuffix("_variance") + "_mean"
        return f"format_string('%.8e', IF({c} <= 1e-12D * {mean} * {mean}, 0D, {c}))"

    return df.withColumns({c: F.expr(f"IF({c} IS NULL, NULL, {text(c)})") for c in columns})


def _scaled(df: DataFrame, prefix: str, unit: float) -> DataFrame:
    """Report byte statistics in mebibytes, variances in their square."""
    out = []
    for name, kind in df.dtypes:
        unscaled = not name.startswith(prefix) or "coefficient" in name or "levene" in name
        if kind != "double" or unscaled:
            out.append(name)
        else:
            out.append(f"{name} / {unit * unit if 'variance' in name else unit}D AS {name}")
    return df.selectExpr(*out)


# Trial tables, composed in one plan from the readings.

def _trial_cpu(spark: SparkSession, sf: str) -> DataFrame:
    return trial.trial_cpu(b.environment_data(spark, sf), b.container_properties(spark, sf), b.host_properties(spark, sf))


def _trial_ram(spark: SparkSession, sf: str) -> DataFrame:
    return trial.trial_ram(b.environment_data(spark, sf), b.container_properties(spark, sf), b.host_properties(spark, sf))


def _trial_cpu_core(spark: SparkSession, sf: str) -> DataFrame:
    return trial.trial_cpu_core(b.core_data(spark, sf), b.container_properties(spark, sf), b.host_properties(spark, sf))


def _trial_throughput(spark: SparkSession, sf: str) -> DataFrame:
    processes = b.process(spark, sf)
    return trial.trial_throughput(
        trial.trial_execution_time(processes), trial.trial_number_of_process_instances(processes)
    )


# Operators.

def describe_by_trial(spark, sf):
    return report(describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage"))


def percentile_curve(spark, sf):
    return report(describe.percentile_curve(b.environment_data(spark, sf), USAGE, "cpu_percent_usage"))


def integral_by_trial(spark, sf):
    order = reading_order(F.col("read_time"))
    stats = describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage", order)
    return report(stats.select(*USAGE, "integral"))


def mode_by_trial(spark, sf):
    return report(describe.mode_rows(b.environment_data(spark, sf), USAGE, "cpu_percent_usage"))


def mode_list(spark, sf):
    stats = describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage", modes=True)
    return report(stats.select(*USAGE, *describe.MODES))


# The plan for groups that are cut into slices, which only large data reaches by itself.

def describe_cut(spark, sf):
    return report(describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage", slice_rows=64))


def levene_cut(spark, sf):
    rows = b.environment_data(spark, sf)
    return report(levene.levene(rows, ["experiment_id"], "trial_id", "cpu_percent_usage", slice_rows=64))


def mode_cut(spark, sf):
    stats = describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage", modes=True, slice_rows=64)
    return report(stats.select(*USAGE, *describe.MODES))


def _stored(spark: SparkSession, rows: DataFrame, table: str, key: list[str]) -> str:
    """A new folder of the shared one, with ``rows`` as a stored table."""
    root = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    write_table(rows, root, table, key)
    return root


def trial_slice(spark, sf):
    """The slice of one trial, read from the stored instances by a table of keys."""
    rows = b.process(spark, sf)
    root = _stored(spark, rows, "process", [*USAGE, "source_process_instance_id"])
    wanted = rows.where("experiment_id = 'p1' AND trial_id = 'p1_2'").select(*USAGE)
    return report(trial.trial_execution_time(read_table(spark, root, "process", slices=wanted)))


def upsert_by_key(spark, sf):
    """Two writes to one table: the second replaces the rows of its keys, in some of the directories."""
    counters = settle(trial.trial_io(b.io_data(spark, sf)))
    first = counters.selectExpr("* EXCEPT (reads, writes, total)", "-1L AS reads", "writes", "NULL AS total")
    root = _stored(spark, first.withColumn("total", F.col("total").cast("bigint")), "trial_io", None)
    write_table(counters.where("device <> 'R' AND trial_id <> 'F_3'"), root, "trial_io")
    return read_table(spark, root, "trial_io").select(*counters.columns)


def ram_results(spark, sf):
    """Summary and modes of a job, written to their two tables from one scan and read back together."""
    root = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    write_tables(trial.trial_ram_results(b.environment_data(spark, sf), b.container_properties(spark, sf), b.host_properties(spark, sf)), root)
    stats = read_table(spark, root, "trial_ram").select(*trial.CONTAINER, "ram_num_data_points", "ram_mean", "ram_q2", "ram_mode_ties")
    both = join_on(stats, read_table(spark, root, "trial_ram_modes"), trial.CONTAINER)
    scaled = {c: F.col(c) / MEBI for c in ("ram_mean", "ram_q2", "mode")}
    return report(both.withColumns(scaled))


def custom_results(spark, sf):
    """Absolute figures and statistics, written to their tables from one scan and read back together."""
    root = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    write_tables(driver.custom_stats(b.faban_driver_custom_stats(spark, sf)), root)
    name = "exp_faban_ops_custom_stats_target"
    absolute = read_table(spark, root, f"{name}_absolute").select(*driver.CUSTOM, "faban_stat_min", "faban_stat_max", F.lit("absolute").alias("target"))
    others = read_table(spark, root, f"{name}_statistic").select(*driver.CUSTOM, "faban_stat_min", "faban_stat_max", F.lit("statistic").alias("target"))
    return report(absolute.unionByName(others))


def mode_min_max(spark, sf):
    stats = describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage", modes=True)
    named = describe.prefixed(stats, USAGE, "cpu")
    return report(named.groupBy("experiment_id").agg(*rollup.mode_extremes("cpu")))


def describe_with_total(spark, sf):
    rows = groups.relevant(b.process(spark, sf), "source_process_instance_id")
    return report(describe.describe(rows, [*USAGE, "process_name"], "duration", total_of=["process_name"]))


def count_with_total(spark, sf):
    rows = groups.relevant(b.process(spark, sf), "source_process_instance_id")
    return report(groups.count_with_total(rows, USAGE, ["process_name"], "instances"))


def _usage(spark: SparkSession, sf: str) -> DataFrame:
    return settle(describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage"))


def trial_ranking(spark, sf):
    stats = _usage(spark, sf)
    return rollup.trial_ranking(describe.prefixed(stats, USAGE, "cpu"), ["experiment_id"], "cpu")


def experiment_rollup(spark, sf):
    stats = _usage(spark, sf)
    return report(rollup.rollup(describe.prefixed(stats, USAGE, "cpu"), ["experiment_id"], "cpu"))


def combined_variance(spark, sf):
    stats = describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage")
    named = describe.prefixed(stats, USAGE, "cpu")
    return report(named.groupBy("experiment_id").agg(rollup.combined_variance("cpu").alias("combined_variance")))


def integral_describe(spark, sf):
    order = reading_order(F.col("read_time"))
    stats = describe.describe(b.environment_data(spark, sf), USAGE, "cpu_percent_usage", order)
    trials = settle(stats.select(*USAGE, F.col("integral").alias("x")))
    return report(describe.describe(trials, ["experiment_id"], "x"), 4)


def core_describe(spark, sf):
    order = reading_order(F.col("read_time"))
    return report(arrays.describe_cores(b.core_data(spark, sf), USAGE, "cpu_percpu_percent_usage", order))


def core_rollup(spark, sf):
    return report(arrays.rollup_cores(settle(_trial_cpu_core(spark, sf)), experiment.CONTAINER, "cpu", carry=["cpu_cores"]))


def levene_statistics(spark, sf):
    return report(levene.levene(b.environment_data(spark, sf), ["experiment_id"], "trial_id", "cpu_percent_usage", p_values=False))


def levene_p_values(spark, sf):
    return report(levene.levene(b.environment_data(spark, sf), ["experiment_id"], "trial_id", "cpu_percent_usage"))


def levene_order_lines(spark, sf):
    lines = b.load(spark, sf, "lineitem")
    return report(levene.levene(lines, ["l_returnflag", "l_linestatus"], "l_linenumber", "l_quantity", p_values=False))


def warmup_trim_long(spark, sf):
    rows = b.process(spark, sf).withColumnRenamed("process_name", "process_definition_id")
    left = warmup.trim_warmup(rows.selectExpr("* EXCEPT (trial_id)", "'all' AS trial_id"), 1100, USAGE)
    return left.select(*USAGE, "process_definition_id", "source_process_instance_id")


def warmup_trim(spark, sf):
    rows = b.process(spark, sf).withColumnRenamed("process_name", "process_definition_id")
    left = warmup.trim_warmup(rows, 20, USAGE)
    return left.select(*USAGE, "process_definition_id", "source_process_instance_id")


def active_cores(spark, sf):
    rows = b.container_properties(spark, sf).join(b.host_properties(spark, sf), "host_id", "left")
    return report(rows.select(*trial.PLACE, trial.active_cores().alias("cores"), trial.memory_capacity().alias("bytes")))


# Jobs.

def job_trial_cpu(spark, sf):
    shares = {c: F.round(c, 12).cast("decimal(20,12)") for c in ("relative_efficency", "absolute_efficency")}
    return report(_trial_cpu(spark, sf).withColumns(shares), 8).withColumns(
        {c: F.col(c).cast("double") for c in shares}
    )


def job_trial_cpu_core(spark, sf):
    cores = _trial_cpu_core(spark, sf)
    cells = F.arrays_zip(*[F.col(f"cpu_{s}") for s in arrays.TRIAL_CORE])
    rows = cores.select(*trial.CONTAINER, "cpu_cores", "cpu_num_data_points", F.posexplode(cells).alias("core", "cell"))
    return report(rows.select(*trial.CONTAINER, "cpu_cores", "cpu_num_data_points", "core", "cell.*"))


def job_trial_ram(spark, sf):
    return report(_scaled(_trial_ram(spark, sf), "ram", MEBI), 8)


def job_trial_io(spark, sf):
    return report(trial.trial_io(b.io_data(spark, sf)))


def job_trial_byte_size(spark, sf):
    return report(trial.trial_byte_size(b.database_sizes(spark, sf)))


def job_trial_execution_time(spark, sf):
    return report(trial.trial_execution_time(b.process(spark, sf)))


def job_trial_process_duration(spark, sf):
    return report(trial.trial_process_duration(b.process(spark, sf)))


def job_trial_number_of_process_instances(spark, sf):
    return report(trial.trial_number_of_process_instances(b.process(spark, sf)))


def job_trial_throughput(spark, sf):
    return report(_trial_throughput(spark, sf), 12)


def job_trial_process_totals(spark, sf):
    totals = trial.trial_process_totals(b.process(spark, sf))
    return report(totals.withColumn("execution_time", F.round("execution_time", 6)), 12)


def job_trial_construct_duration(spark, sf):
    return report(trial.trial_construct_duration(b.construct(spark, sf)))


def job_trial_number_of_construct_instances(spark, sf):
    return report(trial.trial_number_of_construct_instances(b.construct(spark, sf)))


def job_trial_driver_details(spark, sf):
    return report(trial.trial_driver_details(b.faban_details(spark, sf)))


def job_exp_cpu(spark, sf):
    return report(experiment.exp_cpu(settle(_trial_cpu(spark, sf)), b.environment_data(spark, sf)))


def job_exp_cpu_core(spark, sf):
    wide = experiment.exp_cpu_core(settle(_trial_cpu_core(spark, sf)), b.host_properties(spark, sf))
    cells = F.arrays_zip(*[F.col(f"cpu_{s}") for s in experiment.CORE_RESULTS])
    rows = wide.select(*experiment.CONTAINER, "cpu_cores", F.posexplode(cells).alias("core", "cell"))
    return report(rows.select(*experiment.CONTAINER, "cpu_cores", "core", "cell.*"))


def job_exp_ram(spark, sf):
    job = experiment.exp_ram(settle(_trial_ram(spark, sf)), b.environment_data(spark, sf))
    return report(_scaled(job, "ram", MEBI))


def job_exp_io(spark, sf):
    stats = experiment.exp_io(settle(trial.trial_io(b.io_data(spark, sf))))
    return report(_significant(stats, "writes_variance", "total_variance"), 3)


def job_exp_byte_size(spark, sf):
    sizes = settle(trial.trial_byte_size(b.database_sizes(spark, sf)))
    return report(_significant(experiment.exp_byte_size(sizes), "size_variance"), 1)


def job_exp_execution_time(spark, sf):
    stats = experiment.exp_execution_time(settle(trial.trial_execution_time(b.process(spark, sf))))
    return report(_significant(stats, "execution_time_variance"))


def job_exp_throughput(spark, sf):
    return report(experiment.exp_throughput(settle(trial.trial_process_totals(b.process(spark, sf)))), 12)


def job_exp_number_of_process_instances(spark, sf):
    counts = settle(trial.trial_number_of_process_instances(b.process(spark, sf)))
    return report(experiment.exp_number_of_process_instances(counts))


def job_exp_number_of_construct_instances(spark, sf):
    counts = settle(trial.trial_number_of_construct_instances(b.construct(spark, sf)))
    return report(experiment.exp_number_of_construct_instances(counts))


def job_exp_process_duration(spark, sf):
    return report(experiment.exp_process_duration(settle(trial.trial_process_duration(b.process(spark, sf)))))


def job_exp_construct_duration(spark, sf):
    return report(experiment.exp_construct_duration(settle(trial.trial_construct_duration(b.construct(spark, sf)))))


def job_exp_driver_total_ops(spark, sf):
    return report(driver.total_operations(b.faban_driver_summary(spark, sf)))


def job_exp_driver_mix(spark, sf):
    return report(driver.operation_mix(b.faban_driver_mix(spark, sf)), 8)


def job_exp_driver_delay_times(spark, sf):
    return report(driver.delay_times(b.faban_driver_delay_times(spark, sf)))


def job_exp_driver_run_info(spark, sf):
    info = driver.run_info(b.faban_run_info(spark, sf))
    return report(_significant(info, "faban_metric_value_variance"), 4)


def job_exp_driver_response_times(spark, sf):
    return report(driver.response_times(b.faban_driver_response_times(spark, sf)))


def job_exp_driver_custom_absolute(spark, sf):
    return report(driver.custom_absolute(b.faban_driver_custom_stats(spark, sf)))


def job_exp_driver_custom_statistic(spark, sf):
    return report(driver.custom_statistic(b.faban_driver_custom_stats(spark, sf)))


# Modes and rankings of the jobs, as rows with all ties.

def trial_ram_modes(spark, sf):
    return report(trial.trial_ram_modes(b.environment_data(spark, sf)).withColumn("mode", F.col("mode") / MEBI))


def trial_process_duration_modes(spark, sf):
    return report(trial.trial_process_duration_modes(b.process(spark, sf)))


def trial_construct_duration_modes(spark, sf):
    return report(trial.trial_construct_duration_modes(b.construct(spark, sf)))


def trial_driver_details_modes(spark, sf):
    return report(trial.trial_driver_details_modes(b.faban_details(spark, sf)))


def exp_cpu_ranking(spark, sf):
    return experiment.exp_cpu_ranking(settle(_trial_cpu(spark, sf)))


def exp_ram_ranking(spark, sf):
    return experiment.exp_ram_ranking(settle(_trial_ram(spark, sf)))


def exp_process_duration_ranking(spark, sf):
    return experiment.exp_process_duration_ranking(settle(trial.trial_process_duration(b.process(spark, sf))))


def exp_construct_duration_ranking(spark, sf):
    return experiment.exp_construct_duration_ranking(settle(trial.trial_construct_duration(b.construct(spark, sf))))


def exp_io_modes(spark, sf):
    return report(experiment.exp_io_modes(trial.trial_io(b.io_data(spark, sf))))


def exp_byte_size_modes(spark, sf):
    return report(experiment.value_modes(trial.trial_byte_size(b.database_sizes(spark, sf)), ["experiment_id"], "size"))


def exp_throughput_modes(spark, sf):
    totals = trial.trial_process_totals(b.process(spark, sf))
    return report(experiment.value_modes(totals, experiment.PROCESS, "throughput"), 9)


def exp_number_of_process_instances_modes(spark, sf):
    counts = trial.trial_number_of_process_instances(b.process(spark, sf))
    return report(experiment.value_modes(counts, experiment.PROCESS, "number_of_process_instances"))


def exp_number_of_construct_instances_modes(spark, sf):
    counts = trial.trial_number_of_construct_instances(b.construct(spark, sf))
    return report(experiment.value_modes(counts, experiment.CONSTRUCT, "number_of_construct_instances"))


def exp_driver_mix_modes(spark, sf):
    return report(driver.operation_mix_modes(b.faban_driver_mix(spark, sf)))


def exp_driver_run_info_modes(spark, sf):
    return report(driver.run_info_modes(b.faban_run_info(spark, sf)))


def exp_driver_custom_absolute_modes(spark, sf):
    return report(driver.custom_absolute_modes(b.faban_driver_custom_stats(spark, sf)))


TIES = [
    trial_ram_modes, trial_process_duration_modes, trial_construct_duration_modes, trial_driver_details_modes,
    exp_cpu_ranking, exp_ram_ranking, exp_process_duration_ranking, exp_construct_duration_ranking, exp_io_modes,
    exp_byte_size_modes, exp_throughput_modes, exp_number_of_process_instances_modes,
    exp_number_of_construct_instances_modes, exp_driver_mix_modes, exp_driver_run_info_modes,
    exp_driver_custom_absolute_modes,
]
OPERATORS = [
    describe_by_trial, percentile_curve, integral_by_trial, mode_by_trial, mode_list, mode_min_max,
    describe_with_total, count_with_total, trial_ranking, experiment_rollup, combined_variance,
    integral_describe, core_describe, core_rollup, levene_statistics, levene_p_values,
    levene_order_lines, warmup_trim, active_cores, describe_cut, levene_cut, mode_cut, trial_slice, warmup_trim_long,
    upsert_by_key, ram_results, custom_results,
]
JOBS = [
    job_trial_cpu, job_trial_cpu_core, job_trial_ram, job_trial_io, job_trial_byte_size,
    job_trial_execution_time, job_trial_process_duration, job_trial_number_of_process_instances,
    job_trial_throughput, job_trial_process_totals, job_trial_construct_duration, job_trial_number_of_construct_instances,
    job_trial_driver_details, job_exp_cpu, job_exp_cpu_core, job_exp_ram, job_exp_io, job_exp_byte_size,
    job_exp_execution_time, job_exp_throughput, job_exp_number_of_process_instances,
    job_exp_number_of_construct_instances, job_exp_process_duration, job_exp_construct_duration,
    job_exp_driver_total_ops, job_exp_driver_mix, job_exp_driver_delay_times, job_exp_driver_run_info,
    job_exp_driver_response_times, job_exp_driver_custom_absolute, job_exp_driver_custom_statistic,
]


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    """All queries by name."""
    return {q.__name__.removeprefix("job_"): _configured(q) for q in [*OPERATORS, *JOBS, *TIES]}
