"""Trial level: raw readings to one row per trial and group.

Every function covers all trials in its input at once; restrict the input (see
``read_table``) to compute a single slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialstats.functions.parsing import byte_size, cpu_set_size, reading_order
from trialstats.operators.arrays import TRIAL_CORE, assemble_cores, describe_cores
from trialstats.operators.describe import MODES, SUMMARY, describe, mode_rows, modes_of, prefixed, summary_of
from trialstats.operators.groups import (
    TOTAL,
    count_with_total,
    relevant,
    span_seconds,
    specified,
    strict_max,
    throughput,
    with_total,
)
from trialstats.operators.ranking import frequencies, join_on
from trialstats.sources.tables import settle

TRIAL = ["experiment_id", "trial_id"]
CONTAINER = [*TRIAL, "container_id", "container_name", "host_id"]
PROCESS = [*TRIAL, "process_definition_id"]
CONSTRUCT = [*TRIAL, "construct_type", "construct_name"]
PLACE = [*TRIAL, "container_id", "host_id"]

# The report sections that are summarised, and the name of the extra host.
SECTIONS = ["WebDriver Throughput", "WebDriver Response Times"]
AGGREGATE = "aggregate"


def _with_properties(trials: DataFrame, containers: DataFrame, hosts: DataFrame) -> DataFrame:
    """Add the limits of the container and the totals of its host (one row per key each).

    Left joins of aggregated rows; adaptive execution broadcasts a property table when its
    measured size allows and shuffles otherwise.
    """
    limits = containers.select(*PLACE, "cpu_set_cpus", "mem_limit")
    return trials.join(limits, PLACE, "left").join(hosts.select("host_id", "n_cpu", "mem_total"), "host_id", "left")


def active_cores() -> Column:
    """Cores the container may use: its CPU set, else all cores of the host."""
    return F.coalesce(cpu_set_size(F.col("cpu_set_cpus")), "n_cpu")


def memory_capacity() -> Column:
    """Bytes the container may use; no limit, 0 and -1 mean all memory of the host."""
    limit = byte_size(F.col("mem_limit"))
    return F.coalesce(F.when(limit >= 1, limit), F.col("mem_total"))


def _efficiency(prefix: str, capacity: Column) -> Column:
    """Share of a capacity that the integral reaches; null instead of a division by zero."""
    full = capacity.cast("double") * F.col(f"{prefix}_num_data_points")
    return F.col(f"{prefix}_integral") / F.nullif(full, F.lit(0.0))


def _readings(data: DataFrame, measure: str) -> DataFrame:
    """Frequencies of a usage measure per container, with the order of the readings."""
    present = data.where(F.col(measure).isNotNull())
    return frequencies(present, CONTAINER, measure, reading_order(F.col("read_time")))


def _usage(readings: DataFrame, prefix: str, modes: bool) -> DataFrame:
    return prefixed(summary_of(readings, modes), CONTAINER, prefix).withColumn(
        "relative_efficency", _efficiency(prefix, F.col(f"{prefix}_max"))
    )


def trial_cpu(environment: DataFrame, containers: DataFrame, hosts: DataFrame) -> DataFrame:
    """CPU usage per container and trial, with efficiency against the peak and against 100 %."""
    stats = _usage(_readings(environment, "cpu_percent_usage"), "cpu", modes=False)
    names = [f"cpu_{s}" for s in [*SUMMARY, "integral"]]
    return _with_properties(stats, containers, hosts).select(
        *CONTAINER,
        *names,
        active_cores().alias("cpu_cores"),
        "relative_efficency",
        _efficiency("cpu", F.lit(100.0)).alias("absolute_efficency"),
    )


def trial_cpu_core(environment: DataFrame, containers: DataFrame, hosts: DataFrame) -> DataFrame:
    """CPU usage per core as arrays with one entry per core of the host.

    ``cpu_num_data_points`` counts the readings of the trial. A reading with fewer cores
    than the host leaves the missing cores null; further cores are cut off.
    """
    array = "cpu_percpu_percent_usage"
    present = environment.where(F.col(array).isNotNull())
    order = reading_order(F.col("read_time"))
    cores = describe_cores(present, CONTAINER, array, order)
    counts = present.groupBy(*CONTAINER).agg(F.count(F.lit(1)).alias("cpu_num_data_points"))
    sized = cores.join(hosts.select("host_id", "n_cpu"), "host_id", "left")
    wide = assemble_cores(sized, CONTAINER, {s: f"cpu_{s}" for s in TRIAL_CORE}, "n_cpu")
    return _with_properties(join_on(wide, counts, CONTAINER), containers, hosts).select(
        *CONTAINER,
        active_cores().alias("cpu_cores"),
        "cpu_num_data_points",
        *[f"cpu_{s}" for s in TRIAL_CORE],
    )


def trial_ram(environment: DataFrame, containers: DataFrame, hosts: DataFrame) -> DataFrame:
    """Memory usage per container and trial, with efficiency against peak and capacity."""
    return _ram(_readings(environment, "memory_usage"), containers, hosts)


def trial_ram_results(environment: DataFrame, containers: DataFrame, hosts: DataFrame) -> dict[str, DataFrame]:
    """Summary and modes of the memory usage under the names of their tables, from one scan of the readings."""
    readings = settle(_readings(environment, "memory_usage"))
    return {"trial_ram": _ram(readings, containers, hosts), "trial_ram_modes": modes_of(readings)}


def _ram(readings: DataFrame, containers: DataFrame, hosts: DataFrame) -> DataFrame:
    stats = _usage(readings, "ram", modes=True)
    names = [f"ram_{s}" for s in [*SUMMARY, *MODES, "integral"]]
    return _with_properties(stats, containers, hosts).select(
        *CONTAINER,
        *names,
        "relative_efficency",
        _efficiency("ram", memory_capacity()).alias("absolute_efficency"),
    )


def trial_ram_modes(environment: DataFrame) -> DataFrame:
    """Every most frequent memory usage per container and trial."""
    return mode_rows(environment, CONTAINER, "memory_usage")


def trial_io(io: DataFrame) -> DataFrame:
    """Largest reads, writes and total per device; one missing value makes the result null."""
    return io.groupBy(*CONTAINER, "device").agg(
        *[strict_max(c).alias(c) for c in ("reads", "writes", "total")]
    )


def trial_byte_size(sizes: DataFrame) -> DataFrame:
    """Total database size per trial."""
    return sizes.groupBy(*TRIAL).agg(F.sum("size").alias("size"))


def _processes(process: DataFrame) -> DataFrame:
    named = process.withColumnRenamed("process_name", "process_definition_id")
    return relevant(named, "source_process_instance_id")


def trial_execution_time(process: DataFrame) -> DataFrame:
    """Seconds from first start to last end, per process definition and for ``all``."""
    span = span_seconds("start_time", "end_time").alias("execution_time")
    return with_total(_processes(process), TRIAL, ["process_definition_id"], [span])


def trial_number_of_process_instances(process: DataFrame) -> DataFrame:
    """Instances per process definition and for ``all``."""
    return count_with_total(
        _processes(process), TRIAL, ["process_definition_id"], "number_of_process_instances"
    )


def trial_process_duration(process: DataFrame) -> DataFrame:
    """Durations per process definition and for ``all``."""
    stats = describe(
        _processes(process), PROCESS, "duration", modes=True, total_of=["process_definition_id"]
    )
    return prefixed(stats, PROCESS, "process_duration")


def trial_process_duration_modes(process: DataFrame) -> DataFrame:
    """Every most frequent duration per process definition and for ``all``."""
    return mode_rows(_processes(process), PROCESS, "duration", total_of=["process_definition_id"])


def trial_process_duration_results(process: DataFrame) -> dict[str, DataFrame]:
    """Summary and modes of the durations under the names of their tables, from one scan of the instances."""
    freq = settle(frequencies(_processes(process), PROCESS, "duration", total_of=["process_definition_id"]))
    return {
        "trial_process_duration": prefixed(summary_of(freq, modes=True), PROCESS, "process_duration"),
        "trial_process_duration_modes": modes_of(freq),
    }


def trial_throughput(execution_time: DataFrame, instances: DataFrame) -> DataFrame:
    """Instances per second of overall execution time, from the two trial tables."""
    return throughput(
        execution_time, instances, TRIAL, "process_definition_id", "number_of_process_instances"
    )


def trial_process_totals(process: DataFrame) -> DataFrame:
    """Execution time, instances and throughput together, from one pass over the instances.

    The same numbers as the three functions above. The overall time reaches the rows of a
    trial through a window over its aggregated rows, one per process definition.
    """
    totals = with_total(
        _processes(process),
        TRIAL,
        ["process_definition_id"],
        [
            span_seconds("start_time", "end_time").alias("execution_time"),
            F.count(F.lit(1)).alias("number_of_process_instances"),
        ],
    )
    overall = (
        f"max(IF(process_definition_id = '{TOTAL}', execution_time, NULL)) "
        f"OVER (PARTITION BY {', '.join(TRIAL)})"
    )
    return totals.selectExpr("*", f"number_of_process_instances / nullif({overall}, 0) AS throughput")


def _constructs(construct: DataFrame) -> DataFrame:
    return relevant(specified(construct, "construct_type", "construct_name"), "source_construct_instance_id")


def trial_construct_duration(construct: DataFrame) -> DataFrame:
    """Durations per construct type and name and for ``all``."""
    stats = describe(
        _constructs(construct), CONSTRUCT, "duration", modes=True,
        total_of=["construct_type", "construct_name"],
    )
    return prefixed(stats, CONSTRUCT, "construct_duration")


def trial_construct_duration_modes(construct: DataFrame) -> DataFrame:
    """Every most frequent duration per construct type and name and for ``all``."""
    return mode_rows(_constructs(construct), CONSTRUCT, "duration", total_of=["construct_type", "construct_name"])


def trial_construct_duration_results(construct: DataFrame) -> dict[str, DataFrame]:
    """Summary and modes of the durations under the names of their tables, from one scan of the instances."""
    freq = settle(frequencies(_constructs(construct), CONSTRUCT, "duration", total_of=["construct_type", "construct_name"]))
    return {
        "trial_construct_duration": prefixed(summary_of(freq, modes=True), CONSTRUCT, "construct_duration"),
        "trial_construct_duration_modes": modes_of(freq),
    }


def trial_number_of_construct_instances(construct: DataFrame) -> DataFrame:
    """Instances per construct type and name and for ``all``."""
    return count_with_total(
        _constructs(construct), TRIAL, ["construct_type", "construct_name"], "number_of_construct_instances"
    )


CELL = [*TRIAL, "host", "section", "op_name"]


def _driver_cells(details: DataFrame) -> DataFrame:
    """Settled frequencies of the load driver's readings per cell, from one evaluation of the details.

    A reading counts under every section that its own contains, and one without any under none, so
    that the hosts and operations of all readings are there.
    """
    matching = F.filter(
        F.array(*[F.lit(s) for s in SECTIONS]), lambda s: F.col("reported").contains(s)
    )
    cells = details.withColumnRenamed("section", "reported").withColumn("section", F.explode_outer(matching))
    value = F.when(F.col("section").isNotNull(), F.col("value"))
    return settle(frequencies(cells, CELL, value, reading_order(F.col("time"))))


def _in_sections(cells: DataFrame) -> DataFrame:
    """Frequencies of the cells that have readings."""
    return cells.where("g.section IS NOT NULL AND v IS NOT NULL")


def _named_cells(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({c: f"faban_details_{c}" for c in ("host", "section", "op_name")})


def trial_driver_details_modes(details: DataFrame) -> DataFrame:
    """Every most frequent value of each cell that has readings."""
    return trial_driver_details_results(details)["trial_faban_details_modes"]


def trial_driver_details(details: DataFrame) -> DataFrame:
    """Summary of the load driver's time series on a dense grid.

    The grid has every host of the trial plus ``aggregate``, every section and every
    operation of the trial; a cell without readings has ``num_data_points = 0`` and nulls.
    ``aggregate`` covers the rows whose host carries that name. Sections match by substring.
    Summary and modes are both taken over the rows of the cell.
    """
    return trial_driver_details_results(details)["trial_faban_details"]


def trial_driver_details_results(details: DataFrame) -> dict[str, DataFrame]:
    """Summary and modes of the time series under the names of their tables, from one evaluation of the details.

    The hosts and operations of the grid are taken from the aggregated cells.
    """
    cells = _driver_cells(details)
    stats = summary_of(_in_sections(cells), modes=True)

    # Hosts and operations are dimensions: few per trial, and their product is the result.
    named = cells.selectExpr(*[f"g.{c}" for c in TRIAL], "g.host", "g.op_name").distinct()
    hosts = named.select(*TRIAL, F.explode(F.array("host", F.lit(AGGREGATE))).alias("host")).distinct()
    operations = named.select(*TRIAL, "op_name").distinct()
    grid = join_on(hosts, operations, TRIAL).withColumn(
        "section", F.explode(F.array(*[F.lit(s) for s in SECTIONS]))
    )
    counts = ["num_data_points", "mode_ties"]
    names = [*SUMMARY, *MODES, "integral"]
    dense = join_on(grid, stats, CELL, "left").select(
        *TRIAL,
        *[F.col(c).alias(f"faban_details_{c}") for c in ("host", "section", "op_name")],
        *[
            (F.coalesce(F.col(c), F.lit(0)) if c in counts else F.col(c)).alias(f"faban_details_{c}")
            for c in names
        ],
    )
    return {"trial_faban_details": dense, "trial_faban_details_modes": _named_cells(modes_of(_in_sections(cells)))}
