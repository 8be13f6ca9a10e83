from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trialstats.plans import driver, experiment, trial
from trialstats.sources.schemas import schema, tables
from trialstats.sources import tables as stored_tables
from trialstats.sources.tables import finish_write, read_table, settle, write_table, write_tables
from workload import bindings

SF = "/root/testdata/sf0.001"


def test_every_schema_is_declared(spark):
    assert len(tables()) == 14 + 16 + 31
    for name in tables():
        assert {"experiment_id", "host_id"} & set(schema(name).fieldNames())


def test_trial_results_have_their_declared_schema(spark):
    process = bindings.process(spark, SF)
    construct = bindings.construct(spark, SF)
    hosts, containers = bindings.host_properties(spark, SF), bindings.container_properties(spark, SF)
    readings, cores = bindings.environment_data(spark, SF), bindings.core_data(spark, SF)
    times, counts = trial.trial_execution_time(process), trial.trial_number_of_process_instances(process)
    results = {
        "trial_cpu": trial.trial_cpu(readings, containers, hosts),
        "trial_cpu_core": trial.trial_cpu_core(cores, containers, hosts),
        "trial_ram": trial.trial_ram(readings, containers, hosts),
        "trial_io": trial.trial_io(bindings.io_data(spark, SF)),
        "trial_byte_size": trial.trial_byte_size(bindings.database_sizes(spark, SF)),
        "trial_execution_time": times,
        "trial_number_of_process_instances": counts,
        "trial_process_duration": trial.trial_process_duration(process),
        "trial_throughput": trial.trial_throughput(times, counts),
        "trial_construct_duration": trial.trial_construct_duration(construct),
        "trial_number_of_construct_instances": trial.trial_number_of_construct_instances(construct),
        "trial_faban_details": trial.trial_driver_details(bindings.faban_details(spark, SF)),
    }
    for name, df in results.items():
        declared = {f.name: f.dataType.simpleString() for f in schema(name).fields}
        assert dict(df.dtypes) == declared, name


def test_experiment_results_have_their_declared_schema(spark):
    process, construct = bindings.process(spark, SF), bindings.construct(spark, SF)
    hosts, containers = bindings.host_properties(spark, SF), bindings.container_properties(spark, SF)
    readings, cores = bindings.environment_data(spark, SF), bindings.core_data(spark, SF)
    cpu, ram, io = trial.trial_cpu(readings, containers, hosts), trial.trial_ram(readings, containers, hosts), trial.trial_io(bindings.io_data(spark, SF))
    sizes, totals = trial.trial_byte_size(bindings.database_sizes(spark, SF)), trial.trial_process_totals(process)
    counts = trial.trial_number_of_construct_instances(construct)
    durations, constructs = trial.trial_process_duration(process), trial.trial_construct_duration(construct)
    mix, runs, custom = bindings.faban_driver_mix(spark, SF), bindings.faban_run_info(spark, SF), bindings.faban_driver_custom_stats(spark, SF)
    e, d = experiment, driver
    results = {
        "exp_cpu": e.exp_cpu(cpu, readings), "exp_cpu_core": e.exp_cpu_core(trial.trial_cpu_core(cores, containers, hosts), hosts),
        "exp_ram": e.exp_ram(ram, readings), "exp_io": e.exp_io(io), "exp_byte_size": e.exp_byte_size(sizes),
        "exp_execution_time": e.exp_execution_time(totals), "exp_throughput": e.exp_throughput(totals),
        "exp_number_of_process_instances": e.exp_number_of_process_instances(totals),
        "exp_number_of_construct_instances": e.exp_number_of_construct_instances(counts),
        "exp_process_duration": e.exp_process_duration(durations), "exp_construct_duration": e.exp_construct_duration(constructs),
        "exp_cpu_ranking": e.exp_cpu_ranking(cpu), "exp_ram_ranking": e.exp_ram_ranking(ram), "exp_io_modes": e.exp_io_modes(io),
        "exp_process_duration_ranking": e.exp_process_duration_ranking(durations),
        "exp_construct_duration_ranking": e.exp_construct_duration_ranking(constructs),
        "exp_byte_size_modes": e.value_modes(sizes, ["experiment_id"], "size"),
        "exp_faban_total_ops": d.total_operations(bindings.faban_driver_summary(spark, SF)),
        "exp_faban_mix": d.operation_mix(mix), "exp_faban_mix_modes": d.operation_mix_modes(mix),
        "exp_faban_delay_times": d.delay_times(bindings.faban_driver_delay_times(spark, SF)),
        "exp_faban_run_info": d.run_info(runs), "exp_faban_run_info_modes": d.run_info_modes(runs),
        "exp_faban_response_times": d.response_times(bindings.faban_driver_response_times(spark, SF)),
        **d.custom_stats(custom), "exp_faban_ops_custom_stats_target_absolute_modes": d.custom_absolute_modes(custom),
        "trial_ram_modes": trial.trial_ram_modes(readings), "trial_process_duration_modes": trial.trial_process_duration_modes(process),
        "trial_construct_duration_modes": trial.trial_construct_duration_modes(construct),
        "trial_faban_details_modes": trial.trial_driver_details_modes(bindings.faban_details(spark, SF)),
    }
    for name, df in results.items():
        declared = {f.name: f.dataType.simpleString() for f in schema(name).fields}
        assert dict(df.dtypes) == declared, name


def test_repeated_write_replaces_only_its_slice(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([("e", "t1", 1), ("e", "t2", 2)], schema("trial_byte_size"))
    write_table(first, root, "trial_byte_size")
    again = spark.createDataFrame([("e", "t1", 10)], schema("trial_byte_size"))
    write_table(again, root, "trial_byte_size")
    write_table(again, root, "trial_byte_size")
    found = sorted((r["trial_id"], r["size"]) for r in read_table(spark, root, "trial_byte_size").collect())
    assert found == [("t1", 10), ("t2", 2)]


def test_upsert_by_key_keeps_other_rows_of_the_trial(spark, tmp_path):
    root = str(tmp_path)
    text = ["trial_io", schema("trial_io")]
    rows = [("e", "t", "c1", "app", "h", "d", 1, 2, 3), ("e", "t", "c2", "app", "h", "d", 4, 5, 6), ("e", "t", "c2", None, "h", "d", 7, 8, 9),
            ("e", "u", "c1", "app", "h", "d", 1, 1, 1)]
    write_table(spark.createDataFrame(rows, text[1]), root, text[0])
    for _ in range(2):
        again = [("e", "t", "c1", "app", "h", "d", 10, 20, 30), ("e", "t", "c2", None, "h", "d", 70, 80, 90)]
        write_table(spark.createDataFrame(again, text[1]), root, text[0])
    found = sorted((r["trial_id"], r["container_id"], str(r["container_name"]), r["reads"]) for r in read_table(spark, root, "trial_io").collect())
    assert found == [("t", "c1", "app", 10), ("t", "c2", "None", 70), ("t", "c2", "app", 4), ("u", "c1", "app", 1)]


def test_rewritten_modes_leave_no_old_ones(spark, tmp_path):
    rows = "experiment_id string, trial_id string, host_id string, mode double, mode_freq bigint"
    write_table(spark.createDataFrame([("e", "t", "h", 1.0, 2), ("e", "t", "h", 3.0, 2), ("e", "t", "i", 5.0, 1)], rows), str(tmp_path), "trial_ram_modes")
    write_table(spark.createDataFrame([("e", "t", "h", 4.0, 9)], rows), str(tmp_path), "trial_ram_modes")
    found = spark.read.parquet(f"{tmp_path}/trial_ram_modes").select("host_id", "mode").collect()
    assert sorted(map(tuple, found)) == [("h", 4.0), ("i", 5.0)]


def test_key_slice_prunes_directories(spark, tmp_path):
    rows = spark.createDataFrame([("e", f"t{i}", i) for i in range(5)], schema("trial_byte_size"))
    write_table(rows, str(tmp_path), "trial_byte_size")
    part = read_table(spark, str(tmp_path), "trial_byte_size", experiment_id="e", trial_id="t3")
    assert [r["size"] for r in part.collect()] == [3]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "trial_id" in plan.split("PartitionFilters")[1].split("]")[0]


SIZES = "trial_byte_size"


def sizes_of(spark, root):
    return sorted((str(r["trial_id"]), r["size"]) for r in read_table(spark, root, SIZES).collect())


def test_write_that_dies_midway_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    """The second write loses a directory, replaces another and dies; the rerun has every row."""
    root = str(tmp_path)
    rows = [("e", f"t{i}", i) for i in range(6)] + [("e", None, 9)]
    frame = lambda data: spark.createDataFrame(data, schema(SIZES))
    write_table(frame(rows), root, SIZES, key=["experiment_id", "trial_id", "size"])
    update = frame([("e", f"t{i}", 10 + i) for i in range(4)] + [("e", None, 99)])
    replace = stored_tables._replace

    def dies(df, path, by):
        replace(df.where("trial_id = 't0'"), path, by)
        files, at = stored_tables._files(spark, f"{path}/experiment_id=e/trial_id=t1")
        assert files.delete(at, True)
        raise OSError("the driver is lost")

    monkeypatch.setattr(stored_tables, "_replace", dies)
    with pytest.raises(OSError):
        write_table(update, root, SIZES, key=["experiment_id", "trial_id", "size"])
    assert ("t1", 1) not in sizes_of(spark, root)
    monkeypatch.undo()
    write_table(update, root, SIZES, key=["experiment_id", "trial_id", "size"])
    want = [(str(t), n) for _, t, n in rows] + [(f"t{i}", 10 + i) for i in range(4)] + [("None", 99)]
    assert sizes_of(spark, root) == sorted(want)
    assert not finish_write(spark, root, SIZES)


def test_write_that_dies_before_it_is_prepared_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("e", "t1", 1), ("e", "t2", 2)], schema(SIZES))
    write_table(rows, root, SIZES)
    spark.createDataFrame([("e", "t1", 7)], schema(SIZES)).write.partitionBy("experiment_id", "trial_id").parquet(f"{root}/_pending/{SIZES}")
    (tmp_path / "_pending" / SIZES / "_SUCCESS").unlink()
    write_table(spark.createDataFrame([("e", "t2", 20)], schema(SIZES)), root, SIZES)
    assert sizes_of(spark, root) == [("t1", 1), ("t2", 20)]


def test_finished_by_hand(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_table(spark.createDataFrame([("e", "t1", 1), ("e", "t2", 2)], schema(SIZES)), root, SIZES)
    replace, calls = stored_tables._replace, []
    monkeypatch.setattr(stored_tables, "_replace", lambda *a: calls.append(a))
    write_table(spark.createDataFrame([("e", "t2", 20)], schema(SIZES)), root, SIZES)
    assert len(calls) == 1 and sizes_of(spark, root) == [("t1", 1), ("t2", 2)]
    monkeypatch.setattr(stored_tables, "_replace", replace)
    assert not finish_write(spark, root, SIZES)  # it was taken for done


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_table_of_slices_prunes_directories_at_run_time(spark, tmp_path):
    rows = spark.createDataFrame([("e", f"t{i}", i) for i in range(40)] + [("e", None, 99)], schema(SIZES))
    write_table(rows, str(tmp_path), SIZES)
    wanted = spark.createDataFrame([("e", "t3"), ("e", "t7"), ("e", "t7"), ("x", "t9"), ("e", None)], "experiment_id string, trial_id string")
    part = read_table(spark, str(tmp_path), SIZES, slices=wanted)
    assert "dynamicpruning" in executed(part)
    scan = next(n for n in _nodes(part._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet"))
    assert scan.metrics().apply("numPartitions").value() == 3  # of 41: pruning goes by each column, the join by all
    assert sorted(r["size"] for r in part.collect()) == [3, 7]
    only = read_table(spark, str(tmp_path), SIZES, slices=wanted.select("trial_id").where("trial_id = 't9'"))
    assert [r["size"] for r in only.collect()] == [9]
    assert read_table(spark, str(tmp_path), SIZES, slices=wanted.limit(0)).count() == 0


def _nodes(plan):
    """All nodes of an executed plan, through adaptive parts and query stages."""
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]


def test_large_tables_of_slices_are_not_broadcast(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("e", f"t{i}", i) for i in range(9)], schema(SIZES))
    write_table(rows, str(tmp_path), SIZES)
    monkeypatch.setattr(stored_tables, "MAX_SLICES", 1)
    wanted = spark.createDataFrame([("e", "t3"), ("e", "t7")], "experiment_id string, trial_id string")
    part = read_table(spark, str(tmp_path), SIZES, slices=wanted)
    assert "rightHint=(strategy=broadcast)" not in part._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["size"] for r in part.collect()) == [3, 7]


def test_results_of_a_job_share_one_scan(spark):
    """No plan of a result reads the input again: it is evaluated once, when the counts are settled."""
    readings, hosts, containers = bindings.environment_data(spark, SF), bindings.host_properties(spark, SF), bindings.container_properties(spark, SF)
    process, construct, details = bindings.process(spark, SF), bindings.construct(spark, SF), bindings.faban_details(spark, SF)
    pairs = {
        "trial_process_duration": (trial.trial_process_duration_results(process), trial.trial_process_duration(process)),
        "trial_process_duration_modes": (trial.trial_process_duration_results(process), trial.trial_process_duration_modes(process)),
        "trial_construct_duration": (trial.trial_construct_duration_results(construct), trial.trial_construct_duration(construct)),
        "trial_ram_modes": (trial.trial_ram_results(readings, containers, hosts), trial.trial_ram_modes(readings)),
        "trial_faban_details": (trial.trial_driver_details_results(details), None),
        "trial_faban_details_modes": (trial.trial_driver_details_results(details), None),
        "exp_faban_ops_custom_stats_target_absolute": (driver.custom_stats(bindings.faban_driver_custom_stats(spark, SF)), None),
        "exp_faban_ops_custom_stats_target_statistic": (driver.custom_stats(bindings.faban_driver_custom_stats(spark, SF)), None),
    }
    for name, (results, alone) in pairs.items():
        assert "Scan parquet" not in executed(results[name]), name
        if alone is not None:
            assert results[name].select(alone.columns).exceptAll(alone).count() == 0
            assert results[name].count() == alone.count()


def test_results_of_measures_share_one_scan(spark):
    io, mix = settle(trial.trial_io(bindings.io_data(spark, SF))), bindings.faban_driver_mix(spark, SF)
    sizes = trial.trial_byte_size(bindings.database_sizes(spark, SF))
    pairs = [
        (experiment.exp_io_results(io), {"exp_io": experiment.exp_io(io), "exp_io_modes": experiment.exp_io_modes(io)}),
        (driver.operation_mix_results(mix), {"exp_faban_mix": driver.operation_mix(mix), "exp_faban_mix_modes": driver.operation_mix_modes(mix)}),
        (experiment.value_results(sizes, ["experiment_id"], "size", "byte_size"), {"exp_byte_size_modes": experiment.value_modes(sizes, ["experiment_id"], "size")}),
    ]
    for results, alone in pairs:
        for name, df in results.items():
            assert "Scan parquet" not in executed(df), name
        for name, df in alone.items():
            assert results[name].select(df.columns).exceptAll(df).count() == 0 and results[name].count() == df.count(), name


def test_two_results_of_one_job_and_the_next_level(spark, tmp_path):
    root = str(tmp_path)
    process = bindings.process(spark, SF)
    write_tables({
        "trial_execution_time": trial.trial_execution_time(process),
        "trial_number_of_process_instances": trial.trial_number_of_process_instances(process),
    }, root)
    stored = trial.trial_throughput(
        read_table(spark, root, "trial_execution_time"), read_table(spark, root, "trial_number_of_process_instances")
    )
    direct = trial.trial_throughput(
        trial.trial_execution_time(process), trial.trial_number_of_process_instances(process)
    )
    assert stored.select(direct.columns).exceptAll(direct).count() == 0
    assert experiment.exp_throughput(stored).count() == 3 * 6


def test_settled_rows_are_the_same(spark):
    df = bindings.environment_data(spark, SF).groupBy("trial_id").agg(F.count("*").alias("n"))
    assert settle(df).exceptAll(df).count() == 0
