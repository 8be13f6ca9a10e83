"""Null keys are groups like any other, also across joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialstats.functions.parsing import byte_size
from trialstats.plans import driver, trial


def test_operation_without_a_name_has_its_readings(spark):
    rows = [("e", "t", "h", "WebDriver Throughput", None, "2020-01-01T00:00:01Z", 2.0)]
    details = spark.createDataFrame(rows, "experiment_id string, trial_id string, host string, section string, op_name string, time string, value double")
    found = {r["faban_details_section"]: r["faban_details_num_data_points"] for r in trial.trial_driver_details(details).where("faban_details_host = 'h'").collect()}
    assert found == {"WebDriver Throughput": 1, "WebDriver Response Times": 0}
    assert trial.trial_driver_details_modes(details).first()["mode"] == 2.0


def test_run_info_of_a_null_host(spark):
    runs = spark.createDataFrame([("e", "t", None, 60, "ops/sec", 1.5, True)],
                                 "experiment_id string, trial_id string, host string, duration int, metric_unit string, metric_value double, passed boolean")
    r = driver.run_info(runs).first()
    assert (r["faban_host"], r["faban_duration_mean"], r["faban_passed"]) == (None, 60.0, True)
    assert driver.run_info_modes(runs).count() == 2


def test_throughput_of_a_null_process_equals_the_totals(spark):
    rows = [("e", "t", str(i), n, f"2020-01-01 00:00:0{i}", f"2020-01-01 00:00:0{i + 1}", 1, False) for i, n in enumerate([None, "p", None, "p"])]
    process = spark.createDataFrame(rows, "experiment_id string, trial_id string, source_process_instance_id string, process_name string, s string, e string, duration long, to_ignore boolean")
    process = process.withColumn("start_time", F.col("s").cast("timestamp")).withColumn("end_time", F.col("e").cast("timestamp"))
    split = trial.trial_throughput(trial.trial_execution_time(process), trial.trial_number_of_process_instances(process))
    joint = trial.trial_process_totals(process)
    want = {(None, 0.5), ("p", 0.5), ("all", 1.0)}
    assert {(r["process_definition_id"], r["throughput"]) for r in split.collect()} == want
    assert {(r["process_definition_id"], r["throughput"]) for r in joint.collect()} == want


def test_container_without_a_name_keeps_its_cores(spark):
    rows = [("e", "t", "c", None, "h", "2020-01-01T00:00:01Z", [1.0, 3.0])]
    readings = spark.createDataFrame(rows, "experiment_id string, trial_id string, container_id string, container_name string, host_id string, read_time string, cpu_percpu_percent_usage array<double>")
    containers = spark.createDataFrame([], "experiment_id string, trial_id string, container_id string, host_id string, cpu_set_cpus string, mem_limit string")
    hosts = spark.createDataFrame([("h", 2, 10)], "host_id string, n_cpu int, mem_total long")
    r = trial.trial_cpu_core(readings, containers, hosts).first()
    assert (r["container_name"], r["cpu_num_data_points"], r["cpu_mean"]) == (None, 1, [1.0, 3.0])


def test_size_beyond_a_bigint_is_null(spark):
    df = spark.createDataFrame([("99999999999g",), ("2g",), ("99999999999999999999",)], "s string")
    assert [r[0] for r in df.select(byte_size(F.col("s"))).collect()] == [None, 2 * 1024**3, None]
