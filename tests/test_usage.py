"""CPU and memory jobs, from readings and limits to the experiment level."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trialstats.functions.parsing import byte_size, cpu_set_size, reading_order
from trialstats.plans import experiment, trial
from trialstats.sources.schemas import schema

GIB = 1024**3


def environment(spark, rows):
    """Rows: trial, host, second, cpu, cores, memory."""
    df = spark.createDataFrame(rows, "trial string, host string, s int, cpu double, cores array<double>, mem double")
    return df.selectExpr(
        "'e' AS experiment_id", "trial AS trial_id", "'c' || trial AS container_id", "'web' AS container_name",
        "host AS host_id", "CAST(s AS string) AS environment_data_id",
        "'2016-03-18T13:01:' || lpad(s, 2, '0') || '.517955063+01:00' AS read_time",
        "cpu AS cpu_percent_usage", "cores AS cpu_percpu_percent_usage", "mem AS memory_usage",
    )


@pytest.fixture(scope="module")
def tables(spark):
    readings = environment(spark, [
        ("1", "h", 2, 40.0, [4.0, 6.0, 9.0], 2.0 * GIB), ("1", "h", 1, 20.0, [2.0], 1.0 * GIB),
        ("1", "h", 3, 90.0, None, 1.0 * GIB), ("1", "h", 4, None, [6.0, 8.0], None),
        ("2", "h", 1, 50.0, [5.0, 5.0], 1.0 * GIB), ("2", "h", 2, 50.0, [5.0, 5.0], 1.0 * GIB),
        ("3", "x", 1, 0.0, [1.0], 0.0),
    ])
    containers = spark.createDataFrame(
        [("e", "1", "c1", "h", "0-3,7", "2g"), ("e", "2", "c2", "h", None, "-1")], schema("container_properties")
    )
    hosts = spark.createDataFrame([("h", 2, 8 * GIB)], schema("host_properties"))
    return readings, containers, hosts


def test_cpu(tables):
    rows = {r["trial_id"]: r for r in trial.trial_cpu(*tables).collect()}
    one = rows["1"]
    assert (one["cpu_num_data_points"], one["cpu_integral"], one["cpu_cores"]) == (3, 95.0, 5)
    assert one["relative_efficency"] == pytest.approx(95 / 270)
    assert one["absolute_efficency"] == pytest.approx(95 / 300)
    assert rows["2"]["cpu_cores"] == 2
    # No peak to relate to, and nothing known about the host.
    assert (rows["3"]["relative_efficency"], rows["3"]["cpu_cores"]) == (None, None)


def test_ram(tables):
    rows = {r["trial_id"]: r for r in trial.trial_ram(*tables).collect()}
    assert (rows["1"]["ram_mode_min"], rows["1"]["ram_mode_ties"], rows["1"]["ram_mode_freq"]) == (1.0 * GIB, 1, 2)
    assert rows["1"]["absolute_efficency"] == pytest.approx(3 * GIB / (2 * GIB * 3))
    assert rows["2"]["absolute_efficency"] == pytest.approx(1 * GIB / (8 * GIB * 2))
    assert rows["3"]["absolute_efficency"] is None


def test_cores_have_the_width_of_the_host(tables):
    rows = {r["trial_id"]: r for r in trial.trial_cpu_core(*tables).collect()}
    assert rows["1"]["cpu_num_data_points"] == 3
    assert rows["1"]["cpu_mean"] == [4.0, 7.0]
    assert rows["1"]["cpu_integral"] == [8.0, 7.0]
    assert rows["3"]["cpu_mean"] == [1.0]


def test_experiment_level(spark, tables):
    readings, containers, hosts = tables
    rows = {r["host_id"]: r for r in experiment.exp_cpu(trial.trial_cpu(*tables), readings).collect()}
    h = rows["h"]
    assert (h["cpu_min"], h["cpu_max"], h["cpu_cores"]) == (20.0, 90.0, 2)
    assert h["cpu_weighted_avg"] == pytest.approx((150 + 100) / 5)
    ranked = {(r["host_id"], r["ranking"], r["trial_id"]) for r in experiment.exp_cpu_ranking(trial.trial_cpu(*tables)).collect()}
    assert {k for _, k, _ in ranked} == {"best", "worst", "average"} and ("x", "best", "3") in ranked
    assert (h["cpu_integral_min"], h["cpu_integral_max"]) == (50.0, 95.0)
    assert rows["x"]["cpu_levene_test_mean"] is None
    cores = {r["host_id"]: r for r in experiment.exp_cpu_core(trial.trial_cpu_core(*tables), hosts).collect()}
    assert cores["h"]["cpu_max"] == [6.0, 8.0]
    ram = {r["host_id"]: r for r in experiment.exp_ram(trial.trial_ram(*tables), readings).collect()}
    assert (ram["h"]["ram_mode_min"], ram["h"]["ram_mode_max"]) == (1.0 * GIB, 1.0 * GIB)
    assert (ram["h"]["ram_mode_min_freq"], ram["h"]["ram_mode_max_freq"]) == (2, 2)


def test_sizes_and_sets(spark):
    sizes = {
        "2g": 2 * GIB, "2G": 2 * GIB, "2gb": 2 * GIB, "512 mb": 512 * 1024**2, "3k": 3072, "1t": 1024**4,
        "2099945472": 2099945472, "0": 0, "-1": None, "much": None, None: None, "": None,
    }
    sets = {"0-3,7": 5, "1": 1, "0-1,4-5": 4, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in sizes], "s string")
    assert {r[0]: r[1] for r in df.select("s", byte_size(F.col("s"))).collect()} == sizes
    df = spark.createDataFrame([(k,) for k in sets], "s string")
    assert {r[0]: r[1] for r in df.select("s", cpu_set_size(F.col("s"))).collect()} == sets


def test_reading_order_keeps_nanoseconds(spark):
    texts = ["2016-03-18T13:01:05.517955063+01:00", "2016-03-18T12:01:05.517955064Z", "2016-03-18T13:01:05+01:00", "soon"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    base = 1458302465 * 10**9
    found = [r[0] for r in df.select(reading_order(F.col("t"))).collect()]
    assert found == [base + 517955063, base + 517955064, base, None]
