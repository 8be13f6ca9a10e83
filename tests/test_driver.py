from __future__ import annotations

import pytest

from trialstats.plans import driver
from trialstats.plans.trial import trial_driver_details
from trialstats.sources.schemas import schema


def test_details_grid(spark):
    rows = [
        ("e", "t", "h1", "WebDriver Throughput (ops/s)", "op1", "1", 2.0),
        ("e", "t", "h1", "WebDriver Throughput (ops/s)", "op1", "2", 4.0),
        ("e", "t", "h1", "CPU", "op2", "1", 9.0),
        ("e", "t", "h2", "WebDriver Response Times (s)", "op1", "1", None),
    ]
    cells = trial_driver_details(spark.createDataFrame(rows, schema("faban_details"))).collect()
    assert len(cells) == 3 * 2 * 2
    found = {(r[2], r[3], r[4]): r for r in cells}
    full = found["h1", "WebDriver Throughput", "op1"]
    assert (full["faban_details_num_data_points"], full["faban_details_mean"]) == (2, 3.0)
    assert (full["faban_details_mode_min"], full["faban_details_mode_max"], full["faban_details_mode_ties"]) == (2.0, 4.0, 2)
    filled = [k for k, r in found.items() if r["faban_details_num_data_points"]]
    assert filled == [("h1", "WebDriver Throughput", "op1")]
    assert found["aggregate", "WebDriver Response Times", "op2"]["faban_details_mean"] is None


def test_host_named_aggregate_is_not_doubled(spark):
    rows = [("e", "t", "aggregate", "WebDriver Throughput", "op", "1", 2.0)]
    cells = trial_driver_details(spark.createDataFrame(rows, schema("faban_details"))).collect()
    assert sorted(r["faban_details_num_data_points"] for r in cells) == [0, 1]


def test_reports(spark):
    ops = spark.createDataFrame(
        [("e", "t1", "h", "d", 10.0, "ops"), ("e", "t2", "h", "d", 30.0, "ops")], schema("faban_driver_summary")
    )
    assert driver.total_operations(ops).first()["faban_total_ops_mean"] == 20
    mix = spark.createDataFrame(
        [("e", "t1", "h", "d", "o", 1, 2, 0.5), ("e", "t2", "h", "d", "o", 3, None, 0.5)], schema("faban_driver_mix")
    )
    row = driver.operation_mix(mix).first()
    assert (row["faban_successes_mean"], row["faban_failures_num_data_points"], row["faban_mix_mode_min"]) == (2, 1, 0.5)
    delays = spark.createDataFrame(
        [("e", "t1", "h", "d", "o", 1.0, 0.1, 5.0), ("e", "t2", "h", "d", "o", 2.0, 0.2, 4.0)],
        schema("faban_driver_delay_times"),
    )
    assert tuple(driver.delay_times(delays).first())[4:] == pytest.approx((1.5, 0.1, 5.0))
    runs = spark.createDataFrame(
        [("e", "t1", "h", 60, "ops", 5.0, True), ("e", "t2", "h", 62, "ops", 7.0, None), ("e", "t1", "g", 1, "ops", 1.0, True)],
        schema("faban_run_info"),
    )
    info = {r["faban_host"]: r for r in driver.run_info(runs).collect()}
    assert (info["h"]["faban_duration_mean"], info["h"]["faban_metric_value_mean"]) == (61, 6)
    assert (info["h"]["faban_passed"], info["g"]["faban_passed"], info["h"]["faban_metric_unit"]) == (False, True, "ops")
    times = spark.createDataFrame(
        [("e", "t1", "h", "d", "o", "avg", 3.0), ("e", "t2", "h", "d", "o", "avg", 1.0)],
        schema("faban_driver_response_times"),
    )
    assert tuple(driver.response_times(times).first())[-2:] == (1.0, 3.0)


def test_custom_statistics_are_routed_by_target(spark):
    rows = [
        ("e", "t1", "h", "d", "s", "x", "absolute", 1.0), ("e", "t2", "h", "d", "s", "x", "absolute", 3.0),
        ("e", "t1", "h", "d", "s", "y", "statistic", 5.0), ("e", "t1", "h", "d", "s", "z", None, 7.0),
    ]
    results = driver.custom_stats(spark.createDataFrame(rows, schema("faban_driver_custom_stats")))
    absolute = results["exp_faban_ops_custom_stats_target_absolute"].collect()
    statistic = results["exp_faban_ops_custom_stats_target_statistic"].collect()
    assert [(r["faban_stat_description"], r["faban_stat_mean"]) for r in absolute] == [("x", 2.0)]
    assert sorted((r["faban_stat_description"], r["faban_stat_min"], r["faban_stat_max"]) for r in statistic) == [
        ("y", 5.0, 5.0), ("z", 7.0, 7.0),
    ]
