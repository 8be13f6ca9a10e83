from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from trialstats.operators.groups import every, throughput
from trialstats.plans import trial

START = datetime(2024, 1, 1)
PROCESS = (
    "experiment_id string, trial_id string, source_process_instance_id string, process_name string, "
    "start_time timestamp, end_time timestamp, duration long, to_ignore boolean"
)


def instance(name, start, end, ignore=False, instance_id="i", trial_id="t"):
    def time(s):
        return None if s is None else START + timedelta(seconds=s)

    duration = None if start is None or end is None else int((end - start) * 1000)
    return ("e", trial_id, instance_id, name, time(start), time(end), duration, ignore)


def test_largest_io_values(spark):
    rows = [
        ("a", 1, 5, 5, 10), ("b", 1, 5, 5, 10), ("b", 1, 6, 6, 12), ("b", 2, 8, 8, 16), ("b", 2, 6, 6, 12),
        ("c", 1, 5, None, 5), ("c", 1, 6, None, 6), ("c", 2, None, 8, 8), ("c", 2, None, 6, 6),
        ("d", 1, 5, 1, 6), ("d", 1, 6, None, 6),
    ]
    df = spark.createDataFrame(rows, "trial_id string, device string, reads long, writes long, total long")
    df = df.selectExpr("'e' AS experiment_id", "'c' AS container_id", "'c' AS container_name", "'h' AS host_id", "*")
    found = {(r["trial_id"], r["device"]): (r["reads"], r["writes"], r["total"]) for r in trial.trial_io(df).collect()}
    assert found == {
        ("a", "1"): (5, 5, 10), ("b", "1"): (6, 6, 12), ("b", "2"): (8, 8, 16),
        ("c", "1"): (6, None, 6), ("c", "2"): (None, 8, 8), ("d", "1"): (6, None, 6),
    }


def test_total_size(spark):
    sizes = {"one": [10], "two": [10, 20], "large": [9_000_000] * 2, "three": [1, 2, 3], "none": [None]}
    rows = [("e", t, str(i), x) for t, xs in sizes.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "experiment_id string, trial_id string, dbms string, size long")
    found = {r["trial_id"]: r["size"] for r in trial.trial_byte_size(df).collect()}
    assert found == {"one": 10, "two": 30, "large": 18_000_000, "three": 6, "none": None}


def test_process_jobs(spark):
    rows = [
        instance("a", 0, 2), instance("a", 3, 10), instance("b", 1, 4.5), instance("all", 2, 20),
        instance("b", 0, 99, ignore=True), instance("b", 0, 99, ignore=None), instance("b", 0, 99, instance_id=None),
        instance("c", 5, None),
    ]
    df = spark.createDataFrame(rows, PROCESS)
    times = trial.trial_execution_time(df)
    counts = trial.trial_number_of_process_instances(df)
    assert {r[2]: r[3] for r in times.collect()} == {"a": 10.0, "b": 3.5, "c": None, "all": 20.0}
    assert {r[2]: r[3] for r in counts.collect()} == {"a": 2, "b": 1, "c": 1, "all": 5}
    found = {r["process_definition_id"]: r["throughput"] for r in trial.trial_throughput(times, counts).collect()}
    assert found == pytest.approx({"a": 0.1, "b": 0.05, "c": 0.05, "all": 0.25})
    together = trial.trial_process_totals(df)
    apart = times.join(counts, times.columns[:3]).join(trial.trial_throughput(times, counts), times.columns[:3])
    assert together.select(apart.columns).exceptAll(apart).count() == 0
    assert together.count() == apart.count()
    durations = {r["process_definition_id"]: r for r in trial.trial_process_duration(df).collect()}
    assert (durations["a"]["process_duration_mean"], durations["all"]["process_duration_num_data_points"]) == (4500, 4)
    assert durations["c"]["process_duration_num_data_points"] == 0


def test_throughput_without_time(spark):
    times = spark.createDataFrame(
        [("z", "p", 0.0), ("z", "all", 0.0), ("n", "all", None)], "trial_id string, p string, execution_time double"
    )
    counts = spark.createDataFrame([("z", "p", 1), ("z", "all", 1), ("n", "all", 3)], "trial_id string, p string, k int")
    rows = throughput(times, counts, ["trial_id"], "p", "k").collect()
    assert len(rows) == 3 and all(r["throughput"] is None for r in rows)


def test_construct_jobs_name_what_is_missing(spark):
    rows = [("e", "t", "i", None, "n", 4, False), ("e", "t", "i", "Unspecified", "n", 6, False), ("e", "t", "i", "s", None, 8, False)]
    df = spark.createDataFrame(
        rows,
        "experiment_id string, trial_id string, source_construct_instance_id string, construct_type string, "
        "construct_name string, duration long, to_ignore boolean",
    )
    counts = {(r[2], r[3]): r[4] for r in trial.trial_number_of_construct_instances(df).collect()}
    assert counts == {("Unspecified", "n"): 2, ("s", "Unspecified"): 1, ("all", "all"): 3}
    means = {
        (r["construct_type"], r["construct_name"]): r["construct_duration_mean"]
        for r in trial.trial_construct_duration(df).collect()
    }
    assert means == {("Unspecified", "n"): 5, ("s", "Unspecified"): 8, ("all", "all"): 6}


def test_every(spark):
    df = spark.createDataFrame([("a", True), ("b", True), ("b", None), ("c", False)], "k string, p boolean")
    assert dict(df.groupBy("k").agg(every("p")).collect()) == {"a": True, "b": False, "c": False}
