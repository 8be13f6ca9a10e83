from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialstats.operators.describe import (
    describe,
    describe_measures,
    mode_rows,
    percentile_curve,
)

# Name: readings, then n, mean, integral, sd, q1, q2, q3, p95, me, lower and upper bound.
CASES = {
    "one": ([1], 1, 1, 0, 0, 1, 1, 1, 1, 0, 1, 1),
    "four": ([2, 4, 2, 4], 4, 3, 9, 1, 2, 3, 4, 4, 1, 2, 4),
    "equal": ([2, 2, 2], 3, 2, 4, 0, 2, 2, 2, 2, 0, 2, 2),
    "many": ([2] * 10_000, 10_000, 2, 19_998, 0, 2, 2, 2, 2, 0, 2, 2),
}
STATS = ["num_data_points", "mean", "integral", "sd", "q1", "q2", "q3", "p95", "me", "ci095_min", "ci095_max"]


def readings(spark, cases):
    rows = [(name, i, float(x)) for name, xs in cases.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "name string, at int, x double")


def test_known_summaries(spark):
    df = readings(spark, {k: v[0] for k, v in CASES.items()})
    df = df.union(spark.createDataFrame([("none", 0, None)], df.schema))
    found = {r["name"]: r for r in describe(df, ["name"], "x", F.col("at")).collect()}
    for name, (_, *expected) in CASES.items():
        assert [found[name][s] for s in STATS] == pytest.approx(expected), name
    assert found["none"]["num_data_points"] == 0
    assert all(found["none"][s] is None for s in [*STATS[1:], "min", "max", "variance", "percentiles"])


def test_no_input(spark):
    df = spark.createDataFrame([], "name string, at int, x double")
    assert describe(df, ["name"], "x", F.col("at"), modes=True).count() == 0


@pytest.mark.parametrize("slice_rows", [None, 7])
def test_against_numpy(spark, slice_rows):
    """Groups of several shapes, one with a third of the rows, cut into slices or not."""
    rng = np.random.default_rng(5)
    shapes = {
        "hot": rng.lognormal(3, 2, 3000),
        "whole": rng.integers(0, 40, 1500).astype(float),
        "large": 2e9 + rng.normal(0, 1000, 1500),
        "negative": -rng.exponential(5, 1500),
        "constant": np.full(1000, 7.5),
        "pair": np.array([1.0, 2.0]),
    }
    df = readings(spark, shapes).repartition(5)
    options = {} if slice_rows is None else {"slice_rows": slice_rows}
    for r in describe(df, ["name"], "x", F.col("at"), modes=True, **options).collect():
        x = shapes[r["name"]]
        assert r["num_data_points"] == len(x)
        assert r["percentiles"] == pytest.approx(list(np.percentile(x, range(101))), rel=1e-12)
        assert r["mean"] == pytest.approx(x.mean(), rel=1e-12)
        assert r["variance"] == pytest.approx(x.var(), rel=1e-7, abs=1e-12)
        assert r["integral"] == pytest.approx(np.trapezoid(x), rel=1e-12)
        values, counts = np.unique(x, return_counts=True)
        modes = values[counts == counts.max()]
        assert (r["mode_freq"], r["mode_ties"]) == (counts.max(), len(modes))
        assert (r["mode_min"], r["mode_max"]) == (modes.min(), modes.max())


def test_slices_do_not_change_ranks(spark):
    from trialstats.operators.ranking import ranked

    df = spark.range(20_000).selectExpr("id % 3 AS k", "CAST(pmod(hash(id), 5000) AS double) AS x")
    whole = ranked(df, ["k"], "x").drop("slice", "big")
    cut = ranked(df, ["k"], "x", slice_rows=50)
    assert cut.where("big").select("g", "slice").distinct().count() > 100
    largest = cut.groupBy("g", "slice").count().agg(F.max("count")).first()[0]
    assert largest < 1000
    assert whole.exceptAll(cut.drop("slice", "big")).count() == 0
    assert whole.count() == cut.count()


def test_modes(spark):
    df = readings(spark, {"one": [1], "two": [2, 1, 1], "tie": [2, 1]})
    big = spark.range(1_000_000).selectExpr("'big' AS name", "0 AS at", "2.0D AS x")
    df = df.union(big).union(spark.createDataFrame([("big", 0, 1.0), ("big", 0, 3.0)], df.schema))
    found: dict[str, list] = {}
    for r in mode_rows(df, ["name"], "x").collect():
        found.setdefault(r["name"], []).append((r["mode"], r["mode_freq"]))
    assert {k: sorted(v) for k, v in found.items()} == {
        "one": [(1.0, 1)],
        "two": [(1.0, 2)],
        "tie": [(1.0, 1), (2.0, 1)],
        "big": [(2.0, 1_000_000)],
    }


def test_many_ties_are_complete_as_rows(spark):
    df = spark.range(2002).selectExpr("'k' AS k", "CAST(id % 1001 AS double) AS x")
    row = describe(df, ["k"], "x", modes=True).first()
    assert (row["mode_freq"], row["mode_ties"], row["mode_min"], row["mode_max"]) == (2, 1001, 0.0, 1000.0)
    assert sorted(r["mode"] for r in mode_rows(df, ["k"], "x").collect()) == [float(i) for i in range(1001)]


@pytest.mark.parametrize("slice_rows", [1 << 18, 1])
def test_large_whole_numbers_stay_apart(spark, slice_rows):
    rows = [("k", 9007199254740993)] * 2 + [("k", 9007199254740992), ("k", 5), ("k", 5)]
    df = spark.createDataFrame(rows, "k string, x bigint")
    row = describe(df, ["k"], "x", modes=True, slice_rows=slice_rows).first()
    assert (row["mode_freq"], row["mode_ties"], row["num_data_points"]) == (2, 2, 5)
    assert {r["mode"] for r in mode_rows(df, ["k"], "x").collect()} == {9007199254740993, 5}


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0), ("a", 2.0)], "k string, x double")
    assert {tuple(r) for r in mode_rows(df, ["k"], "x").collect()} == {(None, 1.0, 2), ("a", 2.0, 1)}
    cut = describe(df, ["k"], "x", modes=True, slice_rows=1)
    assert {(r["k"], r["mean"], r["num_data_points"]) for r in cut.collect()} == {(None, 1.0, 2), ("a", 2.0, 1)}


def test_total_row_and_reserved_label(spark):
    rows = [("t", "a", 1.0), ("t", "a", 3.0), ("t", "b", 5.0), ("t", "all", 7.0), ("t", None, None)]
    df = spark.createDataFrame(rows, "trial string, process string, x double")
    stats = describe(df, ["trial", "process"], "x", total_of=["process"])
    found = {r["process"]: (r["num_data_points"], r["mean"]) for r in stats.collect()}
    assert found == {"a": (2, 2.0), "b": (1, 5.0), "all": (4, 4.0), None: (0, None)}


def test_two_labels_have_no_subtotals(spark):
    rows = [("t", "task", "x", 1.0), ("t", "task", "y", 2.0), ("t", "all", "x", 3.0)]
    df = spark.createDataFrame(rows, "trial string, kind string, name string, x double")
    stats = describe(df, ["trial", "kind", "name"], "x", total_of=["kind", "name"])
    found = {(r["kind"], r["name"]): r["mean"] for r in stats.collect()}
    assert found == {("task", "x"): 1.0, ("task", "y"): 2.0, ("all", "x"): 3.0, ("all", "all"): 2.0}


def test_measures_side_by_side(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 3, None)], "k string, a int, b double")
    row = describe_measures(df, ["k"], ["a", "b"], ["a", "b"], modes=True).first()
    assert (row["a_mean"], row["a_num_data_points"], row["a_mode_ties"]) == (2.0, 2, 2)
    assert (row["b_mean"], row["b_num_data_points"], row["b_mode_freq"]) == (None, 0, None)


def test_curve_rows(spark):
    df = readings(spark, {"four": [2, 4, 2, 4]})
    rows = percentile_curve(df, ["name"], "x").orderBy("percentile").collect()
    assert [r["percentile"] for r in rows] == list(range(101))
    assert [r["value"] for r in rows] == pytest.approx(list(np.percentile([2, 4, 2, 4], range(101))))


def test_order_of_ties_at_the_ends(spark):
    rows = [("k", 1, 5.0), ("k", 1, 3.0), ("k", 2, 9.0), ("k", 3, 4.0), ("k", 3, 8.0)]
    df = spark.createDataFrame(rows, "k string, at int, x double")
    assert describe(df, ["k"], "x", F.col("at")).first()["integral"] == 29 - (3 + 8) / 2
