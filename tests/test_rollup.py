from __future__ import annotations

import math

import numpy as np
import pytest

from trialstats.operators.arrays import rollup_cores
from trialstats.operators.rollup import rollup, trial_ranking

STATS = ["mean", "min", "max", "q1", "q2", "q3", "p90", "p95", "p99", "me", "variance"]
SCHEMA = (
    "experiment_id string, trial_id string, "
    + ", ".join(f"d_{s} double" for s in STATS)
    + ", d_num_data_points long, d_mode_min double, d_mode_max double, d_mode_freq long"
)


def trial(experiment: str, i: int, value: float, n: int = 1, me: float = 0.0, variance: float = 0.0):
    stats = {s: float(value) for s in STATS} | {"p90": 1.0, "p99": 1.0, "me": me, "variance": variance}
    return (experiment, f"t_{i}", *[stats[s] for s in STATS], n, float(value), float(value), 1)


def listed(trials):
    """Trials by experiment and ranking."""
    found = {}
    for e, kind, t in sorted(tuple(r) for r in trial_ranking(trials, ["experiment_id"], "d").collect()):
        found.setdefault((e, kind), []).append(t)
    return found


# Experiment: values of its trials, then mode ends, weighted mean, best, worst, average.
CASES = {
    "one": ([1], (1, 1), 1, ["t_1"], ["t_1"], ["t_1"]),
    "two": ([1, 2], (1, 2), 1.5, ["t_1"], ["t_2"], ["t_1", "t_2"]),
    "three": ([1, 2, 3], (1, 3), 2, ["t_1"], ["t_3"], ["t_2"]),
    "four": ([1, 2, 3, 4], (1, 4), 2.5, ["t_1"], ["t_4"], ["t_2", "t_3"]),
    "equal": ([1, 1, 1], (1, 1), 1, *[["t_1", "t_2", "t_3"]] * 3),
}


def test_known_experiments(spark):
    rows = [trial(e, i + 1, v) for e, case in CASES.items() for i, v in enumerate(case[0])]
    trials = spark.createDataFrame(rows, SCHEMA)
    found = {r["experiment_id"]: r for r in rollup(trials, ["experiment_id"], "d", modes=True).collect()}
    for e, (values, modes, mean, best, worst, average) in CASES.items():
        r = found[e]
        assert (r["d_mode_min"], r["d_mode_max"]) == modes
        assert r["d_weighted_avg"] == pytest.approx(mean)
        assert r["d_variation_coefficient"] == pytest.approx(np.std(values) / np.mean(values) * 100)
        for s in ("q1", "q2", "q3", "p95", "mean"):
            assert (r[f"d_{s}_min"], r[f"d_{s}_max"]) == (min(values), max(values))
        assert (r["d_p90_min"], r["d_p99_max"]) == (1, 1)
    kinds = ("best", "worst", "average")
    assert listed(trials) == {(e, kind): ts for e, c in CASES.items() for kind, ts in zip(kinds, c[3:])}
    assert math.isnan(found["one"]["d_combined_variance"])


def test_no_trials(spark):
    assert rollup(spark.createDataFrame([], SCHEMA), ["experiment_id"], "d", modes=True).count() == 0


def test_margin_breaks_ties_and_empty_trials_do_not_rank(spark):
    rows = [trial("e", 1, 1, me=0.5), trial("e", 2, 1, me=0.2), trial("e", 3, 4, me=0.1), trial("e", 4, 4, me=0.3)]
    empty = ("e", "t_5", *[None] * len(STATS), 0, None, None, None)
    trials = spark.createDataFrame([*rows, empty], SCHEMA)
    assert listed(trials) == {("e", "best"): ["t_2"], ("e", "worst"): ["t_4"], ("e", "average"): ["t_1", "t_2", "t_3", "t_4"]}
    assert rollup(trials, ["experiment_id"], "d").first()["d_weighted_avg"] == 2.5


def test_many_ties_and_small_means(spark):
    trials = spark.createDataFrame([trial("e", i, 7.0) for i in range(1001)], SCHEMA)
    assert {k: len(v) for k, v in listed(trials).items()} == {("e", k): 1001 for k in ("best", "worst", "average")}
    small = spark.createDataFrame([trial("e", i, v) for i, v in ((1, 1e-10), (2, 2e-10), (3, 9e-10))], SCHEMA)
    assert listed(small)["e", "average"] == ["t_2", "t_3"]


def test_combined_variance_formula(spark):
    n, m, v = np.array([4, 10, 7]), np.array([2.0, 3.5, 1.0]), np.array([0.5, 2.0, 1.5])
    rows = [trial("e", i, m[i], n=int(n[i]), variance=float(v[i])) for i in range(3)]
    r = rollup(spark.createDataFrame(rows, SCHEMA), ["experiment_id"], "d").first()
    grand = (n * m).sum() / n.sum()
    expected = (((n - 1) * v + n * m**2).sum() - n.sum() * grand**2) / (n.sum() - 1)
    assert r["d_combined_variance"] == pytest.approx(expected)


def test_experiment_with_most_trials_matches_pandas(spark):
    rng = np.random.default_rng(1)
    rows = [trial("hot", i, round(float(x), 1)) for i, x in enumerate(rng.normal(50, 5, 700))]
    rows += [trial(f"e{i % 7}", i, float(i)) for i in range(300)]
    trials = spark.createDataFrame(rows, SCHEMA)
    found = listed(trials)
    values = {row[1]: row[2] for row in rows if row[0] == "hot"}
    means = np.array(list(values.values()))
    upper, lower = means[means >= means.mean()].min(), means[means <= means.mean()].max()
    assert found["hot", "best"] == sorted(t for t, x in values.items() if x == means.min())
    assert found["hot", "worst"] == sorted(t for t, x in values.items() if x == means.max())
    assert found["hot", "average"] == sorted(t for t, x in values.items() if x in (upper, lower))


def test_cores(spark):
    stats = ["mean", "min", "max", "variance", "q1", "q2", "q3", "p90", "p95", "p99"]
    schema = (
        "experiment_id string, trial_id string, cpu_num_data_points long, "
        + ", ".join(f"cpu_{s} array<double>" for s in stats)
    )

    def row(e, i, cells):
        return (e, f"t_{i}", 1, *[cells] * len(stats))

    rows = [
        row("one", 1, [1.0, 1.0]), row("two", 1, [1.0, 1.0]), row("two", 2, [2.0, 2.0]),
        row("null", 1, [None, 1.0]), row("null", 2, [None, 1.0]), row("half", 1, [None, 1.0]), row("half", 2, [4.0, 1.0]),
    ]
    cells = rollup_cores(spark.createDataFrame(rows, schema), ["experiment_id"], "cpu").where("core = 0").collect()
    found = {r["experiment_id"]: (r["cpu_min"], r["cpu_max"], r["cpu_weighted_avg"]) for r in cells}
    assert found == {"one": (1, 1, 1), "two": (1, 2, 1.5), "null": (None, None, None), "half": (4, 4, None)}
