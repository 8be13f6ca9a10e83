from __future__ import annotations

import numpy as np
import pytest

from trialstats.functions.fdist import f_tail
from trialstats.operators.levene import levene


def brute(samples: list[np.ndarray], centre: str) -> float:
    if centre == "trimmed":
        samples = [np.sort(s)[int(0.05 * len(s)): len(s) - int(0.05 * len(s))] for s in samples]
    middle = np.median if centre == "median" else np.mean
    z = [np.abs(s - middle(s)) for s in samples]
    n = np.array([len(s) for s in z])
    means = np.array([s.mean() for s in z])
    grand = (n * means).sum() / n.sum()
    between = (n.sum() - len(n)) * (n * (means - grand) ** 2).sum()
    within = (len(n) - 1) * sum(((s - m) ** 2).sum() for s, m in zip(z, means))
    return between / within


@pytest.mark.parametrize("slice_rows", [None, 11])
def test_against_numpy(spark, slice_rows):
    rng = np.random.default_rng(3)
    data = {
        "a": [np.round(rng.normal(10, 1 + i / 4, 300 + 41 * i), 2) for i in range(4)],
        "b": [rng.exponential(2, 97), rng.exponential(3, 1201)],
        "c": [np.array([1.0, 2.0, 4.0]), np.array([2.0, 2.5])],
    }
    rows = [(e, f"t{i}", float(x)) for e, samples in data.items() for i, s in enumerate(samples) for x in s]
    rows += [("a", "t0", None), ("a", "empty", None), ("single", "t0", 1.0), ("flat", "t0", 1.0), ("flat", "t1", 1.0)]
    df = spark.createDataFrame(rows, "e string, t string, x double")
    options = {} if slice_rows is None else {"slice_rows": slice_rows}
    found = {r["e"]: r for r in levene(df, ["e"], "t", "x", **options).collect()}
    for e, samples in data.items():
        for centre in ("mean", "median", "trimmed"):
            w = brute(samples, centre)
            assert found[e][f"{centre}_stat"] == pytest.approx(w, rel=1e-8), (e, centre)
            cut = [2 * int(0.05 * len(s)) if centre == "trimmed" else 0 for s in samples]
            total = sum(len(s) for s in samples) - sum(cut)
            assert found[e][centre] == pytest.approx(f_tail(w, len(samples) - 1, total - len(samples)), rel=1e-6)
    for e in ("single", "flat"):
        assert all(found[e][c] is None for c in ("mean_stat", "median_stat", "trimmed_stat", "mean", "trimmed"))


def test_f_tail_known_values():
    assert f_tail(3.2, 2, 30) == pytest.approx(0.0549918165561, rel=1e-10)
    assert f_tail(0.7, 4, 59000) == pytest.approx(0.59183599022, rel=1e-9)
    # One degree of freedom against one: an arctangent in closed form.
    assert f_tail(5.0, 1, 1) == pytest.approx(1 - 2 / np.pi * np.arctan(np.sqrt(5.0)), rel=1e-12)
    # Two degrees against d: (1 + 2x/d)^(-d/2).
    assert f_tail(1.3, 2, 9) == pytest.approx((1 + 2.6 / 9) ** -4.5, rel=1e-12)
    assert f_tail(0.0, 3, 4) == 1.0
