from __future__ import annotations

import numpy as np
import pytest

from trialstats.operators import warmup
from trialstats.operators.warmup import trim_warmup

SCHEMA = "trial_id string, process_definition_id string, source_process_instance_id string, start_time long"
# Name: (rows, n, rows that stay).
CASES = {
    "short": ([("foobar", "1", 1)], 2, 1),
    "two": ([("foo", "1", 1), ("foo", "2", 1), ("bar", "3", 2), ("bar", "4", 2)], 1, 1),
    "same": ([("foo", "1", 1), ("bar", "2", 1)], 1, 1),
    "few": ([("foo", "1", 1), ("bar", "2", 1)], 2, 2),
    "other": ([("A", "a1", 5), ("B", "b0", 1), ("B", "Z", 5)], 1, 0),
}


@pytest.mark.parametrize("n", [1, 2])
def test_known_cases(spark, n):
    cases = {k: v for k, v in CASES.items() if v[1] == n}
    rows = [(name, *r) for name, case in cases.items() for r in case[0]]
    left = trim_warmup(spark.createDataFrame(rows, SCHEMA), n, ["trial_id"]).groupBy("trial_id").count().collect()
    found = {r[0]: r[1] for r in left}
    assert {name: found.get(name, 0) for name in cases} == {name: case[2] for name, case in cases.items()}


def brute(rows, n):
    """Straight reading of the rule, one trial after the other."""
    kept = []
    for t in {r[0] for r in rows}:
        trial = sorted((r for r in rows if r[0] == t), key=lambda r: (r[3], r[2]))
        best = None
        for d in {r[1] for r in trial}:
            starts = [(r[3], r[2]) for r in trial if r[1] == d]
            if len(starts) < n:
                continue
            time = starts[n - 1][0]
            cut = (time, min(i for s, i in starts if s == time))
            if best is None or time > best[0] or (time == best[0] and cut < best):
                best = cut
        kept += [r for r in trial if best is None or (r[3], r[2]) > best]
    return sorted(kept)


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [
        (f"t{rng.integers(3)}", f"p{min(rng.integers(6), 3)}", f"i{i:04d}", int(rng.integers(60))) for i in range(600)
    ]
    for n in (1, 5, 40, 10_000):
        left = trim_warmup(spark.createDataFrame(rows, SCHEMA), n, ["trial_id"]).collect()
        assert sorted(tuple(r) for r in left) == brute(rows, n), n


def test_timestamps(spark):
    rows = [("t", "p", "1", 1), ("t", "p", "2", 2), ("t", "p", "3", 3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("* EXCEPT (start_time)", "timestamp_seconds(start_time) AS start_time")
    assert [r[2] for r in trim_warmup(df, 2, ["trial_id"]).collect()] == ["3"]


def test_nanosecond_starts_are_exact(spark):
    rows = [("t", "p", f"i{i:05d}", 1_458_302_465_517_955_063 + i) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    for n in (1000, 1001):
        assert trim_warmup(df, n, ["trial_id"]).count() == 1500 - n


def test_null_definition_and_trial_count(spark):
    rows = [("t", None, f"i{i}", i) for i in range(4)] + [(None, "p", f"j{i}", i) for i in range(4)]
    left = trim_warmup(spark.createDataFrame(rows, SCHEMA), 3, ["trial_id"]).collect()
    assert sorted(r[2] for r in left) == ["i3", "j3"]
