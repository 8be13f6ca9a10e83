"""Levene's test: do the trials of an experiment have the same spread?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialstats.functions.fdist import f_upper_tail
from trialstats.operators.ranking import SLICE_ROWS, ranked, with_totals

# The centres of the test, and the share cut from both ends for "trimmed".
CENTRES = ["mean", "median", "trimmed"]
TRIM = 0.05


# Readings of a value that are left after cutting the share from both ends.
_CUT = f"floor({TRIM}D * n)"
_KEPT = f"greatest(0, least(below + cnt, n - {_CUT}) - greatest(below, {_CUT}))"
# Readings of a value among the lower and the upper half of its trial; a middle one is in neither.
_LOWER = "greatest(0, least(below + cnt, n div 2) - below)"
_UPPER = "greatest(0, below + cnt - greatest(below, n - n div 2))"


def _at_rank(rank: str) -> str:
    return f"max(IF(below <= {rank} AND {rank} < below + cnt, d, NULL))"


def trial_deviations(
    df: DataFrame, keys: Sequence[str], trial: str, value: str | Column, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Per trial and centre: readings, mean distance to the centre and its squared spread.

    The trimmed centre works on the trimmed sample throughout, so its count is smaller.
    Missing readings are skipped and a trial without readings is left out.

    Values are taken relative to the mean of their trial. The distances to the median follow from
    the ranks: the upper half of the readings less the lower half; the squares around any centre
    follow from those around the mean. Only the sum of distances to the trimmed mean needs that
    mean at every value, so its two sums are all that is attached to the ranked rows.
    """
    rows = ranked(df, [*keys, trial], value, slice_rows=slice_rows).where("v IS NOT NULL")
    rows = with_totals(
        rows.selectExpr("*", "CAST(v AS double) - mean AS d", f"{_KEPT} AS kept"),
        {"kept_sum": ("sum", "kept * d"), "kept_cnt": ("sum", "kept")},
    )
    sums = {
        "n_mean": "sum(cnt)", "s": "sum(cnt * d)", "s2": "sum(cnt * d * d)", "abs_mean": "sum(cnt * abs(d))",
        "abs_median": f"sum({_UPPER} * d) - sum({_LOWER} * d)",
        "median": f"({_at_rank('(n - 1) div 2')} + {_at_rank('n div 2')}) / 2",
        "n_trimmed": "sum(kept)", "t": "sum(kept * d)", "t2": "sum(kept * d * d)", "abs_trimmed": "sum(kept * abs(d - kept_sum / kept_cnt))",
    }
    groups = rows.groupBy("g").agg(*[F.expr(e).alias(name) for name, e in sums.items()])
    squares = {"mean": "s2", "median": "s2 - 2 * median * s + n_mean * median * median", "trimmed": "t2 - t * t / n_trimmed"}
    counts = {c: "n_trimmed" if c == "trimmed" else "n_mean" for c in CENTRES}
    return groups.selectExpr(
        "g.*",
        *[e for c in CENTRES for e in (f"{counts[c]} AS n_{c}", f"abs_{c} / {counts[c]} AS z_{c}")],
        *[f"{squares[c]} - abs_{c} * abs_{c} / {counts[c]} AS ss_{c}" for c in CENTRES],
    )


def levene(
    df: DataFrame,
    keys: Sequence[str],
    trial: str,
    value: str | Column,
    p_values: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Statistic ``<centre>_stat`` and p-value ``<centre>`` per experiment group.

    W = (N-k) sum(n_i (z_i - z)^2) / ((k-1) sum_i sum_j (z_ij - z_i)^2) over k trials.
    Fewer than two trials with readings, or no spread at all, gives null.
    """
    trials = trial_deviations(df, keys, trial, value, slice_rows)
    aggs = ["count(1) AS n_trials"]
    for c in CENTRES:
        between = f"sum(n_{c} * z_{c} * z_{c}) - sum(n_{c} * z_{c}) * sum(n_{c} * z_{c}) / sum(n_{c})"
        aggs += [f"sum(n_{c}) AS total_{c}", f"greatest(0, {between}) AS between_{c}", f"sum(ss_{c}) AS within_{c}"]
    stats = trials.groupBy(*keys).agg(*[F.expr(a) for a in aggs]).selectExpr(
        *keys,
        "n_trials",
        *[f"total_{c}" for c in CENTRES],
        *[
            f"IF(n_trials > 1, (total_{c} - n_trials) * between_{c} / nullif((n_trials - 1) * within_{c}, 0), NULL) AS {c}_stat"
            for c in CENTRES
        ],
    )
    names = [f"{c}_stat" for c in CENTRES]
    if not p_values:
        return stats.select(*keys, *names)
    return stats.select(
        *keys,
        *names,
        *[
            f_upper_tail(F.col(f"{c}_stat"), F.col("n_trials") - 1, F.col(f"total_{c}") - F.col("n_trials")).alias(c)
            for c in CENTRES
        ],
    )
