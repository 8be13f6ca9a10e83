"""Roll-up of trial summaries to their experiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialstats.operators.ranking import pack, with_part_totals

# Trials of one experiment are spread over this many parts.
PARTS = 64
# Means that differ by this share of their size count as equal when looking for the trial nearest to the average.
CLOSE = "1e-9D"

# Statistics whose smallest and largest value over the trials are reported.
EXTREMES = ["q1", "q2", "q3", "p90", "p95", "p99", "mean"]
RANKINGS = ["best", "worst", "average"]


def extremes(prefix: str, statistics: Sequence[str] = EXTREMES) -> list[Column]:
    """Overall min / max and the min / max over trials of each statistic; nulls are ignored."""
    ends = {f"{prefix}_min": f"min({prefix}_min)", f"{prefix}_max": f"max({prefix}_max)"}
    for s in statistics:
        ends |= {f"{prefix}_{s}_{end}": f"{end}({prefix}_{s})" for end in ("min", "max")}
    return [F.expr(f"{aggregate} AS {name}") for name, aggregate in ends.items()]


def weighted_mean(prefix: str) -> Column:
    """Mean of all readings from the trial means."""
    n, mean = f"{prefix}_num_data_points", f"{prefix}_mean"
    return F.expr(f"sum({mean} * {n}) / nullif(sum({n}) FILTER (WHERE {mean} IS NOT NULL), 0)")


def variation_coefficient(prefix: str) -> Column:
    """Population deviation of the trial means relative to their mean, in percent."""
    return F.expr(f"stddev_pop({prefix}_mean) / nullif(avg({prefix}_mean), 0) * 100")


def combined_variance(prefix: str) -> Column:
    """Variance of all readings from the trial summaries.

    (sum((n_i - 1) v_i + n_i m_i^2) - N M^2) / (N - 1), with the variances as they are
    stored, that is population variances. A single reading gives NaN, none gives null.
    """
    n, m, v = f"{prefix}_num_data_points", f"{prefix}_mean", f"{prefix}_variance"
    grand = f"sum({n} * {m}) / nullif(sum({n}), 0)"
    squares = f"sum(({n} - 1) * {v} + {n} * {m} * {m})"
    return F.expr(
        f"IF(sum({n}) = 1, double('NaN'), "
        f"({squares} - sum({n}) * ({grand}) * ({grand})) / nullif(sum({n}) - 1, 0))"
    )


def mode_extremes(prefix: str) -> list[Column]:
    """Smallest and largest mode over the trials, each with its frequency."""
    out = []
    for end in ("min", "max"):
        mode = f"{prefix}_mode_{end}"
        pair = f"{end}(struct({mode} AS v, {prefix}_mode_freq AS f)) FILTER (WHERE {mode} IS NOT NULL)"
        out += [F.expr(f"({pair}).v AS {mode}"), F.expr(f"({pair}).f AS {mode}_freq")]
    return out


def _equal(a: str, b: str) -> str:
    return f"abs({a} - {b}) <= {CLOSE} * greatest(abs({a}), abs({b}))"


def _ranked_trials(trials: DataFrame, keys: Sequence[str], prefix: str, trial: str) -> DataFrame:
    """Trial rows with ``g``, ``part`` and a flag per ranking.

    Best: smallest mean, then smallest margin. Worst: largest mean, then largest margin.
    Average: the means nearest to the mean of means from above and from below. All ties
    count. Statistics of the experiment reach the trials through parts of the experiment.
    """
    me = f"{prefix}_me"
    rows = trials.selectExpr(
        "*",
        pack(keys),
        f"pmod(xxhash64({trial}), {PARTS}) AS part",
        f"{prefix}_mean AS m",
    )
    rows = with_part_totals(
        rows,
        ["count(m) AS c", "sum(m) AS s", "min(m) AS lo", "max(m) AS hi"],
        {
            "lowest": "min(lo) OVER w",
            "highest": "max(hi) OVER w",
            "centre": "sum(s) OVER w / nullif(sum(c) OVER w, 0)",
        },
    )
    rows = with_part_totals(
        rows,
        [
            f"min({me}) FILTER (WHERE m = lowest) AS b",
            f"max({me}) FILTER (WHERE m = highest) AS w",
            f"min(m) FILTER (WHERE m >= centre OR {_equal('m', 'centre')}) AS u",
            f"max(m) FILTER (WHERE m <= centre OR {_equal('m', 'centre')}) AS l",
        ],
        {
            "best_me": "min(b) OVER w",
            "worst_me": "max(w) OVER w",
            "upper": "min(u) OVER w",
            "lower": "max(l) OVER w",
        },
    )
    return rows.selectExpr(
        "*",
        f"coalesce(m = lowest AND {me} = best_me, false) AS is_best",
        f"coalesce(m = highest AND {me} = worst_me, false) AS is_worst",
        f"coalesce({_equal('m', 'upper')} OR {_equal('m', 'lower')}, false) AS is_average",
    )


def trial_ranking(
    trials: DataFrame, keys: Sequence[str], prefix: str, trial: str = "trial_id"
) -> DataFrame:
    """Best, worst and average trials as rows ``(keys, ranking, trial)``, with all ties."""
    rows = _ranked_trials(trials, keys, prefix, trial)
    kinds = ", ".join(f"IF(is_{k}, '{k}', NULL)" for k in RANKINGS)
    return rows.selectExpr("g.*", f"explode(array_compact(array({kinds}))) AS ranking", trial)


def rollup(
    trials: DataFrame,
    keys: Sequence[str],
    prefix: str,
    modes: bool = False,
    carry: Sequence[Column] = (),
) -> DataFrame:
    """One row per experiment group from the trial summaries ``<prefix>_*``.

    Extremes, weighted mean, variation coefficient, combined variance and, with ``modes``, the
    extreme modes. ``carry`` adds further aggregates of the trial rows. Best, worst and average
    trials are the rows of ``trial_ranking``.
    """
    stats = [
        *extremes(prefix),
        weighted_mean(prefix).alias(f"{prefix}_weighted_avg"),
        variation_coefficient(prefix).alias(f"{prefix}_variation_coefficient"),
        combined_variance(prefix).alias(f"{prefix}_combined_variance"),
        *(mode_extremes(prefix) if modes else []),
        *carry,
    ]
    return trials.groupBy(*keys).agg(*stats)
