"""Distribution summary of a measure per group, with percentiles, modes and integral."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialstats.operators.ranking import SLICE_ROWS, frequencies, rank, with_part_totals

# Name of each reported quantile and its index in the percentile array.
QUANTILES = {"q1": 25, "q2": 50, "q3": 75, "p90": 90, "p95": 95, "p99": 99}

# The statistics of a summary, in reporting order.
SUMMARY = [
    "num_data_points", "min", "max", "mean", "variance", "sd",
    "q1", "q2", "q3", "p90", "p95", "p99", "me", "ci095_min", "ci095_max", "percentiles",
]
# The modes themselves are rows of their own, see ``mode_rows``.
MODES = ["mode_freq", "mode_min", "mode_max", "mode_ties"]


_IS_MODE = "(v IS NOT NULL AND cnt = max_cnt)"


def _percentile_hits() -> list[str]:
    """How many of the 101 percentiles start (``lo``) and end (``hi``) at this value.

    Percentile p of n readings lies between the readings with 0-based rank
    floor((n-1)p/100) and ceil((n-1)p/100). Ranks grow with p, so the percentiles that
    start at one value are consecutive and their number is a difference of two bounds.
    """
    last = "greatest(n - 1, 1)"

    def first_p_from(rank: str) -> str:
        # Smallest p whose lower rank is at least ``rank``.
        return f"least(101, (100 * ({rank}) + {last} - 1) div {last})"

    def last_p_to(rank: str) -> str:
        # Largest p whose upper rank is at most ``rank``.
        return f"IF({rank} < 0, -1, least(100, 100 * ({rank}) div {last}))"

    lo = f"IF(n = 1, 101, {first_p_from('below + cnt')} - {first_p_from('below')})"
    hi = f"IF(n = 1, 101, {last_p_to('below + cnt - 1')} - {last_p_to('below - 1')})"
    return [f"CAST({lo} AS INT) AS lo", f"CAST({hi} AS INT) AS hi"]


def _curve() -> str:
    """The 101 linearly interpolated percentiles from the ``hits``; null for an empty group."""
    lower = "flatten(transform(array_sort(hits), h -> array_repeat(h.v, h.lo)))"
    upper = "flatten(transform(array_sort(hits), h -> array_repeat(h.v, h.hi)))"
    share = "(((num_data_points - 1) * p) % 100) / 100"
    return (
        f"IF(num_data_points > 0, transform("
        f"zip_with({lower}, {upper}, (a, b) -> named_struct('a', a, 'b', b)), (e, p) -> e.a + (e.b - e.a) * {share}), NULL)"
    )


def summarise(rows: DataFrame, modes: bool = False, integral: bool = False) -> DataFrame:
    """Reduce ``ranked`` rows to one summary row per group (``g`` plus the statistics)."""
    extra = _percentile_hits()
    # At most two hits per percentile, so the list is short whatever the group holds; values sort as ranks do.
    aggs = [
        "max(n) AS num_data_points", "CAST(min(v) AS double) AS min", "CAST(max(v) AS double) AS max", "max(mean) AS mean",
        "sum(cnt * (v - mean) * (v - mean)) AS m2",
        "collect_list(struct(CAST(v AS double) AS v, lo, hi)) FILTER (WHERE v IS NOT NULL AND (lo > 0 OR hi > 0)) AS hits",
    ]
    if modes:
        aggs += [
            "nullif(max(max_cnt), 0) AS mode_freq",
            f"CAST(min(v) FILTER (WHERE {_IS_MODE}) AS double) AS mode_min",
            f"CAST(max(v) FILTER (WHERE {_IS_MODE}) AS double) AS mode_max",
            f"count_if({_IS_MODE}) AS mode_ties",
        ]
    if integral:
        aggs += [
            "CAST(min(v) FILTER (WHERE is_first) AS double) AS first_value",
            "CAST(max(v) FILTER (WHERE is_last) AS double) AS last_value",
        ]
    out = rows.selectExpr("*", *extra).groupBy("g").agg(*[F.expr(a) for a in aggs])
    out = out.selectExpr(
        "*",
        "m2 / nullif(num_data_points, 0) AS variance",
        "sqrt(m2 / nullif(num_data_points, 0)) AS sd",
        "2 * sqrt(m2 / nullif(num_data_points, 0)) / sqrt(nullif(num_data_points, 0)) AS me",
        f"{_curve()} AS percentiles",
    )
    derived = {
        **{name: f"get(percentiles, {p})" for name, p in QUANTILES.items()},
        "ci095_min": "mean - me",
        "ci095_max": "mean + me",
        # Trapezoids of unit width: every reading once, the two end readings half.
        "integral": "mean * num_data_points - (first_value + last_value) / 2",
    }
    return out.selectExpr("g", *[f"{derived.get(c, c)} AS {c}" for c in _names(modes, integral)])


def describe(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    order: Column | None = None,
    modes: bool = False,
    total_of: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Summary of ``value`` per ``keys``: one row per group that occurs in ``df``.

    Null values are skipped; a group without values has ``num_data_points = 0`` and nulls.
    Variance is the population variance, ``me`` is twice the standard error, percentiles
    interpolate linearly. With ``order`` the trapezoid ``integral`` over the readings in
    that order is added; readings at the same earliest (latest) instant count as starting
    (ending) with the smallest (largest) value. ``modes`` adds the number, the ends and the
    frequency of the most frequent values; ``mode_rows`` has them all.
    ``total_of`` adds a row over those keys, labelled ``all``.
    """
    return summary_of(frequencies(df, keys, value, order, total_of), modes, slice_rows)


def summary_of(freq: DataFrame, modes: bool = False, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The summary of ``describe`` from ``frequencies``, which ``modes_of`` can share once they are settled."""
    integral = "first_at" in freq.columns
    return summarise(rank(freq, slice_rows), modes, integral).select("g.*", *_names(modes, integral))


def _names(modes: bool, integral: bool) -> list[str]:
    return SUMMARY + (MODES if modes else []) + (["integral"] if integral else [])


def long_measures(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Several measures as rows ``(keys, measure_no, x)``, from one scan."""
    cells = F.array(*[F.col(m).cast("double") for m in measures])
    return df.select(*keys, F.posexplode(cells).alias("measure_no", "x"))


def describe_measures(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    prefixes: Sequence[str],
    modes: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Summaries of several measures side by side, from one scan and one plan."""
    return measures_of(measure_frequencies(df, keys, measures), keys, prefixes, modes, slice_rows)


def measure_frequencies(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``frequencies`` of several measures, each under its number, from one scan."""
    return frequencies(long_measures(df, keys, measures), [*keys, "measure_no"], "x")


def measures_of(
    freq: DataFrame, keys: Sequence[str], prefixes: Sequence[str], modes: bool = False, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The summaries of ``describe_measures`` from ``measure_frequencies``."""
    stats = summary_of(freq, modes, slice_rows)
    wide = [
        F.expr(f"max_by({s}, 1) FILTER (WHERE measure_no = {i}) AS {prefix}_{s}")
        for i, prefix in enumerate(prefixes)
        for s in _names(modes, False)
    ]
    return stats.groupBy(*keys).agg(*wide)


def percentile_curve(
    df: DataFrame, keys: Sequence[str], value: str | Column, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The percentiles as rows ``(keys, percentile, value)``."""
    stats = describe(df, keys, value, slice_rows=slice_rows).where(F.col("num_data_points") > 0)
    return stats.select(*keys, F.posexplode("percentiles").alias("percentile", "value"))


def mode_rows(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    total_of: Sequence[str] = (),
) -> DataFrame:
    """Every most frequent value of each group as a row ``(keys, mode, mode_freq)``.

    Frequencies are joined to the largest one of their group over value-hashed parts of the
    group, so a group in which every value ties is never gathered.
    """
    return modes_of(frequencies(df, keys, value, total_of=total_of))


def modes_of(freq: DataFrame) -> DataFrame:
    """The rows of ``mode_rows`` from ``frequencies``."""
    present = freq.where(F.col("v").isNotNull()).withColumn("part", F.expr("pmod(xxhash64(v), 256)"))
    rows = with_part_totals(present, ["max(cnt) AS part_max"], {"max_cnt": "max(part_max) OVER w"})
    return rows.where(_IS_MODE).selectExpr("g.*", "v AS mode", "cnt AS mode_freq")


def prefixed(stats: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Rename the statistics of a summary to ``<prefix>_<statistic>``."""
    return stats.selectExpr(*keys, *[f"{c} AS {prefix}_{c}" for c in stats.columns if c not in keys])
