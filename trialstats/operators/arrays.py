"""Statistics per position of an array column (one position per CPU core)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialstats.operators.describe import describe
from trialstats.operators.ranking import SLICE_ROWS
from trialstats.operators.rollup import combined_variance, extremes, weighted_mean

# Statistics kept per core on both levels.
TRIAL_CORE = [
    "mean", "integral", "min", "max", "sd", "variance", "q1", "q2", "q3",
    "p90", "p95", "p99", "me", "ci095_min", "ci095_max",
]
ROLLED_CORE = ["mean", "min", "max", "variance", "q1", "q2", "q3", "p90", "p95", "p99"]


def describe_cores(
    df: DataFrame,
    keys: Sequence[str],
    array: str,
    order: Column | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Summary per ``keys`` and ``core`` (0-based position); null arrays are skipped.

    Every reading has a cell for each core, and all cells are shuffled. They carry two hashes of
    their keys (128 bits together) instead of the keys themselves, which one small aggregation of
    the readings gives back at the end.
    """
    at = [order.alias("at")] if order is not None else []
    present = df.where(F.col(array).isNotNull())
    coded = present.select(*keys, *[F.expr(f"{e} AS {n}") for n, e in _codes(keys).items()], *at, F.col(array).alias("cells"))
    cells = coded.select(*CODES, *["at" for _ in at], F.posexplode("cells").alias("core", "usage"))
    stats = describe(cells, [*CODES, "core"], "usage", F.col("at") if at else None, slice_rows=slice_rows)
    names = coded.groupBy(*CODES).agg(F.min(F.struct(*keys)).alias("named"))
    return stats.join(names, CODES).select("named.*", *[c for c in stats.columns if c not in CODES])


# Columns that stand for the keys of a reading.
CODES = ["code_a", "code_b"]


def _codes(keys: Sequence[str]) -> dict[str, str]:
    """Two independent hashes of the keys; a null part counts as one, and not as if it weren't there."""
    parts = ", ".join(f"{k} IS NULL, {k}" for k in keys)
    return {name: f"xxhash64({seed}, {parts})" for seed, name in enumerate(CODES)}


def assemble_cores(
    cores: DataFrame, keys: Sequence[str], names: dict[str, str], width: str | None = None
) -> DataFrame:
    """One row per ``keys`` with an array per statistic, in core order.

    ``names`` maps source to result columns. ``width`` (a column constant per group) pads
    the arrays with nulls or cuts them, so that they have one entry per core of the host.
    """
    cells = f"array_sort(collect_list(struct({', '.join(['core', *names])}))) AS cells"
    size = [] if width is None else [F.expr(f"max({width}) AS width")]
    grouped = cores.groupBy(*keys).agg(F.expr(cells), *size)

    def column(source: str) -> str:
        values = f"transform(cells, cell -> cell.{source})"
        if width is None:
            return values
        padded = f"concat({values}, array_repeat(CAST(NULL AS double), width))"
        return f"IF(width IS NULL, {values}, slice({padded}, 1, width))"

    return grouped.selectExpr(*keys, *[f"{column(s)} AS {t}" for s, t in names.items()])


def explode_cores(trials: DataFrame, keep: Sequence[str], prefix: str) -> DataFrame:
    """Trial rows with one array per statistic as rows per ``core``."""
    zipped = ", ".join(f"{prefix}_{s}" for s in ROLLED_CORE)
    cells = trials.selectExpr(*keep, f"posexplode(arrays_zip({zipped})) AS (core, cell)")
    return cells.select(*keep, "core", "cell.*")


def rollup_cores(trials: DataFrame, keys: Sequence[str], prefix: str, carry: Sequence[str] = ()) -> DataFrame:
    """Experiment statistics per ``keys`` and ``core`` from trial rows that hold arrays.

    The weighted mean is null as soon as one trial has no mean for the core.
    """
    cells = explode_cores(trials, [*keys, "trial_id", f"{prefix}_num_data_points", *carry], prefix)
    complete = F.expr(f"count({prefix}_mean) = count(1)")
    return cells.groupBy(*keys, "core").agg(
        *extremes(prefix),
        F.when(complete, weighted_mean(prefix)).alias(f"{prefix}_weighted_avg"),
        F.when(complete, combined_variance(prefix)).alias(f"{prefix}_combined_variance"),
        *[F.min(c).alias(c) for c in carry],
    )
