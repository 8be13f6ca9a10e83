"""Ranked value frequencies: the shared physical plan of every order statistic.

Percentiles, modes, trimmed samples and medians all need to know where a value
stands inside its group. A window over the whole group would put the group in one
task, and a group may hold a third of all rows. The plan here never does that:

1. *Frequencies.* Readings are counted per (group, value). The count is combined on
   the map side, so a value that repeats a billion times is one row after it, and the
   shuffle hashes group and value together, which spreads a large group over all tasks.
2. *Slices.* A hash of the group and value picks about one value in ``step`` as a splitter,
   and the splitters cut each group into value ranges. ``step`` grows with the input so
   that about ``MAX_SPLITTERS`` exist in total whatever the data is: that bound is what
   makes the broadcast safe. A group too small to own a splitter stays whole.
   Splitters depend on the values only, so a recomputed task cuts at the same places.
3. *Ranks.* Running counts are taken inside a slice; for the groups that are cut, a small
   directory with one row per slice supplies the count of everything before it.

No row is dropped anywhere: splitters only decide which task does the counting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the label of a grand total.
TOTAL = "all"
# Expected number of splitters over all groups together (the broadcast bound).
MAX_SPLITTERS = 1 << 14
# A slice holds about this many distinct values, or more once the bound above is met.
SLICE_ROWS = 1 << 18
# Window key of a slice. ``big`` follows from the group; naming it lets a filter on it pass
# the window, so that plans for cut groups touch nothing else.
SLICE = "g, slice, big"
# Binary search steps: enough for twice the expected number of splitters.
_STEPS = [1 << k for k in range(15, -1, -1)]


def pack(keys: Sequence[str]) -> str:
    """Group keys as one struct, so that a null key equals itself in joins as in groupBy."""
    return f"struct({', '.join(keys)}) AS g"


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where a null key equals a null key, with the keys of ``left`` kept once."""
    packed = f"struct({', '.join(keys)}) AS joined_on"
    other = right.selectExpr(packed, *[c for c in right.columns if c not in keys])
    return left.selectExpr("*", packed).join(other, "joined_on", how).drop("joined_on")


def frequencies(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    order: Column | None = None,
    total_of: Sequence[str] = (),
) -> DataFrame:
    """Count readings per (group, value), in the type of the value: whole numbers stay exact.

    ``cnt`` counts the readings; a null value is kept as one row with ``cnt = 0`` so that a
    group without any reading is still there. With ``order`` (one number or timestamp, so
    that the aggregation stays hash based), ``first_at`` and ``last_at`` are the ends of the
    value in that order. With ``total_of`` (the keys that a grand total runs over) each
    reading is also counted in the group where those keys read ``all``. That label is
    reserved: a real group of the same name is part of the total and of nothing else.
    """
    measure = F.col(value) if isinstance(value, str) else value
    columns = [*keys, measure.alias("v")]
    # The measure is a grouping column too, so the counts look at a second copy of it.
    counted = [F.expr("count(x) AS cnt")]
    kept = ["cnt"]
    if order is not None:
        columns.append(order.alias("at"))
        counted += [
            F.expr("min(at) FILTER (WHERE x IS NOT NULL) AS first_at"),
            F.expr("max(at) FILTER (WHERE x IS NOT NULL) AS last_at"),
        ]
        kept += ["first_at", "last_at"]
    source = df.select(*columns).selectExpr("*", "v AS x")

    if not total_of:
        return source.groupBy(F.expr(pack(keys)), "v").agg(*counted).select("g", "v", *kept)

    labels = list(total_of)
    outer = [k for k in keys if k not in labels]
    own = source.groupBy(*keys, "v").agg(*counted)
    # The total is counted from the frequencies, not from the readings. Both parts read all of their columns,
    # and the filter looks at a count, so that they share one shuffle.
    everywhere = own.where(_whole(kept))
    again = [F.expr("sum(cnt) AS cnt")]
    again += [F.expr(f"{fn}({c}) AS {c}") for fn, c in (("min", "first_at"), ("max", "last_at")) if c in kept]
    total = everywhere.groupBy(*outer, "v").agg(*again)
    named = ", ".join(f"'{k}', {f"'{TOTAL}'" if k in labels else k}" for k in keys)
    is_reserved = " AND ".join(f"{label} <=> '{TOTAL}'" for label in labels)
    groups = own.where(f"IF(cnt >= 0, NOT ({is_reserved}), false)").selectExpr(pack(keys), "v", *kept)
    return groups.unionByName(total.selectExpr(f"named_struct({named}) AS g", "v", *kept))


def _whole(columns: Sequence[str]) -> str:
    """True for every row of frequencies; it reads all that is counted, so that uses of one table share a shuffle."""
    return "cnt >= 0" + (" AND coalesce(first_at <= last_at, true)" if "first_at" in columns else "")


# The hash that picks splitters follows from the group and the value; naming a count in it keeps a filter
# on it behind the shuffle without shuffling the hash.
_PICK = "xxhash64(g, v, cnt < 0)"


def total_or(label: str) -> str:
    """The key of a grouping-sets row, or the label of the total."""
    return f"CASE WHEN is_total = 1 THEN '{TOTAL}' ELSE {label} END"


def keep_total_label(labels: Sequence[str]) -> str:
    """True for the total row and for every group not named like it."""
    return "is_total = 1 OR NOT (" + " AND ".join(f"{label} <=> '{TOTAL}'" for label in labels) + ")"


def _splitters(freq: DataFrame, slice_rows: int) -> DataFrame:
    """About one value in ``step`` per group, sorted: at most ``MAX_SPLITTERS`` expected.

    The count of the values and the choice read every column of ``freq``, so that they and the
    rows themselves come from one shuffle of one scan.
    """
    whole = _whole(freq.columns)
    step = freq.select(F.expr(f"greatest({slice_rows}L, ceil(count_if({whole}) * 2 / {MAX_SPLITTERS}))")).scalar()
    picked = freq.where(F.expr(whole) & (F.pmod(F.expr(_PICK), step) == 0))
    splitters = picked.groupBy("g").agg(F.expr("array_sort(collect_set(v)) AS splitters"))
    return splitters.where("size(splitters) > 0")


def _slice_of() -> str:
    """Number of splitters not above ``v``, by binary search."""
    steps = ", ".join(str(s) for s in _STEPS)
    fits = "pos + step <= size(splitters) AND get(splitters, pos + step - 1) <= v"
    search = f"aggregate(array({steps}), 0, (pos, step) -> IF({fits}, pos + step, pos))"
    return f"coalesce(IF(splitters IS NULL, 0, {search}), 0)"


def sliced(freq: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``slice``, the value range inside its group that a frequency row belongs to, and
    ``big``, whether the group is cut at all."""
    cut = _splitters(freq, slice_rows)
    return freq.join(F.broadcast(cut), "g", "left").selectExpr(
        *freq.columns, f"{_slice_of()} AS slice", "splitters IS NOT NULL AS big"
    )


# Name of a total: a mergeable aggregate (sum, min, max) and its argument.
Totals = Mapping[str, tuple[str, str]]


def with_totals(rows: DataFrame, totals: Totals, before: Totals | None = None) -> DataFrame:
    """Attach totals of the group ``g`` to sliced rows without gathering a group.

    ``totals`` runs over the group, ``before`` over the earlier slices of the group. A group
    in one slice gets them from a window over the slice. For the groups that are cut,
    slices are reduced to one row each and combined over the group; at most
    ``MAX_SPLITTERS`` groups and twice as many slices are expected, so that table is
    broadcast.
    """
    before = before or {}
    parts = [F.expr(f"{fn}({arg}) AS {name}") for name, (fn, arg) in {**totals, **before}.items()]
    group = "OVER (PARTITION BY g)"
    earlier = "OVER (PARTITION BY g ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    directory = rows.where("big").groupBy("g", "slice").agg(*parts).selectExpr(
        "g",
        "slice",
        *[f"{fn}({name}) {group} AS big_{name}" for name, (fn, _) in totals.items()],
        *[f"{fn}({name}) {earlier} AS {name}" for name, (fn, _) in before.items()],
    )
    one = f"OVER (PARTITION BY {SLICE})"
    local = rows.selectExpr("*", *[f"{fn}({arg}) {one} AS own_{name}" for name, (fn, arg) in totals.items()])
    return local.join(F.broadcast(directory), ["g", "slice"], "left").selectExpr(
        *rows.columns,
        *[f"IF(big, big_{name}, own_{name}) AS {name}" for name in totals],
        *before,
    )


def rank(freq: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per (group, value) of ``frequencies`` with its rank and the totals of its group.

    Columns: ``g`` (keys as a struct), ``slice``, ``big``, ``v``, ``cnt``, ``below``
    (readings of the group before this value), ``n``, ``mean``, ``max_cnt``, ``n_values``
    and, if the frequencies have an order, ``is_first`` / ``is_last`` (the value was read first /
    last; when several values were, all are marked).
    """
    totals = {
        "n": ("sum", "cnt"),
        "total": ("sum", "CAST(v AS double) * cnt"),
        "max_cnt": ("max", "cnt"),
        "n_values": ("sum", "IF(v IS NULL, 0, 1)"),
    }
    ends = []
    if "first_at" in freq.columns:
        totals |= {"g_first": ("min", "first_at"), "g_last": ("max", "last_at")}
        ends = ["first_at = g_first AS is_first", "last_at = g_last AS is_last"]
    running = f"sum(cnt) OVER (PARTITION BY {SLICE} ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rows = with_totals(sliced(freq, slice_rows).selectExpr("*", f"{running} AS inside"), totals, {"base": ("sum", "cnt")})
    return rows.selectExpr(
        "g", "slice", "big", "v", "cnt", "coalesce(inside, 0) + coalesce(base, 0) AS below", "n",
        "total / nullif(n, 0) AS mean", "max_cnt", "n_values", *ends,
    )


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    order: Column | None = None,
    total_of: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``rank`` of the frequencies of ``value`` per ``keys``."""
    return rank(frequencies(df, keys, value, order, total_of), slice_rows)


def with_part_totals(rows: DataFrame, partial: Sequence[str], total: Mapping[str, str]) -> DataFrame:
    """Attach statistics of the group ``g`` to rows that are spread over hashed parts.

    ``partial`` reduces each (group, ``part``) to one row; ``total`` combines those few rows
    over ``w``, the window of the group; the result is joined back on (group, part), so a
    large group stays spread over its parts.
    """
    window = "(PARTITION BY g)"
    directory = rows.groupBy("g", "part").agg(*[F.expr(p) for p in partial]).selectExpr(
        "g", "part", *[f"{e.replace('OVER w', f'OVER {window}')} AS {name}" for name, e in total.items()]
    )
    return rows.join(directory, ["g", "part"])
