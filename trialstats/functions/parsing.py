"""Column expressions that read the text fields of monitoring tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit letters of a memory size and their power of 1024.
UNIT_POWERS = {"k": 1, "m": 2, "g": 3, "t": 4}


def byte_size(text: Column) -> Column:
    """Bytes of a memory size such as ``2g``, ``512 mb`` or ``2099945472``.

    Units are powers of 1024, in either case and with or without a trailing ``b``. Text
    that is not a size (including a negative number), or one beyond a bigint, is null.
    """
    compact = F.lower(F.replace(text, F.lit(" "), F.lit("")))
    number = F.regexp_extract(compact, r"^(\d+)([kmgt]?)b?$", 1).try_cast("long")
    unit = F.regexp_extract(compact, r"^(\d+)([kmgt]?)b?$", 2)
    factor = F.lit(1).cast("long")
    for letter, power in UNIT_POWERS.items():
        factor = F.when(unit == letter, F.lit(1024**power)).otherwise(factor)
    return F.try_multiply(number, factor)


def cpu_set_size(text: Column) -> Column:
    """Number of cores in a CPU set such as ``0-3,7`` (here 5); null for no set."""
    def width(part: Column) -> Column:
        bounds = F.split(part, "-")
        span = F.get(bounds, 1).try_cast("int") - F.get(bounds, 0).try_cast("int") + 1
        return F.when(F.size(bounds) == 2, span).otherwise(1)

    parts = F.split(text, ",")
    total = F.aggregate(parts, F.lit(0), lambda count, part: count + width(part))
    return F.when(F.trim(text) != "", total)


def reading_order(read_time: Column) -> Column:
    """Nanoseconds since the epoch of an ISO-8601 text time.

    Spark timestamps stop at microseconds; the last three digits come from the text.
    """
    text = read_time.cast("string")
    micros = F.unix_micros(F.try_to_timestamp(text))
    fraction = F.rpad(F.regexp_extract(text, r"\.(\d+)", 1), 9, "0")
    return micros * 1000 + F.substring(fraction, 7, 3).try_cast("long")
