"""Time expressions.  Instants are handled as integer microseconds so that differences are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros(col: str | Column) -> Column:
    """Epoch microseconds of a timestamp (also of one without time zone, read as session time)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def seconds(delta_us: Column) -> Column:
    return delta_us / F.lit(float(MICROS))


def hour_partition(col: str | Column, parts: int = 24) -> Column:
    """Which of ``parts`` equal portions of the day an instant falls in, as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(F.hour(c.cast("timestamp")) / F.lit(24.0 / parts)).cast("double")


def floor_div(a: Column, b: Column) -> Column:
    """Integer quotient rounded down; ``b`` must be positive."""
    return F.call_function("div", a - F.pmod(a, b), b)


def ceil_div(a: Column, b: Column) -> Column:
    """Integer quotient rounded up; ``b`` must be positive."""
    return -floor_div(-a, b)
