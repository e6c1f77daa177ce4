"""Casts from landed strings to staging types.

A value that does not parse becomes NULL and is counted by
``operators.checks.cast_losses``; a strict cast would abort the whole load.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(column: Column, width: str = "bigint") -> Column:
    """Integer from text; fractions round half up (``'1.6'`` is 2)."""
    return column.try_cast("decimal(38,0)").try_cast(width)


def money(column: Column) -> Column:
    return column.try_cast("decimal(10,4)")


def flag(column: Column) -> Column:
    return column.try_cast("boolean")


def wall_time(column: Column) -> Column:
    """Timestamp without zone; an offset in the text is dropped, not applied."""
    return column.try_cast("timestamp_ntz")


def as_text(column: Column) -> Column:
    return column


CASTS = {
    "long": whole_number,
    "int": lambda column: whole_number(column, "int"),
    "money": money,
    "bool": flag,
    "time": wall_time,
    "text": as_text,
}


def cast_as(name: str, kind: str) -> Column:
    return CASTS[kind](F.col(name)).alias(name)
