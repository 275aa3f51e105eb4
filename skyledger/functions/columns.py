"""Scalar and aggregate column expressions built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def none_if_empty(column: Column) -> Column:
    """Empty text becomes null (a quoted empty CSV field is read as empty text)."""
    return F.nullif(F.trim(column), F.lit(""))


def to_number(column: Column, kind: str) -> Column:
    """Parse text to ``int``, ``double`` or ``date``; dirty text becomes null."""
    return none_if_empty(column).try_cast(kind)


def to_time(column: Column) -> Column:
    """Parse an ``HHMM`` time; what is no time from 0000 to 2400 becomes null."""
    time = to_number(column, "double").cast("int")
    return F.when(time.between(0, 2400) & (time % 100 < 60), time)


def is_zero(flag: Column) -> Column:
    """True for a numeric 0 flag; null stays null, so a filter drops it."""
    return flag == F.lit(0)


def hhmm_text(column: Column) -> Column:
    """An ``HHMM`` integer as text of four digits, or more if it has more."""
    text = column.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(4)), F.lit("0"))


def fixed2(column: Column) -> Column:
    """A number with two decimals, as the files and messages print it."""
    return column.cast("decimal(18,2)").cast("string")


def delimited(*columns: Column, sep: str = ",") -> Column:
    """Join fields with a separator and keep empty places for nulls."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def flight_label(carrier: Column, flight_num: Column) -> Column:
    """``"carrier flight"``, the way a trip names its flights."""
    return F.concat_ws(" ", carrier, flight_num)


def departure_minutes() -> Column:
    """Departure delay minutes for airport rankings.

    A flight with neither delay recorded counts as 0; one with only the arrival side
    recorded stays null and is rejected by the ranking.
    """
    nothing_recorded = F.col("dep_delay_minutes").isNull() & F.col("arr_delay_minutes").isNull()
    return F.when(nothing_recorded, F.lit(0.0)).otherwise(F.col("dep_delay_minutes"))


def arrival_minutes_or_zero() -> Column:
    """Arrival delay minutes for trips, 0 where none is recorded."""
    return F.coalesce(F.col("arr_delay_minutes"), F.lit(0.0))


def ontime_pct(flag: str) -> Column:
    """Share of flights whose late flag is 0, in percent, over flights that have the flag.

    Written with double literals: a decimal 100.0 would change the result type and digits.
    """
    on_time = F.count_if(is_zero(F.col(flag))).cast("double")
    known = F.nullif(F.count(flag), F.lit(0)).cast("double")
    return on_time * F.lit(100.0) / known


def result_line(pattern: str, *columns: str | Column) -> Column:
    """printf-style report line, e.g. ``"%s - %s - %f"``."""
    return F.format_string(pattern, *columns)
