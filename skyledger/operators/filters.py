"""Row filters, defaults, projections and the load audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import delimited, fixed2, hhmm_text, is_zero
from skyledger.schema import FLIGHT13, FLIGHT14


def not_cancelled(flights: DataFrame) -> DataFrame:
    """Flights that flew, diverted ones included; an unknown flag drops the row."""
    return flights.filter(is_zero(F.col("cancelled")))


def clean(flights: DataFrame) -> DataFrame:
    """Flights neither cancelled nor diverted; an unknown flag drops the row."""
    return flights.filter(_is_clean())


def _is_clean() -> Column:
    return is_zero(F.col("cancelled")) & is_zero(F.col("diverted"))


def on_dates(flights: DataFrame, dates: Iterable[dt.date | str]) -> DataFrame:
    """Flights on any of the listed dates."""
    return flights.filter(F.col("flight_date").isin([_as_date(d) for d in dates]))


def in_years(table: DataFrame, years: Iterable[int]) -> DataFrame:
    """Rows of the listed years; on a table partitioned by ``year`` this prunes directories."""
    return table.filter(F.col("year").isin(list(years)))


def with_values(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every listed column has a value.

    One ``IS NOT NULL`` per column, unlike ``dropna``, can be pushed into the file scan.
    """
    for column in columns:
        rows = rows.filter(F.col(column).isNotNull())
    return rows


def default_tail(flights: DataFrame) -> DataFrame:
    """Use the flight number where no tail number is known."""
    return flights.withColumn("tail_num", F.coalesce("tail_num", "flight_num"))


def layout13(flights: DataFrame) -> DataFrame:
    """The 13 columns of the batch extract, tail number defaulted."""
    return default_tail(flights).select(*FLIGHT13.fieldNames())


def layout14(flights: DataFrame) -> DataFrame:
    """The 14 columns of the stream message."""
    return flights.select(*FLIGHT14.fieldNames())


# Columns printed as four-digit times and as two-decimal numbers.
_TIMES = ("dep_time", "arr_time")
_NUMBERS = (
    "dep_delay", "dep_delay_minutes", "dep_del15", "arr_delay", "arr_delay_minutes", "arr_del15",
)


def _as_text(name: str) -> Column:
    column = F.col(name)
    if name in _TIMES:
        return hhmm_text(column)
    if name in _NUMBERS:
        return fixed2(column)
    return column.cast("string")


def text_fields(flights: DataFrame) -> DataFrame:
    """Every column rendered the way the text layouts print it, for CSV output."""
    return flights.select(*[_as_text(name).alias(name) for name in flights.columns])


def message_value(flights: DataFrame) -> DataFrame:
    """One 14-field text line per flight in column ``value``."""
    fields = [_as_text(name) for name in FLIGHT14.fieldNames()]
    return flights.select(delimited(*fields).alias("value"))


def audit(flights: DataFrame, *more: Column) -> DataFrame:
    """One row: clean rows, rows whose flags could not be read, all rows, and what ``more`` counts."""
    unknown = F.col("cancelled").isNull() | F.col("diverted").isNull()
    return flights.agg(
        F.count_if(_is_clean()).alias("good_lines"),
        F.count_if(unknown).alias("unknown_lines"),
        F.count(F.lit(1)).alias("all_lines"),
        *more,
    )


def bad_times() -> Column:
    """For the audit: clean rows whose departure time is missing or is no time of day."""
    return F.count_if(_is_clean() & F.col("dep_time").isNull()).alias("bad_times")


def _as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
