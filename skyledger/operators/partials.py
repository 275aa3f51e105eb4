"""Mergeable partial results by month: counts and sums from which every metric of delays follows.

A month's partials are one row for each route and carrier, whatever the number of flights.  Replacing a month
replaces its partials; reports add up the partials of all months and read no flights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import departure_minutes, is_zero
from skyledger.operators.filters import in_years, with_values
from skyledger.operators.metrics import AIRPORT_CARRIER, AIRPORT_DEST

GRAIN = ("origin", "dest", "carrier")
#: Measures of which a sum and a count of known values are kept.
_MEASURES: dict[str, Callable[[], Column]] = {
    "dep_delay": lambda: F.col("dep_delay"),
    "dep_delay_minutes": lambda: F.col("dep_delay_minutes"),
    "departure_minutes": departure_minutes,
    "arr_delay": lambda: F.col("arr_delay"),
    "arr_delay_minutes": lambda: F.col("arr_delay_minutes"),
}
_FLAGS = ("dep_del15", "arr_del15")


def month_partials(flights: DataFrame) -> DataFrame:
    """Counts and sums by year, month, route and carrier; unknown codes are groups of their own."""
    by = flights.withColumns({"year": F.year("flight_date"), "month": F.month("flight_date")})
    sums = [
        part
        for name, measure in _MEASURES.items()
        for part in (F.sum(measure()).alias(f"{name}_sum"), F.count(measure()).alias(f"{name}_known"))
    ]
    flags = [
        part
        for name in _FLAGS
        for part in (F.count_if(is_zero(F.col(name))).alias(f"{name}_ontime"), F.count(name).alias(f"{name}_known"))
    ]
    return by.groupBy("year", "month", *GRAIN).agg(F.count(F.lit(1)).alias("flights"), *sums, *flags)


def write_partials(flights: DataFrame, path: str) -> None:
    """Write the partials of the months among the flights; those of other months stay."""
    (
        month_partials(flights)
        .hint("rebalance", F.col("year"), F.col("month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def read_partials(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """The partials of all months, or of those of some years."""
    rows = spark.read.parquet(path)
    return rows if years is None else in_years(rows, years)


def airport_counts(partials: DataFrame) -> DataFrame:
    ends = partials.select(F.explode(F.array("origin", "dest")).alias("airport"), "flights")
    return with_values(ends, "airport").groupBy("airport").agg(F.sum("flights").alias("flights"))


def mean(partials: DataFrame, keys: Iterable[str], measure: str) -> DataFrame:
    """Mean of the known values by key; keys without one are left out."""
    total, known = F.sum(f"{measure}_sum"), F.sum(f"{measure}_known")
    found = _by(partials, keys).agg((total / known.cast("double")).alias("mean_delay"), known.alias("known"))
    return found.filter("known > 0").drop("known")


def total(partials: DataFrame, keys: Iterable[str], measure: str) -> DataFrame:
    """Sum of the known values by key; keys without one are left out."""
    found = _by(partials, keys).agg(F.sum(f"{measure}_sum").alias("total_delay"))
    return with_values(found, "total_delay")


def ontime(partials: DataFrame, keys: Iterable[str], flag: str) -> DataFrame:
    """On-time share, with all flights and those without the flag beside it."""
    known, flights = F.sum(f"{flag}_known"), F.sum("flights")
    share = F.sum(f"{flag}_ontime").cast("double") * F.lit(100.0) / F.nullif(known, F.lit(0)).cast("double")
    return _by(partials, keys).agg(share.alias("ontime_pct"), flights.alias("flights"), (flights - known).alias("unknown"))


def _by(partials: DataFrame, keys: Iterable[str]):
    keys = tuple(keys)
    return with_values(partials, *keys).groupBy(*keys)


#: Each metric of flights, as merged from partials.
MERGED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "airport_counts": airport_counts,
    "carrier_mean_delay": lambda p: mean(p, ("carrier",), "dep_delay_minutes"),
    "carrier_total_delay": lambda p: total(p, ("carrier",), "arr_delay"),
    "carrier_ontime_pct": lambda p: ontime(p, ("carrier",), "arr_del15"),
    "airport_carrier_ontime_pct": lambda p: ontime(p, AIRPORT_CARRIER, "dep_del15"),
    "airport_dest_ontime_pct": lambda p: ontime(p, AIRPORT_DEST, "dep_del15"),
    "airport_carrier_mean_delay": lambda p: mean(p, AIRPORT_CARRIER, "departure_minutes"),
    "airport_dest_mean_delay": lambda p: mean(p, AIRPORT_DEST, "departure_minutes"),
    "airport_carrier_total_delay": lambda p: total(p, AIRPORT_CARRIER, "arr_delay_minutes"),
    "airport_dest_total_delay": lambda p: total(p, AIRPORT_DEST, "dep_delay"),
    "route_mean_delay": lambda p: mean(p, AIRPORT_DEST, "arr_delay_minutes"),
    "route_mean_signed_delay": lambda p: mean(p, AIRPORT_DEST, "arr_delay"),
}
