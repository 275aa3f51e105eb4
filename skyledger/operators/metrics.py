"""One definition per metric, used unchanged on batch and on streaming frames.

Every metric is a single ``groupBy`` over built-in aggregates, so Spark combines partial
results on the map side before its one shuffle and a heavily used key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import departure_minutes, ontime_pct
from skyledger.operators.filters import with_values

AIRPORT_CARRIER = ("origin", "carrier")
AIRPORT_DEST = ("origin", "dest")


def airport_counts(flights: DataFrame) -> DataFrame:
    """Departures plus arrivals per airport; an unknown end does not hide the other end."""
    ends = flights.select(F.explode(F.array("origin", "dest")).alias("airport"))
    return with_values(ends, "airport").groupBy("airport").agg(F.count(F.lit(1)).alias("flights"))


def carrier_mean_delay(flights: DataFrame) -> DataFrame:
    """Mean departure delay minutes per carrier."""
    known = with_values(flights, "carrier", "dep_delay_minutes")
    return known.groupBy("carrier").agg(F.avg("dep_delay_minutes").alias("mean_delay"))


def carrier_total_delay(flights: DataFrame) -> DataFrame:
    """Summed signed arrival delay per carrier."""
    known = with_values(flights, "carrier", "arr_delay")
    return known.groupBy("carrier").agg(F.sum("arr_delay").alias("total_delay"))


def carrier_ontime(flights: DataFrame) -> DataFrame:
    """On-time arrival percentage per carrier."""
    return _ontime(flights, ("carrier",), "arr_del15")


def airport_carrier_ontime(flights: DataFrame) -> DataFrame:
    """On-time departure percentage per airport and carrier."""
    return _ontime(flights, AIRPORT_CARRIER, "dep_del15")


def airport_dest_ontime(flights: DataFrame) -> DataFrame:
    """On-time departure percentage per airport and destination."""
    return _ontime(flights, AIRPORT_DEST, "dep_del15")


def airport_carrier_mean_delay(flights: DataFrame) -> DataFrame:
    """Mean departure delay minutes per airport and carrier."""
    return _mean_departure(flights, AIRPORT_CARRIER)


def airport_dest_mean_delay(flights: DataFrame) -> DataFrame:
    """Mean departure delay minutes per airport and destination."""
    return _mean_departure(flights, AIRPORT_DEST)


def airport_carrier_total_delay(flights: DataFrame) -> DataFrame:
    """Summed arrival delay minutes per airport and carrier."""
    known = with_values(flights, *AIRPORT_CARRIER, "arr_delay_minutes")
    return known.groupBy(*AIRPORT_CARRIER).agg(F.sum("arr_delay_minutes").alias("total_delay"))


def airport_dest_total_delay(flights: DataFrame) -> DataFrame:
    """Summed signed departure delay per airport and destination."""
    known = with_values(flights, *AIRPORT_DEST, "dep_delay")
    return known.groupBy(*AIRPORT_DEST).agg(F.sum("dep_delay").alias("total_delay"))


def route_mean_delay(flights: DataFrame) -> DataFrame:
    """Mean arrival delay minutes per route."""
    return _route_mean(flights, "arr_delay_minutes")


def route_mean_signed_delay(flights: DataFrame) -> DataFrame:
    """Mean signed arrival delay per route."""
    return _route_mean(flights, "arr_delay")


def word_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """Words between single spaces and how often each occurs."""
    words = texts.select(F.explode(F.split(column, " ")).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _ontime(flights: DataFrame, keys: tuple[str, ...], flag: str) -> DataFrame:
    """On-time share; flights without the flag stay out of it and are counted apart."""
    return with_values(flights, *keys).groupBy(*keys).agg(
        ontime_pct(flag).alias("ontime_pct"),
        F.count(F.lit(1)).alias("flights"),
        F.count_if(F.col(flag).isNull()).alias("unknown"),
    )


def _mean_departure(flights: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    measured = flights.select(*keys, departure_minutes().alias("minutes"))
    known = with_values(measured, *keys, "minutes")
    return known.groupBy(*keys).agg(F.avg("minutes").alias("mean_delay"))


def _route_mean(flights: DataFrame, measure: str) -> DataFrame:
    known = with_values(flights, *AIRPORT_DEST, measure)
    return known.groupBy(*AIRPORT_DEST).agg(F.avg(measure).alias("mean_delay"))
