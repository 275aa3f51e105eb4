"""Queries on flights with missing values, and flights written as text and read back.

The ``gaps`` view blanks columns of the flight view where a time of day leaves a given remainder, so
every rule about missing values meets rows, over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import filters, metrics, trips
from skyledger.plans.batch import Query
from skyledger.schema import RAW_COLUMNS, RAW_TO_FLIGHT
from skyledger.session import scratch_dir
from skyledger.sources import extract, raw
from skyledger.sources.driver_tables import flights

# Column -> (time of day, divisor, remainder) where it is missing.
GAPS = {
    "carrier": ("dep_time", 7, 3),
    "origin": ("dep_time", 11, 4),
    "dest": ("arr_time", 13, 5),
    "flight_date": ("arr_time", 29, 11),
    "dep_delay_minutes": ("dep_time", 5, 1),
    "arr_delay_minutes": ("arr_time", 3, 1),
    "arr_delay": ("arr_time", 3, 1),
    "arr_del15": ("dep_time", 9, 2),
    "dep_del15": ("dep_time", 9, 5),
    "cancelled": ("arr_time", 19, 4),
    "diverted": ("arr_time", 23, 6),
}


#: Lines of a compressed raw file at most; a real month has half a million.
LINES_PER_FILE = 500_000


def with_gaps(rows: DataFrame) -> DataFrame:
    def gap(name: str):
        time, divisor, remainder = GAPS[name]
        return F.when(F.col(time) % divisor != remainder, F.col(name)).alias(name)

    return rows.select(*[gap(c) if c in GAPS else F.col(c) for c in rows.columns])


def _on_gaps(report, kept=filters.clean) -> Query:
    return lambda spark, sf_dir: report(kept(with_gaps(flights(spark, sf_dir))))


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


# A state between names of a city and its country holds a comma and quotes, as real files do.
_CITY = '"Sea ""Port"", X"'


def _raw_line(rows: DataFrame) -> DataFrame:
    """Flights as lines of the 55 raw columns, text quoted, with a city name that needs quotes."""
    fields = {name: F.coalesce(F.col(alias).cast("string"), F.lit("")) for name, alias, _ in RAW_TO_FLIGHT}
    for name in ("UniqueCarrier", "Origin", "Dest", "TailNum"):
        fields[name] = F.concat(F.lit('"'), fields[name], F.lit('"'))
    fields |= {"OriginCityName": F.lit(_CITY), "DestCityName": F.lit(_CITY), "Year": F.year("flight_date").cast("string")}
    return rows.select(F.concat_ws(",", *[fields.get(name, F.lit("")) for name in RAW_COLUMNS]).alias("value"))


def _with_odd_lines(lines: DataFrame) -> DataFrame:
    """Beside every line in 50 a copy cut short and a header line, which readers must reject."""
    value = F.col("value")
    odd = F.array(value, F.substring_index(value, ",", 12), F.lit(",".join(RAW_COLUMNS)))
    some = F.pmod(F.xxhash64(value), F.lit(50)) == 0
    # In one pass, so that odd lines lie in the files of the lines that they stand beside.
    return lines.select(F.explode(F.when(some, odd).otherwise(F.array(value))).alias("value"))


def headerless_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines without a header, some short and some header lines, read by position."""
    path = scratch_dir(spark, "headerless")
    _with_odd_lines(_raw_line(flights(spark, sf_dir))).write.text(path)
    return filters.layout14(filters.clean(raw.read_flights(spark, path, header=False)))


def raw_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with a header each, compressed, read by name."""
    path = scratch_dir(spark, "raw")
    fields = {name: F.col(alias).cast("string").alias(name) for name, alias, _ in RAW_TO_FLIGHT}
    fields |= {"OriginCityName": F.lit('Sea "Port", X').alias("OriginCityName")}
    rows = flights(spark, sf_dir).select(*[fields.get(name, F.lit("").alias(name)) for name in RAW_COLUMNS])
    # A compressed file is read by one task, so its lines are limited.
    files = rows.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
    files.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return filters.layout14(filters.clean(raw.read_flights(spark, path)))


def extract_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13-field text of flights with gaps, read back."""
    path = scratch_dir(spark, "extract")
    extract.write_layout(filters.clean(with_gaps(flights(spark, sf_dir))), path, 13)
    return extract.read_extract(spark, path, 13)


QUERIES: dict[str, Query] = {
    "gaps_audit": _on_gaps(filters.audit, _as_is),
    "gaps_airport_counts": _on_gaps(metrics.airport_counts),
    "gaps_carrier_ontime_pct": _on_gaps(metrics.carrier_ontime),
    "gaps_carrier_total_delay": _on_gaps(metrics.carrier_total_delay),
    "gaps_airport_carrier_mean_delay": _on_gaps(metrics.airport_carrier_mean_delay),
    "gaps_airport_dest_mean_delay": _on_gaps(metrics.airport_dest_mean_delay),
    "gaps_airport_dest_ontime_pct": _on_gaps(metrics.airport_dest_ontime),
    "gaps_route_mean_delay": _on_gaps(metrics.route_mean_delay),
    "gaps_best_trips": _on_gaps(trips.best_trips),
    "raw_round_trip": raw_round_trip,
    "headerless_round_trip": headerless_round_trip,
    "extract_round_trip": extract_round_trip,
}
