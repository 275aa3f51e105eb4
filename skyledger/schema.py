"""Declared layouts: raw files, the 13- and 14-field records, and the result tables.

``FLIGHT`` is the working model every operator takes.  Times of day are ``HHMM``
integers in the model and four-digit text in the file and message layouts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(), "DATE": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    """A schema from ``"name TYPE, ..."``, usable before any session exists."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind.upper()]) for name, kind in pairs])


# Column order of the raw on-time files, in file order.
RAW_COLUMNS = (
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate", "UniqueCarrier",
    "AirlineID", "Carrier", "TailNum", "FlightNum", "Origin", "OriginCityName", "OriginState",
    "OriginStateFips", "OriginStateName", "OriginWac", "Dest", "DestCityName", "DestState",
    "DestStateFips", "DestStateName", "DestWac", "CRSDepTime", "DepTime", "DepDelay",
    "DepDelayMinutes", "DepDel15", "DepartureDelayGroups", "DepTimeBlk", "TaxiOut", "WheelsOff",
    "WheelsOn", "TaxiIn", "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "ArrivalDelayGroups", "ArrTimeBlk", "Cancelled", "CancellationCode", "Diverted",
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Flights", "Distance", "DistanceGroup",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
)

# Raw column -> model column and type.
RAW_TO_FLIGHT = (
    ("FlightDate", "flight_date", "date"),
    ("DayOfWeek", "day_of_week", "int"),
    ("UniqueCarrier", "carrier", "string"),
    ("FlightNum", "flight_num", "string"),
    ("TailNum", "tail_num", "string"),
    ("Origin", "origin", "string"),
    ("Dest", "dest", "string"),
    ("DepTime", "dep_time", "int"),
    ("ArrTime", "arr_time", "int"),
    ("DepDelay", "dep_delay", "double"),
    ("DepDelayMinutes", "dep_delay_minutes", "double"),
    ("DepDel15", "dep_del15", "double"),
    ("ArrDelay", "arr_delay", "double"),
    ("ArrDelayMinutes", "arr_delay_minutes", "double"),
    ("ArrDel15", "arr_del15", "double"),
    ("Cancelled", "cancelled", "double"),
    ("Diverted", "diverted", "double"),
)

FLIGHT = _struct(", ".join(f"{name} {kind}" for _, name, kind in RAW_TO_FLIGHT))

# Field order of the headerless batch extract.
FLIGHT13 = _struct(
    "flight_date DATE, day_of_week INT, tail_num STRING, flight_num STRING, dep_time STRING, "
    "arr_time STRING, carrier STRING, origin STRING, dest STRING, dep_delay DOUBLE, "
    "arr_delay DOUBLE, dep_delay_minutes DOUBLE, arr_delay_minutes DOUBLE"
)

# Field order of the stream message.
FLIGHT14 = _struct(
    "day_of_week INT, flight_date DATE, carrier STRING, flight_num STRING, origin STRING, "
    "dest STRING, dep_time STRING, dep_delay DOUBLE, dep_delay_minutes DOUBLE, dep_del15 DOUBLE, "
    "arr_time STRING, arr_delay DOUBLE, arr_delay_minutes DOUBLE, arr_del15 DOUBLE"
)


@dataclass(frozen=True)
class ResultTable:
    """A keyed result table: its columns and unique key, and what is best in it.

    ``value`` is the ranked column, and the best rows are the ones with the ``largest`` value or with
    the smallest.
    """

    name: str
    columns: T.StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    value: str | None = None
    largest: bool = True

    @property
    def fields(self) -> list[str]:
        return self.columns.fieldNames()


CARRIER_PERFORMANCE = ResultTable(
    "carrier_performance",
    _struct("airport STRING, carrier STRING, ontime_pct DOUBLE"),
    key=("airport", "carrier"),
    value="ontime_pct",
)

CARRIER_DELAY = ResultTable(
    "carrier_delay",
    _struct("airport STRING, carrier STRING, delay DOUBLE"),
    key=("airport", "carrier"),
    value="delay",
    largest=False,
)

DESTINATION_PERFORMANCE = ResultTable(
    "destination_performance",
    _struct("origin STRING, destination STRING, ontime_pct DOUBLE"),
    key=("origin", "destination"),
    value="ontime_pct",
)

DESTINATION_DELAY = ResultTable(
    "destination_delay",
    _struct("origin STRING, destination STRING, delay DOUBLE"),
    key=("origin", "destination"),
    value="delay",
    largest=False,
)

ROUTE_DELAY = ResultTable(
    "route_delay",
    _struct("origin STRING, destination STRING, mean_delay DOUBLE"),
    key=("origin", "destination"),
    value="mean_delay",
    largest=False,
)

# The columns of a trip.
TRIPS = ResultTable(
    "trips",
    _struct(
        "origin STRING, destination STRING, stopby STRING, date DATE, "
        "xydeptime STRING, xyarrtime STRING, xyflight STRING, xydelay DOUBLE, "
        "yzdate DATE, yzdeptime STRING, yzarrtime STRING, yzflight STRING, yzdelay DOUBLE"
    ),
    key=("origin", "destination", "stopby", "date"),
    partition_by=("date",),
)

AIRPORT_COUNTS = ResultTable(
    "airport_counts",
    _struct("airport STRING, flights BIGINT"),
    key=("airport",),
    value="flights",
)

CARRIER_ONTIME = ResultTable(
    "carrier_ontime",
    _struct("carrier STRING, ontime_pct DOUBLE, flights BIGINT, unknown BIGINT"),
    key=("carrier",),
    value="ontime_pct",
)

TABLES = {
    table.name: table
    for table in (
        CARRIER_PERFORMANCE, CARRIER_DELAY, DESTINATION_PERFORMANCE, DESTINATION_DELAY,
        ROUTE_DELAY, TRIPS,
        AIRPORT_COUNTS, CARRIER_ONTIME,
    )
}
