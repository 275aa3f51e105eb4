"""Queries that write a table first and then read what they need of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import filters, lookup, metrics, partials, ranking
from skyledger.plans.parameters import (
    CORRECTED_BEFORE, CORRECTED_MONTH, LOOKUP_AIRPORTS, LOOKUP_ROUTES, YEARS,
)
from skyledger.schema import (
    CARRIER_DELAY, CARRIER_PERFORMANCE, DESTINATION_DELAY, DESTINATION_PERFORMANCE, ROUTE_DELAY,
    ResultTable,
)
from skyledger.session import scratch_dir
from skyledger.sources import bucketed, tables, yearly
from skyledger.sources.driver_tables import flights


def _written(spark: SparkSession, label: str, write: Callable[[str], object]) -> str:
    """Path of a table that this call writes."""
    path = scratch_dir(spark, label)
    write(path)
    return path


def _yearly_table(spark: SparkSession, sf_dir: str) -> str:
    return _written(
        spark, "flights-by-year", lambda path: yearly.extract_years(flights(spark, sf_dir), path)
    )


def flights_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = yearly.read_years(spark, _yearly_table(spark, sf_dir))
    return table.groupBy("year").agg(F.count(F.lit(1)).alias("flights"))


def flights_year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly.read_years(spark, _yearly_table(spark, sf_dir), YEARS)


# Lookup query: the result table, and the metric that it is written from.
_LOOKUPS = {
    "lookup_carriers": (CARRIER_PERFORMANCE, metrics.airport_carrier_ontime),
    "lookup_destinations": (DESTINATION_PERFORMANCE, metrics.airport_dest_ontime),
    "lookup_carriers_by_delay": (CARRIER_DELAY, metrics.airport_carrier_mean_delay),
    "lookup_destinations_by_delay": (DESTINATION_DELAY, metrics.airport_dest_mean_delay),
}


def _result_table(
    spark: SparkSession, sf_dir: str, table: ResultTable, metric: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    rows = tables.as_table(metric(filters.clean(flights(spark, sf_dir))), table)
    path = _written(spark, table.name, lambda path: tables.write_table(rows, table, path))
    return tables.read_table(spark, table, path)


def _lookup(table: ResultTable, metric: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _result_table(spark, sf_dir, table, metric)
        return lookup.best_of(rows, table, LOOKUP_AIRPORTS)

    return query


def lookup_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _result_table(spark, sf_dir, ROUTE_DELAY, metrics.route_mean_delay)
    return lookup.routes(rows, LOOKUP_ROUTES)


#: The metrics that are also asked of partials.
PARTIAL_REPORTS = (
    "airport_counts", "carrier_mean_delay", "carrier_total_delay", "carrier_ontime_pct",
    "airport_dest_ontime_pct", "airport_carrier_mean_delay", "route_mean_delay",
)


def _corrected(flown: DataFrame) -> DataFrame:
    """A later delivery of one month, without its flights of the early morning."""
    year, month = CORRECTED_MONTH
    of_month = (F.year("flight_date") == year) & (F.month("flight_date") == month)
    return flown.filter(of_month & (F.col("dep_time") >= CORRECTED_BEFORE))


def _merged(name: str):
    """A metric merged from the partials of all months, after one month was replaced."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        flown = filters.clean(flights(spark, sf_dir))
        path = _written(spark, "partials", lambda path: partials.write_partials(flown, path))
        partials.write_partials(_corrected(flown), path)
        return partials.MERGED[name](partials.read_partials(spark, path))

    return query


def best_trips_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "legs")
    name = "legs_" + path.rsplit("-", 1)[1]
    bucketed.write_legs(filters.clean(flights(spark, sf_dir)), name, path)
    return bucketed.best_trips(spark, name)


def table_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table that held one metric, replaced as a whole by another."""
    flown = filters.clean(flights(spark, sf_dir))
    path = scratch_dir(spark, CARRIER_DELAY.name)
    for metric in (metrics.airport_carrier_total_delay, metrics.airport_carrier_mean_delay):
        tables.write_table(tables.as_table(metric(flown), CARRIER_DELAY), CARRIER_DELAY, path)
    return tables.read_table(spark, CARRIER_DELAY, path)


def ranked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full ranking as delimited text, read back line by line."""
    counts = metrics.airport_counts(filters.clean(flights(spark, sf_dir)))
    rows = ranking.full_rank(counts, "flights", "airport")
    path = _written(spark, "ranked", lambda path: tables.write_text(rows.select("rank", "airport", "flights"), path))
    return spark.read.text(path)


def lookup_route_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same routes from a table whose row groups either code skips."""
    rows = tables.as_table(metrics.route_mean_delay(filters.clean(flights(spark, sf_dir))), ROUTE_DELAY)
    path = _written(spark, "route-pairs", lambda path: tables.write_pairs(rows, ROUTE_DELAY, path))
    return lookup.routes(tables.read_table(spark, ROUTE_DELAY, path), LOOKUP_ROUTES)


def lookup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed lines of looked-up routes."""
    return lookup.report_lines(lookup_route(spark, sf_dir), ROUTE_DELAY)


QUERIES = {
    **{f"partials_{name}": _merged(name) for name in PARTIAL_REPORTS},
    "best_trips_bucketed": best_trips_bucketed,
    "table_reset": table_reset,
    "ranked_text": ranked_text,
    "lookup_lines": lookup_lines,
    "lookup_route_interleaved": lookup_route_interleaved,
    "flights_by_year": flights_by_year,
    "flights_year_range": flights_year_range,
    **{name: _lookup(table, metric) for name, (table, metric) in _LOOKUPS.items()},
    "lookup_route": lookup_route,
}
