"""Batch reports on flights, and the named queries that run them on the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import filters, metrics, ranking, trips
from skyledger.plans.parameters import DATES, TRIP_DATES, YEARS
from skyledger.sources.driver_tables import flights, table

Query = Callable[[SparkSession, str], DataFrame]
Report = Callable[..., DataFrame]


def _ranking(metric: Report, rank: Report, *order: str) -> Report:
    """A metric cut down to its first ``n`` rows, or to the first ``n`` of every origin."""

    def report(flights: DataFrame, n: int = ranking.DEFAULT_N) -> DataFrame:
        return rank(metric(flights), *order, n=n)

    return report


def _popularity(flights: DataFrame) -> DataFrame:
    return ranking.full_rank(metrics.airport_counts(flights), "flights", "airport")


def _flights_by_tail(flights: DataFrame) -> DataFrame:
    tails = filters.default_tail(flights).groupBy("tail_num")
    return tails.agg(F.count(F.lit(1)).alias("flights"))


_BY_ORIGIN = "origin"

# Reports on flown flights; the rankings take ``n``.
METRICS: dict[str, Report] = {
    "airport_counts": metrics.airport_counts,
    "airport_popularity": _popularity,
    "carrier_mean_delay": metrics.carrier_mean_delay,
    "carrier_total_delay": metrics.carrier_total_delay,
    "carrier_ontime_pct": metrics.carrier_ontime,
    "airport_carrier_ontime_pct": metrics.airport_carrier_ontime,
    "airport_dest_ontime_pct": metrics.airport_dest_ontime,
    "airport_carrier_mean_delay": metrics.airport_carrier_mean_delay,
    "airport_dest_mean_delay": metrics.airport_dest_mean_delay,
    "airport_carrier_total_delay": metrics.airport_carrier_total_delay,
    "airport_dest_total_delay": metrics.airport_dest_total_delay,
    "route_mean_delay": metrics.route_mean_delay,
    "route_mean_signed_delay": metrics.route_mean_signed_delay,
    "tail_default": _flights_by_tail,
    "trip_first_legs": trips.first_legs,
    "trip_second_legs": trips.second_legs,
    "best_leg_flights": trips.best_leg_flights,
    "best_trips": trips.best_trips,
    "all_trips": trips.all_trips,
}

RANKINGS: dict[str, Report] = {
    "top_airports": _ranking(metrics.airport_counts, ranking.largest, "flights", "airport"),
    "top_carriers_mean_delay": _ranking(
        metrics.carrier_mean_delay, ranking.smallest, "mean_delay", "carrier"
    ),
    "top_carriers_total_delay": _ranking(
        metrics.carrier_total_delay, ranking.smallest, "total_delay", "carrier"
    ),
    "top_carriers_ontime": _ranking(
        metrics.carrier_ontime, ranking.largest, "ontime_pct", "carrier"
    ),
    "top_carriers_by_airport_delay": _ranking(
        metrics.airport_carrier_mean_delay, ranking.smallest_per_group,
        _BY_ORIGIN, "mean_delay", "carrier",
    ),
    "top_dests_by_airport_delay": _ranking(
        metrics.airport_dest_mean_delay, ranking.smallest_per_group,
        _BY_ORIGIN, "mean_delay", "dest",
    ),
    "top_carriers_by_airport_total_delay": _ranking(
        metrics.airport_carrier_total_delay, ranking.smallest_per_group,
        _BY_ORIGIN, "total_delay", "carrier",
    ),
    "top_dests_by_airport_total_delay": _ranking(
        metrics.airport_dest_total_delay, ranking.smallest_per_group,
        _BY_ORIGIN, "total_delay", "dest",
    ),
    "top_carriers_by_airport_ontime": _ranking(
        metrics.airport_carrier_ontime, ranking.largest_per_group,
        _BY_ORIGIN, "ontime_pct", "carrier",
    ),
    "top_dests_by_airport_ontime": _ranking(
        metrics.airport_dest_ontime, ranking.largest_per_group,
        _BY_ORIGIN, "ontime_pct", "dest",
    ),
}

REPORTS: dict[str, Report] = {**METRICS, **RANKINGS}


def _on_all(report: Report) -> Query:
    return lambda spark, sf_dir: report(flights(spark, sf_dir))


def _on_clean(report: Report) -> Query:
    return lambda spark, sf_dir: report(filters.clean(flights(spark, sf_dir)))


def _on_not_cancelled(report: Report) -> Query:
    return lambda spark, sf_dir: report(filters.not_cancelled(flights(spark, sf_dir)))


def _word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.word_counts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "clean_flights": _on_clean(filters.layout14),
    "not_cancelled_flights": _on_not_cancelled(filters.layout14),
    "extract13": _on_clean(filters.layout13),
    "extract_audit": _on_all(filters.audit),
    "flights_on_dates": _on_clean(
        lambda rows: filters.layout14(filters.on_dates(rows, DATES))
    ),
    **{name: _on_clean(report) for name, report in REPORTS.items()},
    # The same reports with diverted flights kept.
    **{
        f"{name}_not_cancelled": _on_not_cancelled(REPORTS[name])
        for name in (
            "top_airports", "airport_popularity", "carrier_total_delay",
            "top_carriers_total_delay", "airport_dest_total_delay",
            "top_dests_by_airport_total_delay", "route_mean_signed_delay",
        )
    },
    "best_trips_on_date": _on_clean(partial(trips.best_trips_on, dates=TRIP_DATES)),
    "best_trips_in_years": _on_clean(
        lambda rows: trips.starting_in(trips.best_trips, rows, YEARS)
    ),
    "publish_messages": _on_clean(filters.message_value),
    "word_count": _word_count,
}
