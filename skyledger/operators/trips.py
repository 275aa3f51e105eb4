"""Two-leg trips X -> Y -> Z whose second leg leaves Y two days after the first leg.

The first leg departs before noon and the second after noon; a 12:00 departure is neither.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import arrival_minutes_or_zero, flight_label, hhmm_text
from skyledger.operators.filters import on_dates, with_values

NOON = 1200
STOPOVER_DAYS = 2
FIRST, SECOND = 1, 2

# The date comes first: it sorts by a number and tells more rows apart than an airport does.
LEG_KEY = ("flight_date", "origin", "dest")
LEG_TIMES = ("dep_time", "arr_time")
LEG_FLIGHT = ("delay", "flight", *LEG_TIMES)
MEETING = ["yzdate", "stopby"]
#: Second legs of a stopover and date come in so many bundles; no bundle holds all of a heavy one.
BUNDLES = 8


def legs(flights: DataFrame) -> DataFrame:
    """Flights as trip legs, marked with the half of the day in which they depart."""
    departure = F.col("dep_time")
    half = F.when(departure < NOON, FIRST).when(departure > NOON, SECOND)
    marked = flights.select(
        *LEG_KEY,
        half.alias("half"),
        arrival_minutes_or_zero().alias("delay"),
        flight_label(F.col("carrier"), F.col("flight_num")).alias("flight"),
        "dep_time",
        "arr_time",
    )
    return with_values(marked, *LEG_KEY, "half")


def first_legs(flights: DataFrame, marked: bool = False) -> DataFrame:
    return _half(flights, FIRST, marked)


def second_legs(flights: DataFrame, marked: bool = False) -> DataFrame:
    return _half(flights, SECOND, marked)


def _half(flights: DataFrame, half: int, marked: bool) -> DataFrame:
    found = legs(flights).filter(F.col("half") == half)
    return found if marked else found.drop("half")


def best_leg_flights(flights: DataFrame) -> DataFrame:
    """Per route, date and half-day, the flight with the least arrival delay.

    Ties go to the smaller flight text, then the earlier departure and arrival.  The minimum
    of a struct is combined on the map side, so a route-date with very many flights reaches
    the shuffle as one row per task.
    """
    return best_of_best(legs(flights))


def best_of_best(candidates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The best of legs that may themselves be the best of earlier parts; ``by`` names more keys to keep."""
    # The date and half-day travel inside the struct too: conditions on those copies stay
    # above the aggregate, so the two sides of the trip join share one scan and one shuffle.
    best = F.min(F.struct(*LEG_FLIGHT, "flight_date", "half")).alias("best")
    return candidates.groupBy(*by, *LEG_KEY, "half").agg(best).select(*by, "origin", "dest", "best.*")


def best_trips(flights: DataFrame) -> DataFrame:
    """Trips made of the best flight of each leg."""
    return trips_of(best_leg_flights(flights))


def trips_of(sides: DataFrame, copies: bool = False) -> DataFrame:
    """Join the first legs among the rows with the second legs among them."""
    half = F.col("half")
    return join_legs(sides.filter(half == FIRST), sides.filter(half == SECOND), copies)


def best_trips_on(flights: DataFrame, dates: Iterable[dt.date | str]) -> DataFrame:
    """Best trips starting on the given dates, least delayed first leg, then second leg.

    Flights of other days are dropped before the trips are built.
    """
    trips = starting_on(best_trips, flights, dates)
    return trips.orderBy("xydelay", "yzdelay", "origin", "stopby", "destination", "date")


def starting_on(
    trips_of_flights: Callable[[DataFrame], DataFrame], flights: DataFrame,
    dates: Iterable[dt.date | str],
) -> DataFrame:
    """Trips whose first leg is on one of the dates; flights of other days are not joined."""
    starts = [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in dates]
    needed = {d + dt.timedelta(days=k) for d in starts for k in (0, STOPOVER_DAYS)}
    return trips_of_flights(on_dates(flights, sorted(needed))).filter(F.col("date").isin(starts))


def starting_in(
    trips_of_flights: Callable[[DataFrame], DataFrame], flights: DataFrame, years: Iterable[int]
) -> DataFrame:
    """Trips whose first leg is in one of the years; the second may be in the next year."""
    years = list(years)
    first = F.year("flight_date").isin(years)
    second = F.year(F.date_sub("flight_date", STOPOVER_DAYS)).isin(years)
    trips = trips_of_flights(flights.filter(first | second))
    return trips.filter(F.year("date").isin(years))


def all_trips(flights: DataFrame) -> DataFrame:
    """Every combination of legs, identical flights folded into a ``copies`` count.

    The number of combinations is the answer's own size.  Repeated records of one flight are
    counted before the join, so a hot group of copies does not multiply its rows.  First legs meet bundles of
    second legs, so the join makes a row for a bundle, and trips are made by a loop over it; AQE splits
    the (airport, date) keys that are still heavy.
    """
    counted = legs(flights).groupBy(*LEG_KEY, *LEG_FLIGHT, "half").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("flight_date").alias("day"),
        F.max("half").alias("side"),
    )
    # As above, conditions on the aggregated copies let both sides share one shuffle.
    sides = counted.drop("flight_date", "half").withColumnsRenamed(
        {"day": "flight_date", "side": "half"}
    )
    # A leg is in many trips, so its times are made text once, before the join.
    return _bundled_trips(sides.withColumns({name: hhmm_text(F.col(name)) for name in LEG_TIMES}))


def _bundled_trips(sides: DataFrame) -> DataFrame:
    """Trips of counted legs: each first leg with every second leg of the bundles that it meets."""
    half = F.col("half")
    first = first_side(sides.filter(half == FIRST), copies=True)
    second = second_side(sides.filter(half == SECOND), copies=True)
    own = [name for name in second.columns if name not in MEETING]
    # The part is a key of its own shuffle, so the legs of a heavy key are bundled by several tasks.
    bundles = second.groupBy(*MEETING, F.pmod(F.xxhash64(*own), F.lit(BUNDLES)).alias("part")).agg(
        F.collect_list(F.struct(*own)).alias("bundle")
    )
    return as_trips(first.join(bundles, MEETING).select(*first.columns, F.inline("bundle")), copies=True)


def first_side(first: DataFrame, copies: bool = False, on: Sequence[str] = ()) -> DataFrame:
    """First legs by where and when they meet second legs."""
    return first.select(
        F.date_add("flight_date", STOPOVER_DAYS).alias("yzdate"),
        F.col("dest").alias("stopby"),
        F.col("origin"),
        *[F.col(name).alias(f"xy_{name}") for name in (*LEG_FLIGHT, *_copied(copies))],
        *on,
    )


def second_side(second: DataFrame, copies: bool = False, on: Sequence[str] = ()) -> DataFrame:
    """Second legs by where and when they meet first legs."""
    return second.select(
        F.col("flight_date").alias("yzdate"),
        F.col("origin").alias("stopby"),
        F.col("dest").alias("destination"),
        *[F.col(name).alias(f"yz_{name}") for name in (*LEG_FLIGHT, *_copied(copies))],
        *on,
    )


def _copied(copies: bool) -> tuple[str, ...]:
    return ("n",) if copies else ()


def join_legs(
    first: DataFrame, second: DataFrame, copies: bool = False, on: Sequence[str] = ()
) -> DataFrame:
    """Equi-join of first legs with second legs on stopover airport and date, and on columns ``on`` of both."""
    return meet(first_side(first, copies, on), second_side(second, copies, on), copies, on)


def meet(xy: DataFrame, yz: DataFrame, copies: bool = False, on: Sequence[str] = ()) -> DataFrame:
    """Trips of both sides."""
    return as_trips(xy.join(yz, [*MEETING, *on]), copies)


def as_trips(pairs: DataFrame, copies: bool = False) -> DataFrame:
    """Pairs of legs as trips."""
    # Times are made text only here, so the shuffle and the stream state hold integers; counted legs bring text.
    as_text = (lambda name: F.col(name)) if copies else (lambda name: hhmm_text(F.col(name)))
    return pairs.select(
        "origin",
        "destination",
        "stopby",
        F.date_sub("yzdate", STOPOVER_DAYS).alias("date"),
        as_text("xy_dep_time").alias("xydeptime"),
        as_text("xy_arr_time").alias("xyarrtime"),
        F.col("xy_flight").alias("xyflight"),
        F.col("xy_delay").alias("xydelay"),
        "yzdate",
        as_text("yz_dep_time").alias("yzdeptime"),
        as_text("yz_arr_time").alias("yzarrtime"),
        F.col("yz_flight").alias("yzflight"),
        F.col("yz_delay").alias("yzdelay"),
        *([(F.col("xy_n") * F.col("yz_n")).alias("copies")] if copies else []),
    )
