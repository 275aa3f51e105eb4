import datetime as dt
import random

import pytest

from skyledger.operators import trips
from skyledger.streaming.trips import HeavyKey, all_trips_stream


def _leg(origin, dest, day, time, delay=0.0, num="1", **more):
    return {
        "origin": origin, "dest": dest, "flight_date": day, "dep_time": time,
        "arr_time": time + 100, "arr_delay_minutes": delay, "flight_num": num, **more,
    }


D = dt.date


@pytest.mark.parametrize(
    "start, end",
    [
        (D(2008, 1, 30), D(2008, 2, 1)),
        (D(2008, 2, 28), D(2008, 3, 1)),
        (D(2007, 2, 28), D(2007, 3, 2)),
        (D(2008, 12, 30), D(2009, 1, 1)),
        (D(2008, 12, 10), D(2008, 12, 12)),
    ],
)
def test_two_days_later_by_the_calendar(flight_rows, start, end):
    flights = flight_rows(_leg("X", "Y", start, 900), _leg("Y", "Z", end, 1500))
    row = trips.best_trips(flights).first()
    assert (row.origin, row.stopby, row.destination) == ("X", "Y", "Z")
    assert (row.date, row.yzdate, row.xydeptime, row.yzdeptime) == (start, end, "0900", "1500")


def test_noon_is_neither_leg(flight_rows):
    times = {1159: (1, 0), 1200: (0, 0), 1201: (0, 1), None: (0, 0)}
    for time, (first, second) in times.items():
        flights = flight_rows({"dep_time": time})
        assert trips.first_legs(flights).count() == first
        assert trips.second_legs(flights).count() == second


def test_best_leg_and_its_ties(flight_rows):
    day = D(2008, 4, 3)
    flights = flight_rows(
        _leg("X", "Y", day, 900, 5.0, "9"),
        _leg("X", "Y", day, 800, 0.0, "8"),
        _leg("X", "Y", day, 700, 0.0, "7"),
        _leg("X", "Y", day, 600, 0.0, "7"),
        _leg("X", "Y", day, 1300, 50.0, "6"),
    )
    best = {r.half: r for r in trips.best_leg_flights(flights).collect()}
    assert (best[1].flight, best[1].dep_time) == ("AA 7", 600)
    assert (best[2].flight, best[2].delay) == ("AA 6", 50.0)


def test_missing_arrival_delay_counts_as_zero(flight_rows):
    flights = flight_rows(_leg("X", "Y", D(2008, 4, 3), 900, None, "1"))
    assert trips.best_leg_flights(flights).first().delay == 0.0


def test_trip_without_airport_or_date_is_no_trip(flight_rows):
    day = D(2008, 4, 3)
    flights = flight_rows(
        _leg("X", None, day, 900), _leg(None, "Z", D(2008, 4, 5), 1500),
        _leg("X", "Y", None, 900), _leg("Y", "Z", None, 1500),
    )
    assert trips.best_trips(flights).count() == 0
    assert trips.all_trips(flights).count() == 0


def _random_flights(n, seed, hot_share):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < hot_share
        rows.append(
            _leg(
                rng.choice("ABCD"),
                "A" if hot else rng.choice("ABCD"),
                D(2008, 1, 1) if hot else D(2008, 1, 1) + dt.timedelta(days=rng.randrange(5)),
                rng.choice([600, 900, 1159, 1200, 1201, 1800]),
                float(rng.randrange(3)),
                str(rng.randrange(20)),
            )
        )
    return rows


def _brute_force(rows, only_best):
    legs = {}
    for r in rows:
        half = 1 if r["dep_time"] < 1200 else 2 if r["dep_time"] > 1200 else None
        if half:
            leg = (r["arr_delay_minutes"], f"AA {r['flight_num']}", r["dep_time"], r["arr_time"])
            legs.setdefault((r["origin"], r["dest"], r["flight_date"], half), []).append(leg)
    if only_best:
        legs = {key: [min(found)] for key, found in legs.items()}
    result = {}
    for (x, y, d1, h1), firsts in legs.items():
        for (y2, z, d2, h2), seconds in legs.items():
            if h1 == 1 and h2 == 2 and y == y2 and d2 == d1 + dt.timedelta(days=2):
                for a in firsts:
                    for b in seconds:
                        key = (
                            x, z, y, d1, f"{a[2]:04d}", f"{a[3]:04d}", a[1], a[0],
                            d2, f"{b[2]:04d}", f"{b[3]:04d}", b[1], b[0],
                        )
                        result[key] = result.get(key, 0) + 1
    return result


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
def test_against_brute_force(flight_rows, hot_share):
    rows = _random_flights(400, seed=3, hot_share=hot_share)
    flights = flight_rows(*rows)
    best = {tuple(r): 1 for r in trips.best_trips(flights).collect()}
    assert best == _brute_force(rows, only_best=True)
    every = {tuple(r)[:-1]: r.copies for r in trips.all_trips(flights).collect()}
    assert every == _brute_force(rows, only_best=False)
    assert set(best) <= set(every)


@pytest.mark.parametrize("repeat_first", [True, False])
def test_spread_keys_give_the_same_trips(flight_rows, repeat_first):
    flights = flight_rows(*_random_flights(300, seed=5, hot_share=0.3))
    plain = trips.join_legs(trips.first_legs(flights), trips.second_legs(flights)).collect()
    heavy = [HeavyKey(r.yzdate, r.stopby, 5, repeat_first) for r in plain[::3]]
    spread = all_trips_stream(flights, list(dict.fromkeys(heavy)))
    assert plain and sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain))


def test_trips_on_dates_are_the_trips_of_those_dates(flight_rows):
    flights = flight_rows(*_random_flights(300, seed=7, hot_share=0.1))
    some = trips.best_trips_on(flights, ["2008-01-02", "2008-01-03"]).collect()
    every = trips.best_trips(flights).filter("date in ('2008-01-02', '2008-01-03')").collect()
    assert sorted(map(tuple, some)) == sorted(map(tuple, every))
    assert [(r.xydelay, r.yzdelay) for r in some] == sorted((r.xydelay, r.yzdelay) for r in some)


def test_times_of_counted_legs_are_text_before_the_join(flight_rows):
    flights = flight_rows({"dep_time": 5}, {"origin": "BBB", "dest": "CCC", "flight_date": dt.date(2008, 1, 26), "dep_time": 1505, "arr_time": None})
    found = trips.all_trips(flights)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lpad" not in plan[: plan.index("Join")] and "lpad" in plan
    row = found.first()
    assert (row.xydeptime, row.xyarrtime, row.yzdeptime, row.yzarrtime, row.copies) == ("0005", "1000", "1505", None, 1)


def test_first_legs_meet_bundles_of_second_legs(flight_rows):
    """The join makes a row for each bundle that a leg meets; trips are made by a loop over the bundle."""
    day, later = dt.date(2008, 1, 1), dt.date(2008, 1, 3)
    first = [_leg("X", "Y", day, 900, float(k), str(k)) for k in range(30)]
    second = [_leg("Y", "Z", later, 1500, float(k), str(k)) for k in range(100)]
    found = trips.all_trips(flight_rows(*first, *second, *second[:7]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline(bundle") < plan.index("Join Inner")
    assert found.count() == 3000 and found.filter("copies = 2").count() == 30 * 7
