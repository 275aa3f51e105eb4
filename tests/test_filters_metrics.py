import datetime as dt

import pytest

from skyledger.operators import filters, metrics, ranking


def _as_dict(frame, key, value):
    return {row[key]: row[value] for row in frame.collect()}


def test_clean_and_not_cancelled(flight_rows):
    flights = flight_rows(
        {"flight_num": "plain"},
        {"flight_num": "cancelled", "cancelled": 1.0},
        {"flight_num": "diverted", "diverted": 1.0},
        {"flight_num": "unknown", "cancelled": None},
    )
    assert [r.flight_num for r in filters.clean(flights).collect()] == ["plain"]
    kept = {r.flight_num for r in filters.not_cancelled(flights).collect()}
    assert kept == {"plain", "diverted"}
    audit = filters.audit(flights).first()
    assert (audit.good_lines, audit.unknown_lines, audit.all_lines) == (1, 1, 4)


def test_dates(flight_rows):
    flights = flight_rows({}, {"flight_date": dt.date(2008, 1, 25)})
    assert filters.on_dates(flights, ["2008-01-25"]).count() == 1


def test_missing_tail_takes_flight_number(flight_rows):
    flights = flight_rows({"tail_num": None, "flight_num": "77"}, {"tail_num": "N5"})
    assert {r.tail_num for r in filters.default_tail(flights).collect()} == {"77", "N5"}


def test_unknown_end_does_not_hide_the_other(flight_rows):
    flights = flight_rows({"origin": None, "dest": "BBB"}, {"origin": "AAA", "dest": "BBB"})
    assert _as_dict(metrics.airport_counts(flights), "airport", "flights") == {"AAA": 1, "BBB": 2}


def test_popularity_counts_every_flight_twice(flight_rows):
    flights = flight_rows(*[{"origin": o, "dest": d} for o, d in ["AB", "BC", "CA", "AC"]])
    counts = metrics.airport_counts(flights)
    assert sum(r.flights for r in counts.collect()) == 2 * 4


BOTH_EMPTY = {"dep_delay_minutes": None, "arr_delay_minutes": None}


def test_no_delay_recorded_counts_as_zero_for_airports_only(flight_rows):
    flights = flight_rows(
        BOTH_EMPTY,
        {"dep_delay_minutes": 10.0, "arr_delay_minutes": 20.0},
        {"dep_delay_minutes": None, "arr_delay_minutes": 90.0},
        {"dep_delay_minutes": 20.0, "arr_delay_minutes": None},
    )
    assert metrics.airport_carrier_mean_delay(flights).first().mean_delay == 10.0
    assert metrics.airport_dest_mean_delay(flights).first().mean_delay == 10.0
    assert metrics.route_mean_delay(flights).first().mean_delay == 55.0
    assert metrics.carrier_mean_delay(flights).first().mean_delay == 15.0


def test_group_without_a_measure_is_left_out(flight_rows):
    flights = flight_rows({"carrier": "XX", "dep_delay_minutes": None, "arr_delay": None})
    assert metrics.carrier_mean_delay(flights).count() == 0
    assert metrics.carrier_total_delay(flights).count() == 0


def test_unknown_flag_stays_out_of_the_share(flight_rows):
    flights = flight_rows({"arr_del15": 0.0}, {"arr_del15": 1.0}, {"arr_del15": None})
    row = metrics.carrier_ontime(flights).first()
    assert (row.ontime_pct, row.flights, row.unknown) == (50.0, 3, 1)
    only_unknown = metrics.carrier_ontime(flight_rows({"arr_del15": None})).first()
    assert only_unknown.ontime_pct is None and only_unknown.unknown == 1


def test_same_flight_twice_counts_twice(flight_rows):
    row = metrics.carrier_ontime(flight_rows({}, {})).first()
    assert row.flights == 2


@pytest.fixture
def scores(spark):
    rows = [("X", "b", 1.0), ("X", "a", 1.0), ("X", "c", 2.0), ("Y", "d", 5.0)]
    return spark.createDataFrame(rows, "airport string, carrier string, score double")


def test_ties(scores):
    x = scores.filter("airport = 'X'")
    assert [r.carrier for r in ranking.smallest(x, "score", "carrier", 2).collect()] == ["a", "b"]
    low = x.filter("score = 1.0")
    assert [r.carrier for r in ranking.largest(low, "score", "carrier", 2).collect()] == ["b", "a"]


def test_per_group_limit(spark):
    rows = [(g, f"c{i:02d}", float(i)) for g in "XY" for i in range(11)]
    metric = spark.createDataFrame(rows, "g string, code string, v double")
    low = ranking.smallest_per_group(metric, "g", "v", "code").collect()
    assert len(low) == 20 and all(r.code != "c10" for r in low)
    high = ranking.largest_per_group(metric, "g", "v", "code", n=3).collect()
    assert {r.code for r in high} == {"c10", "c09", "c08"}
    assert {(r.code, r.rank) for r in high if r.g == "X"} == {("c10", 1), ("c09", 2), ("c08", 3)}


def test_full_rank_is_the_position_in_the_sorted_list(spark):
    counts = [1, 1, 2, 3, 3, 3, 17, 1000, 1001, 10**6, 10**12, 10**12 + 1, 2**62]
    rows = [(f"A{i:02d}", n) for i, n in enumerate(counts)]
    frame = spark.createDataFrame(rows, "airport string, flights bigint")
    ranked = ranking.full_rank(frame, "flights", "airport").collect()
    expected = sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)
    assert [(r.airport, r.flights, r.rank) for r in ranked] == [
        (airport, n, i + 1) for i, (airport, n) in enumerate(expected)
    ]


def test_words(spark):
    texts = spark.createDataFrame([("a b  a",), (" b ",), ("",)], "text string")
    assert _as_dict(metrics.word_counts(texts), "word", "n") == {"a": 2, "b": 2}


def test_full_rank_keeps_zeros_negatives_and_nulls(spark):
    rows = spark.createDataFrame([("a", 0), ("b", 2), ("c", -3), ("d", None), ("e", 2)], "code string, v int")
    got = [tuple(r) for r in ranking.full_rank(rows, "v", "code").collect()]
    assert got == [("e", 2, 1), ("b", 2, 2), ("a", 0, 3), ("c", -3, 4), ("d", None, 5)]


def test_full_rank_spreads_equal_counts_over_tasks(spark):
    rows = spark.range(0, 5000, 1, 4).selectExpr("lpad(id, 5, '0') AS code", "1 AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ranking.full_rank(rows, "v", "code").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r.code for r in got] == [f"{k:05d}" for k in range(4999, -1, -1)]
    assert [r["rank"] for r in got] == list(range(1, 5001))
