"""Partials by month, bucketed legs and state read from checkpoints give the direct answer."""

import datetime as dt

import pytest

from skyledger.operators import metrics, partials, trips
from skyledger.plans.batch import METRICS
from skyledger.sources import bucketed, messages
from skyledger.streaming import running, state
from skyledger.streaming.sinks import BucketedTable
from tests.test_trips import _random_flights


def _rows(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def _mixed():
    """Flights of two months with every kind of missing value."""
    rows = []
    for k in range(60):
        row = {
            "flight_date": dt.date(2008, 1 + k % 2, 1 + k % 28), "carrier": f"C{k % 3}", "origin": f"A{k % 4}", "dest": f"A{k % 5}",
            "dep_delay": float(k % 7 - 3), "dep_delay_minutes": float(max(k % 7 - 3, 0)), "arr_delay": float(k % 11 - 5),
            "arr_delay_minutes": float(max(k % 11 - 5, 0)), "dep_del15": float(k % 2), "arr_del15": float(k % 3 == 0),
        }
        for n, name in enumerate(("carrier", "origin", "dest", "dep_delay", "dep_delay_minutes", "arr_delay", "arr_delay_minutes", "dep_del15", "arr_del15")):
            if k % (7 + n) == 0:
                row[name] = None
        rows.append(row)
    rows.append({"carrier": "only", "origin": "X", "dest": "Y", "dep_del15": None, "arr_del15": None, "arr_delay": None, "dep_delay_minutes": None, "arr_delay_minutes": 1.0})
    return rows


@pytest.mark.parametrize("name", sorted(partials.MERGED))
def test_partials_merge_to_the_metric(flight_rows, name):
    flights = flight_rows(*_mixed())
    assert _rows(partials.MERGED[name](partials.month_partials(flights))) == _rows(METRICS[name](flights))


def test_replacing_a_month_replaces_its_partials_only(spark, tmp_path, flight_rows):
    rows = _mixed()
    path, flights = str(tmp_path / "partials"), str(tmp_path / "flights")
    flight_rows(*rows).write.parquet(flights)
    partials.write_partials(spark.read.parquet(flights), path)
    february = {p.name for p in (tmp_path / "partials" / "year=2008" / "month=2").iterdir()}
    corrected = flight_rows(*(r for r in rows if r.get("flight_date", dt.date(2008, 1, 24)).month == 1 and r["carrier"] != "C1"))
    partials.write_partials(corrected, path)
    assert {p.name for p in (tmp_path / "partials" / "year=2008" / "month=2").iterdir()} == february
    whole = spark.read.parquet(flights).filter("month(flight_date) = 2").unionByName(corrected)
    merged = partials.MERGED["airport_carrier_mean_delay"](partials.read_partials(spark, path, [2008]))
    assert _rows(merged) == _rows(metrics.airport_carrier_mean_delay(whole))
    assert all("/partials/" in f for f in merged.inputFiles())


def test_bucketed_legs_meet_without_a_shuffle(spark, tmp_path, flight_rows):
    flights = flight_rows(*_random_flights(300, seed=9, hot_share=0.2))
    path = str(tmp_path / "legs")
    bucketed.write_legs(flights, "kept_legs", path, buckets=4)
    expected = _rows(trips.best_trips(flights))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = bucketed.best_trips(spark, "kept_legs")
        assert expected and _rows(found) == expected
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        # Another session attaches to the files that are there.
        for side in ("first", "second"):
            spark.sql(f"DROP TABLE kept_legs_{side}")
        bucketed.attach_legs(spark, "other_legs", path, buckets=4)
        again = bucketed.best_trips(spark, "other_legs")
        assert _rows(again) == expected and "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(("job", "read", "metric"), [
    ("airports", state.airport_counts, metrics.airport_counts), ("carriers", state.carrier_ontime, metrics.carrier_ontime),
])
def test_state_is_read_before_and_after_a_restart(spark, tmp_path, flight_rows, job, read, metric):
    rows, topic, checkpoint = _mixed(), str(tmp_path / "topic"), str(tmp_path / "cp")
    target = BucketedTable(spark, running.TABLE_JOBS[job][0], str(tmp_path / "table"), buckets=2)
    for sent in (30, 61):
        messages.publish(messages.to_messages(flight_rows(*rows[30 * (sent == 61) : sent])), "text", path=topic)
        stream = messages.parse(messages.read_messages(spark, "text", path=topic))
        running.keep_table(job, stream, target, checkpoint, trigger=running.AVAILABLE_NOW).awaitTermination()
        assert _rows(read(spark, checkpoint)) == _rows(metric(flight_rows(*rows[:sent])))
