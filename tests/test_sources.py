import csv
import datetime as dt

import pytest

from skyledger.operators import filters, metrics
from skyledger.schema import (
    CARRIER_PERFORMANCE, FLIGHT13, FLIGHT14, RAW_COLUMNS, ROUTE_DELAY,
)
from skyledger.sources import extract, messages, raw, tables, yearly

BASE = {
    "Year": "2008", "DayOfWeek": "4", "FlightDate": "2008-01-24", "UniqueCarrier": "AA",
    "FlightNum": "100", "TailNum": "N1", "Origin": "AUS", "OriginCityName": "Austin, TX",
    "Dest": "JFK", "DestCityName": "New York, NY", "DepTime": "0905", "ArrTime": "1330",
    "DepDelay": "-5.00", "DepDelayMinutes": "0.00", "DepDel15": "0.00", "ArrDelay": "20.00",
    "ArrDelayMinutes": "20.00", "ArrDel15": "1.00", "Cancelled": "0.00", "Diverted": "0.00",
}


def _write(path, *rows, header=True, header_again=False):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, quoting=csv.QUOTE_ALL)
        if header:
            writer.writerow(RAW_COLUMNS)
        for i, row in enumerate(rows):
            if header_again and i == 1:
                writer.writerow(RAW_COLUMNS)
            full = {**BASE, **row}
            writer.writerow([full.get(name, "") for name in RAW_COLUMNS])
    return str(path)


def test_raw_rows_by_name(spark, tmp_path):
    path = _write(tmp_path / "a.csv", {}, {"TailNum": "", "DepTime": ""}, header_again=True)
    rows = sorted(raw.read_flights(spark, path).collect(), key=lambda r: r.tail_num or "")
    assert len(rows) == 2
    assert rows[0].tail_num is None and rows[0].dep_time is None
    full = rows[1]
    assert (full.origin, full.dest, full.flight_num) == ("AUS", "JFK", "100")
    assert (full.flight_date, full.day_of_week) == (dt.date(2008, 1, 24), 4)
    assert (full.dep_time, full.arr_time) == (905, 1330)
    assert (full.dep_delay, full.arr_delay_minutes, full.cancelled) == (-5.0, 20.0, 0.0)


def test_raw_rows_without_header_by_position(spark, tmp_path):
    path = _write(tmp_path / "a.csv", {}, header=False)
    named = _write(tmp_path / "b.csv", {})
    assert raw.read_flights(spark, path, header=False).collect() == raw.read_flights(
        spark, named
    ).collect()


def test_short_and_dirty_rows_are_counted_not_kept(spark, tmp_path):
    path = _write(tmp_path / "a.csv", {}, {"Cancelled": "x"}, {"Cancelled": ""}, {"Diverted": "1.00"})
    with open(path, "a") as out:
        out.write('"2008","1","1"\n')
    flights = raw.read_flights(spark, path)
    audit = filters.audit(flights).first()
    assert (audit.good_lines, audit.unknown_lines, audit.all_lines) == (1, 3, 5)
    assert filters.clean(flights).count() == 1


def test_file_with_other_column_order_is_refused(spark, tmp_path):
    _write(tmp_path / "a.csv", {})
    with open(tmp_path / "b.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(list(reversed(RAW_COLUMNS)))
        writer.writerow([BASE.get(name, "") for name in reversed(RAW_COLUMNS)])
    with pytest.raises(Exception, match="header"):
        raw.read_flights(spark, str(tmp_path / "*.csv")).collect()


def test_years_are_loaded_pruned_and_replaced_one_by_one(spark, tmp_path):
    for year in (2007, 2008):
        for month in (1, 2):
            name = f"On_Time_On_Time_Performance_{year}_{month}.csv"
            _write(
                tmp_path / name, {"FlightDate": f"{year}-0{month}-03"},
                {"FlightDate": f"{year}-0{month}-04", "Cancelled": "1.00"},
            )
    table = str(tmp_path / "table")
    assert yearly.load_years(spark, str(tmp_path), [2007, 2008], table)["rows"] == 4
    assert yearly.load_years(spark, str(tmp_path), [2008], table)["rows"] == 2
    assert yearly.read_years(spark, table).count() == 4
    one = yearly.read_years(spark, table, [2007])
    assert {r.flight_date.year for r in one.collect()} == {2007}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [year" in plan.replace("isnotnull(year", "year")


@pytest.mark.parametrize("fields, schema", [(13, FLIGHT13), (14, FLIGHT14)])
def test_extract_round_trip(spark, tmp_path, flight_rows, fields, schema):
    flights = flight_rows(
        {"dep_time": 5, "arr_time": 2359, "tail_num": None, "flight_num": "42"},
        {"diverted": 1.0},
        {"dep_delay_minutes": None, "arr_delay_minutes": None, "arr_del15": None},
    )
    path = str(tmp_path / "extract")
    extract.write_layout(filters.clean(flights), path, fields)
    back = extract.read_extract(spark, path, fields)
    assert back.columns == schema.fieldNames()
    _, layout = extract.LAYOUTS[fields]
    expected = layout(filters.clean(flights)).select(*schema.fieldNames())
    assert sorted(map(str, back.collect())) == sorted(map(str, expected.collect()))
    text = spark.read.text(path).filter("value like '%0005%'").first().value
    assert "0005" in text and "2359" in text and "0.00" in text


def test_extract_row_that_ends_early(spark, tmp_path):
    (tmp_path / "short.csv").write_text(
        "2008-01-24,4,N1,100,0905,1330,AA,AUS,JFK,,\n"
        "2008-01-24,4,N1,100,0905,1330,AA,AUS,JFK,5.00,9.00,5.00\n"
    )
    flights = extract.read_extract(spark, str(tmp_path / "short.csv"))
    assert flights.filter("arr_delay_minutes is null").count() == 2
    assert metrics.airport_carrier_mean_delay(flights).first().mean_delay == 2.5
    assert metrics.route_mean_delay(flights).count() == 0


def test_message_round_trip(spark, flight_rows):
    flights = flight_rows({"dep_time": 7, "arr_delay": -3.0}, {"cancelled": 1.0}, {"arr_del15": None})
    lines = messages.to_messages(flights)
    assert lines.count() == 2
    back = messages.parse(lines)
    expected = filters.layout14(filters.clean(flights))
    assert sorted(map(str, back.collect())) == sorted(map(str, expected.collect()))


def test_unreadable_messages_have_no_fields(spark):
    lines = spark.createDataFrame(
        [("4,2008-01-24,AA,1,AUS,JFK,0905,0.00,0.00,0.00,1000,0.00,0.00,0.00",), ("junk",),
         ("4,2008-01-24,AA,1,AUS,JFK,0905,0.00,0.00,0.00,1000",)],
        "value string",
    )
    row = metrics.carrier_ontime(messages.parse(lines).filter("carrier is not null")).first()
    assert (row.ontime_pct, row.flights, row.unknown) == (100.0, 2, 1)


def test_feed_limits():
    assert messages.feed_limit("text", 2) == {"maxBytesPerTrigger": str(30 * 1024 * 1024)}
    assert messages.feed_limit("kafka", 2, 500) == {"maxOffsetsPerTrigger": "1000"}
    with pytest.raises(ValueError):
        messages.feed_limit("kafka", 2)


def test_table_round_trip(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("1", "AA", 50.0), ("2", "AA", 60.0)], CARRIER_PERFORMANCE.columns)
    tables.write_table(rows, CARRIER_PERFORMANCE, path)
    assert sorted(tables.read_table(spark, CARRIER_PERFORMANCE, path).collect()) == rows.collect()
    tables.write_table(rows.limit(1), CARRIER_PERFORMANCE, path)
    assert tables.read_table(spark, CARRIER_PERFORMANCE, path).count() == 1


def test_text_report_keeps_the_order(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "code string, n int")
    tables.write_text(rows.orderBy("n"), str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert sorted(lines) == ["a\t1", "b\t2", "c\t3"]


def test_route_table_columns(flight_rows):
    metric = metrics.route_mean_delay(flight_rows({"arr_delay_minutes": 4.0}))
    row = tables.as_table(metric, ROUTE_DELAY).first()
    assert tuple(row) == ("AAA", "BBB", 4.0)


def test_times_out_of_range_are_null_and_counted(spark, flight_rows):
    from skyledger.functions import hhmm_text, to_time

    texts = spark.createDataFrame([("0905",), ("2400",), ("2401",), ("1260",), ("12345",), ("-5",), ("905.0",), ("x",)], "t string")
    assert [r[0] for r in texts.select(to_time(texts.t)).collect()] == [905, 2400, None, None, None, None, 905, None]
    numbers = spark.createDataFrame([(5,), (12345,), (None,)], "t int")
    assert [r[0] for r in numbers.select(hhmm_text(numbers.t)).collect()] == ["0005", "12345", None]
    row = filters.audit(flight_rows({}, {"dep_time": None}, {"dep_time": None, "cancelled": 1.0}), filters.bad_times()).first()
    assert (row.all_lines, row.good_lines, row.bad_times) == (3, 2, 1)


def test_headerless_files_of_another_layout_are_refused(spark, tmp_path):
    from skyledger.schema import RAW_COLUMNS
    from skyledger.sources import raw

    # Three id columns before each airport, as in another edition of the files.
    columns = []
    for name in RAW_COLUMNS:
        if name in ("Origin", "Dest"):
            columns += [f"{name}AirportID", f"{name}AirportSeqID", f"{name}CityMarketID"]
        columns.append(name)
    values = {"FlightDate": "2008-01-24", "UniqueCarrier": "AA", "Origin": "AUS", "Dest": "JFK", "DepTime": "0905", "Cancelled": "0.00", "Diverted": "0.00"}
    line = ",".join(values.get(name, "14986" if name.endswith("ID") else "") for name in columns)
    (tmp_path / "file.csv").write_text(line + "\n")
    path = str(tmp_path / "file.csv")
    with pytest.raises(ValueError, match="layout"):
        raw.read_flights(spark, path, header=False).collect()
    row = raw.read_flights(spark, path, header=False, columns=columns).first()
    assert (row.origin, row.dest, row.cancelled) == ("AUS", "JFK", 0.0)


def test_shifted_file_among_good_ones_is_named(spark, tmp_path):
    from skyledger.schema import RAW_COLUMNS
    from skyledger.sources import raw

    values = {"FlightDate": "2008-01-24", "UniqueCarrier": "AA", "Origin": "AUS", "Dest": "JFK", "DepTime": "0905", "Cancelled": "0.00", "Diverted": "0.00"}
    good = ",".join(values.get(name, "") for name in RAW_COLUMNS)
    (tmp_path / "a.csv").write_text((good + "\n") * 2000)
    (tmp_path / "b.csv").write_text(("14986," + good + "\n") * 50)
    # Odd lines at the head do not make a file bad.
    (tmp_path / "c.csv").write_text("odd\n" * 1001 + (good + "\n") * 1500)
    with pytest.raises(ValueError, match="layout.*/b.csv") as error:
        raw.read_flights(spark, str(tmp_path), header=False)
    assert "a.csv" not in str(error.value) and "c.csv" not in str(error.value)
    kept = raw.read_flights(spark, [str(tmp_path / "a.csv"), str(tmp_path / "c.csv")], header=False)
    assert kept.filter("cancelled = 0").count() == 3500


def test_only_a_local_session_may_go_without_a_shared_folder():
    from types import SimpleNamespace

    from skyledger import session

    def of(master):
        context = SimpleNamespace(master=master, applicationId="app-" + master)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))

    for master in ("local", "local[4]"):
        assert session.shared_root(of(master))
    for master in ("local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError):
            session.shared_root(of(master))


def _rows_scanned(frame):
    """Rows that the scan handed on after it had skipped row groups."""
    rows = frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return rows, leaf.metrics().apply("numOutputRows").value()


def test_either_code_of_a_pair_skips_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    from skyledger.operators import lookup
    from skyledger.schema import ROUTE_DELAY
    from skyledger.sources import tables

    codes = spark.range(200).selectExpr("concat('A', lpad(id, 3, '0')) AS code")
    routes = codes.withColumnRenamed("code", "origin").crossJoin(codes.withColumnRenamed("code", "destination"))
    path = str(tmp_path / "routes")
    tables.write_pairs(routes.selectExpr("*", "CAST(1 AS DOUBLE) AS mean_delay"), ROUTE_DELAY, path, row_group_bytes=4096)
    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in (tmp_path / "routes").glob("*.parquet"))
    table = tables.read_table(spark, ROUTE_DELAY, path)
    assert groups >= 100 and table.count() == 40_000
    rows, scanned = _rows_scanned(lookup.routes(table, [("A017", "A111")]))
    assert [(r.origin, r.destination) for r in rows] == [("A017", "A111")] and scanned <= 6 * 40_000 / groups
    for code in ("origin", "destination"):
        rows, scanned = _rows_scanned(table.filter(f"{code} = 'A017'"))
        assert len(rows) == 200 and scanned <= 40_000 / 4
    assert _rows_scanned(table.filter("origin = 'A0175'"))[1] <= 40_000 / 10


def test_odd_lines_lie_in_the_files_of_the_lines_they_stand_beside(spark, tmp_path, flight_rows):
    from pyspark.sql import functions as F

    from skyledger.plans import gaps

    flights = flight_rows(*[{"flight_num": str(n)} for n in range(400)]).repartition(3)
    path = str(tmp_path / "lines")
    gaps._with_odd_lines(gaps._raw_line(flights)).write.text(path)
    kinds = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.size(F.split("value", ",")).alias("fields"), F.col("value").startswith("Year,").alias("header")
    )
    by_file = kinds.groupBy("file").agg(
        F.count_if("header").alias("headers"), F.count_if(F.col("fields") == 12).alias("short"), F.count(F.lit(1)).alias("lines")
    ).collect()
    assert sum(r.lines - r.headers - r.short for r in by_file) == 400 and sum(r.short for r in by_file) > 0
    assert all(r.headers == r.short < r.lines / 2 for r in by_file)
    assert raw.read_flights(spark, path, header=False).filter("cancelled = 0").count() == 400


def test_file_of_header_lines_only_is_not_refused(spark, tmp_path):
    from skyledger.schema import RAW_COLUMNS

    (tmp_path / "a.csv").write_text((",".join(RAW_COLUMNS) + "\n") * 3)
    assert raw.read_flights(spark, str(tmp_path / "a.csv"), header=False).count() == 0
    _write(tmp_path / "b.csv", {}, header=False)
    assert raw.read_flights(spark, str(tmp_path), header=False).count() == 1


def test_raw_round_trip_writes_compressed_files_of_few_lines(spark, tmp_path, flight_rows, monkeypatch):
    import gzip

    from skyledger.plans import gaps
    from tests.conftest import SMALL

    written = flight_rows(*[{"flight_num": str(n)} for n in range(250)]).coalesce(1)
    monkeypatch.setattr(gaps, "flights", lambda spark, sf_dir: written)
    monkeypatch.setattr(gaps, "scratch_dir", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(gaps, "LINES_PER_FILE", 100)
    assert gaps.raw_round_trip(spark, SMALL).count() == 250
    lines = [len(gzip.open(file).readlines()) for file in (tmp_path / "raw").glob("*.csv.gz")]
    assert sorted(lines) == [51, 101, 101]  # each with its header


def test_line_items_travel_without_the_columns_made_of_them(spark):
    from skyledger.sources.driver_tables import flights
    from tests.conftest import SMALL

    plan = flights(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.splitlines() if "Join" in line][0]
    assert plan.index("dep_delay_minutes") < plan.index(joined) and "dep_delay_minutes" not in plan[plan.index(joined):]
