"""The command line from raw files to a lookup."""

import pytest

from skyledger import cli
from skyledger.schema import CARRIER_DELAY, CARRIER_PERFORMANCE
from skyledger.session import drop_scratch, folders, scratch_dir, shared_root
from skyledger.sources import yearly
from skyledger.sources.tables import as_table
from skyledger.streaming.trips import read_best_trips
from tests.test_sources import _write


@pytest.fixture
def raw_root(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    _write(
        root / "On_Time_On_Time_Performance_2008_1.csv",
        {},
        {"UniqueCarrier": "UA", "DepDelayMinutes": "30.00", "DepDel15": "1.00"},
        {"Diverted": "1.00"},
        {"Cancelled": "1.00"},
    )
    _write(
        root / "On_Time_On_Time_Performance_2008_2.csv",
        {"Origin": "JFK", "Dest": "SFO", "FlightDate": "2008-01-26", "DepTime": "1805"},
    )
    return str(root)


def test_years():
    assert cli.years("1988-1990,1995") == [1988, 1989, 1990, 1995]
    assert (cli.years("first")[-1], cli.years("last")[0], len(cli.years("all"))) == (1998, 1999, 21)


def _run(spark, *words):
    cli.main([str(word) for word in words], spark)


def test_from_raw_files_to_lookup(spark, raw_root, tmp_path, capsys):
    raw_input = ("--input", raw_root, "--layout", "raw", "--years", "2008")
    _run(spark, "audit", *raw_input)
    assert "5 lines, 3 of them good, 0 without readable flags" in capsys.readouterr().out

    table = tmp_path / "flights"
    _run(spark, "load", *raw_input, "--out", table)
    assert "3 flights written" in capsys.readouterr().out

    report = tmp_path / "top"
    _run(spark, "run", "top_airports", "--input", table, "--n", 1, "--out", report)
    assert [r.value for r in spark.read.text(str(report)).collect()] == ["JFK\t3"]

    trips = tmp_path / "trips"
    _run(spark, "run", "best_trips", "--input", table, "--table", "trips", "--out", trips)
    assert spark.read.parquet(str(trips)).first().stopby == "JFK"

    result = tmp_path / "carriers"
    _run(
        spark, "run", "airport_carrier_ontime_pct", "--input", table,
        "--table", "carrier_performance", "--out", result,
    )
    capsys.readouterr()
    _run(spark, "lookup", "carrier_performance", "--input", result, "--keys", "AUS")
    assert capsys.readouterr().out.splitlines() == [
        "AUS - AA - 100.000000", "AUS - UA - 0.000000",
    ]


def test_extract_and_stream(spark, raw_root, tmp_path, capsys):
    raw_input = ("--input", raw_root, "--layout", "raw")
    files = tmp_path / "extract"
    _run(spark, "extract", *raw_input, "--fields", 13, "--out", files)
    _run(spark, "run", "carrier_mean_delay", "--input", files, "--layout", "extract13")
    assert "UA" in capsys.readouterr().out

    topic = tmp_path / "topic"
    _run(spark, "publish", *raw_input, "--transport", "text", "--option", f"path={topic}", "--close", "2100-01-01")
    assert "5 messages published" in capsys.readouterr().out
    source = ("--transport", "text", "--option", f"path={topic}", "--once")
    for job in ("route-mean", "top-carriers", "all-trips", "best-trips", "word-count"):
        _run(
            spark, "stream", job, *source, "--checkpoint", tmp_path / f"cp-{job}",
            "--out", tmp_path / job,
        )
    capsys.readouterr()
    _run(
        spark, "lookup", "route_delay", "--streamed", "--input", tmp_path / "route-mean",
        "--keys", "AUS:JFK,JFK:SFO,XXX:YYY",
    )
    assert sorted(capsys.readouterr().out.splitlines()) == [
        "AUS - JFK - 20.000000", "JFK - SFO - 20.000000",
    ]
    report = spark.read.text(str(tmp_path / "top-carriers")).collect()
    assert {r.value.split("\t")[0] for r in report} == {"AA", "UA"}
    # Two first legs out of AUS meet the onward flight from JFK; one of them is the better.
    assert spark.read.parquet(str(tmp_path / "all-trips")).count() == 2
    assert read_best_trips(spark, str(tmp_path / "best-trips")).count() == 1


def test_months_of_a_year_are_loaded_one_by_one(spark, tmp_path, capsys):
    from tests.test_sources import _write

    dates = {1: "2008-01-24", 2: "2008-02-03", 12: "2008-12-30"}
    for month, date in dates.items():
        (tmp_path / str(month)).mkdir()
        _write(tmp_path / str(month) / f"On_Time_On_Time_Performance_2008_{month}.csv", {"FlightDate": date})
        _run(spark, "load", "--input", tmp_path / str(month), "--layout", "raw", "--years", "2008", "--out", tmp_path / "t")
    table = yearly.read_years(spark, str(tmp_path / "t"))
    assert sorted(str(r.flight_date) for r in table.collect()) == sorted(dates.values())
    with pytest.raises(SystemExit, match="dates"):
        _run(spark, "load", "--input", tmp_path / "t", "--dates", "2008-01-24", "--out", tmp_path / "u")


def test_trips_by_start_date_and_year(spark, tmp_path, capsys):
    from tests.test_sources import _write

    root = tmp_path / "raw"
    root.mkdir()
    first = {"Origin": "X", "Dest": "Y", "DepTime": "0900"}
    second = {"Origin": "Y", "Dest": "Z", "DepTime": "1805"}
    _write(root / "On_Time_On_Time_Performance_2007_12.csv", first | {"FlightDate": "2007-12-30"})
    _write(root / "On_Time_On_Time_Performance_2008_1.csv", second | {"FlightDate": "2008-01-01"}, first | {"FlightDate": "2008-01-24"}, second | {"FlightDate": "2008-01-26"})
    _run(spark, "load", "--input", root, "--layout", "raw", "--out", tmp_path / "t")
    for source in (("--input", root, "--layout", "raw"), ("--input", tmp_path / "t")):
        for report in ("best_trips", "all_trips"):
            for chosen, expected in ((("--years", "2007"), "2007-12-30"), (("--years", "2008"), "2008-01-24"), (("--dates", "2008-01-24"), "2008-01-24")):
                capsys.readouterr()
                _run(spark, "run", report, *source, *chosen)
                lines = capsys.readouterr().out.splitlines()
                assert len(lines) == 1 and expected in lines[0], (source, report, chosen, lines)


def test_lookup_prints_a_block_for_each_key_best_first(spark, tmp_path, capsys):
    rows = [("B", "x", 3.0), ("A", "y", 1.0), ("A", "x", 2.0), ("B", "y", 3.0)]
    spark.createDataFrame(rows, CARRIER_DELAY.columns).write.parquet(str(tmp_path / "t"))
    _run(spark, "lookup", "carrier_delay", "--input", tmp_path / "t", "--keys", "B,A")
    assert capsys.readouterr().out.splitlines() == [f"{a} - {c} - {d:f}" for a, c, d in (("A", "y", 1), ("A", "x", 2), ("B", "x", 3), ("B", "y", 3))]
    with pytest.raises(ValueError, match="ontime_pct"):
        as_table(spark.createDataFrame([], "origin string, carrier string, mean_delay double"), CARRIER_PERFORMANCE)


def test_report_on_screen_says_that_there_is_more(spark, raw_root, capsys):
    _run(spark, "run", "airport_counts", "--input", raw_root, "--layout", "raw", "--n", 1)
    assert "first 1 rows" in capsys.readouterr().out


def test_scratch_is_in_the_shared_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    path = scratch_dir(spark, "x")
    assert path.startswith(shared_root(spark))
    spark.range(1).write.parquet(path)
    assert folders(spark, path)
    drop_scratch(spark)
    assert not folders(spark, path)
