import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyledger.schema import FLIGHT  # noqa: E402
from skyledger.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "skyledger-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def flight_rows(spark):
    """Flights from dicts; what a dict leaves out takes a plain default."""
    import datetime as dt

    defaults = {
        "flight_date": dt.date(2008, 1, 24), "day_of_week": 4, "carrier": "AA",
        "flight_num": "1", "tail_num": "N1", "origin": "AAA", "dest": "BBB",
        "dep_time": 900, "arr_time": 1000, "dep_delay": 0.0, "dep_delay_minutes": 0.0,
        "dep_del15": 0.0, "arr_delay": 0.0, "arr_delay_minutes": 0.0, "arr_del15": 0.0,
        "cancelled": 0.0, "diverted": 0.0,
    }

    def build(*rows):
        full = [{**defaults, **row} for row in rows]
        return spark.createDataFrame(
            [tuple(row[name] for name in FLIGHT.fieldNames()) for row in full], FLIGHT
        )

    return build
