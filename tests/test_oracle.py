"""Every named query against independent SQL on the same tables."""

import duckdb
import pytest

import __spark_entry__
from skyledger.plans import oracle, registry
from tests.conftest import SMALL

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "documents")
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')"
        )
    yield connection
    connection.close()


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(NAMES) == set(oracle.oracle_sql())
    assert set(NAMES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, sql, name):
    frame = __spark_entry__.queries()[name](spark, SMALL)
    cursor = sql.execute(__spark_entry__.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    rows = frame.collect()
    assert _sorted(rows, frame.columns) == _sorted(cursor.fetchall(), columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10
