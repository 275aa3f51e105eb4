"""The physical plans keep what makes them work on large inputs."""

import re

import pytest

import __spark_entry__
from skyledger.operators import lookup, metrics
from skyledger.plans import batch
from skyledger.schema import CARRIER_PERFORMANCE, ROUTE_DELAY
from skyledger.sources import tables
from tests.conftest import SMALL


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _query(spark, name):
    return __spark_entry__.queries()[name](spark, SMALL)


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast."""
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    yield
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(batch.QUERIES))
def test_no_pair_products_no_python_no_single_task(spark, no_broadcast, name):
    plan = _plan(_query(spark, name))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit"):
        assert bad not in plan
    single = len(re.findall(r"Exchange SinglePartition", plan))
    # The one-row audit, and the table of one row per partition behind the full ranking.
    allowed = 1 if name == "extract_audit" or name.startswith("airport_popularity") else 0
    assert single == allowed


@pytest.mark.parametrize("name", [n for n in batch.RANKINGS if "_by_" not in n])
def test_top_n_keeps_n_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in _plan(_query(spark, name))


@pytest.mark.parametrize("name", [n for n in batch.RANKINGS if "_by_" in n])
def test_top_n_per_group_is_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit.*Partial", _plan(_query(spark, name)))


@pytest.mark.parametrize("name", ["best_trips", "all_trips"])
def test_both_legs_share_one_scan(spark, no_broadcast, name):
    frame = _query(spark, name)
    frame.collect()
    final = _plan(frame).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", final)) == 1
    assert "ReusedExchange" in final


def test_scan_reads_and_filters_only_what_is_needed(spark):
    plan = _plan(_query(spark, "carrier_mean_delay"))
    schema = re.search(r"FileScan parquet \[l_.*?ReadSchema: struct<(.*?)>", plan, re.S).group(1)
    columns = {field.split(":")[0] for field in schema.split(",")}
    assert columns == {"l_orderkey", "l_partkey", "l_suppkey", "l_quantity"}
    assert "IsNotNull(l_orderkey)" in plan


def test_date_filter_reaches_the_scan(spark):
    plan = _query(spark, "flights_on_dates")._jdf.queryExecution().optimizedPlan().toString()
    below_joins = plan[plan.rindex("Filter", 0, plan.index("parquet")) :]
    assert "l_shipdate" in below_joins


def test_lookup_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "carriers")
    flights = batch.flights(spark, SMALL)
    metric = metrics.airport_carrier_ontime(flights)
    tables.write_table(tables.as_table(metric, CARRIER_PERFORMANCE), CARRIER_PERFORMANCE, path)
    table = tables.read_table(spark, CARRIER_PERFORMANCE, path)
    plan = _plan(lookup.best_of(table, CARRIER_PERFORMANCE, ["NATION_3"]))
    assert re.search(r"PushedFilters: \[.*EqualTo\(airport,NATION_3\)", plan)


def test_route_lookup_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "routes")
    metric = metrics.route_mean_delay(batch.flights(spark, SMALL))
    tables.write_table(tables.as_table(metric, ROUTE_DELAY), ROUTE_DELAY, path)
    table = tables.read_table(spark, ROUTE_DELAY, path)
    plan = _plan(lookup.routes(table, [("NATION_3", "NATION_7"), ("NATION_7", "NATION_3")]))
    assert re.search(r"PushedFilters: \[.*In\(origin", plan)


def test_skewed_key_is_split(spark, no_broadcast, tmp_path):
    """A stopover that holds a third of all legs is joined by more than one task."""
    from pyspark.sql import functions as F

    from skyledger.operators import trips

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hub = F.when(F.col("id") % 3 == 0, F.lit("HUB")).otherwise(
            F.concat(F.lit("A"), (F.col("id") % 500).cast("string"))
        )
        other = F.concat(F.lit("B"), F.col("id").cast("string"))
        ids = spark.range(0, 60000, 1, 8)
        legs = ids.select(
            F.lit("2008-01-01").cast("date").alias("flight_date"), other.alias("origin"),
            hub.alias("dest"), F.lit(0.0).alias("delay"), other.alias("flight"),
            F.lit(900).alias("dep_time"), F.lit(1000).alias("arr_time"),
        )
        onward = spark.range(0, 30, 1, 2).select(
            F.lit("2008-01-03").cast("date").alias("flight_date"), F.lit("HUB").alias("origin"),
            F.concat(F.lit("C"), F.col("id").cast("string")).alias("dest"),
            F.lit(0.0).alias("delay"), F.lit("x").alias("flight"),
            F.lit(1500).alias("dep_time"), F.lit(1600).alias("arr_time"),
        )
        sides = []
        for name, side in (("legs", legs), ("onward", onward)):
            side.write.parquet(str(tmp_path / name))
            sides.append(spark.read.parquet(str(tmp_path / name)))
        joined = trips.join_legs(*sides)
        assert len(joined.collect()) == 20000 * 30
        assert "skewed" in _plan(joined).split("== Initial Plan ==")[0]
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
