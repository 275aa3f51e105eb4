"""A flight-shaped view over the star-schema test tables.

The joins are arranged so that the large table is shuffled once per key at most: customers and
nations meet the orders before the orders meet the line items.  Line items travel with the few columns
that flights are made of; the flight columns are worked out after the joins.  No side is forced
to be broadcast; Spark decides by the measured size of each table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flights of the view, cancelled and diverted ones included."""
    nation = table(spark, sf_dir, "nation")
    origins = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("origin"))
    )
    dests = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("dest"))
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(dests, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "dest")
    )
    carriers = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("carrier")
    )
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.to_date("l_shipdate").alias("flight_date"),
    )
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(carriers, F.col("l_partkey") == F.col("p_partkey"))
        .join(origins, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("carrier", "origin", "dest", *_own_columns())
        .select(
            "flight_date", "day_of_week", "carrier", "flight_num", "tail_num", "origin", "dest",
            "dep_time", "arr_time", "dep_delay", "dep_delay_minutes", "dep_del15",
            "arr_delay", "arr_delay_minutes", "arr_del15", "cancelled", "diverted",
        )
    )


def _own_columns() -> list:
    """Flight columns that depend on the line item alone; their filters reach its scan."""
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    date = F.col("flight_date")
    hour_seed = part * 7 + line * 131 + order
    minute = (part + order) % 60
    dep_delay = F.col("l_quantity") - 20
    arr_delay = dep_delay + (part % 41) - 20
    return [
        date,
        (F.weekday(date) + 1).alias("day_of_week"),
        (order % 10000).cast("string").alias("flight_num"),
        F.when(part % 13 == 0, None)
        .otherwise(F.concat(F.lit("N"), part.cast("string")))
        .alias("tail_num"),
        ((hour_seed % 24) * 100 + minute).cast("int").alias("dep_time"),
        (((hour_seed + 2) % 24) * 100 + minute).cast("int").alias("arr_time"),
        dep_delay.alias("dep_delay"),
        _floor0(dep_delay).alias("dep_delay_minutes"),
        _late(dep_delay).alias("dep_del15"),
        arr_delay.alias("arr_delay"),
        _floor0(arr_delay).alias("arr_delay_minutes"),
        _late(arr_delay).alias("arr_del15"),
        F.when(part % 50 == 0, 1.0).otherwise(0.0).alias("cancelled"),
        F.when(order % 97 == 0, 1.0).otherwise(0.0).alias("diverted"),
    ]


def _floor0(minutes):
    return F.greatest(minutes, F.lit(0.0))


def _late(minutes):
    return F.when(minutes >= 15, 1.0).otherwise(0.0)
