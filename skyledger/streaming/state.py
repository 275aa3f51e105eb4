"""Running results read from the state of a stream, without its sink.

Spark's state data source reads the checkpoint as a table: the keys and the aggregation buffers that the last committed batch
left.  It needs no running query, so what a stream knows can be looked at between restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _state(spark: SparkSession, checkpoint: str, *names: str) -> DataFrame:
    """Keys and buffers under the given names, in the order in which the metric declares them."""
    rows = spark.read.format("statestore").load(checkpoint)
    # Buffers of one kind have equal names, so they are told apart by their places.
    held = rows.schema["value"].dataType.fields
    named = ", ".join(f"b{k}: {f.dataType.simpleString()}" for k, f in enumerate(held))
    return rows.withColumn("value", F.col("value").cast(f"struct<{named}>")).select("key.*", "value.*").toDF(*names)


def airport_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Flights of each airport so far, of a stream of ``airports`` or ``top-airports``."""
    return _state(spark, checkpoint, "airport", "flights")


def carrier_ontime(spark: SparkSession, checkpoint: str) -> DataFrame:
    """On-time share of each carrier so far, of a stream of ``carriers`` or ``top-carriers``."""
    held = _state(spark, checkpoint, "carrier", "ontime", "known", "flights", "unknown")
    share = F.col("ontime").cast("double") * F.lit(100.0) / F.nullif("known", F.lit(0)).cast("double")
    return held.select("carrier", share.alias("ontime_pct"), "flights", "unknown")
