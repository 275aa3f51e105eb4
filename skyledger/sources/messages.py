"""Flights as text messages: publishing, reading and parsing.

The transport is a parameter (``kafka`` or files of text lines), so the same pipeline runs
against a broker in production and against a folder in tests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from skyledger.functions import to_number, to_time
from skyledger.operators.filters import clean, message_value
from skyledger.schema import FLIGHT14
from skyledger.sources.extract import times_as_numbers

#: Stands for the airports of closing messages.
NO_AIRPORT = "~"
# Fixed value: the rate at which the feed is capped.
FEED_BYTES_PER_SECOND = 15 * 1024 * 1024


def to_messages(flights: DataFrame) -> DataFrame:
    """One ``value`` line per clean flight."""
    return message_value(clean(flights))


def publish(messages: DataFrame, transport: str = "kafka", **options: str) -> int:
    """Append messages to a topic and return how many.

    No key is set: one constant key would send every message to the same topic partition, and
    readers drop the key anyway.  The count is observed while writing.
    """
    sent = Observation("sent")
    counted = messages.observe(sent, F.count(F.lit(1)).alias("rows"))
    counted.write.format(transport).options(**options).mode("append").save()
    return sent.get["rows"]


def closing_messages(spark: SparkSession, date: dt.date) -> DataFrame:
    """Two flights of no airport on a date after all others, one in each half of the day.

    A stream that waits for late flights keeps its newest dates open.  These messages move it on to ``date``, so
    all dates before it by more than the allowed disorder are closed.  They never meet each other.
    """
    rows = [
        {"flight_date": date, "origin": NO_AIRPORT, "dest": NO_AIRPORT, "dep_time": time, "arr_time": time}
        for time in (900, 1500)
    ]
    whole = spark.createDataFrame([tuple(r.get(f.name) for f in FLIGHT14) for r in rows], _closing_ddl())
    return message_value(whole)


def _closing_ddl() -> str:
    numbers = ("dep_time", "arr_time")
    return ", ".join(f"{f.name} {'int' if f.name in numbers else f.dataType.simpleString()}" for f in FLIGHT14)


def publish_stream(
    messages: DataFrame, checkpoint: str, transport: str = "kafka", trigger: dict | None = None,
    **options: str,
):
    """Keep publishing a stream of messages."""
    return (
        messages.writeStream.format(transport)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_messages(spark: SparkSession, transport: str = "kafka", **options: str) -> DataFrame:
    """A streaming frame with the message text in ``value``; keys are dropped."""
    stream = spark.readStream.format(transport).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def feed_limit(transport: str, interval_seconds: float, per_second: int | None = None) -> dict:
    """Source options that cap how much one trigger reads.

    Files are capped in bytes (15 MB per second unless given), a broker in messages.
    """
    if transport == "kafka":
        if per_second is None:
            raise ValueError("a broker source is limited in messages per second")
        return {"maxOffsetsPerTrigger": str(int(per_second * interval_seconds))}
    rate = FEED_BYTES_PER_SECOND if per_second is None else per_second
    return {"maxBytesPerTrigger": str(int(rate * interval_seconds))}


def parse(messages: DataFrame) -> DataFrame:
    """Flights from message text; a line that ends early has nulls in its last columns."""
    record = F.from_csv("value", _ddl(), {"mode": "PERMISSIVE"})
    # Conditions on the fields stay above a generator; pushed below, each of them would parse the line again.
    lines = times_as_numbers(messages.select(F.inline_outer(F.array(record))))
    # So do conditions on the times, each of which would read the text of a time several times.
    return lines.select(F.inline_outer(F.array(F.struct(*lines.columns))))


def checked(messages: DataFrame) -> DataFrame:
    """Messages with a ``reason`` why they are rejected, null for good ones; works on batches and streams.

    A line that ends early is good.  A field that holds text which is no number or date, a line with more
    fields than a message has, and an empty line are not.
    """
    names = [field.name for field in FLIGHT14]
    texts = F.from_csv("value", ", ".join(f"{name} string" for name in (*names, REST)))
    found = messages.select("value", texts.alias("text"))
    wrong = [
        F.when(_unreadable(F.col(f"text.{f.name}"), f), F.lit(f"unreadable {f.name}"))
        for f in FLIGHT14
        if f.name in TIMES or not isinstance(f.dataType, StringType)
    ]
    empty = F.when(F.trim("value") == "", F.lit("empty line"))
    long = F.when(F.col(f"text.{REST}").isNotNull(), F.lit("too many fields"))
    return found.select("value", F.coalesce(empty, long, *wrong).alias("reason"))


REST = "rest"
TIMES = ("dep_time", "arr_time")


def _unreadable(text: Column, field: StructField) -> Column:
    """Text that the parser would turn into null."""
    read = to_time(text) if field.name in TIMES else to_number(text, field.dataType.simpleString())
    return (F.trim(text) != "") & read.isNull()


def good(lines: DataFrame) -> DataFrame:
    """The flights of checked messages that are not rejected."""
    return parse(lines.filter(F.col("reason").isNull()).select("value"))


def rejected(lines: DataFrame) -> DataFrame:
    """The rejected messages and why."""
    return lines.filter(F.col("reason").isNotNull())


def _ddl() -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in FLIGHT14)
