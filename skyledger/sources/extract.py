"""The headerless 13-field extract and 14-field record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import to_time
from skyledger.operators.filters import layout13, layout14, text_fields
from skyledger.schema import FLIGHT13, FLIGHT14

LAYOUTS = {13: (FLIGHT13, layout13), 14: (FLIGHT14, layout14)}


def read_extract(spark: SparkSession, path: str | list[str], fields: int = 13) -> DataFrame:
    """Extract rows as flights; a row that ends early has nulls in its last columns."""
    schema, _ = LAYOUTS[fields]
    return times_as_numbers(spark.read.schema(schema).csv(path))


def write_layout(flights: DataFrame, path: str, fields: int = 13) -> None:
    """The flights as they are, as headerless text in the given layout."""
    _, layout = LAYOUTS[fields]
    text_fields(layout(flights)).write.mode("overwrite").csv(path, emptyValue="")


def times_as_numbers(records: DataFrame) -> DataFrame:
    """Times of day from text to ``HHMM`` integers; every extract row is a flown flight."""
    times = {
        field.name: to_time(F.col(field.name))
        for field in records.schema
        if field.name in ("dep_time", "arr_time") and isinstance(field.dataType, T.StringType)
    }
    return records.withColumns(times)
