"""The clean flight table, partitioned by year and month."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.filters import clean, in_years, layout13
from skyledger.sources.raw import raw_paths, read_flights

# The year ranges that are loaded together.
FIRST_YEARS = range(1988, 1999)
LAST_YEARS = range(1999, 2009)
ALL_YEARS = range(1988, 2009)


def write_years(flights: DataFrame, path: str) -> dict[str, int]:
    """Write flights into one directory per year and month; return how many rows were written.

    Only the months among the flights are replaced, so a year can be loaded month by month.  The
    count is observed while writing and needs no second scan.  The rebalance step yields
    well-sized files per month and lets AQE split a month larger than the rest.
    """
    written = Observation("written")
    rows = flights.withColumns({"year": F.year("flight_date"), "month": F.month("flight_date")})
    # Observed in the writing stage: an earlier stage may run again and count twice.
    (
        rows.hint("rebalance", F.col("year"), F.col("month"))
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )
    return written.get


def read_years(
    spark: SparkSession, path: str, years: Iterable[int] | None = None
) -> DataFrame:
    """The table, restricted to the directories of the given years."""
    table = spark.read.parquet(path)
    return (table if years is None else in_years(table, years)).drop("month")


def load_years(spark: SparkSession, raw_root: str, years: Iterable[int], path: str) -> dict:
    """Monthly raw files of the given years into the table; other months stay as they are."""
    flights = read_flights(spark, raw_paths(raw_root, years))
    return write_years(clean(flights), path)


def extract_years(flights: DataFrame, path: str) -> dict[str, int]:
    """The 13-field extract of the flights, kept as a table by year."""
    return write_years(layout13(clean(flights)), path)
