"""Raw on-time CSV files, read by column name (or by position where no header exists)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import none_if_empty, to_number, to_time
from skyledger.schema import RAW_COLUMNS, RAW_TO_FLIGHT

# Fixed value: the public name of a monthly file.
FILE_PATTERN = "On_Time_On_Time_Performance_{year}_*.csv"


FLAGS = ("Cancelled", "Diverted")
#: Files that an error names.
NAMED_FILES = 20


def raw_paths(root: str, years: Iterable[int]) -> list[str]:
    """One glob per year; each covers the year's monthly files."""
    return [f"{root}/{FILE_PATTERN.format(year=year)}" for year in years]


def read_raw(
    spark: SparkSession, paths: str | list[str], header: bool = True,
    columns: Sequence[str] = RAW_COLUMNS,
) -> DataFrame:
    """Raw text columns by name; the reader handles quotes and the commas inside them.

    With a header, the names come from the first file and every other file is checked against
    them, so a file with another column order fails instead of being misread.  Without one,
    ``columns`` are the names by position, and a file is refused if its flag columns hold flags in
    fewer than half of its lines, header lines left out.
    """
    if not header:
        return _without_header(spark, paths, columns)
    names = spark.read.option("header", True).option("escape", '"').csv(paths).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')  # a quote inside quotes is doubled
        .option("enforceSchema", False)
        .csv(paths)
    )


def _without_header(
    spark: SparkSession, paths: str | list[str], columns: Sequence[str]
) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    rows = spark.read.schema(schema).option("escape", '"').csv(paths)
    wrong = misread_files(rows)
    if wrong:
        raise ValueError(f"no flags where {' and '.join(FLAGS)} should be: another column layout? {', '.join(wrong)}")
    return rows


def misread_files(rows: DataFrame) -> list[str]:
    """Files whose lines mostly hold no flags where flags should be: all lines of all files, in one aggregate.

    Header lines where ``rows`` has their columns say nothing against a file; no flight is read from them.
    """
    flagged = _is_flag("Cancelled") & _is_flag("Diverted")
    by_file = rows.filter(~_is_header()).select(flagged.alias("flagged"), F.col("_metadata.file_path").alias("file")).groupBy("file")
    seen = by_file.agg(F.count(F.lit(1)).alias("lines"), F.count_if("flagged").alias("good"))
    return [r.file for r in seen.filter("2 * good < lines").orderBy("file").limit(NAMED_FILES).collect()]


def _is_header() -> Column:
    return F.coalesce(F.col("Year") == "Year", F.lit(False))


def _is_flag(name: str) -> Column:
    return F.coalesce(to_number(F.col(name), "double").isin(0.0, 1.0), F.lit(False))


def to_flights(raw: DataFrame) -> DataFrame:
    """Typed flights: empty and dirty fields become null, header rows inside files go."""
    return raw.filter(~_is_header()).select(
        *[_typed(name, kind).alias(alias) for name, alias, kind in RAW_TO_FLIGHT]
    )


def _typed(name: str, kind: str):
    column = F.col(name)
    if name in ("DepTime", "ArrTime"):
        return to_time(column)
    if kind == "string":
        return none_if_empty(column)
    if kind == "int":
        # Raw integers may be printed as "3" or "3.00".
        return to_number(column, "double").cast("int")
    return to_number(column, kind)


def read_flights(
    spark: SparkSession, paths: str | list[str], header: bool = True,
    columns: Sequence[str] = RAW_COLUMNS,
) -> DataFrame:
    return to_flights(read_raw(spark, paths, header, columns))
