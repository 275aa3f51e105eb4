"""Keyed Parquet result tables and text reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.schema import ResultTable


def write_table(rows: DataFrame, table: ResultTable, path: str) -> None:
    """Replace the table's content, sorted by key in few files.

    The rebalance step lets AQE merge small pieces and split large ones.  Row group statistics
    then serve lookups by key, so no key needs a directory of its own.
    """
    by = [F.col(c) for c in table.partition_by or table.key[:1]]
    shaped = rows.select(*table.fields).hint("rebalance", *by)
    _writer(shaped.sortWithinPartitions(*table.partition_by, *table.key), table).parquet(path)


#: Bits of each code's hash in the interleaved order.
PAIR_BITS = 12


def interleaved(first: str, second: str, bits: int = PAIR_BITS) -> Column:
    """A number whose bits are taken in turn from the hashes of two columns."""
    hashes = [F.xxhash64(name, F.lit(1)) for name in (first, second)]
    parts = [
        F.shiftleft(F.shiftright(h, bit).bitwiseAND(F.lit(1)), 2 * bit + k)
        for k, h in enumerate(hashes)
        for bit in range(bits)
    ]
    return reduce(Column.__add__, parts)


def write_pairs(rows: DataFrame, table: ResultTable, path: str, row_group_bytes: int | None = None) -> None:
    """Replace the content of a table with a key of two codes, so that either code skips row groups.

    Rows lie in an order that interleaves both codes, so a row group holds few values of each; Bloom filters of
    both columns then tell which row groups can hold a code.  Of n row groups a pair needs one or two,
    and one code about the root of n.
    """
    first, second = table.key
    ordered = rows.select(*table.fields, interleaved(first, second).alias("z"))
    shaped = ordered.repartitionByRange("z").sortWithinPartitions("z").select(*table.fields)
    writer = shaped.write.mode("overwrite")
    for name in table.key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def read_table(spark: SparkSession, table: ResultTable, path: str) -> DataFrame:
    """The table under its declared schema, so codes such as ``"1"`` stay text."""
    return spark.read.schema(table.columns).parquet(path).select(*table.fields)


def _writer(rows: DataFrame, table: ResultTable):
    writer = rows.select(*table.fields).write.mode("overwrite")
    return writer.partitionBy(*table.partition_by) if table.partition_by else writer


def write_text(rows: DataFrame, path: str, sep: str = "\t") -> None:
    """A result as delimited text files, in the order of the rows."""
    rows.write.mode("overwrite").csv(path, sep=sep)


# Metric columns, and the columns of each result table that they become.
_RENAMED = {
    "carrier_performance": {"origin": "airport"},
    "carrier_delay": {"origin": "airport", "mean_delay": "delay", "total_delay": "delay"},
    "destination_performance": {"dest": "destination"},
    "destination_delay": {"dest": "destination", "mean_delay": "delay", "total_delay": "delay"},
    "route_delay": {"dest": "destination"},
}


def as_table(metric: DataFrame, table: ResultTable) -> DataFrame:
    """A metric under the column names of its result table; a metric of another kind is refused."""
    renamed = metric.withColumnsRenamed(_RENAMED.get(table.name, {}))
    missing = [name for name in table.fields if name not in renamed.columns]
    if missing:
        raise ValueError(f"{table.name} has {', '.join(missing)}, which this metric does not give")
    return renamed.select(*table.fields)
