"""Equality lookups on the keyed result tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import result_line
from skyledger.operators.ranking import DEFAULT_N, largest_per_group, smallest_per_group
from skyledger.schema import ResultTable


def best_of(
    rows: DataFrame, table: ResultTable, keys: Iterable[str], n: int = DEFAULT_N
) -> DataFrame:
    """The ``n`` best rows of each listed key, best first by the table's own direction.

    ``keys`` are values of the table's first key column; row group statistics skip the others.
    """
    group, code = table.key
    found = rows.filter(F.col(group).isin(list(keys)))
    per_group = largest_per_group if table.largest else smallest_per_group
    return per_group(found, group, table.value, code, n)


def routes(table: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Mean delay of each listed (origin, destination) pair."""
    pairs = list(pairs)
    wanted = F.lit(False)
    for origin, destination in pairs:
        wanted |= (F.col("origin") == origin) & (F.col("destination") == destination)
    return table.filter(F.col("origin").isin([origin for origin, _ in pairs])).filter(wanted)


def report_lines(rows: DataFrame, table: ResultTable) -> DataFrame:
    """Lookup rows as printable lines, two codes and a number: one block for each key, in rank order."""
    order = [table.key[0], "rank" if "rank" in rows.columns else table.key[1]]
    return rows.orderBy(*order).select(result_line("%s - %s - %f", *table.fields).alias("line"))
