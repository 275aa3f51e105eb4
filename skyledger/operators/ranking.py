"""Rankings over aggregated metrics, always with a total order.

The largest-first rankings break ties by the larger code, the smallest-first ones by the
smaller code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import scratch_dir

DEFAULT_N = 10


def largest(metric: DataFrame, value: str, code: str, n: int = DEFAULT_N) -> DataFrame:
    """The ``n`` rows with the largest value; each task keeps only ``n`` candidates."""
    return metric.orderBy(F.desc(value), F.desc(code)).limit(n)


def smallest(metric: DataFrame, value: str, code: str, n: int = DEFAULT_N) -> DataFrame:
    """The ``n`` rows with the smallest value; each task keeps only ``n`` candidates."""
    return metric.orderBy(F.asc(value), F.asc(code)).limit(n)


def largest_per_group(
    metric: DataFrame, group: str, value: str, code: str, n: int = DEFAULT_N
) -> DataFrame:
    """The ``n`` largest rows of every group, with their rank."""
    return _per_group(metric, group, [F.desc(value), F.desc(code)], n)


def smallest_per_group(
    metric: DataFrame, group: str, value: str, code: str, n: int = DEFAULT_N
) -> DataFrame:
    """The ``n`` smallest rows of every group, with their rank."""
    return _per_group(metric, group, [F.asc(value), F.asc(code)], n)


def _per_group(metric: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    # Filtering row_number() by a constant lets Spark drop rows beyond n before the shuffle.
    position = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return metric.withColumn("rank", position.cast("bigint")).filter(F.col("rank") <= n)


def ranked(metric: DataFrame, value: str, code: str) -> DataFrame:
    """All rows, largest first, without a limit; a distributed range sort."""
    return metric.orderBy(F.desc(value), F.desc(code))


def full_rank(counts: DataFrame, value: str, code: str) -> DataFrame:
    """All rows with their position, largest first, equal values by the larger code; nulls last.

    A plain global window would move every row into one task.  Here a range sort by value and code
    deals the rows to tasks, equal values included, and the sorted rows are kept in the shared folder.
    A position is then the row's place in its partition plus the rows of all partitions before, a
    table of one row per partition.
    """
    spark = counts.sparkSession
    path = scratch_dir(spark, "ranking")
    in_order = counts.orderBy(F.desc(value), F.desc(code))
    in_order.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    # The id holds the partition above 33 bits and the place in it below.
    part = F.shiftrightunsigned("place", 33)
    rows = spark.read.parquet(path).withColumn("part", part)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("size")).select(
        "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    inside = F.col("place") - F.shiftleft("part", 33)
    ranked_rows = rows.join(F.broadcast(starts), "part").withColumn(
        "rank", F.col("start") + inside + 1
    )
    return ranked_rows.select(*counts.columns, "rank").orderBy("rank")
