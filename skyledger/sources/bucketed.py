"""Best legs as bucketed tables: both sides of the trip join lie by (second date, stopover) already.

Writing them shuffles once.  Every later join of the two, of all dates or some, then reads buckets of the same
number side by side and shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators import trips

KEY = ("yzdate", "stopby")
#: Buckets of a table; a multiple of the executors' cores, so that one bucket fits into a task.
BUCKETS = 32


def _write(side: DataFrame, name: str, path: str, buckets: int) -> None:
    # As many tasks as buckets, by the same hash: each bucket is one file.
    (
        side.repartition(buckets, *KEY)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *KEY)
        .sortBy(*KEY)
        .saveAsTable(name)
    )


def write_legs(flights: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Write the best legs as tables ``name_first`` and ``name_second`` under ``path``."""
    best = trips.best_leg_flights(flights)
    half = trips.F.col("half")
    _write(trips.first_side(best.filter(half == trips.FIRST)), f"{name}_first", f"{path}/first", buckets)
    _write(trips.second_side(best.filter(half == trips.SECOND)), f"{name}_second", f"{path}/second", buckets)


def attach_legs(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Make tables that another session has written known to this one."""
    for side in ("first", "second"):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{side}").schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name}_{side} ({columns}) USING parquet "
            f"CLUSTERED BY ({', '.join(KEY)}) SORTED BY ({', '.join(KEY)}) INTO {buckets} BUCKETS LOCATION '{path}/{side}'"
        )


def best_trips(spark: SparkSession, name: str) -> DataFrame:
    """Trips made of the best flight of each leg, from the bucketed tables."""
    return trips.meet(spark.table(f"{name}_first"), spark.table(f"{name}_second"))
