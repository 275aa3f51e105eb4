"""Trips over a stream of flights."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import trips
from skyledger.schema import TRIPS
from skyledger.session import folders
from skyledger.streaming.running import TABLE_TRIGGER
from skyledger.streaming.sinks import RESET, BatchFolders

#: Files loaded month by month need at least a month plus the two days between the legs.
MAX_DISORDER = "33 days"
#: Repeated legs of heavy keys add at most this share of all legs to the state.
MOST_REPEATED = 0.1
_HEAVY = "yzdate DATE, stopby STRING, salts INT, repeat_first BOOLEAN"
#: Legs of a bundle at most, and legs that a task holds to make bundles of.
BUNDLE, HELD = 10_000, 4_000_000
_MEETING = ["yzdate", "stopby", "salt"]


def _bundle(place: str, side: str) -> T.ArrayType:
    kinds = {"delay": T.DoubleType(), "n": T.LongType()}
    fields = [T.StructField(f"{side}_{name}", kinds.get(name, T.StringType())) for name in (*trips.LEG_FLIGHT, "n")]
    return T.ArrayType(T.StructType([T.StructField(place, T.StringType()), *fields]))


_MET = T.StructType([
    T.StructField("yzdate", T.DateType()), T.StructField("stopby", T.StringType()), T.StructField("salt", T.IntegerType()),
    T.StructField("first", _bundle("origin", "xy")), T.StructField("second", _bundle("destination", "yz")),
])


class HeavyKey(NamedTuple):
    """A meeting of legs that is spread over ``salts`` tasks; one of its sides is repeated in each."""

    yzdate: dt.date
    stopby: str
    salts: int
    repeat_first: bool


def heavy_keys(flights: DataFrame, tasks: int | None = None, most_repeated: float = MOST_REPEATED) -> list[HeavyKey]:
    """Frequent items of (second date, stopover): keys with more legs than a task's fair share.

    Fewer keys than ``tasks`` can be that frequent, so they fit on the driver.  The side with fewer legs is the
    one to repeat, as often as the other fills tasks and ``most_repeated`` of all legs allows.
    """
    tasks = tasks or int(flights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("half") == trips.FIRST
    met = F.when(first, F.date_add("flight_date", trips.STOPOVER_DAYS)).otherwise(F.col("flight_date"))
    stop = F.when(first, F.col("dest")).otherwise(F.col("origin"))
    counts = trips.legs(flights).groupBy(met.alias("yzdate"), stop.alias("stopby")).agg(
        F.count_if(first).alias("first"), F.count_if(~first).alias("second"), F.count(F.lit(1)).alias("n")
    )
    # A row for each stopover and date; kept, so that the flights are read once for both questions.
    counts.persist()
    try:
        total = counts.agg(F.sum("n")).first()[0] or 0
        share = total / tasks
        frequent = counts.filter(F.col("n") > share).collect()
    finally:
        counts.unpersist()
    held = sum(r.n for r in frequent)
    found = []
    for r in sorted(frequent, key=lambda r: (r.yzdate, r.stopby)):
        fewer = max(1, min(r.first, r.second))
        allowed = 1 + int(most_repeated * total * r.n / held / fewer)
        salts = min(ceil(r.n / share), allowed)
        if salts > 1:
            found.append(HeavyKey(r.yzdate, r.stopby, salts, r.first < r.second))
    return found


def _kept_keys(spark: SparkSession, checkpoint: str, heavy: Sequence[HeavyKey]) -> list[HeavyKey]:
    """The heavy keys that this checkpoint began with; they are part of its state."""
    path = f"{checkpoint}/heavy-keys"
    if "_SUCCESS" not in folders(spark, path):
        if "offsets" in folders(spark, checkpoint):
            return []  # it began without any
        spark.createDataFrame(list(heavy), _HEAVY).coalesce(1).write.mode("overwrite").parquet(path)
    return [HeavyKey(*r) for r in spark.read.schema(_HEAVY).parquet(path).collect()]


def all_trips_stream(
    flights: DataFrame, heavy: Sequence[HeavyKey] = (), max_disorder: str | None = None
) -> DataFrame:
    """Stream-stream join of first and second legs.

    Without ``max_disorder`` every leg stays in state for good, so a late month still meets its
    partners.  With it (for example ``"33 days"``), legs older than the newest date by more
    than that are dropped from state.  AQE does not run in streams, so legs of ``heavy`` keys are dealt out
    over several tasks, and only the other legs that meet them are repeated.
    """
    first, second = trips.first_legs(flights), trips.second_legs(flights)
    on = []
    if max_disorder is not None:
        first = _meeting(first, trips.STOPOVER_DAYS, max_disorder)
        second = _meeting(second, 0, max_disorder)
        on.append("meeting")
    if heavy:
        keys = F.broadcast(flights.sparkSession.createDataFrame(list(heavy), _HEAVY))
        first = _spread(first, keys, F.date_add("flight_date", trips.STOPOVER_DAYS), "dest", True)
        second = _spread(second, keys, F.col("flight_date"), "origin", False)
        on.append("salt")
    return trips.join_legs(first, second, on=on)


def met_legs_stream(flights: DataFrame, heavy: Sequence[HeavyKey] = (), max_disorder: str | None = None) -> DataFrame:
    """The same join of legs in bundles: a row for every two bundles that meet, which stands for all their trips.

    The legs of a micro-batch that meet the same legs travel and stay in state as one row, so state and result grow
    with the legs, not with the trips.  Equal legs of a bundle are counted in ``n``.
    """
    sides, on = [], list(_MEETING)
    for at, legs in enumerate((trips.first_legs(flights), trips.second_legs(flights))):
        if heavy:
            keys = F.broadcast(flights.sparkSession.createDataFrame(list(heavy), _HEAVY))
            date, stop = (F.col("flight_date"), "origin") if at else (F.date_add("flight_date", trips.STOPOVER_DAYS), "dest")
            legs = _spread(legs, keys, date, stop, not at)
        else:
            legs = legs.withColumn("salt", F.lit(0))
        side = (trips.second_side if at else trips.first_side)(legs, on=["salt"])
        found = _bundled(side, _MET["second" if at else "first"])
        if max_disorder is not None:
            found = found.withColumn("meeting", F.col("yzdate").cast("timestamp")).withWatermark("meeting", max_disorder)
        sides.append(found)
    if max_disorder is not None:
        on.append("meeting")
    return sides[0].join(sides[1], on).select(*_MET.fieldNames())


def _bundled(legs: DataFrame, bundle: T.StructField) -> DataFrame:
    """Legs by meeting, as arrays of at most ``BUNDLE`` different legs, with their times as text."""
    names = [f.name for f in bundle.dataType.elementType][:-1]

    def bundles(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        at = next(k for k, name in enumerate(table.column_names) if name.endswith("_delay"))
        # -0.0 and 0.0 are one delay.
        table = table.set_column(at, table.column_names[at], pc.add(table.column(at), 0.0))
        table = table.group_by([*_MEETING, *names], use_threads=False).aggregate([([], "count_all")])
        table = table.sort_by([(name, "ascending") for name in _MEETING]).combine_chunks()
        keys = [table.column(name).combine_chunks() for name in _MEETING]
        new = np.logical_or.reduce([pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False) for k in keys])
        begin = np.flatnonzero(np.append(True, new))
        size = np.diff(np.append(begin, table.num_rows))
        parts = -(-size // BUNDLE)
        row = np.repeat(np.arange(len(size)), parts)
        part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = begin[row] + part * BUNDLE
        columns = [table.column(name).combine_chunks() for name in (*names, "count_all")]
        columns = [pc.utf8_lpad(c.cast(pa.string()), 4, "0") if pa.types.is_int32(c.type) else c for c in columns]
        each = pa.StructArray.from_arrays(columns, names=[f.name for f in bundle.dataType.elementType])
        arrays = pa.ListArray.from_arrays(pa.array(np.append(start, len(each)), pa.int32()), each)
        whole = pa.table([*(k.take(pa.array(begin[row])) for k in keys), arrays], names=[*_MEETING, bundle.name])
        yield from whole.to_batches(max_chunksize=256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= HELD:
                yield from bundles(held)
                held, rows = [], 0
        if rows:
            yield from bundles(held)

    schema = T.StructType([*(_MET[name] for name in _MEETING), bundle])
    return legs.select(*_MEETING, *names).repartition(*_MEETING).mapInArrow(run, schema)


def _spread(legs: DataFrame, keys: DataFrame, date, stop: str, is_first: bool) -> DataFrame:
    """Legs with a ``salt``: one of several for a heavy key, or a copy for each of them; 0 otherwise."""
    met = legs.withColumns({"yz_at": date, "stop_at": F.col(stop)}).join(
        keys, (F.col("yz_at") == F.col("yzdate")) & (F.col("stop_at") == F.col("stopby")), "left"
    )
    salts = F.coalesce("salts", F.lit(1))
    dealt = F.pmod(F.xxhash64("origin", "dest", "flight_date", "flight", "dep_time"), salts).cast("int")
    repeated = F.coalesce(F.col("repeat_first") == F.lit(is_first), F.lit(False))
    salt = F.explode(F.when(repeated, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(dealt)))
    return met.select(*legs.columns, salt.alias("salt"))


def _meeting(legs: DataFrame, days: int, max_disorder: str) -> DataFrame:
    at = F.date_add("flight_date", days).cast("timestamp")
    return legs.withColumn("meeting", at).withWatermark("meeting", max_disorder)


def keep_all_trips(
    flights: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    heavy: Sequence[HeavyKey] = (), max_disorder: str | None = None, existing: str = RESET, bundled: bool = False,
) -> StreamingQuery:
    """Append every trip as soon as both of its legs have been seen.

    Heavy keys are part of the state's key, so a checkpoint keeps those it began with.  With ``bundled``, bundles of
    legs that meet are appended, for ``read_all_trips`` to make trips of; ``late_rows`` and ``state_rows`` are bundles then.
    """
    heavy = _kept_keys(flights.sparkSession, checkpoint, heavy)
    found = (met_legs_stream if bundled else all_trips_stream)(flights, heavy, max_disorder)
    return _append(found, path, checkpoint, trigger, existing, _MET.fieldNames() if bundled else TRIPS.fields)


def best_trips_stream(flights: DataFrame, max_disorder: str = MAX_DISORDER) -> DataFrame:
    """Trips made of the best flight of each leg: two running minima, joined.

    The best flight of a route, date and half-day is known when no more flights of that date can come, that is
    when the watermark has passed its meeting: then the minimum leaves the first state and enters
    the join.  A joined meeting leaves the second state in the same way, so both hold ``max_disorder`` of dates
    only.  Flights that come later than that are dropped and counted (``late_rows``).
    """
    best = [
        trips.best_of_best(_meeting(legs, days, max_disorder), ("meeting",))
        for legs, days in ((trips.first_legs(flights, True), trips.STOPOVER_DAYS), (trips.second_legs(flights, True), 0))
    ]
    return trips.join_legs(*best, on=["meeting"])


def keep_best_trips(
    flights: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    max_disorder: str = MAX_DISORDER, existing: str = RESET,
) -> StreamingQuery:
    """Append each best trip once, when the watermark has passed its second leg."""
    return _append(best_trips_stream(flights, max_disorder), path, checkpoint, trigger, existing)


def _append(
    found: DataFrame, path: str, checkpoint: str, trigger: dict | None, existing: str, fields: Sequence[str] = TRIPS.fields
) -> StreamingQuery:
    target = BatchFolders(path, lambda rows: rows.select(*fields), existing)
    return (
        found.writeStream.outputMode("append")
        .foreachBatch(target.write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TABLE_TRIGGER))
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Legs that came later than ``max_disorder`` allows and were dropped, in recent batches."""
    return sum(
        state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"]
    )


def state_rows(query: StreamingQuery) -> int:
    """Rows that all stateful operators hold after the last batch."""
    last = query.lastProgress
    return sum(state["numRowsTotal"] for state in last["stateOperators"]) if last else 0


def read_all_trips(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """The appended trips, equal ones folded into a ``copies`` count like the batch result.

    Where two bundles alone meet, their trips are all different and are not shuffled.
    """
    if not bundled:
        return _appended(spark, path).groupBy(*TRIPS.fields).agg(F.count(F.lit(1)).alias("copies"))
    # As many tasks as the session has for a shuffle: a small bundle may hold very many trips.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = _appended(spark, path, _MET).repartition(tasks, *_MEETING)
    met = met.withColumn("rows", F.count(F.lit(1)).over(Window.partitionBy(*_MEETING)))
    folded = _expanded(met.filter("rows > 1")).groupBy(*TRIPS.fields).agg(F.sum("copies").alias("copies"))
    return _expanded(met.filter("rows = 1")).unionByName(folded)


def _expanded(met: DataFrame) -> DataFrame:
    first = met.select("yzdate", "stopby", "second", F.inline("first"))
    return trips.as_trips(first.select(*(c for c in first.columns if c != "second"), F.inline("second")), copies=True)


def read_best_trips(spark: SparkSession, path: str) -> DataFrame:
    """The appended best trips."""
    return _appended(spark, path).select(*TRIPS.fields)


def _appended(spark: SparkSession, path: str, schema: T.StructType = TRIPS.columns) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
