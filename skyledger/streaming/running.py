"""Running metrics since the start of a stream.

Each function takes a streaming flight frame and starts a query whose state is kept per key by
Spark; the metric itself is the one the batch jobs use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import metrics, ranking
from skyledger.schema import (
    AIRPORT_COUNTS, CARRIER_ONTIME, CARRIER_PERFORMANCE, DESTINATION_PERFORMANCE, ROUTE_DELAY,
    ResultTable,
)
from skyledger.sources import messages
from skyledger.sources.tables import as_table
from skyledger.streaming.sinks import RESET, BatchFolders, BucketedTable, ranked_report

# How often the rankings and the keyed tables are brought up to date.
RANKING_TRIGGER = {"processingTime": "2 seconds"}
BATCH_SECONDS = 10
TABLE_TRIGGER = {"processingTime": f"{BATCH_SECONDS} seconds"}
AVAILABLE_NOW = {"availableNow": True}


def _carrier_table(flights: DataFrame) -> DataFrame:
    return as_table(metrics.airport_carrier_ontime(flights), CARRIER_PERFORMANCE)


def _destination_table(flights: DataFrame) -> DataFrame:
    return as_table(metrics.airport_dest_ontime(flights), DESTINATION_PERFORMANCE)


def _route_table(flights: DataFrame) -> DataFrame:
    return as_table(metrics.route_mean_delay(flights), ROUTE_DELAY)


# Running metric of each keyed table.
TABLE_JOBS: dict[str, tuple[ResultTable, Callable[[DataFrame], DataFrame]]] = {
    "airport-carrier": (CARRIER_PERFORMANCE, _carrier_table),
    "airport-dest": (DESTINATION_PERFORMANCE, _destination_table),
    "route-mean": (ROUTE_DELAY, _route_table),
    "airports": (AIRPORT_COUNTS, metrics.airport_counts),
    "carriers": (CARRIER_ONTIME, metrics.carrier_ontime),
}

# Running metric, ranked value and code of each ranking.
RANKING_JOBS: dict[str, tuple[Callable[[DataFrame], DataFrame], str, str]] = {
    "top-airports": (metrics.airport_counts, "flights", "airport"),
    "top-carriers": (metrics.carrier_ontime, "ontime_pct", "carrier"),
}


def keep_table(
    job: str, flights: DataFrame, target: BucketedTable, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert the keys whose metric changed in each micro-batch."""
    _, metric = TABLE_JOBS[job]
    return (
        metric(flights)
        .writeStream.outputMode("update")
        .foreachBatch(target.upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TABLE_TRIGGER))
        .start()
    )


def keep_report(
    job: str, flights: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Rewrite a text report with the full ranking after each micro-batch."""
    metric, value, code = RANKING_JOBS[job]
    return (
        metric(flights)
        .writeStream.outputMode("complete")
        .foreachBatch(ranked_report(path, lambda rows: ranking.ranked(rows, value, code)))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or RANKING_TRIGGER))
        .start()
    )


def show_top(
    job: str, flights: DataFrame, checkpoint: str, n: int = ranking.DEFAULT_N,
    trigger: dict | None = None, sink: str = "console", name: str | None = None,
) -> StreamingQuery:
    """Print (or keep in a memory table) the current ``n`` best rows after each micro-batch.

    Only those ``n`` rows reach the driver.
    """
    metric, value, code = RANKING_JOBS[job]
    writer = (
        ranking.largest(metric(flights), value, code, n)
        .writeStream.outputMode("complete")
        .format(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or RANKING_TRIGGER))
    )
    return (writer.queryName(name) if name else writer).start()


def count_words_per_batch(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    existing: str = RESET,
) -> StreamingQuery:
    """Word counts of every micro-batch by itself; no state is kept."""
    target = BatchFolders(path, lambda rows: metrics.word_counts(rows, "value"), existing)
    return (
        lines.writeStream.foreachBatch(target.write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or RANKING_TRIGGER))
        .start()
    )


def keep_checked(
    lines: DataFrame, path: str, rejected_path: str, checkpoint: str, trigger: dict | None = None,
    existing: str = RESET,
) -> StreamingQuery:
    """Flights of good messages to one folder, rejected messages with their reasons to another."""
    good = BatchFolders(path, messages.good, existing)
    rejected = BatchFolders(rejected_path, messages.rejected, existing)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            good.write(rows, batch_id)
            rejected.write(rows, batch_id)
        finally:
            rows.unpersist()

    return (
        messages.checked(lines)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or RANKING_TRIGGER))
        .start()
    )
