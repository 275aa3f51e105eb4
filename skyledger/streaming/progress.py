"""Progress of streams as a table: rows and bytes of every micro-batch.

The counts are observed in the plan of the stream itself, so they cost no second pass, and reach the driver as one row for
each batch.  A listener gathers them for all streams of the session.
"""

from __future__ import annotations

from collections import deque
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVED = "feed"
_COLUMNS = "stream STRING, batch_id BIGINT, rows BIGINT, bytes BIGINT, milliseconds BIGINT"


def observed(lines: DataFrame) -> DataFrame:
    """A stream of messages that reports how many rows and bytes each micro-batch holds."""
    size = F.coalesce(F.sum(F.octet_length("value").cast("bigint")), F.lit(0))
    return lines.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), size.alias("bytes"))


class Progress(StreamingQueryListener):
    """The newest ``keep`` micro-batches of all observed streams; a context manager."""

    def __init__(self, spark: SparkSession, keep: int = 10_000):
        self.spark = spark
        self.rows: deque[tuple] = deque(maxlen=keep)
        self.ended: dict[str, Event] = {}

    def __enter__(self) -> Progress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        if seen is not None:
            self.rows.append((str(progress.id), progress.batchId, seen["rows"], seen["bytes"], progress.batchDuration))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()

    def drained(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait for the query's end and for its last report, which comes a moment later."""
        query.awaitTermination()
        if not self.ended.setdefault(str(query.runId), Event()).wait(seconds):
            raise TimeoutError(f"no report of the end of stream {query.runId}")

    def table(self) -> DataFrame:
        """One row for each micro-batch, the newest report of a replayed one."""
        rows = {row[:2]: row for row in list(self.rows)}
        return self.spark.createDataFrame(list(rows.values()), _COLUMNS)
