"""Micro-batch sinks: keyed tables with upsert, and ranked text reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from skyledger.schema import ResultTable
from skyledger.session import delete, folders
from skyledger.sources.tables import write_text


#: Key buckets of a table.
BUCKETS = 16
_OWNER = "writer STRING, buckets INT"
#: What a stream does at its first batch when another stream wrote the target before.
RESET, FAIL = "reset", "fail"


def stream_id(rows: DataFrame) -> str:
    """The id of the stream whose micro-batch is being handled.

    Spark keeps it in the checkpoint: it survives restarts, and an emptied checkpoint gets a new one.
    """
    return rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


class OtherStream(RuntimeError):
    """The target holds what another stream wrote."""


class BucketedTable:
    """A keyed Parquet table of which micro-batches rewrite only the key buckets that they touch.

    The bucket of a key is a partition of the table.  A batch reads the buckets of its keys, puts its rows in, and
    writes these buckets whole: first as the pending change, then, by dynamic partition overwrite, in place of the old
    ones.  If the second step fails half way, the replayed batch finds its pending change and repeats that step.
    Rows of a key are replaced as a whole, so a batch that is replayed later changes nothing.  Readers see each
    bucket before or after a batch, not in between.

    A stream that starts anew empties the table, or fails with ``existing="fail"``; one whose earlier batches
    the table does not hold fails.
    """

    def __init__(
        self, spark: SparkSession, table: ResultTable, path: str, buckets: int = BUCKETS, existing: str = RESET,
    ):
        if existing not in (RESET, FAIL):
            raise ValueError(f"existing is {RESET} or {FAIL}")
        self.spark = spark
        self.table = table
        self.path = path
        self.buckets = buckets
        self.existing = existing

    def create(self, writer: str = "") -> None:
        """Create the table empty, dropping what it held before."""
        delete(self.spark, self.path)
        owner = self.spark.range(1).select(F.lit(writer).alias("writer"), F.lit(self.buckets).alias("buckets"))
        owner.coalesce(1).write.parquet(self._owner)

    def read(self) -> DataFrame:
        """The content now."""
        if "_SUCCESS" not in folders(self.spark, self._owner):
            raise FileNotFoundError(f"no table at {self.path}")
        return self._rows().select(*self.table.fields)

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Put rows with new keys in, and let rows with known keys replace the old ones."""
        buckets = self._begin(stream_id(rows), batch_id)
        pending = f"{self.path}/pending/batch={batch_id}"
        if "_SUCCESS" not in folders(self.spark, pending):
            # The batch is read for its buckets, for the anti-join and for the union.
            rows.persist()
            try:
                fresh = self._bucketed(rows.select(*self.table.fields), buckets)
                touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
                current = self._rows().filter(F.col("bucket").isin(touched))
                kept = current.join(fresh, list(self.table.key), "left_anti").select(*fresh.columns)
                self._write(fresh.unionByName(kept), pending)
            finally:
                rows.unpersist()
        change = self.spark.read.schema(self._schema).parquet(pending)
        self._write(change, self._data, partitionOverwriteMode="dynamic")
        for name in folders(self.spark, f"{self.path}/pending"):
            if name != f"batch={batch_id}":
                delete(self.spark, f"{self.path}/pending/{name}")

    def _begin(self, writer: str, batch_id: int) -> int:
        """The number of buckets, after making sure that the table is this stream's."""
        owner = None
        if "_SUCCESS" in folders(self.spark, self._owner):
            owner = self.spark.read.schema(_OWNER).parquet(self._owner).first()
        if owner is not None and owner.writer == writer:
            return owner.buckets
        if batch_id > 0:
            raise OtherStream(f"{self.path} does not hold this stream's batches before {batch_id}")
        if owner is not None and owner.writer and self.existing == FAIL:
            raise OtherStream(f"{self.path} holds what another stream wrote")
        self.create(writer)
        return self.buckets

    def _bucketed(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.table.key), F.lit(buckets)).cast("int"))

    def _rows(self) -> DataFrame:
        if not folders(self.spark, self._data):
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(self._data)

    def _write(self, rows: DataFrame, path: str, **options: str) -> None:
        shaped = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *self.table.key)
        shaped.write.mode("overwrite").options(**options).partitionBy("bucket").parquet(path)

    @property
    def _schema(self) -> StructType:
        return StructType([*self.table.columns, StructField("bucket", IntegerType())])

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    @property
    def _owner(self) -> str:
        return f"{self.path}/owner"


class BatchFolders:
    """Rows appended by micro-batches, one folder per stream and batch.

    A replayed batch overwrites its own folder.  At its first batch a stream removes what another one
    wrote, or fails with ``existing="fail"``: its own batches hold all of the topic again.
    """

    def __init__(self, path: str, shape: Callable[[DataFrame], DataFrame], existing: str = RESET):
        self.path = path
        self.shape = shape
        self.existing = existing

    def write(self, rows: DataFrame, batch_id: int) -> None:
        spark, mine = rows.sparkSession, f"stream={stream_id(rows) or 'none'}"
        others = [x for x in folders(spark, self.path) if x.startswith("stream=") and x != mine]
        if others and batch_id == 0:
            if self.existing == FAIL:
                raise OtherStream(f"{self.path} holds what another stream wrote")
            for name in others:
                delete(spark, f"{self.path}/{name}")
        elif others:
            raise OtherStream(f"another stream has written to {self.path}")
        self.shape(rows).write.mode("overwrite").parquet(f"{self.path}/{mine}/batch={batch_id}")


def ranked_report(
    path: str, rank: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that replaces a text report with the ranked rows."""

    def write(rows: DataFrame, batch_id: int) -> None:
        write_text(rank(rows), path)

    return write
