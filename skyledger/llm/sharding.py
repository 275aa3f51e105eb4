"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes, equal texts together.

Differencing keeps a heap of partial partitions.  The two with the largest spread are combined, the
largest bin of one with the smallest of the other, until one partition is left.  It works on
groups, as all copies of a text are one group that is never divided.

It runs in two levels, so that no task sees all groups.  A bundle is about 1 / (100 shards) of all
bytes.  Buckets of small groups are differenced into bundles in parallel; bundles and the groups that
are larger than a bundle, at most some thousand items whatever the input, are differenced into
shards.  A group larger than a shard's share makes its shard larger; the others stay equal.

A null text counts 16 bytes and crc 0; all null texts are one group, apart from empty texts.  Repeated
rows are rows of their own in one group.  Slots number the rows of a shard by id within hash parts.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import saved

#: Bundles for each shard, small groups in a bucket, and rows of a shard that are numbered together.
FINENESS = 100
BUCKET = 20_000
NUMBERED = 100_000


def difference(sizes: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each item, by multi-way Karmarkar-Karp differencing."""
    n = len(sizes)
    if n == 0 or bins == 1:
        return np.zeros(n, dtype=np.int64)
    # A partition holds the sums of its filled bins, largest first, and for each one item that stands for it.
    # All partitions together never hold more than ``n`` sums.
    parent = np.arange(n)
    heap = [(-int(sizes[k]), k, sizes[k : k + 1].astype(np.int64), np.array([k])) for k in np.argsort(-sizes, kind="stable").tolist()]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, k, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        # The largest of one meets the smallest of the other; empty bins are the smallest of all.
        shared = max(0, len(a) + len(b) - bins)
        i, j = len(a) - shared, len(b) - shared
        parent[y[j:][::-1]] = x[i:]
        sums = np.concatenate([a[:i], a[i:] + b[j:][::-1], b[:j][::-1]])
        stands = np.concatenate([x, y[:j][::-1]])
        order = np.argsort(-sums, kind="stable")
        sums, stands = sums[order], stands[order]
        least = int(sums[-1]) if len(sums) == bins else 0
        heapq.heappush(heap, (least - int(sums[0]), k, sums, stands))
    while not np.array_equal(parent, parent[parent]):
        parent = parent[parent]
    place = np.zeros(n, dtype=np.int64)
    stands = heap[0][3]
    place[stands] = np.arange(len(stands))
    return place[parent]


def _bundles(bundle: float):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array([x for x in table.column("text_key").to_pylist()], dtype="S32"), kind="stable")
        table = table.take(pa.array(order))
        sizes = table.column("bytes").to_numpy()
        bins = max(1, round(float(sizes.sum()) / bundle))
        place = difference(sizes, bins)
        item = table.column("bucket").to_numpy() * (1 << 32) + place
        return pa.table({"text_key": table.column("text_key"), "item": pa.array(item, pa.int64()), "bytes": table.column("bytes")})

    return run


def _to_shards(shards: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("item").to_numpy(), kind="stable")
        items, sizes = table.column("item").to_numpy()[order], table.column("bytes").to_numpy()[order]
        return pa.table({"item": items, "shard": pa.array(difference(sizes, shards), pa.int32())})

    return run


def shard(docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, size, text_crc32, text_key (of the group), shard, slot."""
    text = F.col(text_col).cast("string")
    # A key of 32 bytes; no text has the null key of one byte.
    key = F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"\x00"))
    light = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"), key.alias("text_key"),
    )
    light = saved(light, "sizes")
    groups = saved(light.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    n, rows, total = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    bundle = max(1.0, total / (shards * FINENESS))
    buckets = min(shards * FINENESS, -(-n // BUCKET)) or 1
    large = F.col("bytes") >= bundle  # no more than shards * FINENESS groups
    small = groups.where(~large).withColumn("bucket", F.pmod(F.xxhash64("text_key"), F.lit(buckets)))
    bundled = small.select("bucket", "text_key", "bytes").groupBy("bucket").applyInArrow(_bundles(bundle), "text_key binary, item bigint, bytes bigint")
    alone = groups.where(large).select("text_key", (-1 - F.shiftrightunsigned(F.xxhash64("text_key"), 1)).alias("item"), "bytes")
    members = saved(bundled.union(alone), "bundles")
    items = members.groupBy("item").agg(F.sum("bytes").alias("bytes"))
    placed = saved(items.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_to_shards(shards), "item bigint, shard int"), "shards")
    at = light.join(members.join(F.broadcast(placed), "item").select("text_key", "shard"), "text_key")

    parts = max(16, -(-rows // (shards * NUMBERED)))
    at = saved(at.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int")), "placed")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = at.groupBy("shard", "part").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return at.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "text_key", "shard", (F.col("start") + F.row_number().over(order) - 1).cast("bigint").alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of ``docs`` under ``path``, a folder ``shard=k`` each; large shards get several files.

    A column ``shard`` that ``docs`` has already gives way to the new one.
    """
    of = shard(docs, shards, id_col=id_col, text_col=text_col).select("text_key", F.col("shard").alias("to")).distinct()
    text = F.col(text_col).cast("string")
    key = F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"\x00"))
    placed = docs.select(F.struct("*").alias("row"), key.alias("text_key")).join(of, "text_key").hint("rebalance", "to")
    rest = [c for c in docs.columns if c.lower() != "shard"]
    placed.select(*(F.col("row").getField(c).alias(c) for c in rest), F.col("to").alias("shard")).write.partitionBy("shard").parquet(path)
