"""Saved tables, fixed-size bitmaps, components, and null-safe ids shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.words import give_back, mixed
from skyledger.session import scratch_dir

#: Stands for a null id inside NumPy arrays; it sorts after every id.
NO_ID = np.iinfo(np.int64).max


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back; later stages survive lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def ids_of(column: pa.Array) -> np.ndarray:
    """Ids as int64; null becomes ``NO_ID``."""
    return np.asarray(column.cast(pa.int64()).fill_null(int(NO_ID)), dtype=np.int64)


def ids_to_arrow(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, type=pa.int64(), mask=ids == NO_ID)


def binaries(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], type=pa.binary())


def joined(column: pa.ChunkedArray | pa.Array, dtype: str) -> np.ndarray:
    """All values of a binary column, one after the other, as one array."""
    give_back()
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            offsets = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8))
    return np.concatenate(parts).view(dtype) if parts else np.zeros(0, dtype)


def rowwise(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of runs of equal neighbours."""
    if len(values) == 0:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


# Packs: many small values travel as arrays, one row for each key.


def ranges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash by range, so that sorted hashes have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def home_of(classes: np.ndarray, homes: int) -> np.ndarray:
    return (mixed(classes.view(np.uint64)) % np.uint64(homes)).astype(np.int64)


def by_owner(key: np.ndarray, of: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    """Values by key, and within a key by owner: (key, owners, lengths, values...)."""
    if key.max(initial=0) < 1 << 16 and (of[1:] >= of[:-1]).all():  # by owner already
        order = np.argsort(key.astype(np.uint16), kind="stable")
    else:
        order = np.lexsort((of, key))
    key, of = key[order], of[order]
    values = [v[order] for v in values]
    cut = np.append(runs(key), len(key))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        first = runs(of[a:b])
        yield (int(key[a]), of[a:b][first], np.diff(np.append(first, b - a)).astype(np.uint32), *(v[a:b] for v in values))


def binary_table(rows: list[tuple], schema: str) -> pa.Table:
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), *(binaries([r[k] for r in rows]) for k in range(1, len(names)))], names=names)


def as_batches(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches()


# Fixed-size set of 64-bit keys, to keep rows that no join needs out of a shuffle.

BITMAP_BITS = 1 << 23


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 23)


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of 1 MB, whatever the input, with the bit of every key of ``keys`` (one bigint column) set.

    It only saves work: a key whose bit is set by another one goes to a join that drops it.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
        for b in batches:
            at = _slot(ids_of(b.column(0)))
            np.bitwise_or.at(seen, at >> np.uint64(3), (1 << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        step = len(seen) // 64
        used = [k for k in range(64) if seen[k * step : (k + 1) * step].any()]
        yield pa.record_batch({"part": pa.array(used, pa.int32()), "bits": binaries([seen[k * step : (k + 1) * step] for k in used])})

    def merge(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
        return pa.table({"part": table.column("part")[:1], "bits": binaries([bits])})

    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    step = len(out) // 64
    schema = "part int, bits binary"
    for part, bits in keys.mapInArrow(slots, schema).groupBy("part").applyInArrow(merge, schema).collect():
        out[part * step : (part + 1) * step] = np.frombuffer(bits, np.uint8)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _slot(keys)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def split_by(docs: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose bigint ``key`` cannot be among ``keys``, and the rest, by a bitmap."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(keys))
    at = docs.columns.index(key)

    def part(inside: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(in_bitmap(bits.value, ids_of(b.column(at))) == inside))

        return docs.mapInArrow(run, docs.schema)

    return part(False), part(True)


# Connected components.


def star(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among 0 to n - 1 reduced to one star for each of their components: each node with its smallest one."""
    label = np.arange(n)
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    while not np.array_equal(label, label[label]):
        label = label[label]
    other = np.flatnonzero(label != np.arange(n))
    return other, label[other]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each batch reduced to one star for each of its own components."""
    for b in batches:
        ends, flat = np.unique(np.concatenate([np.asarray(b.column(0)), np.asarray(b.column(1))]), return_inverse=True)
        other, least = star(flat[: b.num_rows], flat[b.num_rows :], len(ends))
        yield pa.record_batch({"a": ends[other], "b": ends[least]})


def components(links: DataFrame) -> DataFrame:
    """Connected components of the undirected links (a bigint, b bigint): rows (node, component).

    The component is its smallest node.  Large-star and small-star rounds run until nothing changes;
    each round is a minimum for each node, joined back.  Where a node has very many neighbours, that join leaves
    them in one partition until Spark splits it by its size; no task holds them at once.
    """
    clean = links.select("a", "b").where("a is not null and b is not null and a <> b")
    # After a shuffle, so that no task runs two Python functions in a row.
    edges = saved(clean.distinct().mapInArrow(_forest, "a bigint, b bigint"), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: every larger neighbour is tied to the smallest one.
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: the smaller neighbours are tied to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        edges = saved(small, "star")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("bigint")).alias("s")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
