"""Links inside groups of any size: small groups whole, large ones by blocks and anchors.

Members of a group come as (component, class, payload).  A ``join`` gets the classes, payloads and labels
of some members and returns links that connect what belongs together, given that equal labels are
connected already.  A group of more than ``block`` bytes is cut into blocks.  The first round joins
every block with the same anchors, which connects copies of one thing.  The second joins whoever is still
apart from the largest part of the group with every block, so every pair that is not connected has
been compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import components, partitions, saved

LINKS = "a bigint, b bigint"
#: Anchors of a large group, about so many.
ANCHORS = 64
Join = Callable[[np.ndarray, list[bytes], np.ndarray], list[tuple[int, int]]]


def _within(rows: DataFrame, join: Join) -> DataFrame:
    """Links within each (component, block, part): rows come sorted, so one group at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[bytes, int]] = {}
        key = None

        def links() -> pa.RecordBatch:
            found = []
            if len(held) > 1:
                found = join(np.array(list(held), dtype=np.int64), [x for x, _ in held.values()], np.array([g for _, g in held.values()], dtype=np.int64))
            return pa.record_batch({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

        for b in batches:
            for component, block, part, name, label, payload in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
                if key != (component, block, part):
                    if key is not None:
                        yield links()
                    held, key = {}, (component, block, part)
                held[name] = (payload, label)
        if key is not None:
            yield links()

    # A fixed number of tasks: what they do is bound by CPU, so Spark must not put them together by bytes.
    order = ["component", "block", "part"]
    return rows.select(*order, "class", "label", "payload").repartition(partitions(rows.sparkSession), *order).sortWithinPartitions(*order).mapInArrow(run, LINKS)


def _large(members: DataFrame, large: DataFrame, join: Join, block: int) -> DataFrame:
    own = members.join(large, "component")
    own = own.withColumn("blocks", F.ceil(F.col("total") / block).cast("int"))
    own = saved(own.withColumn("block", F.pmod(F.hash("class"), F.col("blocks"))).withColumn("dice", F.abs(F.xxhash64("class").cast("double")) / 2.0**63), "large")
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    anchors = own.where(F.col("dice") < ANCHORS / F.col("members")).withColumn("block", every_block)
    first = own.unionByName(anchors).dropDuplicates(["component", "block", "class"])
    found = saved(_within(first.withColumn("part", F.lit(0)).withColumn("label", F.col("class")), join), "links-1")
    names = components(found)
    now = saved(own.join(names, own["class"] == names["node"], "left").select(own["*"], F.coalesce(names["component"], own["class"]).alias("label")), "labels-1")
    # Who is not with the largest part meets every block.
    sizes = now.groupBy("component", "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy("component").agg(F.max(F.struct("n", "label")).getField("label").alias("main"))
    apart = now.join(main, "component").where("label <> main").drop("main")
    parts = apart.groupBy("component").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.length("payload")) / (block / 4)).cast("int")).alias("parts"))
    probes = apart.join(parts, "component").withColumn("part", F.pmod(F.hash("class", F.lit(1)), F.col("parts"))).withColumn("block", every_block)
    whole = now.join(parts, "component").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    second = whole.unionByName(probes).dropDuplicates(["component", "block", "part", "class"])
    return found.union(saved(_within(second, join), "links-2"))


def connected(members: DataFrame, join: Join, block: int) -> DataFrame:
    """Rows (node, component) of all classes that links connect."""
    sizes = members.groupBy("component").agg(F.sum(F.length("payload")).alias("total"), F.count("*").alias("members"))
    large = saved(sizes.where(F.col("total") > block), "large-components")
    if large.isEmpty():
        small, links = members, None
    else:
        small = members.join(large, "component", "left_anti")
        links = _large(members, large, join, block)
    near = _within(small.withColumns({"block": F.lit(0), "part": F.lit(0), "label": F.col("class")}), join)
    return components(near if links is None else near.union(links))
