"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the mean number of its copies.  Among all rates that meet each source's
number of words, entropy balancing takes those closest to one copy of everything, with the
(Fermi-Dirac) entropy that keeps rates between 0 and ``cap``.  Their form is an exponential tilt,

    rate(n) = cap / (1 + (cap - 1) exp(-x n)),    n = words of the document,

with one multiplier x for each source.  The convex dual in x is solved by Newton steps inside a
bracket, for all sources at once: a step sums rates and their slopes over the cells (source, size)
of the corpus, as documents of one cell share their rate.  Rates are then rounded to copies
cell by cell, from long documents to short ones, carrying on what rounding gave away, so a source
misses its target by about half of its shortest document.  Within a cell, hashes of the ids say who
gets one copy more.

Null sources are one source, the last.  Null or empty texts have size 0 and are never taken.
Repeated rows are separate documents.  A source of size 0 has target 0.  Nothing depends on the
order of rows or on partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import saved

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one cell that are ranked together.
RANKED = 100_000
_INDEX = (1 << 33) - 1


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def ranked(df: DataFrame, *by: Column) -> DataFrame:
    """Rows with ``rank`` 0, 1, ... in a total order, without sorting them all in one task."""
    rows = saved(df.orderBy(*by).withColumn("id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftrightunsigned("id", 33)
    counts = rows.groupBy(part.alias("part")).count().orderBy("part").collect()  # a row for each partition
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, "part bigint, start bigint")
    return rows.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", F.col("start") + F.col("id").bitwiseAND(F.lit(_INDEX))).drop("id", "part", "start")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Words wanted of each source: (source, source_size) gets ``k`` and ``target``.

    Sources take the weights in turn, by code point.  They share ``share`` of all words; none gets
    more than ``cap`` times its own, and what that leaves over is shared again by weight.
    """
    rows = ranked(sizes, F.col("source").asc_nulls_last()).withColumnRenamed("rank", "k")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("k") % len(weights) + 1).cast("int"))
    rows = saved(rows.withColumn("weight", weight), "weights")
    limit = cap * F.col("source_size")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        # Sources whose share at this level is above their limit stay at the limit.
        full = F.col("weight") * level > limit
        full_words, open_weight = rows.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        following = (share * total - full_words) / open_weight if open_weight else level
        if not following > level:
            break
        level = following
    return rows.withColumn("target", F.least(F.col("weight") * level, limit)).drop("weight")


def _rate(x: Column, size: Column, cap: float) -> Column:
    power = F.least(F.greatest(-x * size, F.lit(-700.0)), F.lit(700.0))
    return F.lit(cap) / (1 + (cap - 1) * F.exp(power))


def exact(value: Column) -> Column:
    """A sum that does not depend on the order of rows."""
    return F.sum(value.cast("decimal(38,6)")).cast("double")


def multipliers(cells: DataFrame, wanted: DataFrame, cap: float = 2.0, close: float = 1e-6, rounds: int = 60) -> DataFrame:
    """The dual solution: (k, x).  Cells are (k, size, n), wanted (k, source_size, target)."""
    mean = cells.where("size > 0").groupBy("k").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    inner = (F.col("target") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-9))
    # x is kept as y = x * mean; a source that is wanted fully or not at all has no finite y.
    state = wanted.join(mean, "k").select("k", "mean", "target", F.lit(0.0).alias("y"), F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"), (~inner).alias("done"), F.when(F.col("target") > 0, F.lit(1e4)).otherwise(F.lit(-1e4)).alias("edge"))
    state = saved(state.withColumn("y", F.when(F.col("done"), F.col("edge")).otherwise(F.col("y"))).drop("edge"), "dual")
    for _ in range(rounds):
        rate = _rate(F.col("y") / F.col("mean"), F.col("size"), cap)
        words = F.col("size") * F.col("n")
        sums = cells.join(state.where("not done").select("k", "y", "mean"), "k").groupBy("k").agg(
            exact(words * rate).alias("got"), exact(words * F.col("size") / F.col("mean") * rate * (1 - rate / cap)).alias("slope")
        )
        if not state.where("not done").limit(1).count():
            break
        far = F.col("got") - F.col("target")
        low = F.when(far < 0, F.col("y")).otherwise(F.col("low"))
        high = F.when(far > 0, F.col("y")).otherwise(F.col("high"))
        step = F.least(F.greatest(far / F.greatest(F.col("slope"), F.lit(1e-300)), F.lit(-4.0)), F.lit(4.0))
        newton = F.col("y") - step
        fits = (newton > low) & (newton < high)
        done = F.abs(far) <= close * F.col("target")
        still = F.col("done") | F.col("got").isNull()  # settled before; least() and greatest() pass over nulls
        moved = F.when(done, F.col("y")).when(fits, newton).otherwise((low + high) / 2)
        state = saved(
            state.join(sums, "k", "left").select(
                "k", "mean", "target", F.when(still, F.col("y")).otherwise(moved).alias("y"), F.when(still, F.col("low")).otherwise(low).alias("low"),
                F.when(still, F.col("high")).otherwise(high).alias("high"), (still | done).alias("done"),
            ),
            "dual",
        )
    return state.select("k", (F.col("y") / F.col("mean")).alias("x"))


def _rounded(cap: int):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        """Copies of each cell of one source; a source has no more cells than different sizes."""
        cells = cells.sort_values("size", ascending=False)
        carry, out = 0.0, []
        for size, n, rate in zip(cells["size"], cells["n"], cells["rate"], strict=True):
            if size == 0:
                out.append(0)
                continue
            words = n * rate * size + carry
            copies = min(max(int(words / size + 0.5), 0), cap * n)
            carry = words - copies * size
            out.append(copies)
        return cells.assign(copies=out)[["k", "size", "n", "rate", "copies"]]

    return run


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: int = 2,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row for each row of ``docs``: id, mark of the text, size, source_size, target, rate, copies, taken."""
    light = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("mark"),
    )
    light = saved(light, "sizes")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = saved(targets(sizes, weights, share, float(cap)), "targets")
    named = light.alias("d").join(wanted.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.doc_id", "d.size", "d.mark", "s.k")
    named = saved(named, "named")
    cells = saved(named.groupBy("k", "size").agg(F.count("*").alias("n")), "cells")
    x = multipliers(cells, wanted, float(cap))
    rates = cells.join(x, "k", "left").withColumn("rate", F.coalesce(_rate(F.col("x"), F.col("size"), float(cap)), F.lit(0.0)))
    rounded = saved(rates.select("k", "size", "n", "rate").groupBy("k").applyInPandas(_rounded(cap), "k bigint, size bigint, n bigint, rate double, copies bigint"), "copies")

    # Who gets one more: the first in the order of hashes; large cells are ranked in parts.
    parts = F.ceil(F.col("n") / RANKED).cast("int")
    dice = F.xxhash64("doc_id", "mark", F.lit(6))
    placed = named.join(rounded, ["k", "size"]).withColumn("dice", dice).withColumn("part", F.pmod(F.col("dice"), parts))
    before = Window.partitionBy("k", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("k", "size", "part").agg(F.count("*").alias("here")).withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0))).drop("here")
    order = Window.partitionBy("k", "size", "part").orderBy("dice", "doc_id", "mark")
    rank = F.col("before") + F.row_number().over(order)
    extra = (F.col("copies") % F.col("n") >= rank).cast("bigint")
    each = placed.join(counts, ["k", "size", "part"]).withColumn("each", F.floor(F.col("copies") / F.col("n")) + extra)
    return each.join(wanted.drop("source"), "k").select(
        "doc_id", "mark", "size", F.col("source_size").cast("bigint").alias("source_size"), "target", "rate", F.col("each").alias("copies"), (F.col("each") * F.col("size")).alias("taken")
    )


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``mix`` says, with its columns.

    Rows that repeat an id and a text all get the copies of one of them.
    """
    copies = mix(docs, id_col=id_col, text_col=text_col, **how).where("copies > 0").groupBy("doc_id", "mark").agg(F.max("copies").alias("copies"))
    c, d = copies.alias("c"), docs.alias("d")
    same = F.col(f"d.{id_col}").cast("bigint").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("c.mark"))
    both = d.join(c, same).select(F.struct("d.*").alias("row"), F.explode(F.sequence(F.lit(1), F.col("c.copies"))))
    return both.select("row.*")
