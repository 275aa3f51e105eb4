"""Benchmark decontamination: pigeonhole edit matching.

A document is contaminated by a test item if some stretch of it is within the item's error budget of
the whole item, counted in edits of characters.  Both sides are read with A-Z in lower case and each run of
white space as one space, so line breaks do not hide a passage.

An item with budget k is split into k + 1 pieces.  At least one piece of every match is without error, so
all pieces of all items are searched exactly, in one pass over each text, by an Aho-Corasick automaton.
A hit fixes where the item can lie; overlapping places are joined and verified by Myers's bit-parallel
distance, one machine word operation a text character and word of the item.  The budget is
``rate`` of the item's length and is held low enough to leave pieces of ``piece`` characters.

Items are sent to the tasks in blocks of ``block`` characters, so what a task holds is bounded however many
items there are; each block is one pass over the documents.  Nothing else is shuffled.

Null or empty texts match nothing, nor do null items and items without a word.  Items with fewer than
``piece`` characters have budget 0.  Repeated documents give repeated rows; items that repeat a text match
under each of their ids.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import saved



def plain(text: str | None) -> str:
    """White space runs as one space, A-Z in lower case."""
    if not text:
        return ""
    raw = b" ".join(text.encode().lower().split())  # bytes.lower() folds A-Z alone
    return raw.decode()


def budget(length: int, rate: float, piece: int) -> int:
    return max(0, min(int(rate * length), length // piece - 1))


def split_item(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces of nearly equal length, with their offsets."""
    n, parts = len(item), errors + 1
    cuts = [k * n // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def best_end(item: str, masks: dict[str, int], text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and where the first such stretch ends."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, char in enumerate(text, 1):
        eq = masks.get(char, 0)
        x = eq | minus
        d = (((x & plus) + plus) ^ plus) | x
        hp = (minus | ~(d | plus)) & full
        hn = d & plus
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = (hp << 1) & full  # free start: no horizontal step in from row 0
        hn = (hn << 1) & full
        plus = (hn | ~(d | hp)) & full
        minus = hp & d
        if score < best:
            best, end = score, at
    return best, end


class Items:
    """Some items and the automaton of their pieces."""

    def __init__(self, items: Sequence[tuple[int, str]], rate: float, piece: int):
        self.items = [(name, text, budget(len(text), rate, piece)) for name, text in items if text]
        self.masks: list[dict[str, int]] = []
        held: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, errors) in enumerate(self.items):
            masks: dict[str, int] = {}
            for at, char in enumerate(text):
                masks[char] = masks.get(char, 0) | 1 << at
            self.masks.append(masks)
            for at, part in split_item(text, errors):
                held.setdefault(part, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for part, owners in held.items():
            self.automaton.add_word(part, (len(part), owners))
        if held:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, errors, where it ends in the plain text) of every item found, at its best place."""
        if not text or not self.items:
            return []
        places: dict[int, list[int]] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for k, at in owners:
                places.setdefault(k, []).append(end + 1 - size - at)
        found = []
        for k, starts in places.items():
            name, item, errors = self.items[k]
            m, best = len(item), None
            # A place is the item's start if nothing shifted; it lies within the budget of the true one.
            starts.sort()
            group = 0
            for x in range(len(starts)):
                if x + 1 == len(starts) or starts[x + 1] - starts[x] > m:
                    low = max(0, starts[group] - errors)
                    stretch = text[low : starts[x] + m + errors]
                    score, end = (0, m) if stretch == item else best_end(item, self.masks[k], stretch)
                    if score <= errors and (best is None or score < best[0]):
                        best = (score, low + end)
                    group = x + 1
            if best is not None:
                found.append((name, *best))
        return found


RESULT = "doc_id bigint, item_id bigint, errors int, ends_at bigint"


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block: int) -> Iterator[list[tuple[int, str]]]:
    """Plain items, at most ``block`` characters (or one item) at a time on the driver."""
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("item"))
    size = F.length("item")
    total = rows.agg(F.sum(size)).first()[0] or 0
    if total <= block:
        yield [(i, plain(t)) for i, t in rows.collect()]
        return
    parts = -(-2 * total // block)
    numbered = saved(rows.withColumn("part", F.pmod(F.xxhash64("item_id", "item"), F.lit(parts)).cast("int")), "items")
    for part in range(parts):
        yield [(i, plain(t)) for i, t in numbered.where(F.col("part") == part).select("item_id", "item").collect()]


def find_items(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, piece: int = 12, block: int = 8 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_col: str = "text",
) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, errors, ends_at (in the plain text)."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    passes = []
    for items in _blocks(benchmark, item_id_col, item_col, block):
        sent = spark.sparkContext.broadcast((items, rate, piece))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = Items(*sent.value)
            for b in batches:
                rows = [(k, *hit) for k, text in enumerate(b.column("text")) for hit in known.matches(plain(text.as_py()))]
                named = b.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.record_batch([named, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64())], names=["doc_id", "item_id", "errors", "ends_at"])

        passes.append(source.mapInArrow(run, RESULT))
    return reduce(DataFrame.union, passes) if passes else spark.createDataFrame([], RESULT)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, piece: int = 12, block: int = 8 << 20, text_col: str = "text", item_id_col: str = "item_id", item_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    at = docs.columns.index(text_col)
    for items in _blocks(benchmark, item_id_col, item_col, block):
        sent = docs.sparkSession.sparkContext.broadcast((items, rate, piece))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = Items(*sent.value)
            for b in batches:
                yield b.filter(pa.array([not known.matches(plain(t.as_py())) for t in b.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
