"""Quality by importance resampling: hashed n-gram models of good text and of all text.

Words (A-Z in lower case) and pairs of words fall into ``BUCKETS`` buckets by hash.  Their frequencies in
all documents are the raw model, those in labelled good documents the target model, both with one
added to each count.  A document's weight is the sum over its n-grams of log(target / raw): the log ratio
of its probabilities.  Gumbel noise, drawn from the id's hash, is added, and the ``fraction`` of documents
with the highest sums is kept: sampling without replacement in proportion to the weights.

The target model may be fitted on at most ``MAX_LABELS`` labelled documents, those with the smallest hashes
of their ids; the raw model counts everything.  A task sends one pair of count vectors.  The cut is
found exactly, without a global sort: scores become 64-bit keys, and counts of 16 bits at a time narrow
down the key of the last document that is kept.

Null and empty texts have no n-grams: weight 0, and never kept.  Null ids share one draw of noise.  Ties,
which need equal keys, are all kept.  Repeated rows are separate documents and equal texts of
different ids have equal weights but not equal noise.  Labels that are null or of unknown ids do nothing; with no
good label the target is the raw model, and noise alone decides.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import binaries, ids_of, rowwise, saved
from skyledger.llm.words import Words, buffers, inside_windows, mixed, pieces, window_hashes, word_hashes, words_of

BUCKETS = 1 << 14
MAX_LABELS = 200_000
_SLICES = 4


def _buckets(column: pa.Array) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray]]:
    """For pieces of a column: its first row, its words, and the buckets of words and of pairs by place."""
    raw, offsets = buffers(column)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    for i, j in pieces(offsets):
        words = words_of(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        hashes = word_hashes(words, fold=True)
        pairs = (window_hashes(hashes, 2) >> shift).astype(np.int64)
        yield i, words, (hashes >> shift).astype(np.int64), np.where(inside_windows(words, 2), pairs, -1)


def models(docs: DataFrame, good: DataFrame, id_col: str, text_col: str, max_labels: int = MAX_LABELS) -> np.ndarray:
    """Log ratios of the target and the raw model, one for each bucket."""
    spark = docs.sparkSession
    ids = good.select(F.col("doc_id").cast("bigint")).where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    known = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in ids.collect()], dtype=np.int64)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), dtype=np.int64)
        for b in batches:
            chosen = np.isin(ids_of(b.column("doc_id")), known.value) & b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for i, words, ones, twos in _buckets(rowwise(b, "text")):
                own = np.repeat(chosen[i : i + len(words.first) - 1], words.counts)
                for places in (ones, twos):
                    used = places >= 0
                    total[0] += np.bincount(places[used], minlength=BUCKETS)
                    total[1] += np.bincount(places[used & own[: len(places)]], minlength=BUCKETS)
        yield pa.record_batch({"slice": pa.array(range(_SLICES), pa.int32()), "counts": binaries(np.split(total, _SLICES, axis=1))})

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()], axis=0)
        return pa.table({"slice": table.column("slice")[:1], "counts": binaries([total])})

    schema = "slice int, counts binary"
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    total = np.zeros((2, BUCKETS))
    step = BUCKETS // _SLICES
    for k, counts in source.mapInArrow(count, schema).groupBy("slice").applyInArrow(add, schema).collect():
        total[:, k * step : (k + 1) * step] = np.frombuffer(counts, np.int64).reshape(2, step)
    if not total[1].any():
        return np.zeros(BUCKETS)
    share = (total + 1) / (total + 1).sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def _sortable(score: np.ndarray) -> np.ndarray:
    """Doubles as signed integers in the same order."""
    bits = score.view(np.int64)
    return np.where(bits >= 0, bits, bits ^ np.int64(0x7FFFFFFFFFFFFFFF))


def _noise(ids: np.ndarray, seed: int) -> np.ndarray:
    """Standard Gumbel draws."""
    u = (mixed(mixed(ids.view(np.uint64)) ^ np.uint64(seed)) >> np.uint64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) / 2.0**53))


SCORED = "doc_id bigint, n_words bigint, log_weight double, score double, key bigint"


def scores(docs: DataFrame, ratio: np.ndarray, seed: int, id_col: str, text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = ids_of(b.column("doc_id"))
            for i, words, ones, twos in _buckets(rowwise(b, "text")):
                m = len(words.first) - 1
                gain = sent.value[ones]
                gain[: len(twos)] += np.where(twos >= 0, sent.value[twos], 0.0)
                total = np.concatenate(([0.0], np.cumsum(gain)))
                weight = np.zeros(m)
                for k in range(m):  # a sum of its own for each text, so that equal texts get equal sums
                    weight[k] = gain[words.first[k] : words.first[k + 1]].sum()
                own = ids[i : i + m]
                score = weight + _noise(own, seed)
                yield pa.record_batch([b.column("doc_id").slice(i, m), pa.array(words.counts), pa.array(weight), pa.array(score), pa.array(_sortable(score))], names=["doc_id", "n_words", "log_weight", "score", "key"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCORED)


def key_of_rank(keys: DataFrame, rank: int) -> int | None:
    """The ``rank``-th largest value (from 1) of a bigint column ``key``, by counts of 16 bits at a time."""
    found, left = 0, rank
    rows = keys
    for level in range(4):
        part = F.shiftright("key", 48 - 16 * level).bitwiseAND(F.lit(0xFFFF))
        if level == 0:
            part = F.shiftright("key", 48) + F.lit(0x8000)
        counts = rows.groupBy(part.alias("part")).count().orderBy(F.desc("part")).collect()  # at most 65,536 rows
        for value, n in counts:
            if left <= n:
                break
            left -= n
        else:
            return None
        digit = value - 0x8000 if level == 0 else value
        found = (found << 16) + digit
        rows = rows.where(F.shiftright("key", 48 - 16 * level) == found)
    return found


def resample(
    docs: DataFrame, labels: DataFrame, fraction: float | None = None, seed: int = 1, max_labels: int = MAX_LABELS,
    id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, log_weight, score, kept.

    Without ``fraction``, as large a part of the documents is kept as labels call good.
    """
    if fraction is None:
        fraction = labels.agg(F.avg((F.col(quality_col) == 1).cast("double"))).first()[0]
        fraction = 1.0 if fraction is None else fraction
    good = labels.where(F.col(quality_col) == 1).select(F.col(id_col).alias("doc_id"))
    ratio = models(docs, good, id_col, text_col, max_labels)
    rows = saved(scores(docs, ratio, seed, id_col, text_col), "scores")
    some = rows.where("n_words > 0")
    want = int(fraction * rows.count() + 0.5)
    total = some.count()
    least = key_of_rank(some, min(want, total)) if want and total else None
    kept = F.lit(False) if least is None else (F.col("n_words") > 0) & (F.col("key") >= least)
    return rows.select("doc_id", "n_words", "log_weight", "score", kept.alias("kept"))
