"""Phrase collocations per language, by weighted acyclic automata of phrase counts.

Texts are lower-cased (A-Z only), split at ``[.,;:!?]`` and line ends into pieces, and pieces at spaces and tabs into
words.  Per language, f counts a phrase's contiguous occurrences within pieces.  Phrases of two or three
words with f >= ``min_count`` are candidates.  Cutting one after its first k words gives the counts l and r of both
parts and the score floor(10**6 * f * f / (l * r)); the lowest score over the cuts counts, and of equal scores the smallest
k.  A candidate whose words lie within a longer candidate with 100 * f(longer) >= ``inside_percent`` * f is dropped.  The
first ``top`` of each language are reported.

How it runs.
1. Shards: a task counts the one, two and three word phrases of some megabytes of text, sorts them, and builds count
   transducers from them (``automata``), one for each prefix range: a range of hashes of the language and the
   first one or two words.  The first label is the language, so a language of any size is spread over all ranges.
2. Union: the transducers of a range are united and weights summed; phrases below ``min_count`` go.  There is a range for
   every few megabytes of text, so a group that a task holds is small.  Beyond ``WIDE`` ranges, shards are cut by wide
   ranges, some shards of a wide range are united at a time, and their union is cut by narrow ranges.
3. Parts: what is left is small, so ranges next to each other are put together.  Each such range asks for the counts of the
   parts of its candidates: an automaton of parts goes to the range that counts them and is composed with the
   transducer there.  A part is asked for once by a range, however many candidates have it.  Asks carry the
   largest count of the longer candidates around a phrase, so the range that counts it also learns what is dropped.
4. Scores are computed with whole numbers of any size, and ranked by a window that keeps ``top`` rows of each language a task.

Null languages are ``und``.  Null and empty texts have no words.  Repeated rows count as often as they occur; ids are
not read, and other columns are ignored.  Languages without a candidate, and empty tables, give no rows.
Bytes that are no UTF-8 are counted as they are and shown as U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import automata
from skyledger.llm.common import ranges, rowwise, saved
from skyledger.llm.words import FOLD, U64, WORD_BYTE, Words, buffers, give_back, mixed, pieces, span_hashes, words_of

#: Bytes of text in a shard, and for which there is one range; bytes for which there is one range of what is left.
SHARD = 4 << 20
RANGE = 4 << 20
LEFT = 64 << 20
#: Up to so many ranges, shards are cut by them at once.
WIDE = 256
NO_LANGUAGE = "und"

#: Punctuation that ends a piece, as a line end, like the line ends themselves.
_ENDS = np.arange(256, dtype=np.uint8)
_ENDS[list(b".,;:!?")] = 0x0A
_FACTOR = U64(0xA0761D6478BD642F)

PACKED = "bucket bigint, salt int, automaton binary"
MERGED = "bucket bigint, automaton binary"
SENT = "bucket bigint, asker bigint, kind int, automaton binary"
SCORED = "lang string, phrase string, a bigint, l bigint, r bigint, score bigint"
ASKED, ANSWERED, DROPPED = 0, 1, 2


def _buckets(words: pa.Array, rows: np.ndarray, buckets: int) -> np.ndarray:
    """The prefix range of each row (language, one to three words): by language and first word, or first two words."""
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    each = span_hashes(np.frombuffer(data or b"", np.uint8), bounds[:-1], bounds[1:])
    key = mixed(each[rows[:, 0]] * _FACTOR + each[rows[:, 1]])
    longer = rows[:, 2] >= 0
    key[longer] = mixed(key[longer] * _FACTOR + each[rows[longer, 2]])
    return ranges(key, buckets)


def _labels(words: Words, langs: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All different words and languages, sorted, and the labels of the words and of the languages."""
    inside = WORD_BYTE[words.raw]
    offsets = np.concatenate(([0], np.cumsum(words.end - words.begin)))
    each = pa.Array.from_buffers(pa.large_binary(), len(words.begin), [None, pa.py_buffer(offsets), pa.py_buffer(words.raw[inside].tobytes())])
    coded = pa.concat_arrays([each, pa.array(langs, pa.large_binary())]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    label = rank[coded.indices.to_numpy()]
    n = len(words.begin)
    return coded.dictionary.take(pa.array(order)), label[:n], label[n:]


def counted(raw: np.ndarray, offsets: np.ndarray, langs: list[bytes], of: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, sorted rows (language, one to three words) and counts of all phrases of some texts; ``of`` is each text's language."""
    words = words_of(_ENDS[FOLD[raw]], offsets)
    names, word, lang = _labels(words, langs)
    n, size = len(word), len(names)
    owner = words.owner()
    ends = np.concatenate(([0], np.cumsum((words.raw >= 0x0A) & (words.raw <= 0x0D), dtype=np.int64)))
    together = np.zeros(n, dtype=bool)
    together[:-1] = (owner[1:] == owner[:-1]) & (ends[words.begin[1:]] == ends[words.end[:-1]])
    # Each kind of phrase is numbered in order, with the number of the phrase one word shorter first.
    one, at, n_one = np.unique(lang[of[owner]] * size + word, return_inverse=True, return_counts=True)
    start = np.flatnonzero(together)
    two, at_two, n_two = np.unique(at[start] * size + word[np.minimum(start + 1, n - 1)], return_inverse=True, return_counts=True)
    pair = np.full(n, -1, dtype=np.int64)
    pair[start] = at_two
    start = start[together[np.minimum(start + 1, n - 1)]]
    three, n_three = np.unique(pair[start] * size + word[np.minimum(start + 2, n - 1)], return_counts=True)
    # In sorted order a phrase comes before those that it begins.
    above_two, above_three = two // max(size, 1), three // max(size, 1)
    at_three = np.arange(len(three)) + above_three + above_two[above_three] + 2
    at_two = np.arange(len(two)) + above_two + 1 + np.searchsorted(above_three, np.arange(len(two)))
    at_one = np.arange(len(one)) + np.searchsorted(above_two, np.arange(len(one))) + np.searchsorted(above_two[above_three], np.arange(len(one)))
    rows = np.full((len(one) + len(two) + len(three), automata.DEPTH), -1, dtype=np.int32)
    counts = np.empty(len(rows), dtype=np.int64)
    firsts = np.stack([one // max(size, 1), one % max(size, 1)], axis=1)
    rows[at_one, :2], counts[at_one] = firsts, n_one
    rows[at_two, :2], rows[at_two, 2], counts[at_two] = firsts[above_two], two % max(size, 1), n_two
    rows[at_three, :3], rows[at_three, 3], counts[at_three] = rows[at_two[above_three], :3], three % max(size, 1), n_three
    return names, rows, counts


def _with_totals(part: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by part, with one more for each part and language: all words that the part counts for it."""
    order = np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")
    part, rows, weights = part[order], rows[order], weights[order]
    start = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (rows[1:, 0] != rows[:-1, 0])))[: len(part)])
    single = np.where(rows[:, 2] < 0, weights, 0)
    total = np.add.reduceat(single, start) if len(start) else start
    start, total = start[total > 0], total[total > 0]
    heads = np.full((len(start), automata.DEPTH), -1, dtype=np.int32)
    heads[:, 0] = rows[start, 0]
    return np.insert(part, start, part[start]), np.insert(rows, start, heads, axis=0), np.insert(weights, start, total)


def _united(blobs: list[bytes], min_count: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    words, rows, weights = automata.union([automata.read(x) for x in blobs])
    keep = (weights >= min_count) | (rows[:, 1] < 0)
    return words, rows[keep], weights[keep]


def _one(words: pa.Array, rows: np.ndarray, weights: np.ndarray) -> bytes:
    return automata.build(words, np.zeros(len(rows), np.int64), rows, weights)[0][1]


def _table(schema: str, *columns: list) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def _held(table: pa.Table, min_count: int) -> pa.Table:
    """The automata of one range as one, without rare phrases; no row if nothing is left."""
    found = _united(table.column("automaton").to_pylist(), min_count)
    return _table(MERGED, [table.column("bucket")[0].as_py()], [_one(*found)]) if len(found[1]) else _table(MERGED, [], [])


def _asked(rows: np.ndarray, weights: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts of all candidates, each once, with one more than the largest count of a longer candidate around it (else 1)."""
    rows, weights = rows[rows[:, 2] >= 0], weights[rows[:, 2] >= 0]
    none = np.full(len(rows), -1, dtype=np.int32)
    three = rows[:, 3] >= 0
    last = np.where(three, rows[:, 3], rows[:, 2])
    single = np.ones(len(rows), dtype=np.int64)
    parts = [
        (np.stack([rows[:, 0], rows[:, 1], none, none], axis=1), single),
        (np.stack([rows[:, 0], last, none, none], axis=1), single),
        (np.stack([rows[:, 0], rows[:, 1], rows[:, 2], none], axis=1)[three], weights[three] + 1),
        (np.stack([rows[:, 0], rows[:, 2], rows[:, 3], none], axis=1)[three], weights[three] + 1),
    ]
    return automata.summed(np.concatenate([p for p, _ in parts]), np.concatenate([w for _, w in parts]), n_words, largest=True)


def scores(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[int]:
    """floor(10**6 * a * a / (left * right)) with whole numbers of any size."""
    return [1_000_000 * x * x // (y * z) for x, y, z in zip(a.tolist(), left.tolist(), right.tolist(), strict=True)]


def _scored(own: automata.Automaton, answers: list[bytes], dropped: list[bytes]) -> pa.Table:
    rows, weights = own.sequences()
    texts = [w.decode("utf-8", "replace") for w in own.words.to_pylist()]
    totals, totals_n = rows[rows[:, 1] < 0], weights[rows[:, 1] < 0]
    at = rows[:, 2] >= 0
    rows, a = rows[at], weights[at]
    out: list[list] = [[texts[k] for k in totals[:, 0].tolist()], [None] * len(totals), totals_n.tolist(), [None] * len(totals), [None] * len(totals), [None] * len(totals)]
    if dropped:
        words, gone, ones = automata.union([automata.read(x) for x in dropped])
        gone = automata.read(_one(words, gone, ones))
        labels = gone.labels_of(own.words)
        lost = gone.weights_of(np.where(rows >= 0, labels[rows], -1)) > 0
        # Words that the other automaton lacks must not end a row early.
        lost &= ((rows < 0) | (labels[rows] >= 0)).all(axis=1)
        rows, a = rows[~lost], a[~lost]
    if len(rows):
        words, known, counts = automata.union([automata.read(x) for x in answers])
        parts = automata.read(_one(words, known, counts))
        rows_there = np.where(rows >= 0, parts.labels_of(own.words)[rows], -1)
        lang, none = rows_there[:, :1], np.full((len(rows), 1), -1)
        three = rows[:, 3] >= 0
        left = parts.weights_of(np.hstack([lang, rows_there[:, 1:2], none, none]))
        right = parts.weights_of(np.where(three[:, None], np.hstack([lang, rows_there[:, 2:4], none]), np.hstack([lang, rows_there[:, 2:3], none, none])))
        score = scores(a, left, right)
        # The second cut of three words counts if it scores lower.
        other = np.flatnonzero(three)
        left_two = parts.weights_of(np.hstack([rows_there[other, :3], none[other]]))
        right_two = parts.weights_of(np.hstack([lang[other], rows_there[other, 3:4], none[other], none[other]]))
        for k, x, y, z in zip(other.tolist(), scores(a[other], left_two, right_two), left_two.tolist(), right_two.tolist(), strict=True):
            if x < score[k]:
                score[k], left[k], right[k] = x, y, z
        phrases = [" ".join(texts[k] for k in row if k >= 0) for row in rows[:, 1:].tolist()]
        for column, values in zip(out, ([texts[k] for k in rows[:, 0].tolist()], phrases, a.tolist(), left.tolist(), right.tolist(), score), strict=True):
            column += values
    return _table(SCORED, *out)


def phrase_counts(docs: DataFrame, min_count: int = 10, text_col: str = "text", lang_col: str = "lang", shard: int = SHARD, per_range: int = RANGE, wide: int = WIDE) -> DataFrame:
    """Count transducers (bucket, automaton) of all phrases of up to three words with at least ``min_count`` occurrences.

    Beside them, each transducer has for every language the number of all word occurrences that its range counts.
    """
    return _counts(docs, _layout(docs, text_col, per_range, wide), min_count, text_col, lang_col, shard)


def _layout(docs: DataFrame, text_col: str, per_range: int, wide: int) -> tuple[int, int]:
    """How many wide ranges there are, and narrow ones in each; by the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0
    ranges = max(1, ceil(total / per_range))
    if ranges <= wide:
        return ranges, 1
    return ceil(ranges**0.5), ceil(ranges / ceil(ranges**0.5))


def _counts(docs: DataFrame, layout: tuple[int, int], min_count: int, text_col: str, lang_col: str, shard: int) -> DataFrame:
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text"))
    wide, narrow = layout

    def cut(names: pa.Array, rows: np.ndarray, counts: np.ndarray, ranges: int, salt: int) -> pa.Table:
        packs = automata.build(names, *_with_totals(_buckets(names, rows, ranges), rows, counts))
        return _table(PACKED, [k for k, _ in packs], [salt] * len(packs), [x for _, x in packs])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() if TaskContext.get() else 0
        for b in batches:
            raw, offsets = buffers(rowwise(b, "text"))
            coded = rowwise(b, "lang").cast(pa.large_binary()).dictionary_encode()
            langs, of = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for i, j in pieces(offsets, shard):
                found = counted(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], langs, of[i:j])
                number += 1
                if len(found[1]):
                    # Of a wide range, a narrow range's worth of shards is united at a time.
                    yield from cut(*found, wide, number % narrow).to_batches()

    def unite(table: pa.Table) -> pa.Table:
        give_back()
        words, rows, weights = automata.union([automata.read(x) for x in table.column("automaton").to_pylist()])
        counted_here = rows[:, 1] >= 0
        return cut(words, rows[counted_here], weights[counted_here], wide * narrow, 0)

    def finish(table: pa.Table) -> pa.Table:
        give_back()
        return _held(table, min_count)

    packed = source.mapInArrow(shards, PACKED)
    if narrow > 1:
        packed = packed.groupBy("bucket", "salt").applyInArrow(unite, PACKED)
    return packed.groupBy("bucket").applyInArrow(finish, MERGED)


def collocations(
    docs: DataFrame, min_count: int = 10, inside_percent: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
    shard: int = SHARD, per_range: int = RANGE, left: int = LEFT, wide: int = WIDE,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score) of the first ``top`` phrases of each language."""
    layout = _layout(docs, text_col, per_range, wide)
    buckets = layout[0] * layout[1]
    fine = saved(_counts(docs, layout, min_count, text_col, lang_col, shard), "phrases")
    together = max(1, left // per_range)
    coarse = fine.withColumn("bucket", F.floor(F.col("bucket") / together))

    def put_together(table: pa.Table) -> pa.Table:
        return _held(table, min_count)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for asker, blob in zip(b.column("bucket").to_pylist(), b.column("automaton").to_pylist(), strict=True):
                own = automata.read(blob)
                rows, weights = _asked(*own.sequences(), len(own.words))
                if not len(rows):
                    continue
                to = _buckets(own.words, rows, buckets) // together
                order = np.argsort(to, kind="stable")
                packs = automata.build(own.words, to[order], rows[order], weights[order])
                yield from _table(SENT, [k for k, _ in packs], [asker] * len(packs), [ASKED] * len(packs), [x for _, x in packs]).to_batches()

    def answer(own: pa.Table, asks: pa.Table) -> pa.Table:
        """Counts of the parts that other ranges ask for, and which of the phrases counted here are dropped."""
        out: list[list] = [[], [], [], []]
        if not own.num_rows or not asks.num_rows:
            return _table(SENT, *out)
        bucket, counts = own.column("bucket")[0].as_py(), automata.read(own.column("automaton")[0].as_py())
        gone = []
        for asker, blob in zip(asks.column("asker").to_pylist(), asks.column("automaton").to_pylist(), strict=True):
            query = automata.read(blob)
            rows, around, found = counts.compose(query)
            rows, weights = automata.summed(rows, np.stack([around, found], axis=1), len(query.words), largest=True)
            around, found = weights[:, 0], weights[:, 1]
            for column, value in zip(out, (asker, bucket, ANSWERED, _one(query.words, rows, found)), strict=True):
                column.append(value)
            inside = (rows[:, 2] >= 0) & (100 * (around - 1) >= inside_percent * found)
            if inside.any():
                gone.append(automata.read(_one(query.words, rows[inside], np.ones(inside.sum(), np.int64))))
        if gone:
            for column, value in zip(out, (bucket, bucket, DROPPED, _one(*automata.union(gone, largest=True))), strict=True):
                column.append(value)
        return _table(SENT, *out)

    def score(own: pa.Table, sent: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _table(SCORED, [], [], [], [], [], [])
        kinds, blobs = sent.column("kind").to_pylist(), sent.column("automaton").to_pylist()
        by_kind = {k: [x for kind, x in zip(kinds, blobs, strict=True) if kind == k] for k in (ANSWERED, DROPPED)}
        return _scored(automata.read(own.column("automaton")[0].as_py()), by_kind[ANSWERED], by_kind[DROPPED])

    held = saved(coarse.groupBy("bucket").applyInArrow(put_together, MERGED), "phrase-ranges")
    asks = held.mapInArrow(ask, SENT)
    sent = held.groupBy("bucket").cogroup(asks.groupBy("bucket")).applyInArrow(answer, SENT)
    scored = saved(held.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(score, SCORED), "scored-phrases")
    totals = scored.where("phrase is null").groupBy("lang").agg(F.sum("a").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.where("phrase is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
