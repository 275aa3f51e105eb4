"""Quality rules: a suffix array over the words of each text finds what it says more than once.

Suffixes of many texts are sorted together by prefix doubling: a round sorts by the ranks of two
neighbouring halves, and only suffixes that still share their rank go on.  The longest common
prefix of neighbouring suffixes bounds the intervals of the array; a maximal repeat is the common
prefix of such an interval.  The spans of all maximal repeats of at least ``min_repeat`` words are
united.  A text is kept if it passes the base rules, if the united spans cover no more than
``max_covered`` of its words, and if its longest repeat has no more than ``max_longest`` words.

Texts never meet each other, so nothing is shuffled.  Memory of a task is some megabytes of text
at a time (``PIECE``), or one text if that is longer: about 300 bytes a word and doubling round.
Null and empty texts have no words and fail the base rules; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import rowwise, runs
from skyledger.llm.words import Words, buffers, pieces, span_hashes, word_hashes, words_of

#: Bytes of text whose suffixes are sorted together.
PIECE = 2 << 20

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


@dataclass(frozen=True)
class Limits:
    """Base rules and the limits of the repetition rule."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_repeat: int = 10
    max_covered: float = 0.3
    max_longest: int = 100


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and for each place of that order the place where its run begins."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = runs(key)
    return order, np.repeat(start, np.diff(np.append(start, len(key))))


def suffix_array(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all texts in order, and the longest common prefix of each with the one before.

    Words are ordered by hash, not by spelling: any fixed order gives the same repeats.  Suffixes
    of one text stand together and have no prefix in common with those of another.
    """
    n = int(words.first[-1])
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = words.owner()
    last = words.first[1:][owner]  # end of the text of each word
    order, rank_at = _ranked(word_hashes(words))
    dense = np.empty(n, dtype=np.int64)
    dense[order] = rank_at
    order, rank_at = _ranked(owner * n + dense)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order] = rank_at
    rank[n] = -1
    levels = [rank.astype(np.int32)]
    suffixes, h = order, 1
    size = np.diff(np.append(runs(rank_at), n))
    open_ = np.flatnonzero(np.repeat(size > 1, size))  # places whose rank is shared
    while len(open_):
        at = suffixes[open_]
        after = np.where(at + h < last[at], rank[np.minimum(at + h, n)], -1)
        group = rank_at[open_]
        again = np.lexsort((after, group))
        at, after, group = at[again], after[again], group[again]
        suffixes[open_] = at  # groups are runs of places, so they stay where they were
        new = np.ones(len(at), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        cut = np.flatnonzero(new)
        size = np.diff(np.append(cut, len(at)))
        rank_at[open_] = np.repeat(open_[cut], size)
        rank[at] = rank_at[open_]
        levels.append(rank.astype(np.int32))
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    # Common prefixes: walk the rounds from the widest to the narrowest.
    common = np.zeros(n, dtype=np.int64)
    pair = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]]) + 1
    x, y = suffixes[pair - 1].copy(), suffixes[pair].copy()
    length = np.zeros(len(pair), dtype=np.int64)
    end_x, end_y = last[x], last[y]
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        inside = (x + step <= end_x) & (y + step <= end_y)
        same = inside & (levels[k][np.minimum(x, n)] == levels[k][np.minimum(y, n)])
        x[same] += step
        y[same] += step
        length[same] += step
    common[pair] = length
    return suffixes, common


def repeats(words: Words) -> np.ndarray:
    """For each word, how long the longest sequence is that begins here and also elsewhere in its text."""
    suffixes, common = suffix_array(words)
    deepest = np.maximum(common, np.append(common[1:], 0)) if len(common) else common
    out = np.empty(len(suffixes), dtype=np.int64)
    out[suffixes] = deepest
    return out


def _united(begin: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + length, -1)
    return np.cumsum(edge[:n]) > 0


def _by_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def _dup_lines(raw: np.ndarray, offsets: np.ndarray) -> list[int]:
    data = raw.tobytes()
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        lines = [x for x in data[a:b].split(b"\n") if x and not x.isspace()]
        out.append(len(lines) - len(set(lines)))
    return out


def measure(raw: np.ndarray, offsets: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    words = words_of(raw, offsets)
    n = int(words.first[-1])
    longest = repeats(words)
    chars = np.zeros(len(raw) + 1, dtype=np.int64)
    inside = np.zeros(len(raw) + 1, dtype=np.int8)
    inside[words.begin] += 1
    inside[words.end] -= 1
    np.cumsum((np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((raw & 0xC0) != 0x80), out=chars[1:])
    signs = np.concatenate(([0], np.cumsum(SYMBOLS[raw], dtype=np.int64)))
    triple = np.flatnonzero(longest >= 3)
    wide = np.flatnonzero(longest >= limits.min_repeat)
    counts = words.counts
    filled = counts > 0
    top = np.zeros(len(counts), dtype=np.int64)
    if filled.any():
        top[filled] = np.maximum.reduceat(longest, words.first[:-1][filled])
    out = {
        "n_words": counts,
        "word_chars": chars[offsets[1:]] - chars[offsets[:-1]],
        "n_symbols": signs[offsets[1:]] - signs[offsets[:-1]],
        "n_dup_lines": np.array(_dup_lines(raw, offsets), dtype=np.int64),
        "n_repeat_words": _by_text(_united(triple, np.full(len(triple), 3), n), words.first),
        "n_covered": _by_text(_united(wide, longest[wide], n), words.first),
        "longest_repeat": top,
    }
    base = (counts < limits.min_words) | (100 * out["n_repeat_words"] > limits.max_repeat_percent * counts)
    out["base_failed"] = base
    out["kept"] = ~base & (out["n_covered"] <= limits.max_covered * counts) & (top <= limits.max_longest)
    return out


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")
RESULT = "doc_id bigint, " + ", ".join(f"{x} bigint" for x in NAMES) + ", base_failed boolean, kept boolean"


def _measured(batch: pa.RecordBatch, limits: Limits) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    raw, offsets = buffers(rowwise(batch, "text"))
    for i, j in pieces(offsets, PIECE):
        yield i, j, measure(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], limits)


def judge(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its measures, whether it fails the base rules, and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for i, j, m in _measured(b, limits):
                yield pa.record_batch([ids.slice(i, j - i), *(pa.array(m[x]) for x in (*NAMES, "base_failed", "kept"))], names=["doc_id", *NAMES, "base_failed", "kept"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [m["kept"] for _, _, m in _measured(pa.record_batch([b.column(at)], names=["text"]), limits)]
            yield b.filter(pa.array(np.concatenate(good) if good else np.zeros(0, dtype=bool)))

    return docs.mapInArrow(run, docs.schema)
