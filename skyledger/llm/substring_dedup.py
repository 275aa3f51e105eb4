"""Substring dedup: remove token windows that an earlier document already has.

Rabin-Karp hashes of every window of ``width`` words are counted in Spark: windows meet by hash,
and a word is removed when a window that covers it also starts in a document with a smaller id.
Overlapping windows merge into maximal removal intervals.

How it runs.  A task hashes some megabytes of text at a time.  Windows that it holds twice are
settled there (the smallest id stays), so a window that every document has is one entry a piece.
The rest goes to ``buckets`` by hash range, packed as arrays: eight bytes for the hash and about
one for the place.  A bucket sorts its hashes and returns the places that lose.  Only documents
that lose words are then shuffled, with their places; a bitmap of fixed size tells which.

Null or empty texts have no words and lose none.  A null id ranks as 2**63 - 1, and rows that
share an id never take words from each other.  Texts shorter than a window lose nothing.  Other
columns are ignored.  Equal hashes of different windows (2**-64 a pair) are taken for equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import NO_ID, binaries, bitmap, ids_of, in_bitmap, joined, rowwise, runs, saved
from skyledger.llm.volume import buckets_for
from skyledger.llm.words import buffers, give_back, inside_windows, mixed, pieces, window_hashes, word_hashes, words_of

PACKED = "bucket int, ids binary, marks binary, counts binary, hashes binary, steps binary, jumps binary, lost binary"
LOST = "home int, ids binary, marks binary, counts binary, places binary"
PLACES = "doc_id bigint, mark int, places binary"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, text string"


def _home(ids: np.ndarray, marks: np.ndarray, homes: int) -> np.ndarray:
    """Spread documents evenly: ids may have a common stride or be null."""
    return (mixed(ids.view(np.uint64) ^ mixed(marks.astype(np.int64).view(np.uint64))) % np.uint64(homes)).astype(np.int64)


def _packed_rows(ids, marks, raw, offsets, width: int, buckets: int) -> list[tuple]:
    words = words_of(raw, offsets)
    hashes = window_hashes(word_hashes(words), width)
    inside = inside_windows(words, width)
    place = np.flatnonzero(inside)
    if not len(place):
        return []
    h = hashes[place]
    doc = np.searchsorted(words.first, place, side="right") - 1
    within = (place - words.first[doc]).astype(np.int64)
    order = np.argsort(h)
    sorted_h, sorted_id = h[order], ids[doc[order]]
    start = runs(sorted_h)
    size = np.diff(np.append(start, len(order)))
    least = np.repeat(np.minimum.reduceat(sorted_id, start), size)
    lost = np.zeros(len(h), dtype=bool)
    lost[order[sorted_id > least]] = True
    out = []
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    for kind, keep in ((False, np.flatnonzero(~lost)), (True, np.flatnonzero(lost))):
        # What was lost here needs no hash and may go anywhere: its document says where.
        to = (_home(ids[doc[keep]], marks[doc[keep]], buckets) if kind else bucket[keep]).astype(np.uint16 if buckets < 65536 else np.int64)
        keep = keep[np.argsort(to, kind="stable")]
        to = np.sort(to, kind="stable")
        cut = np.append(runs(to), len(to))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            at = keep[a:b]
            d = doc[at]
            first = runs(d)
            step = np.diff(within[at], prepend=0)
            step[first] = within[at[first]]
            empty = np.zeros(0, np.uint8)
            out.append((
                int(to[a]), ids[d[first]], marks[d[first]], np.diff(np.append(first, len(d))).astype(np.uint32),
                empty if kind else h[at], np.minimum(step, 255).astype(np.uint8), step[step >= 255].astype(np.uint32),
                np.array([kind], np.uint8),
            ))
    return out


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    counts = np.frombuffer(row["counts"], np.uint32)
    ids = np.repeat(np.frombuffer(row["ids"], np.int64), counts)
    marks = np.repeat(np.frombuffer(row["marks"], np.int32), counts)
    step = np.frombuffer(row["steps"], np.uint8).astype(np.int64)
    step[step == 255] = np.frombuffer(row["jumps"], np.uint32)
    total = np.cumsum(step)
    first = np.cumsum(counts.astype(np.int64)) - counts
    return ids, marks, np.frombuffer(row["hashes"], np.uint64), (total - np.repeat(total[first] - step[first], counts)).astype(np.uint32)


def _settled(ids: np.ndarray, marks: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places sorted by document, and where each document begins."""
    order = np.lexsort((places, marks, ids))
    ids, marks, places = ids[order], marks[order], places[order]
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])
    return ids, marks, places, np.flatnonzero(new)


def _losers(table: pa.Table, homes: int) -> pa.Table:
    """Of one bucket, the places of windows that also start in a document with a smaller id.

    They leave in packs, one for each ``home`` that gathers the places of its documents.
    """
    give_back()
    rows = [{name: table.column(name)[i].as_buffer() for name in table.column_names if name != "bucket"} for i in range(table.num_rows)]
    settled = [np.frombuffer(r["lost"], np.uint8)[0] == 1 for r in rows]
    open_ = [_unpack(r) for r, s in zip(rows, settled, strict=True) if not s]
    parts = [(i, m, p) for i, m, _, p in (_unpack(r) for r, s in zip(rows, settled, strict=True) if s)]
    if open_:
        h = np.concatenate([x[2] for x in open_])
        order = np.argsort(h)
        h = h[order]
        same = h[1:] == h[:-1]
        twice = np.zeros(len(h), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        order, h = order[twice], h[twice]
        ids = np.concatenate([x[0] for x in open_])[order]
        if len(h):
            start = runs(h)
            least = np.repeat(np.minimum.reduceat(ids, start), np.diff(np.append(start, len(h))))
            late = ids > least
            order, ids = order[late], ids[late]
            parts.append((ids, np.concatenate([x[1] for x in open_])[order], np.concatenate([x[3] for x in open_])[order]))
    ids, marks, places = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
    ids, marks, places, first = _settled(ids, marks, places)
    home = _home(ids[first], marks[first], homes)
    chunks = np.split(places, first[1:]) if len(first) else []
    packs = []
    for k in np.unique(home):
        own = np.flatnonzero(home == k)
        counts = np.array([len(chunks[x]) for x in own], dtype=np.uint32)
        packs.append((k, ids[first[own]], marks[first[own]].astype(np.int32), counts, np.concatenate([chunks[x] for x in own]).astype(np.uint32)))
    return pa.table([pa.array([x[0] for x in packs], pa.int32()), *(binaries([x[k] for x in packs]) for k in range(1, 5))], names=["home", "ids", "marks", "counts", "places"])


def _by_document(table: pa.Table) -> pa.Table:
    """The packs of one home as one row for each document."""
    counts = joined(table.column("counts"), "u4")
    ids = np.repeat(joined(table.column("ids"), "i8"), counts)
    marks = np.repeat(joined(table.column("marks"), "i4"), counts)
    ids, marks, places, first = _settled(ids, marks, joined(table.column("places"), "u4"))
    return pa.table({
        "doc_id": pa.array(ids[first], pa.int64()), "mark": pa.array(marks[first], pa.int32()), "places": binaries(np.split(places, first[1:]) if len(first) else []),
    })


def _cut(words, row: int, places: np.ndarray, width: int) -> tuple[list[dict], str]:
    """Removal intervals of one text, and its kept words joined by one space."""
    n = int(words.counts[row])
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + width, -1)
    gone = np.cumsum(edge[:n]) > 0
    flips = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    spans = [{"start": int(a), "end": int(b)} for a, b in zip(flips[::2], flips[1::2], strict=True)]
    first = int(words.first[row])
    keep = np.flatnonzero(~gone) + first
    text = words.raw.tobytes()
    kept = b" ".join(text[words.begin[k] : words.end[k]] for k in keep)
    return spans, kept.decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: its words, the removed ones, their intervals, and the kept words.

    ``spans`` are word positions [start, end); ``text`` joins the kept words with one space.
    """
    if width < 1:
        raise ValueError("width must be at least 1")
    spark = docs.sparkSession
    buckets = buckets or buckets_for(docs, text_col)
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.hash(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = buffers(rowwise(b, "text"))
            ids, marks = ids_of(b.column("doc_id")), np.asarray(b.column("mark"), dtype=np.int32)
            for i, j in pieces(offsets):
                rows = _packed_rows(ids[i:j], marks[i:j], raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width, buckets)
                if rows:
                    yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), *(binaries([r[k] for r in rows]) for k in range(1, 8))], names=PACKED_NAMES)

    lost = source.mapInArrow(packed, PACKED).groupBy("bucket").applyInArrow(lambda table: _losers(table, buckets), LOST)
    places = saved(lost.groupBy("home").applyInArrow(_by_document, PLACES), "places")
    bits = spark.sparkContext.broadcast(bitmap(places.select("doc_id")))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that lose nothing."""
        for b in batches:
            b = b.filter(pa.array(~in_bitmap(bits.value, ids_of(b.column("doc_id")))))
            kept = [b" ".join(t.encode().split()) if t else b"" for t in b.column("text").to_pylist()]
            n = [k.count(b" ") + 1 if k else 0 for k in kept]
            yield pa.record_batch([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.zeros(len(n), np.int64)), pa.array([[]] * len(n), SPANS), pa.array([k.decode() for k in kept], pa.string())], names=RESULT_NAMES)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bitmap(bits.value, ids_of(b.column("doc_id")))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = buffers(rowwise(b, "text"))
            lists = b.column("places").to_pylist()
            for i, j in pieces(offsets, 1 << 20):
                words = words_of(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                spans, texts = [], []
                for k in range(j - i):
                    at = np.frombuffer(lists[i + k] or b"", np.uint32).astype(np.int64)
                    s, t = _cut(words, k, at, width)
                    spans.append(s)
                    texts.append(t)
                gone = [sum(x["end"] - x["start"] for x in s) for s in spans]
                yield pa.record_batch([b.column("doc_id").slice(i, j - i), pa.array(words.counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, SPANS), pa.array(texts, pa.string())], names=RESULT_NAMES)

    hit = source.mapInArrow(marked, source.schema).alias("d").join(
        places.alias("p"), (F.coalesce("d.doc_id", F.lit(int(NO_ID))) == F.col("p.doc_id")) & (F.col("d.mark") == F.col("p.mark")), "left"
    ).select("d.doc_id", "d.text", "p.places")
    return source.mapInArrow(whole, RESULT).unionByName(hit.mapInArrow(cut, RESULT))


PACKED_NAMES = [part.split()[0] for part in PACKED.split(", ")]
RESULT_NAMES = ["doc_id", "n_words", "n_removed", "spans", "text"]
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
