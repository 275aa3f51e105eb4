"""Token ids in packed rows: best-fit-decreasing bins with a segment tree over free space.

Texts become token ids of a public byte-level BPE vocabulary, each text followed by the end-of-text
id.  A text longer than a row is split: whole rows, and a rest.  Rests are packed by decreasing
length, each into the fullest row in which it still fits; a segment tree over free space finds that row.
A row holds its ids, the cumulative lengths of its segments, and positions that start again at 0 with
each segment.  ``doc_ids`` and ``starts`` say where each segment comes from, so every text can be put
together again.

A task tokenizes and packs its own rows, ``pool`` tokens at a time, so nothing is shuffled and memory is
bounded; a pool of some millions leaves well under one row in a hundred unfilled.  Words that a piece of text
repeats are tokenized once: the vocabulary's pattern always cuts where white space follows something
else, so stretches between such places can be tokenized apart.

Null and empty texts have no segment.  Null ids stay null in ``doc_ids``.  Repeated rows are packed as
often as they occur.  Other columns are ignored.  Row ids hold the partition and a number; they are unique,
and the same for the same partitions.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import rowwise
from skyledger.llm.words import SPACE, buffers, pieces, span_hashes

#: Fixed value: the pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space outside ASCII before a white space byte: the pattern need not cut there.
_NO_CUT = re.compile(rb"(?:\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80)(?=[ \t-\r])")
_ENCODERS: dict[str, tiktoken.Encoding] = {}
_LENGTHS: dict[str, np.ndarray] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str) -> tiktoken.Encoding:
    if path not in _ENCODERS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def _encode_spans(known: tiktoken.Encoding, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of spans that begin with white space and end without, and how many each has.

    They are encoded as one text, in which the pattern cuts where a span begins; the lengths of
    the tokens then tell which ids are whose.
    """
    if not spans:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    if known.name not in _LENGTHS:
        _LENGTHS[known.name] = np.array([len(known.decode_single_token_bytes(k)) for k in range(known.n_vocab)], dtype=np.int64)
    size = np.array([len(x) for x in spans], dtype=np.int64)
    ids = known.encode_to_numpy(b"".join(spans).decode("utf-8", "replace"), disallowed_special=())
    ends = np.cumsum(_LENGTHS[known.name][ids])
    last = np.searchsorted(ends, np.cumsum(size))
    if len(ends) and last[-1] < len(ends) and np.array_equal(ends[last], np.cumsum(size)):
        return ids, np.diff(last + 1, prepend=0)
    each = [known.encode_ordinary(x.decode("utf-8", "replace")) for x in spans]  # bytes that are no UTF-8
    return np.array([k for x in each for k in x], dtype=np.uint32), np.array([len(x) for x in each], dtype=np.int64)


def encode(known: tiktoken.Encoding, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and where each text's ids begin."""
    if not len(raw):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    data = raw.tobytes()
    white = SPACE[raw]
    cut = np.zeros(len(raw), dtype=bool)
    cut[1:] = white[1:] & ~white[:-1]
    cut[[m.end() for m in _NO_CUT.finditer(data)]] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(raw))
    _, one, which = np.unique(span_hashes(raw, begin, end), return_index=True, return_inverse=True)
    # Spans at the start of a text, or with white space at its end, are encoded alone.
    joint = white[begin[one]] & ~white[end[one] - 1]
    order = np.concatenate([np.flatnonzero(joint), np.flatnonzero(~joint)])
    text = [data[a:b] for a, b in zip(begin[one][order].tolist(), end[one][order].tolist(), strict=True)]
    n = int(joint.sum())
    flat, some = _encode_spans(known, text[:n])
    alone = [known.encode_ordinary(x.decode("utf-8", "replace")) for x in text[n:]]
    flat = np.concatenate([flat, np.array([k for x in alone for k in x], dtype=np.uint32)])
    size = np.empty(len(order), dtype=np.int64)
    size[order] = np.concatenate([some, np.array([len(x) for x in alone], dtype=np.int64)])
    start = np.empty(len(order), dtype=np.int64)
    start[order] = np.cumsum(size[order]) - size[order]
    size, start = size[which], start[which]
    out_start = np.cumsum(size) - size
    total = int(size.sum())
    tokens = flat[np.repeat(start - out_start, size) + np.arange(total)]
    bounds = np.append(out_start, total)
    return tokens, bounds[np.searchsorted(begin, offsets)]


class FreeSpace:
    """How many open rows have which free space, in a segment tree."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, space: int, n: int) -> None:
        k = space + self.leaves
        while k:
            self.count[k] += n
            k >>= 1

    def least_from(self, space: int) -> int:
        """The smallest free space of at least ``space`` that a row has, or -1."""
        count, k = self.count, space + self.leaves
        while not count[k]:
            while k & 1:  # a right child: what follows is to the right of the parent
                k >>= 1
                if k == 0:
                    return -1
            k += 1
        while k < self.leaves:
            k <<= 1
            if not count[k]:
                k += 1
        return k - self.leaves


def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Rows of items: longest first, each into the fullest row that has space for it."""
    tree, rows = FreeSpace(room), []
    open_: list[list[int]] = [[] for _ in range(room + 1)]
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        space = tree.least_from(size)
        if space < 0:
            row, space = len(rows), room
            rows.append([])
        else:
            row = open_[space].pop()
            tree.add(space, -1)
        rows[row].append(k)
        if space > size:
            open_[space - size].append(row)
            tree.add(space - size, 1)
    return rows


RESULT = "row_id bigint, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<bigint>, starts array<bigint>"


def _packed(segments: list[tuple[int | None, int, np.ndarray]], room: int, pad: int, dtype: type, first: int) -> tuple[pa.RecordBatch, float]:
    whole = [[k] for k, s in enumerate(segments) if len(s[2]) == room]
    rest = [k for k, s in enumerate(segments) if len(s[2]) < room]
    rows = whole + [[rest[k] for k in row] for row in best_fit(np.array([len(segments[k][2]) for k in rest], dtype=np.int64), room)]
    ids, places, sums, owners, starts, used = [], [], [], [], [], []
    steps = np.arange(room, dtype=np.uint16 if room <= 1 << 16 else np.uint32)
    for row in rows:
        own = [segments[k] for k in row]
        lengths = [len(s[2]) for s in own]
        n = sum(lengths)
        filled = np.full(room, pad, dtype=dtype)
        filled[:n] = np.concatenate([s[2] for s in own])
        ids.append(filled.tobytes())
        places.append(np.concatenate([*(steps[:m] for m in lengths), steps[: room - n]]).tobytes())
        sums.append(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
        owners.append([s[0] for s in own])
        starts.append([s[1] for s in own])
        used.append(n)
    return pa.record_batch([
        pa.array(range(first, first + len(rows)), pa.int64()), pa.array(used, pa.int32()), pa.array(ids, pa.binary()), pa.array(places, pa.binary()),
        pa.array(sums, pa.list_(pa.int32())), pa.array(owners, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.int64())),
    ], names=[x.split()[0] for x in RESULT.split(", ")])


def pack(
    docs: DataFrame, room: int = 2048, vocabulary: str | None = None, end_of_text: int = 50256, pad: int | None = None,
    pool: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Packed rows of ``room`` ids.

    ``ids`` and ``positions`` are little-endian arrays of ``room`` numbers of two bytes (four for larger
    vocabularies or rows); what no segment uses holds ``pad`` (the end-of-text id unless given).
    """
    path = vocabulary or default_vocabulary()
    pad = end_of_text if pad is None else pad

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        dtype = np.uint16 if max(known.n_vocab, end_of_text, pad) < 1 << 16 else np.uint32
        row_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        waiting: list[tuple[int | None, int, np.ndarray]] = []
        held = 0
        for b in batches:
            raw, offsets = buffers(rowwise(b, "text"))
            ids = b.column("doc_id").to_pylist()
            for i, j in pieces(offsets):
                tokens, bounds = encode(known, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                tokens = tokens.astype(dtype)
                for k in range(j - i):
                    if bounds[k + 1] > bounds[k]:
                        own = np.append(tokens[bounds[k] : bounds[k + 1]], dtype(end_of_text))
                        waiting.extend((ids[i + k], at, own[at : at + room]) for at in range(0, len(own), room))
                        held += len(own)
                if held >= pool:
                    out = _packed(waiting, room, pad, dtype, row_id)
                    row_id += out.num_rows
                    waiting, held = [], 0
                    yield out
        if waiting:
            yield _packed(waiting, room, pad, dtype, row_id)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, RESULT)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet files; the ``ids`` of a row group are one matrix of ``room`` columns."""
    packed.write.option("compression", "zstd").parquet(path)


def matrix(ids: pa.ChunkedArray | pa.Array, room: int) -> np.ndarray:
    """The ids (or positions) of some packed rows as a matrix."""
    rows = ids.to_pylist()
    if not rows:
        return np.zeros((0, room), dtype=np.uint16)
    dtype = {2: np.uint16, 4: np.uint32}[len(rows[0]) // room]
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(-1, room)
