"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A text is cut by the vocabulary's pattern, and each match is encoded by itself.  A match that is a token is
that token.  Any other one starts as single bytes.  A segment tree has a leaf for each byte position: at the
first byte of a part, the rank of the token that this part and the next one would form.  Every node keeps the
smallest rank below it with the leftmost position of that rank, so the root names the next merge.  A merge
changes the leaves of three live neighbours (the merged part, the part before it, and the part that is gone),
and each change climbs to the root in a logarithmic number of steps.

Matches of up to ``LOCKSTEP`` bytes are encoded many at a time: their trees are rows of one NumPy array, and each
step merges once in every row that still has a pair.  Longer ones have a tree of their own.

How it runs.  Nothing is shuffled; a task encodes some megabytes of text at a time.  The pattern always cuts where
ASCII white space follows something that is no white space, so the stretches between such places are encoded
once a piece, however often they occur.  A worker remembers some hundred thousand stretches, which only saves time.

Null and empty texts have no ids.  Bytes that are no UTF-8 are read as U+FFFD, as the public library does.  Repeated
rows and ids are encoded row by row, null ids stay null, and other columns are ignored.  Ids that no token has
make ``decode_ids`` fail; null ids decode to empty bytes.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import rowwise
from skyledger.llm.words import SPACE, buffers, pieces

#: Longest match, in bytes, that is encoded in step with others.
LOCKSTEP = 64
#: Stretches of text in one generation of what a worker remembers, before those of one piece.
REMEMBERED = 1 << 17
#: White space outside ASCII before a white space byte: the pattern need not cut there.
_NO_CUT = re.compile(rb"(?:\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80)(?=[ \t-\r])")
_LOADED: dict[tuple[str, str], Vocabulary] = {}

NONE = np.iinfo(np.int64).max


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Vocabulary:
    """Tokens by rank, and the ranks that pairs of tokens merge to."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # White space as the public library has it: the property, without the separators 0x1C to 0x1F.
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.size = max(ranks.values(), default=-1) + 1
        self.tokens: list[bytes | None] = [None] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for bytes {missing[:5]}")
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [
            (ranks[token[:k]] * self.size + ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        # One more entry, so that every search ends inside.
        self.pair_keys = np.append(table[:, 0], NONE)
        self.pair_ranks = np.append(table[:, 1], NONE)
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def recall(self, stretches: list[bytes]) -> list[bytes]:
        """Ids of each stretch; those seen lately are remembered, in two generations."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {}, self.recent
        recent, older = self.recent, self.older
        out = [recent.get(x) or older.get(x) for x in stretches]
        new = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(new, _stretches(self, [stretches[k] for k in new]), strict=True):
            out[k] = ids
        recent.update((x, y) for x, y in zip(stretches, out, strict=True) if len(x) <= LOCKSTEP)
        return out

    @cached_property
    def merges(self) -> dict[int, int]:
        return dict(zip(self.pair_keys[:-1].tolist(), self.pair_ranks[:-1].tolist(), strict=True))

    @cached_property
    def joined_tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens, one after the other, and where each begins; a rank without a token has none."""
        bounds = np.concatenate(([0], np.cumsum([len(t or b"") for t in self.tokens], dtype=np.int64)))
        return np.frombuffer(b"".join(t or b"" for t in self.tokens), np.uint8), bounds

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs of tokens merge to; ``NONE`` where they do not."""
        key = left * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)


def load(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a file of base64 tokens and ranks; each worker reads it once."""
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as lines:
            _LOADED[path, pattern] = Vocabulary({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}, pattern)
    return _LOADED[path, pattern]


# One tree for one long match.


def merge_long(known: Vocabulary, piece: bytes) -> list[int]:
    """Ids of one match."""
    n = len(piece)
    token = known.of_byte[np.frombuffer(piece, np.uint8)].tolist()
    leaves = 1 << (n - 1).bit_length()
    shift = leaves.bit_length()
    # Ranks come first in a key and positions second, so the least key is the leftmost of the least rank.
    level = np.full(leaves, NONE, dtype=np.int64)
    start = np.array(token, dtype=np.int64)
    ranks = known.ranks_of(start[:-1], start[1:])
    level[: n - 1] = np.where(ranks == NONE, NONE, (ranks << shift) + np.arange(n - 1))
    levels = [level]
    while len(level) > 1:
        level = np.minimum(level[::2], level[1::2])
        levels.append(level)
    tree = [NONE, *(x for level in reversed(levels) for x in level.tolist())]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    merges, size = known.merges, known.size

    def put(place: int, key: int) -> None:
        k = place + leaves
        tree[k] = key
        while k > 1:
            other = tree[k ^ 1]
            key = key if key < other else other
            k >>= 1
            if tree[k] == key:  # nothing above changes
                return
            tree[k] = key

    def pair(place: int) -> int:
        following = after[place]
        rank = merges.get(token[place] * size + token[following]) if following < n else None
        return NONE if rank is None else (rank << shift) + place

    while tree[1] != NONE:
        place, rank = tree[1] & ((1 << shift) - 1), tree[1] >> shift
        gone = after[place]
        token[place] = rank
        after[place] = after[gone]
        if after[gone] < n:
            before[after[gone]] = place
        put(gone, NONE)
        put(place, pair(place))
        if before[place] >= 0:
            put(before[place], pair(before[place]))
    out, place = [], 0
    while place < n:
        out.append(token[place])
        place = after[place]
    return out


# Many trees in step.


def merge_many(known: Vocabulary, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of matches of at most ``LOCKSTEP`` bytes, one after the other, and how many each has."""
    size = np.array([len(x) for x in matches], dtype=np.int64)
    leaves = 1 << max(int(size.max()) - 1, 1).bit_length()
    shift = leaves.bit_length()
    rows = np.arange(len(matches))
    place = np.arange(leaves)
    held = place < size[:, None]
    token = np.zeros((len(matches), leaves), dtype=np.int64)
    token[held] = known.of_byte[np.frombuffer(b"".join(matches), np.uint8)]
    tree = np.full((len(matches), 2 * leaves), NONE, dtype=np.int64)
    left, at = np.nonzero(held[:, 1:])
    ranks = known.ranks_of(token[left, at], token[left, at + 1])
    tree[left, leaves + at] = np.where(ranks == NONE, NONE, (ranks << shift) + at)
    width = leaves
    while width > 1:
        tree[:, width // 2 : width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
        width //= 2
    before = np.broadcast_to(place - 1, token.shape).copy()
    after = np.broadcast_to(place + 1, token.shape).copy()
    alive = held.copy()

    def put(rows: np.ndarray, places: np.ndarray, keys: np.ndarray) -> None:
        k = places + leaves
        tree[rows, k] = keys
        while k[0] > 1:  # all leaves are equally deep
            keys = np.minimum(keys, tree[rows, k ^ 1])
            k = k >> 1
            tree[rows, k] = keys

    def pairs(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        following = after[rows, places]
        ends = following >= size[rows]
        ranks = known.ranks_of(token[rows, places], token[rows, np.minimum(following, leaves - 1)])
        return np.where(ends | (ranks == NONE), NONE, (ranks << shift) + places)

    while True:
        rows = rows[tree[rows, 1] != NONE]
        if not len(rows):
            break
        root = tree[rows, 1]
        places = root & ((1 << shift) - 1)
        gone = after[rows, places]
        token[rows, places] = root >> shift
        alive[rows, gone] = False
        following = after[rows, gone]
        after[rows, places] = following
        linked = following < size[rows]
        before[rows[linked], following[linked]] = places[linked]
        put(rows, gone, np.full(len(rows), NONE))
        put(rows, places, pairs(rows, places))
        previous = before[rows, places]
        behind = previous >= 0
        if behind.any():
            put(rows[behind], previous[behind], pairs(rows[behind], previous[behind]))
    return token[alive], alive.sum(axis=1)


def encode_matches(known: Vocabulary, matches: list[bytes]) -> list[bytes]:
    """Ids of each match as little-endian 32-bit numbers."""
    out: list[bytes] = [b""] * len(matches)
    classes: dict[int, list[int]] = {}
    for k, x in enumerate(matches):
        rank = known.ranks.get(x)
        if rank is not None:
            out[k] = rank.to_bytes(4, "little")
        elif len(x) > LOCKSTEP:
            out[k] = np.array(merge_long(known, x), dtype="<u4").tobytes()
        else:
            classes.setdefault((len(x) - 1).bit_length(), []).append(k)
    for own in classes.values():
        ids, count = merge_many(known, [matches[k] for k in own])
        flat, ends = ids.astype("<u4").tobytes(), np.cumsum(count) * 4
        for k, a, b in zip(own, (ends - count * 4).tolist(), ends.tolist(), strict=True):
            out[k] = flat[a:b]
    return out


def _stretches(known: Vocabulary, stretches: list[bytes]) -> list[bytes]:
    """Ids of each stretch of text between places where the pattern always cuts."""
    cut = [[m.encode() for m in known.pattern.findall(x.decode())] for x in stretches]
    different = list(dict.fromkeys(m for own in cut for m in own))
    ids = dict(zip(different, encode_matches(known, different), strict=True))
    return [b"".join([ids[m] for m in own]) for own in cut]


def encode(known: Vocabulary, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some texts, one after the other, and where each text's ids begin."""
    if not len(raw):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    data = raw.tobytes()
    try:
        data.decode()
    except UnicodeDecodeError:
        texts = [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        data = b"".join(texts)
        raw, offsets = np.frombuffer(data, np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in texts], dtype=np.int64)))
    white = SPACE[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[1:-1] = white[1:] & ~white[:-1]
    cut[[m.end() for m in _NO_CUT.finditer(data)]] = False
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    # The stretches lie one after the other, so they are a column of the same bytes.
    column = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
    different = column.dictionary.to_pylist()
    ids = known.recall(different)
    size = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    which = column.indices.to_numpy()
    start, size = (np.cumsum(size) - size)[which], size[which]
    ends = np.concatenate(([0], np.cumsum(size)))
    tokens = flat[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
    return tokens, ends[np.searchsorted(bounds, offsets)]


def decode(known: Vocabulary, ids: np.ndarray) -> bytes:
    """The bytes of some ids."""
    if len(ids) and (ids.max() >= known.size):
        raise ValueError(f"no token has the id {int(ids.max())}")
    flat, bounds = known.joined_tokens
    at = ids.astype(np.int64)
    start, size = bounds[at], bounds[at + 1] - bounds[at]
    if len(size) and not size.all():
        raise ValueError(f"no token has the id {int(at[size == 0][0])}")
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - (ends - size), size) + np.arange(total)].tobytes()


ENCODED = "doc_id bigint, n_tokens bigint, ids binary"
DECODED = "doc_id bigint, text binary"
BOTH = "doc_id bigint, n_tokens bigint, ids binary, decoded binary"


def _encoded(docs: DataFrame, vocabulary: str | None, pattern: str | None, id_col: str, text_col: str, back: bool) -> DataFrame:
    path, pattern = vocabulary or default_vocabulary(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load(path, pattern)
        for b in batches:
            raw, offsets = buffers(rowwise(b, "text"))
            for i, j in pieces(offsets):
                tokens, bounds = encode(known, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                own = [tokens[x:y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                out = {"doc_id": b.column("doc_id").slice(i, j - i), "n_tokens": pa.array(np.diff(bounds), pa.int64()), "ids": pa.array([x.tobytes() for x in own], pa.binary())}
                if back:
                    out["decoded"] = pa.array([decode(known, x) for x in own], pa.binary())
                yield pa.record_batch(out)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, BOTH if back else ENCODED)


def encode_texts(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its id, the number of ids, and the ids as little-endian 32-bit numbers."""
    return _encoded(docs, vocabulary, pattern, id_col, text_col, back=False)


def decode_ids(encoded: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row for each row of ``encoded``: its id and the bytes of its text."""
    path, pattern = vocabulary or default_vocabulary(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load(path, pattern)
        for b in batches:
            texts = [decode(known, np.frombuffer(x or b"", dtype="<u4")) for x in b.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "text": pa.array(texts, pa.binary())})

    return encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, DECODED)


def round_trip(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_texts``, with the decoded bytes of the ids beside them, in one pass."""
    return _encoded(docs, vocabulary, pattern, id_col, text_col, back=True)
