"""Words of whole Arrow batches as NumPy arrays.

A word is a run of bytes outside 0x20 and 0x09-0x0D.  Words are identified by 64-bit polynomial
hashes of their UTF-8 bytes, computed for a whole batch at once.  Two given different words get
the same hash with a chance of 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK = 1 << 20
#: Texts are taken in pieces of so many bytes; a longer text is a piece of its own.
PIECE = 2 << 20

# Workers live on between tasks.  With one allocator for NumPy and Arrow, what a piece needed
# can be given back to the system when it is done.
pa.set_memory_pool(pa.system_memory_pool())
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    if _TRIM is not None:
        _TRIM(0)

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _splitmix(n: int, seed: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=U64) * U64(_BASE)) ^ U64(seed)
    return mixed(x)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD_BYTE = ~SPACE
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_BYTE = _splitmix(256, 1)
_BYTE_FOLDED = _BYTE[FOLD]


def powers(factor: int, n: int) -> np.ndarray:
    """factor**0 .. factor**(n-1) modulo 2**64."""
    out = np.full(n, factor & _MASK, dtype=U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


_P = 0xD6E8FEB86659FD93
_TABLES: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    if name not in _TABLES:
        factor = {"p": _P, "inverse": pow(_P, -1, 1 << 64)}[name]
        _TABLES[name] = powers(factor, BLOCK + 1)
    return _TABLES[name]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column without copying; nulls count as empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=width)[column.offset : column.offset + n + 1].astype(np.int64)
    if column.null_count:
        # Spark writes nulls with no bytes; other writers may not.
        if np.any(np.diff(offsets)[column.is_null().to_numpy(zero_copy_only=False)]):
            return buffers(column.fill_null(""))
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes, or of one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b
        give_back()


@dataclass
class Words:
    """Words of several texts: where each begins and ends in ``raw``, and which text owns it."""

    raw: np.ndarray
    offsets: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # index of each text's first word; n + 1 entries

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), self.counts)


def words_of(raw: np.ndarray, offsets: np.ndarray) -> Words:
    inside = WORD_BYTE[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    shuts = inside.copy()
    shuts[:-1] &= ~inside[1:]
    if len(raw):
        edge = offsets[:-1][np.diff(offsets) > 0]
        opens[edge] = inside[edge]
        edge = offsets[1:][np.diff(offsets) > 0] - 1
        shuts[edge] = inside[edge]
    begin = np.flatnonzero(opens)
    end = np.flatnonzero(shuts) + 1
    return Words(raw, offsets, begin, end, np.searchsorted(begin, offsets))


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of ordered, disjoint byte spans; ``fold`` lower-cases A-Z first."""
    out = np.empty(len(begin), dtype=U64)
    table = _BYTE_FOLDED if fold else _BYTE
    size = end - begin
    i, n = 0, len(begin)
    while i < n:
        j = int(np.searchsorted(end, begin[i] + BLOCK, side="right"))
        if j <= i:  # one span longer than a block
            piece = raw[begin[i] : end[i]]
            piece = FOLD[piece] if fold else piece
            out[i] = U64(int.from_bytes(blake2b(piece.tobytes(), digest_size=8).digest(), "little"))
            i += 1
            continue
        low, high = int(begin[i]), int(end[j - 1])
        sums = np.zeros(high - low + 1, dtype=U64)
        np.cumsum(table[raw[low:high]] * _table("p")[: high - low], out=sums[1:])
        at = begin[i:j] - low
        h = (sums[end[i:j] - low] - sums[at]) * _table("inverse")[at]
        out[i:j] = mixed(h + size[i:j].astype(U64) * U64(_BASE))
        i = j
    return out


def word_hashes(words: Words, fold: bool = False) -> np.ndarray:
    return span_hashes(words.raw, words.begin, words.end, fold)


_Q = 0xA0761D6478BD642F | 1


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of every ``width`` consecutive words; len(hashes) - width + 1 entries."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    if width <= 8:
        total = hashes[:n].copy()
        for k in range(1, width):
            total = total * U64(_Q) + hashes[k : k + n]
        return mixed(total + U64(width))
    # Prefix sums of h[j] * Q**-j turn each window into one difference.
    inverse = pow(_Q, -1, 1 << 64)
    sums = np.zeros(len(hashes) + 1, dtype=U64)
    np.cumsum(hashes * powers(inverse, len(hashes)), out=sums[1:])
    total = (sums[width:] - sums[:n]) * powers(_Q, n)
    return mixed(total * U64(_BASE) + U64(width))


def inside_windows(words: Words, width: int) -> np.ndarray:
    """For each window start 0..n-width: does the window stay within one text?"""
    n = int(words.first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    fits = np.zeros(n + 1, dtype=np.int32)
    low = words.first[:-1]
    high = np.maximum(words.first[1:] - width + 1, low)
    keep = (high > low) & (low < n)
    np.add.at(fits, low[keep], 1)
    np.add.at(fits, np.minimum(high[keep], n), -1)
    return np.cumsum(fits[:n]) > 0
