"""Weighted acyclic automata over words: count transducers of sorted sequences.

An automaton holds sequences of at most ``DEPTH`` words, each with a weight.  Its states lie in levels, by how many
words they have read; arcs of a state are sorted by word, and an arc carries the weight of the sequence that ends with
it (0 if that sequence is only a beginning of others).  States with equal arcs are one state, so what follows
different beginnings in the same way is held once.  Sequences come sorted; with each one that follows, the states that
it leaves behind are complete, and are looked up among the registered ones.  Here that is done for all
sequences at once, the last level first.

Many automata are built in one go: the rows of ``part`` k make the k-th one.  Two states are taken for equal only
after their arcs have been compared; their hashes just bring them together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skyledger.llm.common import runs
from skyledger.llm.words import U64, mixed

DEPTH = 4
_FACTOR = U64(0xD6E8FEB86659FD93)


@dataclass
class Level:
    """States of one level: arcs of state s are ``first[s]`` to ``first[s + 1]``; ``target`` 0 means no further state."""

    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray


@dataclass
class Automaton:
    words: pa.Array  # sorted and different; labels are places in it
    levels: list[Level]

    def _arcs(self, depth: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of some states, and which of the states each belongs to."""
        level = self.levels[depth]
        size = level.first[state + 1] - level.first[state]
        ends = np.cumsum(size)
        of = np.repeat(np.arange(len(state)), size)
        return np.repeat(level.first[state] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0), of

    def _step(self, depth: int, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The arc of each state with a given label, or -1; states and labels below 0 have none."""
        level = self.levels[depth]
        owner = np.repeat(np.arange(len(level.first) - 1), np.diff(level.first))
        keys = owner * (len(self.words) + 1) + level.label
        wanted = np.where((state < 0) | (label < 0), -1, state * (len(self.words) + 1) + label)
        at = np.searchsorted(keys, wanted)
        hit = np.zeros(len(wanted), dtype=bool)
        inside = at < len(keys)
        hit[inside] = keys[at[inside]] == wanted[inside]
        return np.where(hit, at, -1)

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences with a weight, as rows of labels (-1 behind the end), and their weights."""
        rows, weights = [], []
        state, path = np.zeros(min(len(self.levels[0].first) - 1, 1), dtype=np.int64), np.zeros((1, 0), dtype=np.int32)
        for depth, level in enumerate(self.levels):
            arcs, of = self._arcs(depth, state)
            path = np.column_stack([path[of], level.label[arcs].astype(np.int32)])
            held = level.weight[arcs] > 0
            rows.append(np.pad(path[held], ((0, 0), (0, DEPTH - 1 - depth)), constant_values=-1))
            weights.append(level.weight[arcs][held])
            onward = level.target[arcs] > 0
            state, path = level.target[arcs][onward] - 1, path[onward]
        return np.concatenate(rows), np.concatenate(weights)

    def labels_of(self, words: pa.Array) -> np.ndarray:
        """The labels of some words; -1 for words that the automaton does not have."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def weights_of(self, rows: np.ndarray) -> np.ndarray:
        """The weight of each row of labels; 0 if the automaton does not have it."""
        state = np.zeros(len(rows), dtype=np.int64)
        out = np.zeros(len(rows), dtype=np.int64)
        for depth, level in enumerate(self.levels[: rows.shape[1]]):
            going = np.flatnonzero((rows[:, depth] >= 0) & (state >= 0))
            arc = self._step(depth, state[going], rows[going, depth])
            out[rows[:, depth] >= 0] = 0
            found = arc >= 0
            out[going[found]] = level.weight[arc[found]]
            state[going] = np.where(found, level.target[np.maximum(arc, 0)] - 1 if len(level.target) else -1, -1)
        return out

    def compose(self, other: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sequences of ``other``, as rows of its labels, their weights there, and their weights here (0 if unknown).

        Both automata are walked side by side: a pair of states leads on where both have the next word.
        """
        here = self.labels_of(other.words)
        rows, theirs, ours = [], [], []
        n = min(len(other.levels[0].first) - 1, 1)
        their_state, our_state, path = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((1, 0), np.int32)
        for depth, level in enumerate(other.levels):
            arcs, of = other._arcs(depth, their_state)
            path = np.column_stack([path[of], level.label[arcs].astype(np.int32)])
            own = self.levels[depth]
            arc = self._step(depth, our_state[of], here[level.label[arcs]])
            found = arc >= 0
            weight, target = np.zeros(len(arcs), np.int64), np.full(len(arcs), -1)
            weight[found], target[found] = own.weight[arc[found]], own.target[arc[found]] - 1
            held = level.weight[arcs] > 0
            rows.append(np.pad(path[held], ((0, 0), (0, DEPTH - 1 - depth)), constant_values=-1))
            theirs.append(level.weight[arcs][held])
            ours.append(weight[held])
            onward = level.target[arcs] > 0
            their_state, our_state, path = level.target[arcs][onward] - 1, target[onward], path[onward]
        return np.concatenate(rows), np.concatenate(theirs), np.concatenate(ours)


def summed(rows: np.ndarray, weights: np.ndarray, n_words: int, largest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted and different, with the sum (or the largest) of their weights."""
    if not len(rows):
        return rows, weights
    if (n_words + 1) ** DEPTH < 1 << 63:
        key = np.zeros(len(rows), dtype=np.int64)
        for k in range(DEPTH):
            key = key * (n_words + 1) + (rows[:, k] + 1)
        order = np.argsort(key)
        start = runs(key[order])
    else:
        order = np.lexsort([rows[:, k] for k in reversed(range(DEPTH))])
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[order][1:] != rows[order][:-1]).any(axis=1)
        start = np.flatnonzero(new)
    total = (np.maximum if largest else np.add).reduceat(weights[order], start)
    return rows[order[start]], total


def union(automata: list[Automaton], largest: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, sorted rows and weights of all sequences; weights of a sequence are added, or the largest is taken."""
    coded = pa.concat_arrays([a.words for a in automata]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    label = rank[coded.indices.to_numpy()]
    rows, weights, base = [], [], 0
    for a in automata:
        own, weight = a.sequences()
        own[own >= 0] = label[base + own[own >= 0]]
        rows.append(own)
        weights.append(weight)
        base += len(a.words)
    rows, weights = np.concatenate(rows), np.concatenate(weights)
    rows, weights = summed(rows, weights, len(order), largest)
    return coded.dictionary.take(pa.array(order)), rows, weights


def _registered(part: np.ndarray, size: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each state, given by the sizes and arcs of states in order: the number of its equal, and the states that stay, by part."""
    first = np.cumsum(size) - size
    within = np.arange(len(label)) - np.repeat(first, size)
    arc = mixed(label.astype(U64) * _FACTOR + mixed(weight.astype(U64) + mixed(target.astype(U64))))
    sign = np.add.reduceat(mixed(arc + within.astype(U64) * _FACTOR), first) if len(first) else np.zeros(0, U64)
    order = np.argsort(sign, kind="stable")
    order = order[np.argsort(part[order], kind="stable")]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (sign[order][1:] != sign[order][:-1]) | (part[order][1:] != part[order][:-1])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    stay = order[new]
    twin = stay[number]
    same = np.array_equal(size[twin], size)
    if same:
        arcs = np.repeat(first[twin], size) + within
        same = np.array_equal(label[arcs], label) and np.array_equal(weight[arcs], weight) and np.array_equal(target[arcs], target)
    if not same:  # two unequal states with the same hash: share nothing
        return np.arange(len(size)), np.arange(len(size))
    return number, stay


def _integers(arrays: list[np.ndarray]) -> bytes:
    """Lengths, widths, and the numbers in as few bytes as the largest of each array needs."""
    width = []
    for x in arrays:
        top = int(x.max()) if len(x) else 0
        width.append(1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8)
    head = np.array([len(x) for x in arrays], dtype="<u4").tobytes() + bytes(width)
    return head + b"".join(x.astype(f"<u{w}").tobytes() for x, w in zip(arrays, width, strict=True))


ARRAYS = 1 + 4 * DEPTH


def build(words: pa.Array, part: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> list[tuple[int, bytes]]:
    """(part, automaton in bytes) for each part; rows are sorted by part and labels, and different within a part."""
    if not len(rows):
        return []
    length = (rows >= 0).sum(axis=1)
    changed = np.ones(len(rows), dtype=bool)
    changed[1:] = part[1:] != part[:-1]
    opens = changed
    parts = part[opens]
    parent = np.cumsum(opens) - 1
    nodes = []  # by depth: first row, parent
    for depth in range(DEPTH):
        changed = changed.copy()
        changed[1:] |= rows[1:, depth] != rows[:-1, depth]
        new = changed & (length > depth)
        at = np.flatnonzero(new)
        nodes.append((at, parent[at]))
        parent = np.cumsum(new) - 1
    levels = []
    target = np.zeros(len(nodes[-1][0]), dtype=np.int64)
    for depth in reversed(range(DEPTH)):
        at, above = nodes[depth]
        label, weight = rows[at, depth].astype(np.int64), np.where(length[at] == depth + 1, weights[at], 0)
        start = runs(above)
        size = np.diff(np.append(start, len(at)))
        of_part = np.searchsorted(parts, part[at[start]]) if len(start) else np.zeros(0, np.int64)
        number, stay = _registered(of_part, size, label, weight, target)
        kept = np.repeat(start[stay] - (np.cumsum(size[stay]) - size[stay]), size[stay]) + np.arange(size[stay].sum())
        levels.insert(0, (of_part[stay], size[stay], label[kept], weight[kept], target[kept]))
        if depth:
            # What the nodes one level up lead to: the number of a state within its part, from 1 on.
            first = np.searchsorted(of_part[stay], np.arange(len(parts)))
            target = np.zeros(len(nodes[depth - 1][0]), dtype=np.int64)
            target[above[start]] = number - first[of_part] + 1
    # Labels within each part.
    n = len(words)
    every = np.concatenate([np.repeat(p, s) * n + label for p, s, label, _, _ in levels])
    used, local = np.unique(every, return_inverse=True)
    of_used = used // n
    bound = np.searchsorted(of_used, np.arange(len(parts) + 1))
    own = words.take(pa.array(used % n)).cast(pa.large_binary())
    _, offsets, data = own.buffers()
    offsets = np.frombuffer(offsets, np.int64)[own.offset : own.offset + len(own) + 1]
    data = memoryview(data or b"")
    cut, base = [], 0
    for of_part, size, label, weight, target in levels:
        local_label = local[base : base + len(label)] - bound[np.repeat(of_part, size)]
        base += len(label)
        ends = np.concatenate(([0], np.cumsum(size)))
        states = np.searchsorted(of_part, np.arange(len(parts) + 1))
        cut.append((size, states.tolist(), ends[states].tolist(), local_label, weight, target))
    out = []
    sizes = np.diff(offsets)
    bound = bound.tolist()
    for k, name in enumerate(parts.tolist()):
        arrays = [sizes[bound[k] : bound[k + 1]]]
        for size, states, arcs, label, weight, target in cut:
            here = slice(arcs[k], arcs[k + 1])
            arrays += [size[states[k] : states[k + 1]], label[here], weight[here], target[here]]
        out.append((name, _integers(arrays) + bytes(data[offsets[bound[k]] : offsets[bound[k + 1]]])))
    return out


def read(blob: bytes) -> Automaton:
    """An automaton from its bytes."""
    length = np.frombuffer(blob, "<u4", ARRAYS)
    width = blob[4 * ARRAYS : 5 * ARRAYS]
    at, arrays = 5 * ARRAYS, []
    for n, w in zip(length.tolist(), width, strict=True):
        arrays.append(np.frombuffer(blob, f"<u{w}", n, at).astype(np.int64))
        at += n * w
    offsets = np.concatenate(([at], at + np.cumsum(arrays[0])))
    words = pa.Array.from_buffers(pa.large_binary(), len(arrays[0]), [None, pa.py_buffer(offsets), pa.py_buffer(blob)])
    levels = []
    for k in range(1, ARRAYS, 4):
        size, label, weight, target = arrays[k : k + 4]
        levels.append(Level(np.concatenate(([0], np.cumsum(size))), label, weight, target))
    return Automaton(words, levels)
