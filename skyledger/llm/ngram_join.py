"""N-gram Jaccard join: sets in a prefix tree, walked with shared partial overlaps.

Every text is the set of its word n-grams.  Two texts link when their sets reach the similarity;
the result is the connected component of every text.

1. Sets.  Each text gives its set's size and a fingerprint; equal sets are one class from here on.
2. Who can link at all.  All n-grams meet by hash, four bytes each, and every class learns how many
   of its own also occur in another class.  Two sets of similarity t share one of their first
   n - ceil(t n) + 1 n-grams in any global order; with the rarest first, a class with that many
   n-grams of its own has no partner.  Its set goes no further.
3. Coarse components.  The n-grams of the classes that are left are counted exactly.  The global
   order is by the bits of that count, then by hash.  N-grams so frequent that they stand out in
   a table of fixed size come last and are not sent.  Classes that share an n-gram of their
   prefixes are tied together; a task ties what it holds itself and sends each n-gram once.
4. Tree.  The sets of one coarse component are stored in a compressed prefix tree, in which
   the n-grams that most of them share stand near the root.  Each set walks it: a node adds
   its overlap once for all sets below it, and a subtree is left when the n-grams that remain there
   and in the probe cannot reach the overlap that its smallest fitting set would need, or when
   all its sets are already connected with the probe.
5. Components too large for one task are cut into blocks of ``block`` n-grams.  The first round
   joins each block with the same few anchors, which connects copies of one text.  The second
   compares whoever is still apart with every block, so no link is lost.

Null and empty texts have no n-grams and stay alone; a text of fewer than ``n`` words is one n-gram.
Repeated rows and ids are in one class; a null id counts only if its class has no other.  Other
columns are ignored.  Sets and n-grams are told apart by 64-bit hashes.  The four bytes of step 2 are short enough to let two
n-grams look shared now and then, which only keeps a class that step 3 drops.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import as_batches, binaries, binary_table, bitmap, by_owner, components, fresh, home_of, in_bitmap, joined, partitions, ranges, rowwise, runs, saved, split_by
from skyledger.llm.grouped_links import LINKS, connected
from skyledger.llm.words import buffers, give_back, pieces, window_hashes, word_hashes, words_of

#: The table of counts, whatever the input: 4 MB.
SKETCH_BITS = 20
SLICES = 16


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``percent`` / 100."""

    percent: int = 85

    def prefix(self, size: int) -> int:
        return size - -(-self.percent * size // 100) + 1

    def overlap(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))

    def holds(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


def sets_of(column: pa.Array, n: int, fold: bool) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    raw, offsets = buffers(column)
    for i, j in pieces(offsets):
        words = words_of(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        hashes = word_hashes(words, fold)
        grams = window_hashes(hashes, n)
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            if b - a >= n:
                s = np.sort(grams[a : b - n + 1])
                yield s[runs(s)]
            elif b > a:
                yield window_hashes(hashes[a:b], int(b - a))
            else:
                yield np.zeros(0, dtype=np.uint64)


def class_of(s: np.ndarray) -> int:
    return int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _slots(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint64(64 - SKETCH_BITS)


SETS = "doc_id bigint, mark bigint, size bigint, class bigint"


def _set_rows(source: DataFrame, n: int, fold: bool) -> DataFrame:
    """A text's set size and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(len(s), class_of(s) if len(s) else None) for s in sets_of(rowwise(b, "text"), n, fold)]
            yield pa.record_batch([b.column("doc_id"), b.column("mark"), pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["doc_id", "mark", "size", "class"])

    return source.mapInArrow(run, SETS)


#: Grams held together by one step, eight bytes each.
HELD = 1 << 19

# Step 2. Shares of all classes, by piece: a class that several pieces hold has the same count in each.

SEEN = "bucket int, classes binary, lengths binary, grams binary, piece binary, here binary"
SHARES = "home int, classes binary, pieces binary, counts binary"


def _seen(classes: list[int], sets: list[np.ndarray], buckets: int, piece: int) -> pa.Table:
    """N-grams of one piece, each once.  Those of two of its classes are counted here, and sent without owner."""
    of = np.repeat(np.array(classes, dtype=np.int64), [len(s) for s in sets])
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, of = grams[order], of[order]
    start = runs(grams)
    times = np.diff(np.append(start, len(grams)))
    owner, times_here = np.unique(of[np.repeat(times > 1, times)], return_counts=True)
    own = of[start].copy()
    grams = grams[start]
    short = (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    bucket = ranges(grams, buckets)
    # Owner 0 of what is shared already: nobody waits for an answer.
    own[times > 1] = 0
    rows = [(*r, np.array([piece], np.int64), np.zeros(0, np.int64)) for r in by_owner(bucket, own, short)]
    rows.append((int(bucket[0]), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.array([piece], np.int64), np.stack([owner, times_here])))
    return binary_table(rows, SEEN)


def _shares(table: pa.Table, homes: int) -> pa.Table:
    """Of one bucket: how many n-grams of each class, piece by piece, also occur elsewhere."""
    give_back()
    owners, grams, pieces_, found = [], [], [], []
    for k in range(table.num_rows):
        row = {x: table.column(x)[k].as_buffer() for x in table.column_names if x != "bucket"}
        piece = np.frombuffer(row["piece"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.uint32)
        owners.append(np.repeat(np.frombuffer(row["classes"], np.int64), lengths))
        grams.append(np.frombuffer(row["grams"], np.uint32))
        pieces_.append(np.repeat(piece, len(grams[-1])))
        here = np.frombuffer(row["here"], np.int64).reshape(2, -1)
        found.append((here[0], np.repeat(piece, here.shape[1]), here[1]))
    of, g, piece = np.concatenate(owners), np.concatenate(grams), np.concatenate(pieces_)
    order = np.argsort(g, kind="stable")
    g, of, piece = g[order], of[order], piece[order]
    start = runs(g)
    size = np.diff(np.append(start, len(g)))
    if len(g):
        # Shared: another class has it, or a piece already found two classes that do.
        least, most = np.minimum.reduceat(of, start), np.maximum.reduceat(of, start)
        lone = np.minimum.reduceat(np.where(of == 0, 0, 1), start)
        shared = np.repeat((least != most) | (lone == 0), size) & (of != 0)
        of, piece = of[shared], piece[shared]
        order = np.lexsort((piece, of))
        of, piece = of[order], piece[order]
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (piece[1:] != piece[:-1])
        cut = np.flatnonzero(new)
        found.append((of[cut], piece[cut], np.diff(np.append(cut, len(of)))))
    of, piece, counts = (np.concatenate([x[k] for x in found]).astype(np.int64) for k in range(3))
    home = home_of(of, homes)
    rows = []
    for k in np.unique(home):
        own = home == k
        rows.append((int(k), of[own], piece[own], counts[own]))
    return binary_table(rows, SHARES)


def _shared_of(table: pa.Table) -> pa.Table:
    """Of one home: the number of shared n-grams of each class."""
    of, piece, counts = (joined(table.column(x), "i8") for x in ("classes", "pieces", "counts"))
    order = np.lexsort((piece, of))
    of, piece, counts = of[order], piece[order], counts[order]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (piece[1:] != piece[:-1])
    cut = np.flatnonzero(new)
    if not len(cut):
        return pa.table({"class": pa.array([], pa.int64()), "shared": pa.array([], pa.int64())})
    total, of = np.add.reduceat(counts, cut), of[cut]
    start = runs(of)
    return pa.table({"class": of[start], "shared": np.maximum.reduceat(total, start)})


# Step 3. Exact counts among the classes that are left, then prefixes.

SENT = "bucket int, classes binary, lengths binary, grams binary"
LEVELS = "home int, classes binary, lengths binary, grams binary, levels binary"
TIED = "bucket int, classes binary, lengths binary, grams binary, ties binary"


def _held_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Classes and sets of a table (class, grams), some at a time."""
    names, sets, held = [], [], 0
    for b in batches:
        for name, grams in zip(b.column("class").to_pylist(), b.column("grams"), strict=True):
            names.append(name)
            sets.append(np.frombuffer(grams.as_buffer(), dtype=np.uint64))
            held += len(sets[-1])
            if held >= HELD:
                yield np.array(names, dtype=np.int64), sets
                names, sets, held = [], [], 0
    if names:
        yield np.array(names, dtype=np.int64), sets


def _hot_slots(own: DataFrame) -> np.ndarray:
    """Counts of n-grams in a table of fixed size, with 0 where a count does not stand out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for _, sets in _held_sets(batches):
            counts += np.bincount(_slots(np.concatenate(sets)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
        used = [(k, part) for k, part in enumerate(np.split(counts, SLICES)) if part.any()]
        yield pa.record_batch({"slice": pa.array([k for k, _ in used], pa.int32()), "counts": binaries([p for _, p in used])})

    def total(table: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(x, np.uint32).astype(np.uint64) for x in table.column("counts").to_pylist()], axis=0)
        return pa.table({"slice": table.column("slice")[:1], "counts": binaries([np.minimum(sums, 2**32 - 1).astype(np.uint32)])})

    schema = "slice int, counts binary"
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    step = len(out) // SLICES
    for k, counts in own.mapInArrow(run, schema).groupBy("slice").applyInArrow(total, schema).collect():
        out[k * step : (k + 1) * step] = np.frombuffer(counts, np.uint32)
    usual = out.mean()
    out[out < max(256, 16 * usual)] = 0
    return out


def _levels(table: pa.Table, homes: int) -> pa.Table:
    """Of one bucket: the bits of each n-gram's count, sent home to its classes."""
    of = np.repeat(joined(table.column("classes"), "i8"), joined(table.column("lengths"), "u4"))
    grams = joined(table.column("grams"), "u8")
    order = np.argsort(grams)
    grams, of = grams[order], of[order]
    start = runs(grams)
    size = np.diff(np.append(start, len(grams)))
    level = np.repeat(np.ceil(np.log2(size + 1)).astype(np.uint8), size)
    shared = np.repeat(size > 1, size)
    of, grams, level = of[shared], grams[shared], level[shared]
    return binary_table(list(by_owner(home_of(of, homes), of, grams, level)), LEVELS)


def _tied(classes: np.ndarray, grams: np.ndarray, buckets: int) -> pa.Table:
    """Prefix n-grams of one home, each once; classes that share one are tied to the smallest."""
    order = np.lexsort((classes, grams))
    grams, of = grams[order], classes[order]
    start = runs(grams)
    least = np.repeat(of[start], np.diff(np.append(start, len(grams))))
    other = of != least
    ties = np.unique(np.stack([of[other], least[other]], axis=1), axis=0)
    grams, of = grams[start], of[start]
    rows = [(*r, ties if k == 0 else ties[:0]) for k, r in enumerate(by_owner(ranges(grams, buckets), of, grams))]
    return binary_table(rows, TIED)


def _prefixes(table: pa.Table, alike: Similarity, hot: np.ndarray, buckets: int) -> pa.Table:
    """Of one home: the prefixes of its classes, without n-grams that no other class has.

    A row with level 255 tells a class's size; its n-grams are those in hot slots.
    """
    of = np.repeat(joined(table.column("classes"), "i8"), joined(table.column("lengths"), "u4"))
    grams, level = joined(table.column("grams"), "u8"), joined(table.column("levels"), "u1")
    told = level == 255
    sizes = dict(zip(of[told].tolist(), grams[told].astype(np.int64).tolist(), strict=True))
    of, grams, level = of[~told], grams[~told], level[~told]
    rank = level.astype(np.int64)
    in_hot = level == 254
    rank[in_hot] = hot[_slots(grams[in_hot]).astype(np.int64)].astype(np.int64) + 64
    order = np.lexsort((grams, rank, of))
    of, grams = of[order], grams[order]
    start = runs(of)
    count = np.diff(np.append(start, len(of)))
    keep = np.zeros(len(of), dtype=bool)
    for a, m in zip(start.tolist(), count.tolist(), strict=True):
        size = sizes[int(of[a])]
        keep[a : a + max(0, alike.prefix(size) - (size - m))] = True
    return _tied(of[keep], grams[keep], buckets)


def _ties(table: pa.Table) -> pa.Table:
    """Of one bucket: classes that share an n-gram, each tied to the smallest."""
    of = np.repeat(joined(table.column("classes"), "i8"), joined(table.column("lengths"), "u4"))
    grams = joined(table.column("grams"), "u8")
    pairs = [joined(table.column("ties"), "i8").reshape(-1, 2)]
    order = np.argsort(grams)
    grams, of = grams[order], of[order]
    start = runs(grams)
    if len(grams):
        least = np.repeat(np.minimum.reduceat(of, start), np.diff(np.append(start, len(grams))))
        pairs.append(np.stack([of, least], axis=1)[of != least])
    both = np.unique(np.concatenate(pairs), axis=0)
    return pa.table({"a": both[:, 0], "b": both[:, 1]})


def _coarse(own: DataFrame, alike: Similarity, buckets: int) -> DataFrame:
    """Ties between classes that share an n-gram of their prefixes."""
    hot = own.sparkSession.sparkContext.broadcast(_hot_slots(own))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, sets in _held_sets(batches):
            of, grams = np.repeat(names, [len(s) for s in sets]), np.concatenate(sets)
            cold = hot.value[_slots(grams).astype(np.int64)] == 0
            yield from as_batches(binary_table(list(by_owner(ranges(grams[cold], buckets), of[cold], grams[cold])), SENT))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Straight home: sizes, and n-grams in hot slots."""
        for names, sets in _held_sets(batches):
            of, grams = np.repeat(names, [len(s) for s in sets]), np.concatenate(sets)
            warm = hot.value[_slots(grams).astype(np.int64)] > 0
            of = np.concatenate([names, of[warm]])
            values = np.concatenate([np.array([len(s) for s in sets], dtype=np.uint64), grams[warm]])
            level = np.repeat(np.array([255, 254], dtype=np.uint8), [len(names), len(of) - len(names)])
            yield from as_batches(binary_table(list(by_owner(home_of(of, buckets), of, values, level)), LEVELS))

    levels = own.mapInArrow(sent, SENT).groupBy("bucket").applyInArrow(lambda t: _levels(t, buckets), LEVELS)
    homes = levels.union(own.mapInArrow(told, LEVELS)).groupBy("home")
    prefixes = homes.applyInArrow(lambda t: _prefixes(t, alike, hot.value, buckets), TIED)
    return prefixes.groupBy("bucket").applyInArrow(_ties, LINKS)


@dataclass
class Node:
    """A path of ``order[low][start:stop]`` that the sets low..high (in tree order) share."""

    low: int
    high: int
    start: int
    stop: int
    children: list[Node] = field(default_factory=list)
    ends: int = 0  # so many sets, the first ones, end here
    fewest: int = 0
    most: int = 0
    rest: int = 0


class PrefixTree:
    """Sets as increasing arrays, in lexicographic order, in a compressed tree."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.sets, self.sizes = sets, sizes
        self.shared = [0] * len(sets)
        for k in range(1, len(sets)):
            x, y = sets[k - 1], sets[k]
            m = min(len(x), len(y))
            apart = np.flatnonzero(x[:m] != y[:m])
            self.shared[k] = int(apart[0]) if len(apart) else m
        self.root = self._build(0, len(sets), 0)

    def _build(self, low: int, high: int, depth: int) -> Node:
        """Top down with an own stack, as trees of long shared paths can be deep."""
        root = Node(low, high, depth, depth)
        work = [(root, True)]
        while work:
            node, opening = work.pop()
            if not opening:
                node.fewest = int(self.sizes[node.low : node.high].min())
                node.most = int(self.sizes[node.low : node.high].max())
                node.rest = max((c.stop - c.start + c.rest for c in node.children), default=0)
                continue
            work.append((node, False))
            k = node.low
            while k < node.high and len(self.sets[k]) == node.stop:
                k += 1
            node.ends = k - node.low
            while k < node.high:
                end = k + 1
                while end < node.high and self.shared[end] > node.stop:
                    end += 1
                stop = min([len(self.sets[k]), *self.shared[k + 1 : end]])
                child = Node(k, end, node.stop, stop)
                node.children.append(child)
                work.append((child, True))
                k = end
        return root

    def connect(self, alike: Similarity, label: np.ndarray, width: int) -> None:
        """Give the sets that link, directly or through others, the same label."""
        held = np.zeros(width + 1, dtype=bool)
        n = len(self.sets)
        changes = None
        for k in range(n - 1):
            if changes is None:
                changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
            if changes[n - 1] == changes[k]:
                break  # all that follow are connected with this one
            probe, size = self.sets[k], int(self.sizes[k])
            held[probe] = True
            least, most = -(-alike.percent * size // 100), 100 * size // alike.percent
            stack = [(self.root, 0)]
            while stack:
                node, overlap = stack.pop()
                if node.high <= k + 1 or node.most < least or node.fewest > most:
                    continue
                if changes[node.high - 1] == changes[node.low] and label[node.low] == label[k]:
                    continue
                if node.stop > node.start:
                    path = self.sets[node.low][node.start : node.stop]
                    overlap += int(np.count_nonzero(held[path]))
                    left = len(probe) - int(np.searchsorted(probe, path[-1], side="right"))
                else:
                    left = len(probe)
                if overlap + min(left, node.rest) < alike.overlap(size, max(node.fewest, least)):
                    continue
                for j in range(max(node.low, k + 1), node.low + node.ends):
                    if label[j] != label[k] and alike.holds(overlap, size, int(self.sizes[j])):
                        old, new = max(label[j], label[k]), min(label[j], label[k])
                        label[label == old] = new
                        changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
                stack.extend((c, overlap) for c in node.children)
            held[probe] = False


def tree_links(classes: np.ndarray, payloads: list[bytes], groups: np.ndarray, alike: Similarity) -> list[tuple[int, int]]:
    """Links that connect what similarity connects, given that equal ``groups`` are connected already."""
    sets = [np.frombuffer(x, dtype=np.uint64) for x in payloads]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    grams = np.concatenate(sets)
    _, flat, times = np.unique(grams, return_inverse=True, return_counts=True)
    # N-grams that most sets have come first; those of one set only can never match.
    shared = np.flatnonzero(times > 1)
    place = np.full(len(times), -1, dtype=np.int64)
    place[shared[np.argsort(-times[shared], kind="stable")]] = np.arange(len(shared))
    flat = place[flat]
    cut = np.cumsum(sizes)[:-1]
    paths = [np.sort(x[x >= 0]) for x in np.split(flat, cut)]
    order = sorted(range(len(paths)), key=lambda k: paths[k].astype(">u4").tobytes())
    _, label = np.unique(groups[order], return_inverse=True)
    # Labels are numbers of the first place of each group, as merging keeps the smaller one.
    first = np.full(label.max() + 1, len(order), dtype=np.int64)
    np.minimum.at(first, label, np.arange(len(order)))
    label = first[label]
    before = label.copy()
    PrefixTree([paths[k] for k in order], sizes[order]).connect(alike, label, len(shared))
    named = classes[order]
    return [(int(named[k]), int(named[label[k]])) for k in range(len(order)) if label[k] != before[k]]


def _joined(source: DataFrame, n: int, percent: int, fold: bool, block: int, buckets: int | None) -> tuple[DataFrame, DataFrame]:
    """Texts (doc_id, mark, size, class), and the component of every class that links to another."""
    spark = source.sparkSession
    alike = Similarity(percent)
    buckets = buckets or partitions(spark)
    texts = saved(_set_rows(source, n, fold), "sets")

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece = TaskContext.get().partitionId() << 32
        waiting: dict[int, np.ndarray] = {}
        held = 0
        for b in batches:
            for s in sets_of(rowwise(b, "text"), n, fold):
                if len(s) and (c := class_of(s)) not in waiting:
                    waiting[c] = s
                    held += len(s)
                if held >= HELD:
                    yield from as_batches(_seen(list(waiting), list(waiting.values()), buckets, piece))
                    waiting, held, piece = {}, 0, piece + 1
        if waiting:
            yield from as_batches(_seen(list(waiting), list(waiting.values()), buckets, piece))

    shares = source.mapInArrow(seen, SEEN).groupBy("bucket").applyInArrow(lambda t: _shares(t, buckets), SHARES)
    shared = shares.groupBy("home").applyInArrow(_shared_of, "class bigint, shared bigint")
    classes = texts.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"))
    prefix = F.col("size") - F.ceil(F.lit(percent) * F.col("size") / 100) + 1
    left = saved(shared.join(classes, "class").where(F.col("size") - F.col("shared") < prefix).select("class"), "left")
    bits = spark.sparkContext.broadcast(bitmap(left))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets of classes that may have a partner, each once a batch."""
        for b in batches:
            found: dict[int, np.ndarray] = {}
            for s in sets_of(rowwise(b, "text"), n, fold):
                if len(s) and (c := class_of(s)) not in found and in_bitmap(bits.value, np.array([c]))[0]:
                    found[c] = s
            names = list(found)
            for k in range(0, len(names), 1000):
                part = names[k : k + 1000]
                yield pa.record_batch({"class": pa.array(part, pa.int64()), "grams": binaries([found[c] for c in part])})

    sets = source.mapInArrow(wanted, "class bigint, grams binary").join(left, "class", "left_semi")
    sets = saved(sets.groupBy("class").agg(F.first("grams").alias("grams")), "grams")
    coarse = components(_coarse(sets, alike, buckets))
    own = saved(sets.join(coarse, sets["class"] == coarse["node"]).select("component", "class", F.col("grams").alias("payload")), "tied")
    return texts, connected(own, lambda c, p, g: tree_links(c, p, g, alike), 8 * block)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))


def join_components(
    docs: DataFrame, n: int = 4, percent: int = 85, fold: bool = True, id_col: str = "doc_id", text_col: str = "text",
    block: int = 1 << 22, buckets: int | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size (of its set), class (of equal sets), component_id.

    ``component_id`` is the smallest id that links reach, the row's own included.  ``block`` is the
    number of n-grams that one task may hold for one component.
    """
    texts, fine = _joined(_source(docs, id_col, text_col), n, percent, fold, block, buckets)
    classes = texts.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    named = classes.join(fine, classes["class"] == fine["node"], "left").select("class", "least", F.coalesce("component", "class").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = saved(named.join(least, "component").select("class", "component_id"), "component-ids")
    return texts.join(ids, "class", "left").select("doc_id", "size", "class", F.coalesce("component_id", F.when(F.col("class").isNull(), F.col("doc_id"))).alias("component_id"))


def keep_one(
    docs: DataFrame, n: int = 5, percent: int = 80, fold: bool = True, id_col: str = "doc_id", text_col: str = "text",
    block: int = 1 << 22, buckets: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one with the smallest id, nulls last.

    Of rows that repeat an id and a text one stays.  Texts without words all stay.
    """
    texts, fine = _joined(_source(docs, id_col, text_col), n, percent, fold, block, buckets)
    keys = texts.where("class is not null").groupBy("class", "doc_id", "mark").agg(F.count("*").alias("rows"))
    named = keys.join(fine, keys["class"] == fine["node"], "left").select("doc_id", "mark", "rows", F.coalesce("component", "class").alias("component"))
    named = saved(named.withColumn("rank", F.struct(F.col("doc_id").isNull(), "doc_id", "mark")), "members")
    first = named.groupBy("component").agg(F.min("rank").alias("first"))
    stays = named.join(first, "component").select(F.xxhash64("doc_id", "mark").alias("key"), (F.col("rank") == F.col("first")).alias("stays"), "rows")
    decided = saved(stays.where("not stays or rows > 1").select("key", "stays"), "decided")

    key = fresh("key")
    columns = docs.columns
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("bigint"), F.xxhash64(F.col(text_col))))
    clear, rest = split_by(keyed, key, decided.select("key"))
    kept = rest.join(decided.where("not stays").select(F.col("key").alias(key)), key, "left_anti")
    # Only rows that repeat a deciding id and text are repeats; the bitmap lets others through, too.
    again = fresh("again")
    repeated = decided.where("stays").select(F.col("key").alias(key), F.lit(True).alias(again)).distinct()
    marked = kept.join(repeated, key, "left")
    once = marked.where(F.col(again)).dropDuplicates([key])
    return clear.select(*columns).unionByName(marked.where(F.col(again).isNull()).select(*columns)).unionByName(once.select(*columns))
