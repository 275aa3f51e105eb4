"""Vector codes: product quantization with codebooks trained by exact rounds over metric trees.

Vectors become whole numbers, floor(``scale`` * x), and are cut into ``parts`` equal consecutive parts.  The codebook of a part
starts as that part of the ``entries`` vectors with the smallest ids.  Each of ``rounds`` rounds assigns every part to its
nearest entry (squared Euclidean distance, ties to the lower index) and then replaces each entry by floor(sum / count) of its
parts; unused entries stay.  At last parts are assigned again: their entries make up the code.

Metric trees.  A task cuts its vectors into blocks and builds, for each part, a tree of balls middle-out: some sqrt(n) anchors
are found first (each new anchor is the point that lies farthest from its owner in the widest ball, and takes over the points that
are nearer to it; an anchor's points are sorted by distance, so only those farther than half the way to the new
anchor are looked at).  The anchors' balls are merged two by two, closest first, up to the root, and each anchor's points are
treated the same way further down.  A ball holds its centre, radius, and the sum and count of its points.

A round walks each tree from the root with a list of entries that may be nearest.  An entry leaves the list of a ball if another
one is nearer to every point of the ball; the balls below inherit what is left.  A ball with one entry left is owned by it as a
whole, and adds its cached sum and count.  Points of other leaves are compared with the entries that are left.

How it runs.  Trees are built once and written, so rounds and restarts read them.  Rounds return one row for each part,
entry and task, summed in Spark; only codebooks (a fixed number of entries) come to the driver and go out again.  No vector is shuffled,
and totals of labels are joined back by broadcast only for labels with many rows, whose number is bounded.

Results are exact: bounds leave room for rounding, sums and distances are whole numbers.  Where numbers are too large for
doubles to hold distances, Python's whole numbers are used.  An error above the largest bigint is given as that.

Vectors that are null or empty, or hold null or non-finite components, are dropped, as are vectors whose length is not that of the
kept vector with the smallest id.  Repeated ids and vectors are rows of their own; null ids rank after all ids and stay null.  Of
equal ids, smaller vectors rank first.  With fewer kept vectors than entries, there are as many entries as vectors.  Null labels
are one group.  Other columns are ignored.  An empty table gives no rows.  A length that ``parts`` does not divide is an error.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import saved
from skyledger.llm.words import give_back

#: Vectors of a block; leaves hold at most ``LEAF`` points.
BLOCK = 1 << 13
LEAF = 48
#: Labels with a larger share of all rows than 1 / ``HEAVY`` are joined by broadcast.
HEAVY = 1000


# Trees.


@dataclass
class Tree:
    """Balls in an array, the root first; ``left`` is 0 for leaves, whose points are ``begin`` to ``end`` in ``order``."""

    centre: np.ndarray
    radius: np.ndarray
    total: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    order: np.ndarray


def anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Indexes of points in balls around at most ``wanted`` anchors; each point lies with an anchor that is nearest to it."""
    first = points[0]
    far = np.sqrt(((points - first) ** 2).sum(axis=1))
    order = np.argsort(-far, kind="stable")
    owned, reach, places = [order], [far[order]], [first]
    while len(owned) < wanted:
        widest = max(range(len(owned)), key=lambda k: reach[k][0])
        if reach[widest][0] == 0:
            break
        new = points[owned[widest][0]]
        took, took_far = [], []
        for k, place in enumerate(places):
            # Points nearer to their anchor than half the way stay with it.
            n = int(np.searchsorted(-reach[k], -np.sqrt(((place - new) ** 2).sum()) / 2))
            if not n:
                continue
            here = owned[k][:n]
            away = np.sqrt(((points[here] - new) ** 2).sum(axis=1))
            nearer = away < reach[k][:n]
            took.append(here[nearer])
            took_far.append(away[nearer])
            owned[k] = np.concatenate([here[~nearer], owned[k][n:]])
            reach[k] = np.concatenate([reach[k][:n][~nearer], reach[k][n:]])
        new_far = np.concatenate(took_far)
        by = np.argsort(-new_far, kind="stable")
        owned.append(np.concatenate(took)[by])
        reach.append(new_far[by])
        places.append(new)
    return owned


def build_tree(points: np.ndarray) -> Tree:
    """A metric tree over the rows of ``points`` (whole numbers in doubles or objects)."""
    near = points.astype(np.float64)
    nodes: list[list] = []  # [points or None, left, right, centre, radius]

    def ball(members: np.ndarray) -> tuple[np.ndarray, float]:
        centre = near[members].mean(axis=0)
        return centre, float(np.sqrt(((near[members] - centre) ** 2).sum(axis=1).max()))

    def grow(members: np.ndarray) -> int:
        groups = anchors(near[members], max(2, int(len(members) ** 0.5))) if len(members) > LEAF else []
        if len(groups) < 2:
            nodes.append([members, 0, 0, *ball(members)])
            return len(nodes) - 1
        tops = [grow(members[g]) for g in groups]
        return merge(tops, [members[g] for g in groups])

    def merge(tops: list[int], members: list[np.ndarray]) -> int:
        """Balls merged two by two: always the two whose common ball is smallest."""
        n = len(tops)
        centre = np.stack([nodes[t][3] for t in tops])
        radius = np.array([nodes[t][4] for t in tops])
        count = np.array([len(m) for m in members], dtype=np.float64)
        apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
        width = np.maximum(apart + radius[:, None] + radius[None], 2 * np.maximum(radius[:, None], radius[None]))
        np.fill_diagonal(width, np.inf)
        for _ in range(n - 1):
            i, j = divmod(int(np.argmin(width)), n)
            share = count[i] / (count[i] + count[j])
            middle = share * centre[i] + (1 - share) * centre[j]
            reach = max(np.sqrt(((centre[k] - middle) ** 2).sum()) + radius[k] for k in (i, j))
            nodes.append([None, tops[i], tops[j], middle, float(reach) * (1 + 1e-12)])
            tops[i], centre[i], radius[i] = len(nodes) - 1, middle, nodes[-1][4]
            count[i] += count[j]
            width[j, :] = width[:, j] = np.inf
            live = np.isfinite(width[i]) if n > 2 else np.zeros(n, bool)
            away = np.sqrt(((centre - middle) ** 2).sum(axis=1))
            fresh_width = np.maximum(away + radius[i] + radius, 2 * np.maximum(radius, radius[i]))
            width[i, live] = width[live, i] = fresh_width[live]
        return tops[int(np.argmax(count))]

    root = grow(np.arange(len(points)))
    # The root first, points in the order of the leaves.
    place, order, stack, visit = {}, [], [root], []
    while stack:
        k = stack.pop()
        place[k] = len(visit)
        visit.append(k)
        if nodes[k][0] is None:
            stack += [nodes[k][2], nodes[k][1]]
    begin, end = np.zeros(len(visit), np.int64), np.zeros(len(visit), np.int64)
    for k in visit:
        if nodes[k][0] is not None:
            begin[place[k]] = len(order)
            order.extend(nodes[k][0].tolist())
            end[place[k]] = len(order)
    left = np.array([place[nodes[k][1]] if nodes[k][0] is None else 0 for k in visit])
    right = np.array([place[nodes[k][2]] if nodes[k][0] is None else 0 for k in visit])
    for k in range(len(visit) - 1, -1, -1):
        if left[k]:
            begin[k], end[k] = begin[left[k]], end[right[k]]
    order = np.array(order, dtype=np.int64)
    sums = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64 if points.dtype != object else object)
    np.cumsum(points[order].astype(sums.dtype), axis=0, out=sums[1:])
    return Tree(np.stack([nodes[k][3] for k in visit]), np.array([nodes[k][4] for k in visit]), sums[end] - sums[begin], begin, end, left, right, order)


def nearest(points: np.ndarray, book: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
    """The nearest entry of each point, of equal ones the lowest; ``allowed`` masks entries for each point."""
    if points.dtype == object:
        away = np.array([[sum((a - b) ** 2 for a, b in zip(p, e, strict=True)) for e in book.tolist()] for p in points.tolist()], dtype=object)
        if allowed is not None:
            away = np.where(allowed, away, away.max() + 1)
        return np.array([row.index(min(row)) for row in away.tolist()], dtype=np.int64)
    away = (book**2).sum(axis=1) - 2 * (points @ book.T)
    if allowed is not None:
        away[~allowed] = np.inf
    return away.argmin(axis=1)


def assign(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The nearest entry of every point, or -1 below balls that are owned as a whole; and those balls as (ball, entry)."""
    code = np.full(len(points), -1, dtype=np.int64)
    owned: list[tuple[int, int]] = []
    near = book.astype(np.float64)
    between = np.sqrt(((near[:, None] - near[None]) ** 2).sum(axis=2))
    balls, lists = np.zeros(1, dtype=np.int64), np.ones((1, len(book)), dtype=bool)
    while len(balls):
        centre, radius = tree.centre[balls], tree.radius[balls]
        away = ((centre**2).sum(axis=1)[:, None] - 2 * (centre @ near.T)) + (near**2).sum(axis=1)
        best = np.where(lists, away, np.inf).argmin(axis=1)
        # Over the ball, the other's squared distance is larger by at least this.
        lead = away - away[np.arange(len(balls)), best][:, None] - 2 * radius[:, None] * between[best]
        slack = 1e-9 * ((centre**2).sum(axis=1)[:, None] + (near**2).sum(axis=1) + (near[best] ** 2).sum(axis=1)[:, None] + (radius**2)[:, None] + 1)
        lists = lists & ~(lead > slack)
        alone = lists.sum(axis=1) == 1
        owned += zip(balls[alone].tolist(), lists[alone].argmax(axis=1).tolist(), strict=True)
        leaf = (tree.left[balls] == 0) & ~alone
        if leaf.any():
            size = tree.end[balls[leaf]] - tree.begin[balls[leaf]]
            at = np.repeat(tree.begin[balls[leaf]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            of = np.repeat(np.flatnonzero(leaf), size)
            for a in range(0, len(at), 4096):
                rows = tree.order[at[a : a + 4096]]
                code[rows] = nearest(points[rows], near if points.dtype != object else book, lists[of[a : a + 4096]])
        onward = ~alone & ~leaf
        lists = np.repeat(lists[onward], 2, axis=0)
        balls = np.stack([tree.left[balls[onward]], tree.right[balls[onward]]], axis=1).ravel()
    return code, owned


# Whole numbers of any size.


def _largest(x: np.ndarray) -> int:
    return max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0


def _fitting(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles if all squared distances between them are exact there, else as whole numbers of any size."""
    most = max(_largest(x) for x in arrays)
    if 4 * arrays[0].shape[1] * most * most < 1 << 52:
        return [x.astype(np.float64) for x in arrays]
    return [x.astype(object) for x in arrays]


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as bigints, or as whole numbers of any size where needed."""
    if vectors.size and np.abs(vectors).max() * scale >= 1 << 62:
        return np.array([[int(x) * scale if abs(x) >= 1 << 53 else int(np.floor(x * scale)) for x in row] for row in vectors.tolist()], dtype=object)
    return np.floor(vectors * scale).astype(np.int64)


def _store(x: np.ndarray) -> bytes:
    if x.dtype == object:
        return b"any:" + ",".join(map(str, x.ravel().tolist())).encode()
    if x.dtype == np.int64 and _largest(x) < 1 << 31:
        x = x.astype(np.int32)
    return x.dtype.str.encode() + b":" + x.tobytes()


def _fetch(data: bytes) -> np.ndarray:
    kind, _, rest = data.partition(b":")
    if kind == b"any":
        return np.array([int(v) for v in rest.split(b",")] if rest else [], dtype=object)
    x = np.frombuffer(rest, dtype=kind.decode())
    return x.astype(np.int64) if x.dtype == np.int32 else x


#: Sums leave a task as numbers of so many bits, so that no sum of them passes 64 bits.
LIMB = 40
SUMS = "part int, entry int, place int, limb int, total bigint"


def _limbs(part: int, entry: int, place: int, value: int) -> list[tuple]:
    sign, value, out, limb = (1 if value >= 0 else -1), abs(value), [], 0
    while value or not limb:
        out.append((part, entry, place, limb, sign * (value & ((1 << LIMB) - 1))))
        value, limb = value >> LIMB, limb + 1
    return out


# Rounds.

TREE = ("centre", "radius", "total", "begin", "end", "left", "right", "order")


def _blocks(vectors: DataFrame, parts: int, width: int, scale: int, block: int) -> DataFrame:
    """Rows of up to ``block`` vectors with their trees; columns of ``vectors`` are vec_id, label and embedding."""
    label = vectors.schema["label"].dataType.simpleString()
    schema = f"vec_ids array<bigint>, labels array<{label}>, points binary, " + ", ".join(f"{name} array<binary>" for name in TREE)

    def row(ids: pa.ChunkedArray, labels: pa.ChunkedArray, x: np.ndarray) -> pa.RecordBatch:
        give_back()
        points = whole(x, scale)
        trees = [build_tree(points[:, k * width : (k + 1) * width]) for k in range(parts)]
        columns = [pa.array([c.to_pylist()], pa.list_(c.type)) for c in (ids, labels)] + [pa.array([_store(points)], pa.binary())]
        columns += [pa.array([[_store(getattr(t, name)) for t in trees]], pa.list_(pa.binary())) for name in TREE]
        return pa.record_batch(columns, names=["vec_ids", "labels", "points", *TREE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def built(batch: pa.Table) -> pa.RecordBatch:
            flat = batch.column("embedding").combine_chunks()
            flat = flat.flatten() if isinstance(flat, pa.ListArray | pa.LargeListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
            return row(batch.column("vec_id"), batch.column("label"), flat.to_numpy(zero_copy_only=False).reshape(batch.num_rows, parts * width))

        for b in batches:
            held.append(b)
            count += b.num_rows
            while count >= block:
                table = pa.Table.from_batches(held)
                yield built(table.slice(0, block))
                held, count = table.slice(block).to_batches(), count - block
        if count:
            yield built(pa.Table.from_batches(held))

    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, schema)


def _trees(b: pa.RecordBatch, k: int, parts: int, width: int) -> tuple[np.ndarray, list[Tree]]:
    points = _fetch(b.column("points")[k].as_py())
    points = points.reshape(-1, parts * width)
    stored = {name: b.column(name)[k].as_py() for name in TREE}
    trees = []
    for p in range(parts):
        x = {name: _fetch(stored[name][p]) for name in TREE}
        x["centre"], x["total"] = x["centre"].reshape(-1, width), x["total"].reshape(-1, width)
        trees.append(Tree(**x))
    return points, trees


def _round(blocks: DataFrame, books: list[np.ndarray], parts: int, width: int) -> list[np.ndarray]:
    """The codebooks after one round."""
    sent = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for b in batches:
            for k in range(b.num_rows):
                points, trees = _trees(b, k, parts, width)
                for p, tree in enumerate(trees):
                    own, book = _fitting(points[:, p * width : (p + 1) * width], sent.value[p])
                    code, owned = assign(tree, own, book)
                    rest = np.flatnonzero(code >= 0)
                    raw = points[rest, p * width : (p + 1) * width]
                    order = np.argsort(code[rest], kind="stable")
                    entries, first = np.unique(code[rest][order], return_index=True)
                    totals = np.add.reduceat(raw[order], first, axis=0) if len(first) else raw
                    found = list(zip(entries.tolist(), totals.tolist(), np.diff(np.append(first, len(rest))).tolist(), strict=True))
                    found += [(e, tree.total[ball].tolist(), int(tree.end[ball] - tree.begin[ball])) for ball, e in owned]
                    for entry, total, n in found:
                        sums[p, entry, -1] += n
                        for place, value in enumerate(total):
                            sums[p, entry, place] += value
        rows = [r for key, value in sums.items() for r in _limbs(*key, value)]
        names = [x.split()[0] for x in SUMS.split(", ")]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64() if name == "total" else pa.int32()) for i, name in enumerate(names)], names=names)

    summed = blocks.mapInArrow(run, SUMS).groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total"))
    value: Counter = Counter()
    for r in summed.collect():  # entries times components
        value[r.part, r.entry, r.place] += r.total << (LIMB * r.limb)
    out = []
    for p, book in enumerate(books):
        rows = book.astype(object)
        for e in range(len(rows)):
            n = value[p, e, -1]
            if n:
                rows[e] = [value[p, e, place] // n for place in range(width)]
        out.append(rows if _largest(rows) >= 1 << 62 else rows.astype(np.int64))
    return out


def _coded(blocks: DataFrame, books: list[np.ndarray], parts: int, width: int, label: str) -> DataFrame:
    sent = blocks.sparkSession.sparkContext.broadcast(books)
    top = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                points, trees = _trees(b, k, parts, width)
                codes, error = np.empty((len(points), parts), dtype=np.uint8 if len(sent.value[0]) <= 256 else np.dtype(">u2")), np.zeros(len(points), dtype=object)
                for p, tree in enumerate(trees):
                    own, book = _fitting(points[:, p * width : (p + 1) * width], sent.value[p])
                    code, owned = assign(tree, own, book)
                    for ball, entry in owned:
                        code[tree.order[tree.begin[ball] : tree.end[ball]]] = entry
                    codes[:, p] = code
                    away = ((own - book[code]) ** 2).sum(axis=1)
                    error = error + (away.astype(np.int64) if own.dtype != object else away)
                text = codes.tobytes().hex()
                step = len(text) // max(len(points), 1)
                yield pa.record_batch({
                    "vec_id": b.column("vec_ids")[k].values, "label": b.column("labels")[k].values,
                    "code": pa.array([text[i : i + step] for i in range(0, len(text), step)] if step else [], pa.string()),
                    "error": pa.array([min(int(e), int(top)) for e in error], pa.int64()),
                })

    return blocks.mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint")


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with an equal label, summed."""
    most = F.lit(int(np.iinfo(np.int64).max)).cast("decimal(38,0)")
    totals = saved(coded.groupBy("label").agg(F.count("*").alias("rows"), F.least(F.sum(F.col("error").cast("decimal(20,0)")), most).cast("bigint").alias("label_error")), "label-errors")
    heavy = F.col("rows") * HEAVY > coded.count()
    few = F.broadcast(totals.where(heavy).select(F.col("label").alias("same"), "label_error"))
    near = coded.join(few, F.col("label").eqNullSafe(F.col("same")), "left").drop("same")
    rest = near.where("label_error is null").drop("label_error")
    others = totals.where(~heavy).select(F.col("label").alias("same"), "label_error")
    return near.where("label_error is not null").unionByName(rest.join(others, F.col("label").eqNullSafe(F.col("same"))).drop("same"))


def train(vectors: DataFrame, blocks: DataFrame, parts: int, width: int, entries: int, rounds: int, scale: int) -> list[np.ndarray]:
    """The codebooks of all parts, as whole numbers; they start with the first vectors by id."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    start = whole(np.array([r.embedding for r in first], dtype=np.float64).reshape(len(first), parts * width), scale)
    books = [start[:, p * width : (p + 1) * width] for p in range(parts)]
    for _ in range(rounds):
        books = _round(blocks, books, parts, width)
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, block: int = BLOCK,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows (vec_id, label, code, error, label_error) of the kept vectors, and the codebooks.

    A code has two hex digits for each part (four with more than 256 entries).
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    kept = kept.where(finite & (F.size("embedding") > 0))
    label = kept.schema["label"].dataType.simpleString()
    head = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").select(F.size("embedding").alias("n")).first()
    if head is None:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error")), []
    if head.n % parts:
        raise ValueError(f"{parts} parts cannot cut vectors of {head.n} components")
    width = head.n // parts
    kept = kept.where(F.size("embedding") == head.n)
    blocks = saved(_blocks(kept, parts, width, scale, block), "vector-trees")
    books = train(kept, blocks, parts, width, entries, rounds, scale)
    return _with_label_errors(saved(_coded(blocks, books, parts, width, label), "vector-codes")), books
