"""Vector codes against plain whole-number rounds, and the trees against their definition."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from skyledger.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error bigint, rows bigint, same string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", 1, 2, "y") for i, v, g in rows], SCHEMA)


def by_hand(rows, parts, entries, rounds, scale=1024):
    """(sorted rows of vec_id, code, error, label_error; codebooks) with Python's whole numbers only."""
    kept = [(i, v, g) for i, v, g in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    whole = [[int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in v] for _, v, _ in kept]
    cut = [[v[p * width : (p + 1) * width] for v in whole] for p in range(parts)]
    books = [[list(v) for v in own[:entries]] for own in cut]

    def away(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def near(p):
        return [min((away(v, e), k) for k, e in enumerate(books[p])) for v in cut[p]]

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for v, (_, k) in zip(cut[p], near(p), strict=True):
                members[k].append(v)
            for k, own in members.items():
                books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [near(p) for p in range(parts)]
    top, total = 2**63 - 1, defaultdict(int)
    out = []
    for n, (i, _, g) in enumerate(kept):
        error = min(sum(last[p][n][0] for p in range(parts)), top)
        total[g] += error
        out.append((i, "".join(f"{last[p][n][1]:02x}" for p in range(parts)), error, g))
    return sorted(((i, c, e, min(total[g], top)) for i, c, e, g in out), key=str), books


def check(spark, rows, parts=2, entries=4, rounds=3, block=16):
    coded, books = vector_codes.compress(table(spark, rows), parts=parts, entries=entries, rounds=rounds, block=block)
    expected, expected_books = by_hand([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], g) for i, v, g in rows], parts, entries, rounds)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()), key=str) == expected
    assert [b.tolist() for b in books] == expected_books
    return expected


def test_random_vectors_with_ties_and_labels(spark):
    rng = random.Random(3)
    rows = [(k, [rng.randrange(-3, 4) / 1024 for _ in range(4)], rng.choice([None, 1, 1, 1, 2])) for k in range(300)]
    check(spark, rows, entries=16)


def test_nulls_odd_lengths_repeats_and_null_ids(spark):
    good = [(5, [0.5, 0.25, -0.5, 1.0], 1), (3, [0.1, 0.2, 0.3, 0.4], None), (3, [0.1, 0.2, 0.3, 0.4], None), (3, [0.0, 0.2, 0.3, 0.4], 2), (None, [1.0, 1.0, 1.0, 1.0], None), (-9, [-1.0, -0.001, 0.0, 0.3], 2)]
    bad = [(0, None, 1), (1, [], 1), (2, [0.1, None, 0.2, 0.3], 1), (4, [float("nan"), 0.0, 0.0, 0.0], 1), (6, [float("inf"), 0.0, 0.0, 0.0], 1), (7, [0.1, 0.2], 1)]
    assert len(check(spark, good + bad)) == len(good)


def test_numbers_of_any_size(spark):
    rows = [(k, [3e38 * (-1) ** k, 1e30 * k, 0.5, -2e25], k % 2) for k in range(12)] + [(20, [1.0, 2.0, 3.0, 4.0], 0)]
    check(spark, rows, entries=3, block=8)


def test_empty_table_single_vector_and_wrong_length(spark):
    coded, books = vector_codes.compress(table(spark, []))
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"] and coded.count() == 0 and books == []
    check(spark, [(1, [0.5, 0.5], 7)])
    with pytest.raises(ValueError):
        vector_codes.compress(table(spark, [(1, [0.5, 0.5, 0.5], 7)]), parts=2)


def test_labels_without_many_rows_are_joined_the_same(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "HEAVY", 4)
    rng = random.Random(4)
    rows = [(k, [rng.random(), rng.random()], None if k % 9 == 0 else k % 50 if k % 2 else 1) for k in range(200)]
    check(spark, rows)


@pytest.mark.parametrize(("n", "width", "spread"), [(1, 3, 9), (60, 1, 2), (400, 2, 40), (900, 5, 1000), (200, 3, 0)])
def test_trees_hold_every_point_and_assign_exactly(n, width, spread):
    rng = np.random.default_rng(n)
    centres = rng.integers(-50 * spread, 50 * spread + 1, (5, width))
    points = centres[rng.integers(0, 5, n)] + rng.integers(-spread, spread + 1, (n, width))
    tree = vector_codes.build_tree(points)
    assert sorted(tree.order.tolist()) == list(range(n))
    for ball in range(len(tree.radius)):
        own = points[tree.order[tree.begin[ball] : tree.end[ball]]]
        assert (own.sum(axis=0) == tree.total[ball]).all()
        assert (np.sqrt(((own - tree.centre[ball]) ** 2).sum(axis=1)) <= tree.radius[ball] * (1 + 1e-9) + 1e-9).all()
        if tree.left[ball]:
            assert tree.begin[ball] == tree.begin[tree.left[ball]] and tree.end[ball] == tree.end[tree.right[ball]] and tree.end[tree.left[ball]] == tree.begin[tree.right[ball]]
    book = np.concatenate([centres, points[: min(n, 20)]])
    own, entries = vector_codes._fitting(points, book)
    code, owned = vector_codes.assign(tree, own, entries)
    for ball, entry in owned:
        code[tree.order[tree.begin[ball] : tree.end[ball]]] = entry
    assert (code == ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    if spread and n >= 400:  # balls are owned as a whole
        _, owned = vector_codes.assign(tree, *vector_codes._fitting(points, centres))
        assert sum(tree.end[b] - tree.begin[b] for b, _ in owned) > n / 2


def test_anchors_own_what_is_nearest_to_them():
    rng = np.random.default_rng(8)
    points = rng.normal(size=(300, 3))
    groups = vector_codes.anchors(points, 17)
    assert len(groups) == 17 and sorted(np.concatenate(groups).tolist()) == list(range(300))
    assert len(vector_codes.anchors(np.zeros((9, 2)), 3)) == 1


def test_more_entries_than_a_byte(spark):
    rows = [(k, [k / 1024, -k / 1024], 0) for k in range(300)]
    coded, books = vector_codes.compress(table(spark, rows), parts=2, entries=300, rounds=1)
    assert {r.vec_id: r.code for r in coded.collect()} == {k: f"{k:04x}" * 2 for k in range(300)} and len(books[0]) == 300
