"""Substring dedup, the n-gram join and line dedup against brute force."""

import random

import pytest

from skyledger.llm import line_dedup, ngram_join, substring_dedup
from tests.llm.helpers import ODD, documents, sentence


def corpus(seed):
    rng = random.Random(seed)
    passage = sentence(rng, 30, 500)
    rows = [(k, t) for k, t in enumerate(ODD)]
    for k in range(10, 40):
        parts = [sentence(rng, rng.randrange(1, 60), 500)]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(2), passage)
        rows.append((k, "\n".join(parts)))
    base = sentence(rng, 80, 500).split()
    for k in range(40, 60):  # near copies
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(80)] = f"n{rng.randrange(999)}"
        rows.append((k, " ".join(words)))
    rows += [(60, rows[45][1]), (61, rows[45][1].upper()), (45, rows[45][1]), (45, "another text of the id 45"), (None, rows[45][1]), (None, None)]
    rng.shuffle(rows)
    return rows


def repeats(rows, width):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    rank = lambda i: (i is None, i or 0)
    least = {}
    for i, w in words:
        for a in range(len(w) - width + 1):
            key = tuple(w[a : a + width])
            least[key] = min(least.get(key, rank(i)), rank(i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for a in range(len(w) - width + 1):
            if least[tuple(w[a : a + width])] < rank(i):
                gone[a : a + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def same(a, b):
    return sorted(a, key=str) == sorted(b, key=str)


@pytest.mark.parametrize("width", [1, 5, 20])
def test_substring_dedup(spark, width):
    rows = corpus(1)
    got = substring_dedup.remove_repeats(documents(spark, rows).repartition(3), width).collect()
    assert same([(r.doc_id, r.n_words, r.n_removed, r.text) for r in got], repeats(rows, width))
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_substring_dedup_in_pieces(spark, monkeypatch):
    """Windows that only meet in a bucket, not in a piece."""
    rows = corpus(2)
    table = documents(spark, rows).repartition(len(rows))
    got = substring_dedup.remove_repeats(table, 10, buckets=7).collect()
    assert same([(r.doc_id, r.n_words, r.n_removed, r.text) for r in got], repeats(rows, 10))


def test_empty_tables(spark):
    none = documents(spark, [])
    assert substring_dedup.remove_repeats(none).collect() == []
    assert ngram_join.join_components(none).collect() == []
    assert ngram_join.keep_one(none).collect() == []
    assert line_dedup.remove_lines(none).collect() == []


def grams(text, n):
    w = (text or "").encode()
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in w).split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def linked(rows, n, percent):
    sets = [grams(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return sets, [root(k) for k in range(len(rows))]


@pytest.mark.parametrize(("n", "percent", "block"), [(4, 85, 1 << 22), (5, 80, 1 << 22), (4, 85, 300), (2, 50, 200)])
def test_ngram_join(spark, n, percent, block):
    rows = corpus(3)
    sets, roots = linked(rows, n, percent)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    expected = [(i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots, strict=True)]
    got = ngram_join.join_components(documents(spark, rows).repartition(4), n, percent, block=block)
    assert same([(r.doc_id, r.size, r.component_id) for r in got.collect()], expected)


def test_keep_one_of_each_component(spark):
    rows = corpus(4)
    table = documents(spark, rows).repartition(4)
    sets, roots = linked(rows, 5, 80)
    kept = ngram_join.keep_one(table, 5, 80)
    assert kept.columns == table.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    expected = [row for row, s in zip(rows, sets, strict=True) if not s]
    for r in set(roots):
        members = [rows[k] for k in range(len(rows)) if roots[k] == r and sets[k]]
        if members:
            least = min((i is None, i or 0) for i, _ in members)
            assert sum((i is None, i or 0) == least and (i, t) in got for i, t in set(members)) == 1
            expected.append(None)
    assert len(got) == len(expected)


def test_many_copies_and_a_common_gram(spark):
    rng = random.Random(9)
    common = "the of and to in"
    rows = [(k, f"{common} {sentence(rng, 30, 10**6)}") for k in range(150)]
    copy = sentence(rng, 60, 10**6)
    rows += [(k, copy) for k in range(1000, 1200)]
    rows += [(k, f"{copy} tail{k}") for k in range(2000, 2150)]
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(documents(spark, rows), block=4000).collect()}
    assert all(got[k] == k for k in range(150))
    assert {got[k] for k in got if k >= 1000} == {1000}


# Lines


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        q = [i]
        for j, t in enumerate(b, 1):
            q.append(min(p[j - 1] + (c != t), p[j] + 1, q[j - 1] + 1))
        p = q
    return p[-1]


def changed(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        k, kind = rng.randrange(len(chars) or 1), rng.randrange(3) if chars else 0
        if kind == 0:
            chars.insert(k, rng.choice("abcé"))
        elif kind == 1:
            chars.pop(k)
        else:
            chars[k] = rng.choice("abcé")
    return "".join(chars)


def test_banded_distance():
    rng = random.Random(5)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
        b = changed(rng, a, rng.randrange(4)) if a else "ab"[: rng.randrange(3)]
        for most in (1, 2, 3):
            assert line_dedup.within(a, b, most) == (edit_distance(a, b) <= most), (a, b, most)


def kept_lines(rows, budget):
    rank = lambda i, t, p: (i is None, i or 0, t, p)
    lines = {}
    for i, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            if line.encode().split():
                lines.setdefault(line, []).append(rank(i, t, p))
    names = list(lines)
    parent = {x: x for x in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(names):
        for b in names[:k]:
            most = budget.edits(min(len(a), len(b)))
            if most and abs(len(a) - len(b)) <= most and edit_distance(a, b) <= most:
                parent[root(a)] = root(b)
    first = {}
    for x in names:
        first[root(x)] = min(first.get(root(x), min(lines[x])), min(lines[x]))
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        worded = [p for p, x in enumerate(own) if x.encode().split()]
        gone = {p for p in worded if rank(i, t, p) != first[root(own[p])]}
        out.append((i, len(worded), len(gone), None if t is None else "\n".join(x for p, x in enumerate(own) if p not in gone)))
    return out


@pytest.mark.parametrize("block", [16 << 20, 400])
def test_line_dedup(spark, block):
    rng = random.Random(6)
    budget = line_dedup.Budget(short=10, long=20)
    stock = ["".join(rng.choice("abcdefé ") for _ in range(rng.randrange(1, 45))) for _ in range(12)]
    rows = [(k, t) for k, t in enumerate(ODD[:7])]
    for k in range(10, 50):
        own = [changed(rng, rng.choice(stock), rng.randrange(4)) for _ in range(rng.randrange(1, 6))]
        rows.append((k, "\n".join([*own, "", " "][: rng.randrange(1, 8)])))
    rows += [(None, rows[20][1]), (70, rows[20][1])]
    got = line_dedup.remove_lines(documents(spark, rows).repartition(5), budget, block=block, buckets=5).collect()
    assert same([(r.doc_id, r.n_lines, r.n_removed, r.text) for r in got], kept_lines(rows, budget))


def test_budget_of_long_lines_grows():
    budget = line_dedup.Budget()
    assert [int(budget.edits(n)) for n in (29, 30, 60, 119, 120, 200, 1000, 4000)] == [0, 1, 2, 2, 3, 5, 25, 100]
    for rate in (10, 40):
        b = line_dedup.Budget(rate=rate)
        assert all(-(-(n - b.edits(n)) // (b.edits(n) + 1)) >= b.run for n in range(b.least, 5000))
        assert b.gram + b.span - 1 == b.run


def test_banded_distance_of_many_edits():
    rng = random.Random(8)
    for _ in range(150):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(20, 120)))
        b = changed(rng, a, rng.randrange(30))
        true = edit_distance(a, b)
        assert all(line_dedup.within(a, b, most) == (true <= most) for most in (3, 5, 9, 20))


@pytest.mark.parametrize("block, near", [(16 << 20, 256), (2000, 256), (16 << 20, 2)])
def test_line_dedup_of_long_lines(spark, monkeypatch, block, near):
    """Long lines with many edits, at the edges of their budgets, by the default budget."""
    monkeypatch.setattr(line_dedup, "NEAR", near)
    rng = random.Random(9)
    budget = line_dedup.Budget()
    stock = ["".join(rng.choice("abcdefghé ") for _ in range(n)) for n in (115, 119, 121, 158, 161, 240, 330, 400)]
    rows = []
    for k in range(60):
        line = stock[k % len(stock)]
        rows.append((k, "\n".join([changed(rng, line, rng.randrange(len(line) // 25 + 1)), f"line {k}"])))
    rows += [(100, stock[7]), (101, stock[7][:150] + "another" + stock[7][154:])]
    got = line_dedup.remove_lines(documents(spark, rows).repartition(5), budget, block=block, buckets=5).collect()
    expected = kept_lines(rows, budget)
    assert same([(r.doc_id, r.n_lines, r.n_removed, r.text) for r in got], expected)
    two = kept_lines(rows, line_dedup.Budget(rate=1 << 20))
    assert sum(x[2] for x in expected) > sum(x[2] for x in two) + 5


def test_lost_places_of_repeated_rows_are_listed_once(spark, monkeypatch):
    kept = {}
    save = line_dedup.saved
    monkeypatch.setattr(line_dedup, "saved", lambda df, label: kept.setdefault(label, save(df, label)))
    rows = [(1, "one line\nanother line")] + [(None, "one line\nanother line")] * 20
    got = line_dedup.remove_lines(documents(spark, rows)).collect()
    assert sorted(r.n_removed for r in got) == [0] + [2] * 20
    assert [sorted(r.places) for r in kept["lost-lines"].collect()] == [[0, 1]]


def test_keep_one_keeps_wordless_rows_even_if_every_bit_is_set(spark, monkeypatch):
    import numpy as np

    from skyledger.llm import common

    rows = [(None, None), (None, None), (4, " "), (4, " "), (4, " "), (7, "a b c d e f"), (7, "a b c d e f"), (9, "a b c d e f")]
    expected = [(4, " ")] * 3 + [(7, "a b c d e f")] + [(None, None)] * 2
    for full in (False, True):
        if full:
            monkeypatch.setattr(common, "bitmap", lambda keys: np.full(common.BITMAP_BITS // 8, 255, np.uint8))
        kept = ngram_join.keep_one(documents(spark, rows), 5, 80).collect()
        assert sorted(((r.doc_id, r.text) for r in kept), key=str) == expected


def test_substring_dedup_of_the_largest_id_and_of_ids_with_a_stride(spark):
    top = 2**63 - 1
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(8 * k, text + f" end{k}") for k in range(12)] + [(top, text), (-5, text)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(documents(spark, rows), width=50).collect()}
    assert got == {**{8 * k: 60 for k in range(12)}, top: 60, -5: 0}


def test_shared_runs_count_copies_once_whatever_the_slices(monkeypatch):
    import numpy as np

    from skyledger.llm import line_dedup
    from skyledger.llm.common import binary_table

    near = "".join(chr(97 + k * k % 26) for k in range(200))
    far = "".join(chr(110 + k * k % 13) for k in range(150)) + near[-50:]
    lines = [near] * 300 + [near[:90] + "z" + near[91:], far]
    text = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32)
    bounds = np.arange(0, 200 * len(lines) + 1, 200)
    names = np.array([1] * 300 + [2, 3], dtype=np.int64)
    of, signs = line_dedup._least_hashes(text, bounds, line_dedup.Budget())
    bins = line_dedup._bins(text, bounds)
    count = np.bincount(of, minlength=len(lines)).astype(np.uint32)
    low = (signs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    table = binary_table([(0, names, count, low, np.full(len(lines), 200, np.uint32), bins)], line_dedup.RUNS)
    for entries in (None, 100):
        if entries:
            monkeypatch.setattr(line_dedup, "SLICE", entries)
        found = line_dedup._near(line_dedup.Budget())(table)
        assert list(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True)) == [(2, 1)]
    some, other = np.arange(32, dtype=np.uint8).reshape(2, 16) * 8, np.full((2, 16), 255, np.uint8)
    assert line_dedup._apart(some, other).tolist() == np.abs(some.astype(int) - other).sum(axis=1).tolist()


def test_pairs_compared_at_once_are_within_as_one_by_one():
    import numpy as np

    rng = random.Random(12)
    for _ in range(20):
        pairs = []
        while len(pairs) < 30:
            a = "".join(rng.choice("abcé") for _ in range(rng.randrange(20, 120)))
            a, b = sorted((a, changed(rng, a, rng.randrange(30))), key=len)
            most = rng.randrange(14)
            if len(b) - len(a) <= most:
                pairs.append((a, b, most))
        words, bounds = line_dedup.low_bytes([x for a, b, _ in pairs for x in (a, b)])
        first = np.arange(len(pairs)) * 2
        got = line_dedup.perhaps_within(words, bounds, first, first + 1, np.array([most for *_, most in pairs]))
        assert got.tolist() == [line_dedup.within(a, b, most) for a, b, most in pairs]


def test_lines_that_share_runs_in_a_row_meet_at_the_first_only():
    import numpy as np

    from skyledger.llm.common import binary_table, by_owner

    rng = random.Random(13)
    near = "".join(rng.choice("abcdefgh ") for _ in range(400))
    lines = [near, near[:200] + "z" + near[201:], near[:50] + "z" + near[50:]]
    chars = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in lines])))
    names = np.arange(1, 4, dtype=np.int64)
    budget = line_dedup.Budget()
    buckets = 16
    signed = line_dedup._runs_signed(names, chars, bounds, budget, buckets)
    near_of = line_dedup._near(budget)
    found = [near_of(signed.filter(np.asarray(signed.column("bucket")) == k)) for k in sorted(set(signed.column("bucket").to_pylist()))]
    ties = [t for f in found for t in zip(f["a"].to_pylist(), f["b"].to_pylist(), strict=True)]
    # Without the signs before, every bucket ties them again.
    line, signs = line_dedup._least_hashes(chars, bounds, budget)
    packs = by_owner(line_dedup.ranges(line_dedup.mixed(signs), buckets), line, (signs & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    bins, size = line_dedup._bins(chars, bounds), np.diff(bounds).astype(np.uint32)
    plain = [near_of(binary_table([(key, names[own], count, low, size[own], bins[own])], line_dedup.RUNS)) for key, own, count, low in packs]
    assert {x for t in ties for x in t} == {1, 2, 3}
    assert len(ties) <= 6 < sum(f.num_rows for f in plain)


def test_bytes_sent_for_long_lines_do_not_grow_with_the_buckets():
    import numpy as np

    rng = random.Random(14)
    lines = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(120, 900))) for _ in range(120)]
    chars = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in lines])))
    sent = []
    for buckets in (12, 3000):
        table = line_dedup._runs_signed(np.arange(len(lines)), chars, bounds, line_dedup.Budget(), buckets)
        sent.append(sum(len(x) for c in table.column_names[1:] for x in table.column(c).to_pylist()))
    assert sent[0] == sent[1] < 2 * len(chars)


def test_lines_at_the_edge_of_their_budget_meet():
    import numpy as np

    rng = random.Random(15)
    budget = line_dedup.Budget()
    near_of, pairs = line_dedup._near(budget), 0
    for n in (120, 121, 159, 160, 199, 240, 399, 441, 799, 801, 1600, 2601):
        for kind in ("change", "insert", "remove"):
            a = [chr(97 + rng.randrange(20)) for _ in range(n)]
            b, most = list(a), int(budget.edits(n))
            # As evenly as possible, so that no stretch between two edits is longer than it must be.
            for k in range(most, 0, -1):
                at = min(n - 1, k * n // (most + 1) + rng.randrange(2))
                b[at : at + (kind != "insert")] = [] if kind == "remove" else ["é"]
            short, long = sorted(("".join(a), "".join(b)), key=len)
            if not line_dedup.within(short, long, int(budget.edits(len(short)))):
                continue
            pairs += 1
            chars = np.frombuffer((short + long).encode("utf-32-le"), dtype=np.uint32)
            bounds = np.array([0, len(short), len(short) + len(long)])
            signed = line_dedup._runs_signed(np.array([3, (1 << 40) - 2]), chars, bounds, budget, 7)
            found = [near_of(signed.filter(np.asarray(signed.column("bucket")) == k)) for k in set(signed.column("bucket").to_pylist())]
            ties = {t for f in found for t in zip(f["a"].to_pylist(), f["b"].to_pylist(), strict=True)}
            assert ties == ({((1 << 40) - 2, 3)}), (n, kind)
    assert pairs > 24
