"""Phrase automata against dictionaries, and collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import automata, collocations
from tests.llm.helpers import ODD

SCHEMA = "doc_id bigint, text string, lang string, phrase string, rank int, bucket int, n bigint"


def table(spark, rows):
    return spark.createDataFrame([(k, t, g, "p", 1, 2, 3) for k, (t, g) in enumerate(rows)], SCHEMA)


def by_hand(rows, min_count, percent, top):
    count, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                count.update((lang, *words[k : k + size]) for k in range(len(words) - size + 1))
    candidates = {p: a for p, a in count.items() if len(p) > 2 and a >= min_count}
    found = defaultdict(list)
    for p, a in candidates.items():
        lang, words = p[0], p[1:]
        longer = [f for q, f in candidates.items() if q[0] == lang and len(q) > len(p) and any(q[k : k + len(words)] == words for k in range(1, len(q) - len(words) + 1))]
        if any(100 * f >= percent * a for f in longer):
            continue
        cuts = [(10**6 * a * a // (count[lang, *words[:k]] * count[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), count[lang, *words[:k]], count[lang, *words[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1)
    )


def got(frame):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


def prose(seed, n, words=12):
    rng = random.Random(seed)
    marks = ["", "", "", "", ",", ".", "\n", "!\t"]
    return " ".join(rng.choice(["the", "The", "of", f"w{rng.randrange(words)}", f"É{rng.randrange(3)}", "x\x00y"]) + rng.choice(marks) for _ in range(n))


@pytest.mark.parametrize("settings", [{}, {"shard": 400, "per_range": 300, "left": 300, "wide": 2}, {"shard": 1000, "per_range": 500, "left": 2000, "wide": 512}])
def test_collocations_as_counted_by_hand(spark, settings):
    rows = [(prose(k, 60), ["en", "de", None, "und"][k % 4]) for k in range(40)] + [(t, "odd") for t in ODD] + [(None, None)]
    rows += [("same words here again. " * 30, "rep")] * 3
    expected = by_hand(rows, 4, 50, 25)
    assert expected and {r[0] for r in expected} >= {"en", "de", "und", "rep"}
    assert got(collocations.collocations(table(spark, rows), min_count=4, top=25, **settings)) == expected


def test_very_long_text_and_threshold_of_inside(spark):
    rows = [("a b c " * 20_000 + ". a b", "en"), ("a b d. " * 19_999, "en"), ("a b. " * 3, "en")]
    for percent in (10, 50, 67):
        assert got(collocations.collocations(table(spark, rows), inside_percent=percent)) == by_hand(rows, 10, percent, 2000)


def test_no_rows_and_no_candidates(spark):
    empty = collocations.collocations(table(spark, []))
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.count() == 0
    assert collocations.collocations(table(spark, [("one two three", "en"), (None, None), ("", "de")])).count() == 0


def test_scores_pass_64_bits():
    a = np.array([3 * 10**9, 10], dtype=np.int64)
    assert collocations.scores(a, np.array([4 * 10**9, 10]), np.array([5 * 10**9, 11])) == [10**6 * 9 // 20, 10**6 * 100 // 110]


def sequences(a):
    rows, weights = a.sequences()
    words = a.words.to_pylist()
    return {tuple(words[k] for k in row if k >= 0): w for row, w in zip(rows.tolist(), weights.tolist(), strict=True)}


def made(counts, part=None):
    words = sorted({w for s in counts for w in s})
    rows = np.array([[words.index(w) for w in s] + [-1] * (4 - len(s)) for s in sorted(counts)], dtype=np.int32).reshape(-1, 4)
    weights = np.array([counts[s] for s in sorted(counts)], dtype=np.int64)
    return automata.read(automata.build(pa.array(words, pa.large_binary()), np.zeros(len(rows), np.int64), rows, weights)[0][1])


def some(seed, n=300):
    rng = random.Random(seed)
    return {tuple(f"w{rng.randrange(6)}".encode() for _ in range(rng.randrange(1, 5))): rng.choice([1, 1, 1, 2, 300, 70_000, 1 << 33]) for _ in range(n)}


def test_automata_hold_what_went_in_and_share_states():
    counts = some(1)
    assert sequences(made(counts)) == counts
    alike = {(a, b, c, d): 1 for a in (b"a", b"b", b"c") for b in (b"a", b"b") for c in (b"x", b"y") for d in (b"x", b"y", b"z")}
    a = made(alike)
    assert sequences(a) == alike and [len(level.first) - 1 for level in a.levels] == [1, 1, 1, 1]


def test_states_with_equal_hashes_are_compared(monkeypatch):
    counts = some(2)
    monkeypatch.setattr(automata, "mixed", lambda x: np.zeros_like(x))
    assert sequences(made(counts)) == counts


def test_union_adds_or_takes_the_largest():
    parts = [some(k, 80) for k in range(4)]
    for largest in (False, True):
        expected: dict = {}
        for p in parts:
            for s, w in p.items():
                expected[s] = max(expected.get(s, 0), w) if largest else expected.get(s, 0) + w
        words, rows, weights = automata.union([made(p) for p in parts], largest)
        names = words.to_pylist()
        assert {tuple(names[k] for k in row if k >= 0): w for row, w in zip(rows.tolist(), weights.tolist(), strict=True)} == expected


def test_composition_and_lookup():
    one, other = some(5), some(6, 500) | {(b"new",): 3, (b"w1", b"new", b"w2"): 4}
    a, b = made(one), made(other)
    rows, theirs, ours = a.compose(b)
    names = b.words.to_pylist()
    found = {tuple(names[k] for k in row if k >= 0): (x, y) for row, x, y in zip(rows.tolist(), theirs.tolist(), ours.tolist(), strict=True)}
    assert found == {s: (w, one.get(s, 0)) for s, w in other.items()}
    asked = [s for s in other if b"new" not in s]
    rows = np.array([[a.words.to_pylist().index(w) for w in s] + [-1] * (4 - len(s)) for s in asked])
    assert a.weights_of(rows).tolist() == [one.get(s, 0) for s in asked]


def test_automata_of_many_parts_are_those_of_each_part():
    parts = [some(k, 40) for k in range(5)]
    words = sorted({w for p in parts for s in p for w in s})
    keys = [(k, s) for k, p in enumerate(parts) for s in sorted(p)]
    rows = np.array([[words.index(w) for w in s] + [-1] * (4 - len(s)) for _, s in keys], dtype=np.int32)
    built = automata.build(pa.array(words, pa.large_binary()), np.array([k for k, _ in keys]) * 3, rows, np.array([parts[k][s] for k, s in keys]))
    assert [k for k, _ in built] == [0, 3, 6, 9, 12]
    assert [sequences(automata.read(x)) for _, x in built] == parts
