"""Quality rules, decontamination, URL rules and the classifier against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from skyledger.llm import classifier, decontaminate, quality_rules, url_filter
from tests.llm.helpers import ODD, documents, sentence


def measures(text, least):
    raw = (text or "").encode()
    w = raw.split()
    n = len(w)

    def covered(k):
        seen, gone = Counter(tuple(w[i : i + k]) for i in range(n - k + 1)), [False] * n
        for i in range(n - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        return sum(gone)

    longest = max((k for k in range(1, n) if len({tuple(w[i : i + k]) for i in range(n - k + 1)}) < n - k + 1), default=0)
    lines = [x for x in raw.split(b"\n") if x.split()]
    return (n, sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), covered(3), covered(least), longest)


def test_quality_measures_and_verdict(spark):
    rng = random.Random(1)
    limits = quality_rules.Limits(min_words=5, min_repeat=4, max_covered=0.3, max_longest=9)
    rows = list(enumerate([*ODD[:7], *(sentence(rng, rng.randrange(80), rng.choice([2, 9, 99])) + rng.choice(["", "\n# $", "\nx\nx\n x"]) for _ in range(150))]))
    rows += [(None, rows[20][1]), (3, rows[3][1])]
    table = documents(spark, rows).repartition(3)
    got = {(r.doc_id, r.n_words): r for r in quality_rules.judge(table, limits).collect()}
    good = []
    for i, t in rows:
        m = measures(t, limits.min_repeat)
        r = got[(i, m[0])]
        assert tuple(r[x] for x in quality_rules.NAMES) == m, t
        assert r.base_failed == (m[0] < 5 or 100 * m[4] > 50 * m[0])
        assert r.kept == (not r.base_failed and m[5] <= 0.3 * m[0] and m[6] <= 9)
        good += [(i, t)] * r.kept
    kept = quality_rules.keep_good(table, limits)
    assert kept.schema == table.schema
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(good, key=str)


def test_suffixes_are_sorted_with_their_common_prefixes():
    rng = random.Random(2)
    for _ in range(100):
        text = sentence(rng, rng.randrange(1, 60), rng.choice([1, 2, 4])).encode()
        raw = np.frombuffer(text, np.uint8)
        words = quality_rules.words_of(raw, np.array([0, len(raw)]))
        suffixes, common = quality_rules.suffix_array(words)
        w = text.split()
        assert sorted(suffixes.tolist()) == list(range(len(w)))
        for k in range(1, len(w)):
            a, b = w[suffixes[k - 1] :], w[suffixes[k] :]
            same = next((m for m in range(min(len(a), len(b))) if a[m] != b[m]), min(len(a), len(b)))
            assert common[k] == same


def test_clean_long_text_is_kept_and_a_loop_is_not(spark):
    rng = random.Random(3)
    clean = sentence(rng, 30_000, 5_000)
    loop = " ".join(["the same ten words again and again and once more"] * 50)
    got = {r.doc_id: r for r in quality_rules.judge(documents(spark, [(1, clean), (2, loop), (3, clean + " " + sentence(rng, 150, 10**6) * 2)])).collect()}
    assert got[1].kept and not got[2].kept and not got[3].kept


def test_no_rows(spark):
    none = documents(spark, [])
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert quality_rules.judge(none).collect() == [] and quality_rules.keep_good(none).collect() == []
    assert decontaminate.find_items(none, items).collect() == []
    assert classifier.resample(none, spark.createDataFrame([], "doc_id bigint, quality int")).collect() == []
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id bigint, url string"), []).collect() == []


# Decontamination


def least_edits(item, text):
    p = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        q = [i]
        for j, t in enumerate(text, 1):
            q.append(min(p[j - 1] + (c != t), p[j] + 1, q[j - 1] + 1))
        p = q
    return min(p)


def damaged(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        k, kind = rng.randrange(len(chars)), rng.randrange(3)
        chars[k : k + (kind != 0)] = [] if kind == 1 else ["z"]
    return "".join(chars)


def test_items_within_their_budget_are_found(spark):
    rng = random.Random(4)
    items = [(k, sentence(rng, rng.randrange(4, 30), 300)) for k in range(8)] + [(8, None), (9, ""), (10, "short"), (11, None)]
    items += [(12, items[0][1])]
    rows = [(k, t) for k, t in enumerate(ODD[:7])]
    for k in range(10, 80):
        item = rng.choice(items[:8])[1]
        rows.append((k, f"{sentence(rng, 20, 300)}\n{damaged(rng, item, rng.randrange(6)).upper()} {sentence(rng, 9, 300)}"))
    rows += [(None, rows[30][1]), (30, rows[30][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    table = documents(spark, rows).repartition(3)
    expected = []
    for i, t in rows:
        for name, item in items:
            item, plain = decontaminate.plain(item), decontaminate.plain(t)
            if item and plain and (edits := least_edits(item, plain)) <= decontaminate.budget(len(item), 0.05, 8):
                expected.append((i, name, edits))
    for block in (8 << 20, 200):  # in one pass, and in several
        got = decontaminate.find_items(table, benchmark, rate=0.05, piece=8, block=block).collect()
        assert sorted([(r.doc_id, r.item_id, r.errors) for r in got], key=str) == sorted(expected, key=str)
        clean = decontaminate.clean(table, benchmark, rate=0.05, piece=8, block=block)
        dirty = {i for i, _, _ in expected}
        assert sorted([r.doc_id for r in clean.collect()], key=str) == sorted([i for i, _ in rows if i not in dirty], key=str)
        assert clean.schema == table.schema


def test_bit_parallel_distance():
    rng = random.Random(5)
    for _ in range(500):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))
        masks = {}
        for at, char in enumerate(item):
            masks[char] = masks.get(char, 0) | 1 << at
        assert decontaminate.best_end(item, masks, text)[0] == min(least_edits(item, text), len(item))


# URL rules

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS = [
    None, "", "no scheme", "http://", "http://NET", "http://a.net/", "http://x.example.net/en/a?b#c", "ftp://example.net/en", "https://EXAMPLE.net:80/en/",
    "http://a.b.org/fr/x", "x://é.org/fr/?", "http://..net/", "http://net/#", "//net/", "http://a?x://net/", "http://example.com/de/#", "http://notexample.com/de/", "http://org\n/fr/",
]


def judged(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, a) for a, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (r[0], r[1], r[3] == "block"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("small", [url_filter.SMALL, 0])
def test_url_rules(spark, small):
    rng = random.Random(6)
    hosts = [".".join(rng.choice(["a", "b", "ab", "net", "org"]) for _ in range(rng.randrange(1, 5))) for _ in range(80)]
    urls = URLS + [f"http://{h}{p}" for h in hosts for p in ("", "/", "/x/y", "/x?z")]
    rows = list(enumerate(urls)) + [(1, urls[1]), (None, urls[30])]
    pages = spark.createDataFrame([(i, u, "html", "h") for i, u in rows], "page_id bigint, url string, html string, host string")
    more = RULES + [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(["", "/", "/x", "/x/y"])) for _ in range(60)]
    for rules in (RULES, more):
        table = spark.createDataFrame(rules, "action string, host string, path string")
        got = url_filter.judge_urls(pages.repartition(3), table, small=small).collect()
        expected = [(i, *judged(u, rules)) for i, u in rows]
        assert sorted([tuple(r) for r in got], key=str) == sorted(expected, key=str)


# Classifier


def test_classifier_on_held_out_labels(spark):
    rng = random.Random(7)
    good = lambda: sentence(rng, rng.randrange(20, 90), 50)
    bad = lambda: " | ".join(f"J{rng.randrange(50)}" for _ in range(rng.randrange(20, 90)))
    rows = [(k, good() if k % 4 else bad()) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(0, 400, 2)] + [(None, 1, 0), (10**6, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    table = documents(spark, rows).repartition(3)
    got = {r.doc_id: r.kept for r in classifier.resample(table, labels, fraction=0.75).collect()}
    held_out = [k for k in range(1, 400, 2)]
    assert np.mean([got[k] == (k % 4 > 0) for k in held_out]) > 0.97
    again = {r.doc_id: r.kept for r in classifier.resample(table.repartition(7), labels, fraction=0.75).collect()}
    assert got == again and sum(got.values()) == 300


def test_classifier_with_odd_rows(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "a b c"), (None, "a b c"), (4, ODD[4])]
    labels = spark.createDataFrame([(7, 1)], "doc_id bigint, quality int")
    for fraction in (None, 0.0, 0.5, 1.0):
        got = classifier.resample(documents(spark, rows), labels, fraction=fraction).collect()
        assert len(got) == len(rows)
        assert all(not r.kept for r in got if r.n_words == 0)
        ranked = sorted((r for r in got if r.n_words), key=lambda r: -r.score)
        assert [r.kept for r in ranked] == sorted((r.kept for r in ranked), reverse=True)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.log_weight for r in classifier.resample(documents(spark, rows), none).collect()} == {0.0}


def test_rank_selection_is_exact(spark):
    rng = random.Random(8)
    values = [rng.randrange(-(2**63), 2**63) for _ in range(200)] + [5, 5, 5, -1, 0, 2**63 - 1, -(2**63)]
    keys = spark.createDataFrame([(v,) for v in values], "key bigint")
    for rank in (1, 2, 100, 104, len(values)):
        assert classifier.key_of_rank(keys, rank) == sorted(values, reverse=True)[rank - 1]
    assert classifier.key_of_rank(keys, len(values) + 1) is None


def test_largest_id_is_no_null(spark):
    from skyledger.llm import classifier, decontaminate, packing, quality_rules

    top = 2**63 - 1
    docs = documents(spark, [(top, "one two three four"), (None, "one two three four")])
    both = {top, None}
    assert {r.doc_id for r in quality_rules.judge(docs).collect()} == both
    items = spark.createDataFrame([(1, "one two three four")], "item_id bigint, text string")
    assert {r.doc_id for r in decontaminate.find_items(docs, items).collect()} == both
    labels = spark.createDataFrame([(top, 1)], "doc_id bigint, quality int")
    assert {r.doc_id for r in classifier.resample(docs, labels).collect()} == both
    assert {d for r in packing.pack(docs, room=16).collect() for d in r.doc_ids} == both
