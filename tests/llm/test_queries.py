"""The registered queries and the pipeline over whole small tables."""

import importlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from skyledger.llm import decontaminate, line_dedup, mixing, ngram_join, oracle, packing, quality_rules, queries
from skyledger.llm.common import saved
from tests.conftest import SMALL

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def texts(sql):
    return dict(sql.execute("SELECT doc_id, text FROM documents").fetchall())


def test_all_queries_and_the_pipeline_are_registered():
    entry = importlib.import_module("__spark_entry__")
    numbers = sorted(int(name[2:].split("_")[0]) for name in entry.queries() if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(oracle.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_matches_sql(spark, sql, name):
    frame = queries.QUERIES[name](spark, SMALL)
    cursor = sql.execute(oracle.ORACLE_SQL[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = sorted(tuple(map(str, row)) for row in cursor.fetchall())
    assert sorted(tuple(map(str, row)) for row in frame.select(*columns).collect()) == expected


def test_decontamination_query(spark, sql, texts):
    """Without errors a match is the item itself; with errors the distance is checked in its own test."""
    got = queries.QUERIES["op2_benchmark_decontamination"](spark, SMALL).collect()
    items = sql.execute("SELECT item_id, text FROM benchmark").fetchall()
    exact = {(d, i) for d, t in texts.items() for i, x in items if decontaminate.plain(x) in decontaminate.plain(t)}
    assert exact and {(r.doc_id, r.item_id) for r in got if r.errors == 0} == exact


def test_classifier_query(spark, sql, texts):
    got = {r.doc_id: r.kept for r in queries.QUERIES["op5_quality_classifier"](spark, SMALL).collect()}
    assert set(got) == set(texts)
    labels = dict(sql.execute("SELECT doc_id, quality FROM labels").fetchall())
    right = [got[d] == (q == 1) for d, q in labels.items() if d in got]
    assert sum(right) >= 0.9 * len(right)


def test_classifier_counts_are_recounted(spark, sql, texts):
    """Counts of words and pairs, their ratios and sums, and the kept documents, in plain Python."""
    import math

    import numpy as np

    from skyledger.llm import classifier
    from skyledger.llm.words import buffers, window_hashes, word_hashes, words_of

    good = {d for d, q in sql.execute("SELECT doc_id, quality FROM labels").fetchall() if q == 1}
    share = sql.execute("SELECT avg((quality = 1)::INT) FROM labels").fetchone()[0]
    shift = 64 - classifier.BUCKETS.bit_length() + 1
    counts = [Counter(), Counter()]
    features = {}
    for d, t in texts.items():
        hashes = word_hashes(words_of(*buffers(__import__("pyarrow").array([t]))), fold=True)
        features[d] = [int(h) >> shift for h in hashes] + [int(window_hashes(hashes[k : k + 2], 2)[0]) >> shift for k in range(len(hashes) - 1)]
        counts[0].update(features[d])
        counts[1].update(features[d] if d in good else [])
    totals = [sum(c.values()) + classifier.BUCKETS for c in counts]
    weight = {d: sum(math.log((counts[1][f] + 1) / totals[1]) - math.log((counts[0][f] + 1) / totals[0]) for f in own) for d, own in features.items()}
    noise = classifier._noise(np.array(list(texts), dtype=np.int64), 1)
    score = {d: weight[d] + z for d, z in zip(texts, noise.tolist(), strict=True)}
    want = int(share * len(texts) + 0.5)
    kept = set(sorted((d for d, own in features.items() if own), key=lambda d: -score[d])[:want])
    got = {r.doc_id: r for r in queries.QUERIES["op5_quality_classifier"](spark, SMALL).collect()}
    assert all(abs(r.log_weight - weight[d]) < 1e-6 and abs(r.score - score[d]) < 1e-6 for d, r in got.items())
    assert {d for d, r in got.items() if r.kept} == kept


def test_mixing_query(spark, sql, texts):
    got = queries.QUERIES["op6_source_mixing"](spark, SMALL).collect()
    assert {r.doc_id: r["size"] for r in got} == {d: len(t.encode().split()) for d, t in texts.items()}
    taken = Counter()
    for r in got:
        taken[(r.target, r.source_size)] += r.taken
        assert r.taken <= 2 * r["size"]
    sources = dict(sql.execute("SELECT doc_id, source FROM documents").fetchall())
    by_source, size, most = Counter(), Counter(), Counter()
    for r in got:
        source = sources[r.doc_id]
        by_source[source] += r.taken
        size[source] += r["size"]
        most[source] = max(most[source], r["size"])
    target = {sources[r.doc_id]: r.target for r in got}
    for source, words in by_source.items():
        assert abs(words - target[source]) <= most[source] and target[source] <= 2 * size[source]
    assert {sources[r.doc_id]: r.source_size for r in got} == size
    assert abs(sum(taken.values()) - 1.5 * sum(len(t.encode().split()) for t in texts.values())) < 0.01 * sum(taken.values())


def test_sharding_query(spark, texts):
    got = queries.QUERIES["op8_sharding"](spark, SMALL).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {d: (len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in texts.items()}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_packing_query(spark, texts):
    got = queries.QUERIES["op9_token_packing"](spark, SMALL).collect()
    tokens = Counter()
    for r in got:
        for d, a, b in zip(r.doc_ids, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            tokens[d] += b - a
    known = packing.encoder(packing.default_vocabulary())
    assert tokens == {d: len(known.encode_ordinary(t)) + 1 for d, t in texts.items() if t}


def test_pipeline_stages_take_effect(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, tables = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SMALL), name.replace(" ", "-"))
        tables.append(docs)
    good, unlike, clean, mixed, rows = tables
    assert all(t.columns == columns for t in tables[:-1])
    ids = lambda t: sorted(r.doc_id for r in t.select("doc_id").collect())
    assert ids(good) == sorted(r.doc_id for r in quality_rules.judge(spark.read.parquet(f"{SMALL}/documents.parquet")).collect() if r.kept)
    groups = {r.doc_id: r.component_id for r in ngram_join.join_components(good, n=5, percent=80).collect()}
    assert ids(unlike) == sorted(d for d, c in groups.items() if d == c)
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    found = {r.doc_id for r in decontaminate.find_items(unlike, benchmark).collect()}
    assert found and ids(clean) == sorted(set(ids(unlike)) - found)
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    assert ids(mixed) == sorted(d for d, n in copies.items() for _ in range(n))
    packed = Counter(d for r in rows.collect() for d, s in zip(r.doc_ids, r.starts, strict=True) if s == 0)
    assert packed == Counter({d: n for d, n in copies.items() if n})
    again = corpus_pipeline.run(spark, SMALL)
    assert again.columns == rows.columns and again.count() == rows.count()


def test_line_query(spark, texts):
    """Lines of every difference of lengths are compared."""
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in queries.QUERIES["op10_line_dedup"](spark, SMALL).collect()}
    lines = {}
    for d, t in texts.items():
        for p, x in enumerate(t.split("\n")):
            if x.encode().split():
                lines.setdefault(x, []).append((d, p))
    names = sorted(lines, key=len)
    parent = {x: x for x in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    budget = line_dedup.Budget()
    for k, a in enumerate(names):
        most = int(budget.edits(len(a)))
        for b in names[k + 1 :]:
            if len(b) > len(a) + most:
                break
            unlike = sum(((Counter(a) - Counter(b)) | (Counter(b) - Counter(a))).values())
            if most and root(a) != root(b) and unlike <= 2 * most and line_dedup.within(a, b, most):
                parent[root(b)] = root(a)
    first = {}
    for x in names:
        first[root(x)] = min(first.get(root(x), min(lines[x])), min(lines[x]))
    removed, total = Counter(), Counter()
    for x, places in lines.items():
        for d, p in places:
            total[d] += 1
            removed[d] += (d, p) != first[root(x)]
    assert got == {d: (total[d], removed[d]) for d in texts}
