"""Mixing, sharding and packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skyledger.llm import mixing, packing, sharding
from tests.llm.helpers import ODD, documents, sentence


def corpus(seed, n=300):
    rng = random.Random(seed)
    rows = [(k, t) for k, t in enumerate(ODD)]
    rows += [(k, sentence(rng, rng.randrange(1, 120))) for k in range(10, n)]
    rows += [(None, "a b c"), (None, "a b c"), (12, rows[12][1]), (12, "another text")]
    sources = [rng.choice(["s0"] * 4 + ["s1", "s10", "é", "", None]) for _ in rows]
    return rows, sources


def water(sizes, weights, share, cap):
    """Targets by sharing again and again what full sources leave over."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, rest, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("share", [1.5, 0.4, 2.0])
def test_mix_meets_its_targets(spark, share):
    rows, sources = corpus(1)
    table = documents(spark, rows, sources).repartition(3)
    got = mixing.mix(table, share=share).collect()
    assert sorted([(r.doc_id, r.size) for r in got], key=str) == sorted([(i, len((t or "").encode().split())) for i, t in rows], key=str)
    sizes, by_row = Counter(), defaultdict(set)
    for (i, t), s in zip(rows, sources, strict=True):
        sizes[s] += len((t or "").encode().split())
        by_row[(i, len((t or "").encode().split()))].add(s)
    expected = water(sizes, (3, 1, 2), share, 2)
    taken = Counter()
    for r in got:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2 and 0 <= r.rate <= 2
        taken[(round(r.target, 6), r.source_size)] += r.taken
    for s, size in sizes.items():
        assert any(abs(t - round(expected[s], 6)) < 1e-3 and n == size and abs(words - expected[s]) <= 12 for (t, n), words in taken.items()), s
    again = mixing.mix(table.repartition(5), share=share).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_tilt_is_exponential(spark):
    """Rates of one source lie on one curve in the size of the document."""
    rows, _ = corpus(2)
    got = mixing.mix(documents(spark, rows, [("a", "b")[k % 2] for k in range(len(rows))]), weights=(1, 3)).collect()
    for source in {r.source_size for r in got}:
        slopes = [np.log(r.rate / (2 - r.rate)) / r.size for r in got if r.source_size == source and r.size and 0 < r.rate < 2]
        assert len(slopes) > 20 and np.ptp(slopes) < 1e-6


def test_repeated_rows_of_the_mix(spark):
    rows, sources = corpus(3)
    table = documents(spark, rows, sources)
    table = table.withColumn("copies", table.n_chars).withColumn("doc", table.lang)
    copies = Counter()
    for r in mixing.mix(table).collect():
        copies[(r.doc_id, r.size)] = max(copies[(r.doc_id, r.size)], r.copies)
    out = mixing.repeated(table)
    assert out.columns == table.columns
    found = Counter((r.doc_id, len((r.text or "").encode().split())) for r in out.collect())
    times = Counter((i, len((t or "").encode().split())) for i, t in rows)
    assert found == Counter({k: n * times[k] for k, n in copies.items() if n})


def test_ranks_over_partitions(spark):
    rows = spark.createDataFrame([(f"v{k:03d}",) for k in range(200)] + [(None,)], "v string").repartition(7)
    got = {r.v: r["rank"] for r in mixing.ranked(rows, rows.v.asc_nulls_last()).collect()}
    assert got == {f"v{k:03d}": k for k in range(200)} | {None: 200}


def test_empty_tables(spark):
    none = documents(spark, [])
    assert mixing.mix(none).collect() == [] and mixing.repeated(none).collect() == []
    assert sharding.shard(none).collect() == []
    assert packing.pack(none).collect() == []


# Shards


@pytest.mark.parametrize("bucket", [20_000, 40])
def test_shards_are_balanced_and_groups_whole(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET", bucket)
    rows, sources = corpus(4, 600)
    rows += [(5000 + k, "one text that very many rows share") for k in range(150)]
    table = documents(spark, rows).repartition(4)
    got = sharding.shard(table, shards=8).collect()
    raw = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len(raw(t)) + 16, zlib.crc32(raw(t))) for i, t in rows)
    total, slots, places = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
        places[bytes(r.text_key)].add(r["shard"])
    assert all(len(p) == 1 for p in places.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(Counter({k: sum(len(raw(t)) + 16 for _, t in rows if t == k) for k in {t for _, t in rows}}).values())
    share = sum(total.values()) / 8
    assert set(total) == set(range(8)) and max(total.values()) <= max(1.02 * share, largest)
    again = sharding.shard(table.repartition(2), shards=8).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_differencing_beats_the_greedy_rule():
    rng = np.random.default_rng(5)
    for bins in (2, 5, 40):
        sizes = rng.integers(1, 10_000, 800)
        place = sharding.difference(sizes, bins)
        sums = np.bincount(place, weights=sizes, minlength=bins)
        greedy = np.zeros(bins)
        for s in sorted(sizes, reverse=True):
            greedy[greedy.argmin()] += s
        assert np.ptp(sums) <= np.ptp(greedy) + 1
    assert sharding.difference(np.array([8, 7, 6, 5, 4]), 2).shape == (5,)
    two = np.bincount(sharding.difference(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])
    assert sorted(two) == [14, 16]  # the textbook case
    assert sharding.difference(np.zeros(0, np.int64), 3).tolist() == []


def test_written_shards_hold_all_rows(spark, tmp_path):
    rows, _ = corpus(6, 100)
    table = documents(spark, rows).withColumnRenamed("lang", "text_key")
    sharding.write_shards(table, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=str) == sorted(rows, key=str)


# Packing


@pytest.mark.parametrize(("room", "pool"), [(64, 1 << 20), (64, 500), (2048, 1 << 20)])
def test_packed_rows_give_every_text_back(spark, room, pool):
    rows, _ = corpus(7, 120)
    got = packing.pack(documents(spark, rows).repartition(3), room=room, pool=pool).collect()
    assert len({r.row_id for r in got}) == len(got)
    found = defaultdict(list)
    for r in got:
        ids, positions = np.frombuffer(r.ids, np.uint16), np.frombuffer(r.positions, np.uint16)
        assert len(ids) == len(positions) == room and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= room
        assert (ids[r.n_tokens :] == 50256).all()
        for name, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert positions[a:b].tolist() == list(range(b - a))
            found[name].append((start, ids[a:b].tolist()))
    known = packing.encoder(packing.default_vocabulary())
    texts = defaultdict(list)
    for i, t in rows:
        if t:
            texts[i].append(t)
    for name, own in texts.items():
        expected = Counter()
        for t in own:
            ids = [*known.encode_ordinary(t), 50256]
            expected.update((at, tuple(ids[at : at + room])) for at in range(0, len(ids), room))
        assert Counter((s, tuple(ids)) for s, ids in found.pop(name)) == expected
        if len(own) == 1:
            ids = [k for _, part in sorted((s, list(p)) for s, p in expected) for k in part]
            assert ids[-1] == 50256 and known.decode(ids[:-1]) == own[0]
    assert not found


def test_best_fit_is_best_fit():
    rng = random.Random(8)
    for _ in range(200):
        sizes = np.array([rng.randrange(1, 51) for _ in range(rng.randrange(70))], dtype=np.int64)
        rows = packing.best_fit(sizes, 50)
        assert sorted(k for r in rows for k in r) == list(range(len(sizes)))
        free = []
        for k in np.argsort(-sizes, kind="stable"):
            fits = [x for x in range(len(free)) if free[x] >= sizes[k]]
            if fits:
                free[min(fits, key=lambda x: free[x])] -= sizes[k]
            else:
                free.append(50 - sizes[k])
        assert sorted(50 - sum(sizes[k] for k in r) for r in rows) == sorted(free)


def test_stretches_are_tokenized_like_the_whole():
    rng = random.Random(9)
    known = packing.encoder(packing.default_vocabulary())
    parts = [" ", "  ", "\n", "\t", " ", "　", " ", "\u0085", "a", "B", "1", "'s", "é", "!", "\x1c", "\r", "日", "​", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(3000)] + [None, ""]
    import pyarrow as pa

    raw, offsets = packing.buffers(pa.array(texts, pa.string()))
    ids, bounds = packing.encode(known, raw, offsets)
    for k, t in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == known.encode_ordinary(t or "")


def test_matrix_of_packed_rows(spark, tmp_path):
    rows, _ = corpus(10, 60)
    packing.write_matrices(packing.pack(documents(spark, rows), room=32), str(tmp_path / "rows"))
    import pyarrow.parquet as pq

    table = pq.read_table(tmp_path / "rows")
    ids = packing.matrix(table["ids"], 32)
    assert ids.shape == (table.num_rows, 32) and ids.dtype == np.uint16


def test_differencing_of_many_bins_is_that_of_dense_partitions_and_stays_small():
    import heapq
    import tracemalloc

    def dense(sizes, bins):
        """Each partition with all of its bins, empty ones included."""
        n = len(sizes)
        parts = [(-int(sizes[k]), k, [(int(sizes[k]), [k])] + [(0, [])] * (bins - 1)) for k in range(n)]
        heapq.heapify(parts)
        while len(parts) > 1:
            _, k, a = heapq.heappop(parts)
            _, _, b = heapq.heappop(parts)
            both = sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, b[::-1], strict=True)), key=lambda r: -r[0])
            heapq.heappush(parts, (both[-1][0] - both[0][0], k, both))
        place = np.zeros(n, dtype=np.int64)
        for at, (_, items) in enumerate(parts[0][2]):
            place[items] = at
        return place

    rng = np.random.default_rng(7)
    for n, bins in ((1, 5), (3, 5), (40, 7), (60, 60), (80, 2), (50, 90)):
        sizes = rng.integers(16, 60, n)
        assert np.array_equal(sharding.difference(sizes, bins), dense(sizes, bins)), (n, bins)
    tracemalloc.start()
    sharding.difference(rng.integers(16, 10_000, 20_000), 4000)
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
