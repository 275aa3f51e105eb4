"""Byte pairs against the public library and against merging one pair at a time."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from skyledger.llm import byte_pairs, queries
from skyledger.llm.words import buffers
from tests.conftest import SMALL
from tests.llm.helpers import ODD, documents


@pytest.fixture(scope="module")
def known():
    return byte_pairs.load(byte_pairs.default_vocabulary(), byte_pairs.default_pattern())


@pytest.fixture(scope="module")
def library(known):
    return tiktoken.Encoding("own", pat_str=byte_pairs.default_pattern(), mergeable_ranks=known.ranks, special_tokens={})


def ids_of(known, texts):
    tokens, bounds = byte_pairs.encode(known, *buffers(pa.array(texts, pa.string())))
    return [tokens[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def by_hand(known, piece):
    """The definition: the leftmost pair of the least rank, until no pair is a token."""
    parts = [bytes([b]) for b in piece]
    while True:
        ranks = [known.ranks.get(x + y) for x, y in zip(parts, parts[1:])]
        if piece in known.ranks or not any(r is not None for r in ranks):
            return [known.ranks[piece]] if piece in known.ranks else [known.ranks[x] for x in parts]
        k = min((r, k) for k, r in enumerate(ranks) if r is not None)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


MIXED = [" ", "\n", "\t", " ", "　", "\x1c", "\x00", "\r\n", "a", "B", "é", "1", "٣", "'", "s", "'re", "!", "中", "😀", "́", " the", "ſ"]


def test_random_texts_as_the_library_encodes_them(known, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(MIXED) for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert ids_of(known, texts) == [library.encode_ordinary(t) for t in texts]


def test_characters_of_every_plane(known, library):
    points = [chr(c) for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}1{c}  {c}" for c in points]
    assert ids_of(known, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 16, 17, 63, 64, 65, 130, 1000])
def test_both_kinds_of_trees_merge_leftmost_least_ranks(known, n):
    rng = random.Random(n)
    pieces = [bytes(rng.choice(b"abeinrst") for _ in range(n)) for _ in range(4)] + [b"a" * n, bytes(rng.randrange(256) for _ in range(n))]
    expected = [by_hand(known, p) for p in pieces]
    whole = [p in known.ranks for p in pieces]
    assert [np.frombuffer(x, "<u4").tolist() for x in byte_pairs.encode_matches(known, pieces)] == expected
    if n > 1:
        for p, e, w in zip(pieces, expected, whole, strict=True):
            assert w or byte_pairs.merge_long(known, p) == e


def test_very_long_matches(known, library):
    rng = random.Random(2)
    texts = ["x" * 30_000, " " * 5_000, "é" * 4_000, "".join(rng.choice("abcdefghij") for _ in range(20_000)), "1" * 10_000 + " "]
    got = ids_of(known, texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [byte_pairs.decode(known, np.array(x, np.uint32)) for x in got] == [t.encode() for t in texts]


def test_memory_of_stretches_changes_nothing(known, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 3)
    for seed in range(6):
        rng = random.Random(seed)
        text = " ".join(f"word{rng.randrange(20)}" for _ in range(200))
        assert ids_of(known, [text]) == [library.encode_ordinary(text)]


def test_bytes_that_are_no_utf8(known, library):
    raw, offsets = np.frombuffer(b"ab\xff\xfecd\xe4\xb8", np.uint8), np.array([0, 4, 8])
    tokens, bounds = byte_pairs.encode(known, raw, offsets)
    expected = [library.encode_ordinary(x.decode("utf-8", "replace")) for x in (b"ab\xff\xfe", b"cd\xe4\xb8")]
    assert [tokens[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == expected


def test_rows_nulls_and_clashing_columns(spark, known, library):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (3, "one"), (9223372036854775807, "last id"), (-1, "one")]
    docs = documents(spark, rows).withColumnRenamed("key", "ids").withColumnRenamed("mark", "n_tokens")
    got = byte_pairs.encode_texts(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids"]
    expected = sorted(((i, library.encode_ordinary(t or "")) for i, t in rows), key=str)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got.collect()), key=str) == expected
    back = byte_pairs.decode_ids(got)
    assert sorted(((r.doc_id, bytes(r.text)) for r in back.collect()), key=str) == sorted(((i, (t or "").encode()) for i, t in rows), key=str)


def test_empty_table_and_wrong_ids(spark, known):
    assert byte_pairs.round_trip(documents(spark, [])).count() == 0
    assert byte_pairs.decode(known, np.zeros(0, np.uint32)) == b""
    with pytest.raises(ValueError):
        byte_pairs.decode(known, np.array([known.size], np.uint32))
    with pytest.raises(ValueError):
        byte_pairs.Vocabulary({b"a": 0}, byte_pairs.default_pattern())


def test_query(spark, library):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op11_byte_bpe"](spark, SMALL).collect()
    expected = {}
    for d, t in rows.items():
        ids = np.array(library.encode_ordinary(t), dtype="<u4")
        expected[d] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected
