import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm.words import buffers, inside_windows, pieces, span_hashes, window_hashes, word_hashes, words_of

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b　", max_size=30)), max_size=12)


def split(texts):
    return [(t or "").encode().split() for t in texts]


@given(TEXT, st.sampled_from([1, 2, 5, 12]))
@settings(max_examples=200, deadline=None)
def test_words_and_windows_of_any_texts(texts, width):
    raw, offsets = buffers(pa.array(texts, pa.string()))
    words = words_of(raw, offsets)
    data = raw.tobytes()
    found = [data[a:b] for a, b in zip(words.begin, words.end, strict=True)]
    expected = split(texts)
    assert found == [w for own in expected for w in own]
    assert words.counts.tolist() == [len(own) for own in expected]
    h = window_hashes(word_hashes(words), width)
    inside = inside_windows(words, width)
    by_hash = {}
    for at, ok in enumerate(inside):
        if ok:
            assert by_hash.setdefault(int(h[at]), tuple(found[at : at + width])) == tuple(found[at : at + width])
    total = sum(max(0, len(own) - width + 1) for own in expected)
    assert int(inside.sum()) == total
    assert len(by_hash) == len({tuple(own[k : k + width]) for own in expected for k in range(len(own) - width + 1)})


def test_sliced_and_null_columns():
    column = pa.array(["a b", None, "c", "d e f"]).slice(1, 3)
    raw, offsets = buffers(column)
    assert raw.tobytes() == b"cd e f" and offsets.tolist() == [0, 0, 1, 6]


def test_spans_longer_than_a_block_and_folding():
    long = b"x" * (3 << 20)
    raw = np.frombuffer(long + b" " + long + b" Ab aB", np.uint8)
    words = words_of(raw, np.array([0, len(raw)]))
    plain, folded = word_hashes(words), span_hashes(raw, words.begin, words.end, fold=True)
    assert plain[0] == plain[1] and plain[2] != plain[3] and folded[2] == folded[3]


def test_pieces_cover_all_rows_once():
    offsets = np.array([0, 5, 5, 100, 101, 102])
    assert list(pieces(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(pieces(np.array([0]), 10)) == []
