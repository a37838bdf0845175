import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm import text as tx
from tests.llm import brute

TEXTS = st.lists(st.none() | st.text(alphabet="aAb0 \t\n\v.é漢_-", max_size=30), max_size=8)


def _batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_patterns(texts, limit):
    for inside, pattern in ((tx.BY_BLANKS, brute.BLANKS), (tx.LETTERS, brute.LETTERS)):
        seen, want = {}, [pattern.findall((t or "").translate(brute.LOWER)) for t in texts]
        for row, end, data, offsets in tx.text_slices(_batch(texts), "text", limit):
            hashes, first = tx.words(data, offsets, inside)
            for k in range(row, end):
                own = hashes[first[k - row] : first[k - row + 1]].tolist()
                assert len(own) == len(want[k])
                for h, w in zip(own, want[k]):
                    assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_slices_cover_all_rows_once():
    texts = ["x" * k for k in (0, 5, 100, 0, 3, 0)]
    rows = [(a, b) for a, b, _, _ in tx.text_slices(_batch(texts), "text", 8)]
    assert [k for a, b in rows for k in range(a, b)] == list(range(6))


def test_a_word_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(tx, "PIECE", 16)
    data = np.frombuffer(b"aa " + b"x" * 100 + b" aa", np.uint8)
    hashes, first = tx.words(data, np.array([0, len(data)]), tx.BY_BLANKS)
    assert len(hashes) == 3 and hashes[0] == hashes[2] != hashes[1] and first.tolist() == [0, 3]


def test_rolling_hashes_meet_run_hashes_of_equal_bytes():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    rolling = tx.rolling_hashes(data, 3)
    assert rolling[0] == rolling[3] and rolling[0] != rolling[6] and len(rolling) == 7
    assert len(tx.rolling_hashes(data[:2], 3)) == 0


def test_grams_tell_order_and_length():
    h = np.array([1, 2, 1, 2, 3], np.uint64)
    two = tx.grams(h, 2)
    assert two[0] == two[2] != two[1] and len(tx.grams(h, 6)) == 0
    assert tx.grams(h, 1)[0] != tx.grams(h, 2)[0]
