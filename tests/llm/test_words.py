import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm.words import (blocks, per_text, split_words, whole_windows, window_hashes, word_hashes)

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t é\x0bX", max_size=60)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from([1, 2, 3, 5, 13]))
def test_words_and_windows_agree_with_python(texts, k):
    raw = [None if t is None else t.encode() for t in texts]
    w = split_words(raw)
    expected = [(t or b"").split() for t in raw]
    got = [bytes(w.data[s:s + n]) for s, n in zip(w.starts, w.lens)]
    assert got == [x for own in expected for x in own]
    assert np.diff(w.ptr).tolist() == [len(own) for own in expected]
    hashes = word_hashes(w)
    by_word = dict(zip(got, hashes.tolist()))
    assert len(set(by_word.values())) == len(by_word)
    assert [by_word[x] for x in got] == hashes.tolist()
    windows, whole = window_hashes(hashes, k), whole_windows(w.ptr, len(hashes), k)
    sequences = [tuple(own[i:i + k]) for own in expected for i in range(len(own) - k + 1)]
    assert whole.sum() == len(sequences)
    seen = {}
    for sequence, h in zip(sequences, windows[whole].tolist()):
        assert seen.setdefault(sequence, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_window_hash_equals_itself_anywhere():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 2**63, 50, dtype=np.uint64)
    a = window_hashes(np.concatenate([rng.integers(0, 2**63, 7, dtype=np.uint64), part]), 50)
    b = window_hashes(np.concatenate([part, rng.integers(0, 2**63, 900, dtype=np.uint64)]), 50)
    assert a[-1] == b[0]


def test_lower_case_is_ascii_only():
    w = split_words(["AÉ aé".encode()], lower=True)
    assert bytes(w.data[w.starts[0]:w.starts[0] + w.lens[0]]).decode() == "aÉ"


def test_blocks_cover_all_rows_and_bound_bytes():
    texts = [b"x" * 10, None, b"y" * 100, b"", b"z" * 3]
    found = list(blocks(texts, 50))
    assert [i for a, b in found for i in range(a, b)] == list(range(5))
    assert list(blocks([], 50)) == []


def test_per_text_sums():
    w = split_words([b"a b", None, b"c"])
    assert per_text(np.ones(3), w.ptr).tolist() == [2, 0, 1]
