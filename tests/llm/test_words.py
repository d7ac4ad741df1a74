import re

import numpy as np
from hypothesis import given, strategies as st

from basketseq.llm.words import LOWER_ASCII, shingle_set, utf8, window_hashes, word_hashes

TEXT = st.text(alphabet=st.sampled_from("ab cé\n\t\x0b\xa0　"), max_size=60)


def split(raw):
    return re.findall(rb"[^\x20\x09-\x0D]+", raw)


@given(TEXT)
def test_equal_words_have_equal_hashes_and_others_do_not(text):
    raw = text.encode()
    words, hashes = split(raw), word_hashes(raw)
    assert len(words) == len(hashes)
    assert len(set(words)) == len(set(hashes.tolist()))
    assert len(set(zip(words, hashes.tolist(), strict=True))) == len(set(words))


@given(TEXT, st.integers(1, 4))
def test_windows_are_told_apart_like_tuples(text, size):
    raw = text.encode()
    words = split(raw)
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = window_hashes(word_hashes(raw), size).tolist()
    assert len(windows) == len(hashes)
    assert len(set(windows)) == len(set(hashes)) == len(set(zip(windows, hashes, strict=True)))


@given(TEXT, TEXT)
def test_sets_overlap_like_sets_of_tuples(a, b):
    def tuples(raw):
        w = split(raw)
        return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()

    left, right = a.encode(), b.encode()
    found = np.intersect1d(shingle_set(left, 3), shingle_set(right, 3))
    assert len(shingle_set(left, 3)) == len(tuples(left))
    assert len(found) == len(tuples(left) & tuples(right))


def test_place_and_length_of_a_text_do_not_matter():
    word = word_hashes(b"abc")[0]
    assert word_hashes(b"x " * 70_000 + b"abc")[-1] == word


def test_lower_casing_takes_ascii_only():
    assert utf8("ÀBC").translate(LOWER_ASCII) == "Àbc".encode()
    assert utf8(None) == b""
