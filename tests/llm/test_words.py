from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fareloom.llm.words import hash_windows, hash_words, split_words, text_slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c 文", max_size=30)), max_size=8)


@settings(deadline=None, max_examples=200)
@given(texts, st.integers(1, 40))
def test_words_of_any_slicing_equal_the_pattern(values, limit):
    seen = []
    for first, end, data, offsets in text_slices(pa.array(values, pa.string()), limit):
        words = split_words(data, offsets)
        for i in range(end - first):
            a, b = words.first[i], words.first[i + 1]
            seen.append([bytes(data[s:e]).decode() for s, e in zip(words.start[a:b], words.end[a:b])])
    assert seen == [WORD.findall(v or "") for v in values]


def hashes(value, lower=False):
    (_, _, data, offsets), = text_slices(pa.array([value]))
    return hash_words(data, split_words(data, offsets), lower)


def test_hashes_depend_on_the_word_alone():
    a, b = hashes("one two  one"), hashes("\nxx one")
    assert a[0] == a[2] == b[1] and len({*a.tolist(), *b.tolist()}) == 3
    assert hashes("ONE É", True)[0] == a[0] and hashes("É", True)[0] != hashes("é", True)[0]
    assert len(set(hashes("a aa aaa b ab ba").tolist())) == 6


def test_windows_at_starts_equal_all_windows():
    h = hashes(" ".join("abcdefgh"))
    all_of_them = hash_windows(h, 3, 2)
    assert (hash_windows(h, 3, 2, np.array([4, 1])) == all_of_them[[4, 1]]).all() and len(set(all_of_them.tolist())) == 6
