from __future__ import annotations

import collections
import re

import numpy as np
import pytest

from fareloom.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    words = [WORD.findall(t or "") for _, t in rows]
    count = collections.Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force_on_odd_rows(spark, documents, odd_rows):
    rows = odd_rows + [(20 + i, odd_rows[8][1][i * 50:i * 50 + 700] + f" tail{i}") for i in range(5)]
    assert result(substrings.deduplicated(documents(rows), counters=1 << 20)) == brute(rows, 35)


@pytest.mark.parametrize("counters", [1 << 20, 1 << 21])
def test_small_alphabet_and_crowded_counters(spark, documents, counters):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["x", "y"], 60))) for i in range(60)]
    assert result(substrings.deduplicated(documents(rows), width=12, anchor=5, counters=counters, depth=1)) == brute(rows, 12)


def test_empty_table(documents):
    assert substrings.deduplicated(documents([]), counters=1 << 20).collect() == []


def test_kept_bytes_are_exact_around_multibyte_words(documents):
    passage = " ".join(f"é{i}文" for i in range(35))
    rows = [(1, f"start {passage} end"), (2, f"other\n{passage}"), (3, passage[:-3])]
    assert result(substrings.deduplicated(documents(rows), counters=1 << 20)) == brute(rows, 35)
