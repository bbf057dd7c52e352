from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pytest

from fareloom.llm import spellings

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def counts(rows, every=97):
    found = collections.Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def expected(words):
    forms, out = {}, {}
    for w, n in words.items():
        others = [v for v in words if abs(len(v) - len(w)) <= 1 and near(v, w)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 2 * n else None
        forms[w] = form
        out[w] = [form, None, n, len(others), words[form] if form else None]
    for w, row in out.items():
        row[1] = w
        while forms[row[1]]:
            row[1] = forms[row[1]]
    return {(w, *row) for w, row in out.items()}


def compared(df, words):
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == expected(words)


def texts_of(words):
    """Documents in which the words occur as often as asked."""
    return [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (20, "Naïve naive NAÏVE naïve÷ ÀÉ×ÿ " * 3), (21, "ABCde abcdeŸ 文abcde abcde1abcdé " * 4), (None, "without number " * 5)]
    compared(spellings.spelling_variants(documents(rows)), counts([(r[0], r[1]) for r in rows]))
    assert spellings.spelling_variants(documents([])).collect() == []


def test_whole_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len(words) > 300
    compared(spellings.spelling_variants(docs), words)


def test_dense_neighbours_runs_and_ties(documents):
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("aabé"), int(rng.integers(5, 9)))): int(rng.integers(3, 60)) for _ in range(400)}
    compared(spellings.spelling_variants(documents(texts_of(words)), every=None), words)


def test_chains_follow_to_their_end(documents):
    """A chain of forms, each one edit on and twice as frequent, hot forms with many variants, and long words."""
    chain = {"abcdefgh"[:5] + "z" * i: 3 * 2 ** i for i in range(1, 12)}
    hot = {"qqqqqq"[:i] + c + "qqqqqq"[i:]: 3 for i in range(7) for c in "abcdefghijklmnop"} | {"qqqqqq": 500}
    long = {"lm" * 4000: 6, "lm" * 3999 + "l": 3, "lm" * 2000 + "x" + "lm" * 2000: 12, "lm" * 2000 + "y" + "lm" * 2000: 25}
    words = chain | hot | long
    out = spellings.spelling_variants(documents(texts_of(words)), every=None)
    roots = {r.word: r.root for r in out.collect()}
    assert {roots[w] for w in chain} == {max(chain, key=chain.get)} and {roots[w] for w in hot} == {"qqqqqq"}
    quick = {w: n for w, n in words.items() if len(w) < 100}
    compared(out.where("length(word) < 100"), quick)
    got = {r.word: (r.form, r.n_near) for r in out.where("length(word) > 100").collect()}
    a, b, x, y = long
    assert got == {a: (y, 3), b: (a, 1), x: (y, 2), y: (None, 2)}


@pytest.mark.parametrize("word", ["a", "aab", "é" * 30, "abc" * 20])
def test_node_keys_tell_prefixes_apart(word):
    keys = spellings.node_keys(word)
    assert len(keys) == len(set(keys)) == len(word) + 1
    assert all(len(k) <= spellings.SHORT for k in keys)
    assert keys[:-1] == spellings.node_keys(word[:-1])


def test_ratio_below_two_is_refused(documents):
    with pytest.raises(ValueError):
        spellings.spelling_variants(documents([]), ratio=1)
