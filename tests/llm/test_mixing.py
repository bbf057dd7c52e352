from __future__ import annotations

import collections
import math
import re

import pytest

from fareloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, share=1.5, cap=2.0, weights=(3, 1, 2)):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, target, left = set(order), {}, share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not full:
            target.update({s: left * weight[s] / total for s in open_})
            break
        target.update({s: cap * sizes[s] for s in full})
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return target


def many(sources=("a", "b", "c", None, "é", "z")):
    return [(i, "w " * (i * 37 % 50 + 1), "en", sources[(i * i) % len(sources) if i % 3 else 0]) for i in range(3000)]


def test_targets_and_taken_words(documents):
    rows = many()
    got = mixing.mixed_copies(documents(rows)).collect()
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text))
    expected, taken = filled(sizes), collections.Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, expected[r.source], rel_tol=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 60  # one document, about


def test_reruns_agree_whatever_the_partitions(documents):
    one, two = (sorted(map(tuple, mixing.mixed_copies(documents(many()).repartition(n)).collect())
                       , key=str) for n in (1, 7))
    assert one == two


def test_odd_rows(documents, odd_rows):
    got = mixing.mixed_copies(documents(odd_rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (d is None, d or 0, len(WORD.findall(t or ""))) for d, t in odd_rows)
    assert mixing.mixed_copies(documents([])).collect() == []
    assert [(r.target, r.taken) for r in mixing.mixed_copies(documents([(1, None), (2, " ")])).collect()] == [(0.0, 0)] * 2


def test_documents_come_as_often_as_drawn(documents):
    docs = documents(many())
    copies = {r.doc_id: r.copies for r in mixing.mixed_copies(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == {d: n for d, n in copies.items() if n}


@pytest.mark.parametrize("name", ["op2_mix_sources"])
def test_statement(spark, sf_dir, name):
    from check import compare, connect

    from fareloom.llm import entries

    assert compare(entries.QUERIES[name](spark, sf_dir), connect(sf_dir), entries.ORACLES[name]) is None
