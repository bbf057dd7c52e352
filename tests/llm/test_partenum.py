from __future__ import annotations

import re

import numpy as np
import pytest

from fareloom.llm import partenum, sharing
from fareloom.llm.components import components
from fareloom.llm.sketches import counter_places, filtered


def partenum_counters(features, counters):
    return counter_places(features, counters, 1)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sets(rows, size):
    out = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out.append(frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, size=3, percent=90):
    own = sets(rows, size)
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            common = len(own[i] & own[j])
            if a is not None and b is not None and common and 100 * common >= percent * len(own[i] | own[j]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d)) for (d, _), s in zip(rows, own)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for i in rng.choice(len(words), edits, replace=False):
        words[i] = f"new{rng.integers(1 << 30)}"
    return " ".join(words)


def test_equals_brute_force(documents, odd_rows):
    rng = np.random.default_rng(5)
    rows = list(odd_rows)
    for k in range(12):
        base = [f"w{rng.integers(4000)}" for _ in range(int(rng.integers(4, 400)))]
        for e in range(6):
            rows.append((100 + 10 * k + e, edited(rng, base, min(len(base), e * len(base) // 90))))
    assert result(partenum.linked_documents(documents(rows))) == brute(rows)


def test_large_cluster_over_many_blocks(documents):
    """A chain whose ends are unlike: links lie between blocks and far from the least member."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        words[int(rng.integers(200))] = f"new{i}"
        rows.append((i, " ".join(words)))
    assert result(partenum.linked_documents(documents(rows), block=7)) == brute(rows)


@pytest.mark.parametrize("percent,ratio", [(90, 140), (80, 125), (80, 140), (60, 170)])
def test_signatures_meet_for_every_linked_pair(percent, ratio):
    """Sets at the edge of the bound, of equal and unequal sizes, share a signature."""
    rng = np.random.default_rng(7)
    bands = partenum.Bands(percent, 1, ratio)
    tenth = 100 - percent
    for size in (5, 10, 11, 19, 20, 37, 100, 333, 1000):
        for _ in range(40):
            pool = rng.integers(1, 1 << 62, 2 * size + 5).astype(np.uint64)
            grow = int(rng.integers(0, size * tenth // percent + 1))
            b = np.unique(np.concatenate([pool[:size], pool[size:size + grow]]))
            room = len(b) * tenth // 100 - grow
            drop = int(rng.integers(0, max(room, 0) + 1))
            a, b = np.sort(pool[:size]), np.sort(b[drop:])
            common = len(np.intersect1d(a, b))
            if 100 * common < percent * (len(a) + len(b) - common) or len(a) == len(b) == common:
                continue
            values, owner = partenum.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands)
            assert set(values[owner == 0].tolist()) & set(values[owner == 1].tolist())


def test_empty_signatures_are_left_out_and_sets_without_likeness_do_not_meet():
    rng = np.random.default_rng(8)
    bands = partenum.Bands(80, 1, 140)
    sizes = rng.integers(5, 400, 1500)
    features = rng.integers(1, 1 << 62, int(sizes.sum())).astype(np.uint64)
    values, owner = partenum.signatures(features, np.append(0, np.cumsum(sizes)), bands)
    _, group, count = np.unique(values, return_inverse=True, return_counts=True)
    assert set(owner.tolist()) == set(range(1500))
    assert len(np.unique(owner[count[group] > 1])) < 100
    with pytest.raises(ValueError):
        partenum.Bands(80, 1, 115)


def test_sets_with_few_shared_features_do_not_sign():
    features, bounds = np.arange(1, 41, dtype=np.uint64), np.array([0, 10, 10, 20, 40])
    bits = np.zeros(1024 // 8, np.uint8)
    for place in next(partenum_counters(features[[*range(0, 8), *range(10, 17)]], 1024)):
        bits[place >> 3] |= 128 >> (place & 7)
    able = partenum.sharing_sets(features, bounds, bits, 1024, 80)
    assert 0 in able and 1 not in able and 3 not in able


def test_copies_and_near_copies_meet_in_hot_signatures(documents):
    """A third of the rows alike, in pieces of several tasks and of several rounds of combining."""
    rng = np.random.default_rng(10)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(f"x{rng.integers(10_000)}" for _ in range(60))) for i in range(120)]
    rows += [(1000 + i, " ".join(base)) for i in range(30)] + [(2000 + i, " ".join([*base[:i], f"y{i}", *base[i + 1:]])) for i in range(30)]
    old, partenum.FLUSH = partenum.FLUSH, 500
    try:
        assert result(partenum.linked_documents(documents(rows), shingle=5, percent=80)) == brute(rows, 5, 80)
    finally:
        partenum.FLUSH = old


def test_empty_table(documents):
    assert partenum.linked_documents(documents([])).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 140)] + [(300, 290), (5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 290: 290, 300: 290}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_texts_go_through_one_worker_a_task_in_small_slices(spark, documents):
    """A filter that is a Python stage of its own would take a second worker on every core."""
    docs = documents([(i, f"a b c d e f {i}") for i in range(20)])
    heads = partenum.id_filter(docs.where("doc_id < 10"), "doc_id")
    bits = spark.sparkContext.broadcast(partenum.shared_counters(docs.select("doc_id", "text"), heads, 3, 1 << 20))
    signed = partenum.signature_rows(docs.select("doc_id", "text"), heads, bits, 1 << 20, 3, 50, 1, 200)
    assert signed._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc for r in signed.select("doc").distinct().collect()} == set(range(10))
    assert partenum.SLICE <= 1 << 20


@pytest.mark.parametrize("entries,ranges", [(50, 256), (1_500_000, 512)])
def test_features_of_several_rows_are_counted_exactly(documents, monkeypatch, entries, ranges):
    """Met twice in one task or in two, a word of all rows, an id that comes twice, and rows that the filter leaves out."""
    monkeypatch.setattr(sharing, "ENTRIES", entries)
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(["common", *sorted({f"w{rng.integers(400)}" for _ in range(25)})])) for i in range(60)] + [(7, "twice here"), (7, "twice here")]
    rows.append((-(1 << 40), "w1 w2 w3"))
    docs = documents(rows).select("doc_id", "text")
    heads = partenum.id_filter(docs.where("doc_id < 50"), "doc_id")

    def sets_of(batch):
        for start, _, data, offsets in partenum.text_slices(batch.column(1), 1 << 20):
            yield *partenum.shingle_sets(data, offsets, 1), start

    words = [(d, set(t.split())) for d, t in rows if d < 50]
    hashes = {w: partenum.shingle_sets(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]), 1)[0] for w in set().union(*(w for _, w in words))}
    half = {w for w, h in hashes.items() if sharing.counted(h)[0]}
    assert 0.3 < len(half) / len(hashes) < 0.7
    seen = [w for _, own in words for w in own]
    wanted = {}
    for d, own in words:
        n = sum(w in half and seen.count(w) > 1 for w in own)
        if n:
            wanted[d] = wanted.get(d, 0) + n
    assert dict(map(tuple, sharing.shared_counts(docs, heads, sets_of, ranges).collect())) == wanted
    assert [sharing.ranges_of(n) for n in (0, 1 << 20, (1 << 28) + 1)] == [256, 256, 512]


def families(rng, count):
    """(id, text) of `count` texts without likeness, each with a near copy."""
    rows = []
    for k in range(count):
        base = [f"w{rng.integers(1 << 30)}" for _ in range(int(rng.integers(30, 90)))]
        rows += [(10 * k + e, " ".join(edited(rng, base, e))) for e in range(2)]
    return rows


def test_a_full_sketch_does_not_let_every_document_sign(documents, monkeypatch):
    """Beyond some data most counters of the sketch are full: all documents signed, and most met in one cluster."""
    few = families(np.random.default_rng(12), 20)
    unlike = [(1000 + i, " ".join(f"x{j}" for j in range(3500 * i, 3500 * (i + 1)))) for i in range(600)]
    signing, signed = [], partenum.signature_rows

    def seen(docs, heads, *rest):
        signing.append(filtered(docs, heads, "doc_id").count())
        return signed(docs, heads, *rest)

    monkeypatch.setattr(partenum, "signature_rows", seen)
    found = partenum.linked_documents(documents(few + unlike), shingle=5, percent=80, counters=1 << 20)
    assert result(found) == sorted([*brute(few, 5, 80), *((i, 3496, i) for i, _ in unlike)], key=str)
    assert len(signing) == 1 and signing[0] <= 60


def test_a_common_line_does_not_make_one_cluster(documents, monkeypatch):
    """Signatures of nothing but the line joined most families into a cluster whose members were all compared with all."""
    rng, rows = np.random.default_rng(13), []
    for k in range(60):
        base = [*(f"line{i}" for i in range(12)), *(f"w{rng.integers(1 << 30)}" for _ in range(int(rng.integers(12, 40))))]
        rows += [(10 * k + e, " ".join([*base[:-1], f"end{k}-{e}"])) for e in range(2)]
    compared, verified = [], partenum.verified

    def seen(placed, *rest):
        compared.append(placed.count())
        return verified(placed, *rest)

    monkeypatch.setattr(partenum, "verified", seen)
    assert result(partenum.linked_documents(documents(rows), shingle=5, percent=80, block=7, counters=1 << 22)) == brute(rows, 5, 80)
    assert sum(compared) < 4 * len(rows)  # 3,389 before
