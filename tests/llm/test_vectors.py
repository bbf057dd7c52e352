from __future__ import annotations

import collections

import numpy as np
import pytest

from fareloom.llm import neighbours, vector_dedup

NAN, INF = float("nan"), float("inf")
ODD = [(901, None), (902, [0.0] * 8), (903, [NAN] + [1.0] * 7), (904, [INF] + [1.0] * 7), (905, [None] + [1.0] * 7), (906, [1.0] * 3), (None, [1.0] * 8), (907, [])]


def clustered(n, d=8, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(n // 8, 1), d))
    return [(i, (centres[i % len(centres)] + spread * rng.standard_normal(d)).astype(np.float32).tolist()) for i in range(n)]


def brute_links(rows, cosine):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    close = u @ u.T >= cosine
    label = list(range(len(rows)))
    changed = True
    while changed:
        new = [min(label[j] for j in np.flatnonzero(close[i])) for i in range(len(rows))]
        changed, label = new != label, new
    return {i: (int(close[k].sum()) - 1, ids[label[k]]) for k, i in enumerate(ids)}


@pytest.mark.parametrize("spread, part, blocks", [(0.05, 16_384, 4), (0.3, 40, 3), (0.001, 16, 8)])
def test_links_equal_brute_force(vectors, spread, part, blocks):
    rows = clustered(300, spread=spread)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(vectors(rows), part=part, blocks=blocks).collect()}
    assert got == brute_links(rows, 0.95)


def test_odd_vectors_link_with_nothing(vectors):
    rows = clustered(40)
    got = collections.Counter(tuple(r) for r in vector_dedup.near_duplicates(vectors(rows + ODD + rows[:2])).collect())
    expected = collections.Counter({(i, n, c, i == c): 1 for i, (n, c) in brute_links(rows, 0.95).items()})
    for i, _ in rows[:2]:  # a repeated row is the same vector
        expected[next(k for k in expected if k[0] == i)] += 1
    for i, _ in ODD:
        expected[i, 0, i, i is not None] += 1
    assert got == expected
    assert vector_dedup.near_duplicates(vectors([])).collect() == []
    assert [tuple(r) for r in vector_dedup.near_duplicates(vectors([(4, None)])).collect()] == [(4, 0, 4, True)]


def brute_nearest(rows, every, k):
    out = {}
    for i, v in rows:
        if i % every == 0:
            a = np.array(v, np.float32).astype(float)
            ranked = sorted((float(np.sqrt(((np.array(w, np.float32).astype(float) - a) ** 2).sum())), j) for j, w in rows if j != i)
            out[i] = [j for _, j in ranked[:k]]
    return out


def test_recall_order_and_scores(vectors):
    rows = clustered(600, d=24, spread=0.4)
    got = neighbours.search(vectors(rows + ODD), every=10, candidate_block=150, query_block=20).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by[r.query_id].append(r)
    truth = brute_nearest(rows, 10, 10)
    assert set(by) == set(truth)
    assert sum(len({r.vec_id for r in by[q]} & set(t)) for q, t in truth.items()) >= 0.9 * 10 * len(truth)
    for q, found in by.items():
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        a = np.array(rows[q][1], np.float32).astype(float)
        assert all(r.score == np.sqrt(((np.array(rows[r.vec_id][1], np.float32).astype(float) - a) ** 2).sum()) for r in found)


def test_sparse_regions_get_k_rows(vectors):
    """Tight groups teach a small radius; queries far from all of them still get their true neighbours."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((60, 32))
    rows = [(i, (centres[i % 60] + 0.001 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(60 * 49) if i % 100]
    lone = [(100 * i, (3 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(8)]
    grouped = [(100 * i, (centres[i] + 0.001 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(8, 29)]
    rows += lone + grouped
    got = collections.defaultdict(list)
    for r in sorted(neighbours.search(vectors(rows), candidate_block=1_000, query_block=5).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
    truth = brute_nearest(rows, 100, 10)
    assert {q: len(f) for q, f in got.items()} == {q: min(10, len(rows) - 1) for q in truth}
    assert all(got[q] == truth[q] for q, _ in lone)


def test_few_and_equal_candidates(vectors):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.search(vectors(rows)).collect())
    assert got == [(0, 1, 2), (0, 2, 100), (0, 3, 3), (100, 1, 0), (100, 2, 2), (100, 3, 3)]
    assert neighbours.search(vectors([])).collect() == []


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 16, (500, 4)).astype(np.uint16)
    index = neighbours.SubstringIndex(codes)
    for radius in (0, 3, 4, 17, 30):
        for code in (codes[7], codes[9] ^ np.array([1, 0, 3, 0], np.uint16)):
            assert index.within(code, radius).tolist() == np.flatnonzero(neighbours.hamming(code, codes) <= radius).tolist()


def test_growing_radius_is_certain():
    """However small the first radius, the rows found are the true ones, and no sum of plane distances exceeds a true distance."""
    rng = np.random.default_rng(6)
    rows = rng.standard_normal((400, 12)) * np.linspace(3, 0.2, 12)
    codes = neighbours.learned_codes(rows, 64)
    index = neighbours.SubstringIndex(codes.of(rows))
    nodes = np.arange(400)
    for own in range(0, 400, 23):
        code, least = codes.of(rows[own:own + 1])[0], neighbours.beyond(codes.turned(rows[own:own + 1])[0])
        distance = np.sqrt(((rows - rows[own]) ** 2).sum(axis=1))
        differ = neighbours.hamming(code, codes.of(rows))
        assert all(distance[i] ** 2 + 1e-9 >= least[differ[i] - 1] for i in nodes if differ[i])
        truth = sorted((distance[i], i) for i in nodes if i != own)
        for k in (1, 10, 1_000):
            ids, found = neighbours.certain(rows[own], own, code, least, index, rows, nodes, k, 0)
            assert list(zip(found, ids)) == truth[:k]
