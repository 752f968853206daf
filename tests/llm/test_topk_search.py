from __future__ import annotations

import math
import random

import numpy as np
import pytest

from barmart.llm import topk_search


def brute(rows, k=5):
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, v in good:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        products = ((sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        scores = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for s, i in products)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def result(spark, rows, **changes):
    df = spark.createDataFrame([(i, v, 1, 5) for i, v in rows], "vec_id long, embedding array<float>, score int, part int")
    return sorted(tuple(r) for r in topk_search.self_search(df).collect())


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(700)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]  # ties
    return rows


def test_equals_brute_force(spark, vectors):
    assert result(spark, vectors) == brute(vectors)


def test_many_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 64)
    monkeypatch.setattr(topk_search, "QUERIES", 4)
    assert result(spark, vectors) == brute(vectors)


def test_odd_rows(spark):
    rows = [
        (0, [0.5, -0.5]),
        (0, [0.25, 0.5]),
        (50, [1.0]),
        (100, []),
        (3, None),
        (None, [1.0, 1.0]),
        (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]),
        (6, [None, 1.0]),
        (7, [1.0, 2.0, 3.0]),
        (7, [1.0, 2.0, 3.0]),
        (8, [5e5, 2.0]),
    ]
    assert result(spark, rows) == brute(rows)


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(50, [0.1, 0.2]), (1, [0.3, 0.1])]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[:1]) == []
    assert result(spark, []) == []


def test_the_search_stops_early_and_is_right():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 40, (10, 32))
    values = np.floor(centres[rng.integers(0, 10, 3000)] + rng.normal(0, 8, (3000, 32))).astype(np.int64)
    index = topk_search.ImpactIndex(values)
    for q in values[:20]:
        possible = index.best(q, 5, np.array([], int))
        best = np.sort(values @ q)[-5:]
        assert len(possible) < 3000 and np.array_equal(np.sort(values[possible] @ q)[-5:], best)


def test_scores_beyond_a_long(spark):
    """Scores saturate, whether vector, query or both have large components; the others go through the index."""
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(1, 260)]
    rows += [(300, [1e12] * 8), (301, [-1e12] * 8), (302, [1e12] + [0.0] * 7), (350, [2.0**14] * 8), (303, [1e30, -1e30] + [0.0] * 6)]
    good = [(i, [max(-(2**63), min(2**63 - 1, math.floor(256 * float(np.float32(x))))) for x in v]) for i, v in rows]
    want = []
    for q, v in good:
        if q % 50 == 0:
            scores = ((sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
            best = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for s, i in scores)[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    got = result(spark, rows)
    assert got == sorted(want) and max(r[3] for r in got) == 2**63 - 1


def test_bounds_after_any_share_of_the_segments():
    """What a query has processed of a dimension is one run of postings; no vector scores more than its bound."""
    rng = np.random.default_rng(3)
    values = np.floor(rng.normal(0, 60, (300, 7))).astype(np.int64)
    values[:, 3] = 5
    index = topk_search.ImpactIndex(values)
    for query in (*values[:5], np.array([3, 0, -7, 0, 1, -1, 0])):
        q = query[index.dims]
        impact = np.maximum(q * (index.levels * topk_search.STEP), q * (index.levels * topk_search.STEP + topk_search.STEP - 1))
        order = np.argsort(-impact, kind="stable")
        for end in (0, 1, len(order) // 2, len(order) - 1, len(order)):
            # Vector by vector: the impact of its segments that are processed, and the largest that is left where none is.
            table = {(d, level): i for d, level, i in zip(index.dims[order[:end]], index.levels[order[:end]], impact[order[:end]])}
            rest = {}
            for d, i in zip(index.dims[order[end:]], impact[order[end:]]):
                rest.setdefault(d, i)
            want = [sum(table.get((d, x // topk_search.STEP), rest.get(d)) for d, x in enumerate(v)) for v in values]
            got = index.bounds(query, impact, order, end)
            assert np.allclose(got, want) and (got >= values @ query - 1e-6).all()


def test_search_of_blocks_equals_all_products(monkeypatch):
    rng = np.random.default_rng(4)
    for leads, left, size in ((1, 0.02, 20), (8, 0.25, 300), (128, 0.02, 100_000)):
        monkeypatch.setattr(topk_search, "LEADS", leads)
        monkeypatch.setattr(topk_search, "LEFT", left)
        for n in (1, 4, 60, 300):
            values = np.floor(rng.normal(0, size, (n, 6))).astype(np.int64)
            values[n // 2 :: 3] = values[0]
            ids, queries = rng.integers(0, 2 * n, n), np.concatenate([values[:6], np.zeros((1, 6), np.int64)])
            own = np.append(ids[:6], 7)
            want = [(int(o), i, -s) for o, x in zip(own, queries) for s, i in sorted((-int(y @ x), int(j)) for y, j in zip(values, ids) if j != o)[:5]]
            assert [tuple(map(int, r)) for r in topk_search.search_block(ids, values, own, queries, 5)] == want
