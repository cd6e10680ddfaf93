"""Vector searches against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from orgmetrics.llm import ann_search, exact_topk
from orgmetrics.llm.queries import QUERIES
from tests.conftest import rows

IS_QUERY = "vec_id % 20 = 0"


def table(spark, vectors):
    return spark.createDataFrame(
        [(i, v, "x", 0.5) for i, v in vectors], "vec_id bigint, embedding array<float>, v string, score double"
    )


def brute(vectors, k, scale=None):
    good = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        v = tuple(math.floor(scale * x) for x in v) if scale else tuple(v)
        good[i] = min(v, good.get(i, v))
    out = []
    for q in good:
        if q % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(good[q], x)), i) for i, x in good.items() if i != q and len(x) == len(good[q])]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    made = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(300)]
    made += [(i, made[7][1]) for i in range(300, 330)]  # ties
    made += [(400, None), (401, [None] * 12), (402, [float("nan")] * 12), (403, [float("inf")] + [0.0] * 11)]
    made += [(420, []), (None, made[1][1]), (20, made[20][1]), (440, [1.0] * 5), (441, [2.0] * 5)]
    return made


def test_exact_search(spark, vectors):
    found = exact_topk.exact_topk(table(spark, vectors), IS_QUERY, k=7)
    assert rows(found) == brute(vectors, 7, 64)


def test_exact_search_in_many_cells(spark, vectors, monkeypatch):
    monkeypatch.setattr(exact_topk, "QUERIES_PER_CELL", 5)
    monkeypatch.setattr(exact_topk, "ROWS_PER_CELL", 100)
    found = exact_topk.exact_topk(table(spark, vectors), IS_QUERY, k=7)
    assert rows(found) == brute(vectors, 7, 64)


def test_exact_search_beyond_doubles(spark):
    large = [(i, [float((i * 37 % 11) * 10**6 + 1), 3e6, float(i)]) for i in range(60)]
    found = exact_topk.exact_topk(table(spark, large), IS_QUERY, k=5)
    assert rows(found) == brute(large, 5, 64)


def test_exact_search_without_enough_rows(spark):
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert rows(exact_topk.exact_topk(table(spark, few), IS_QUERY)) == [(0, 1, 1, 2048)]
    assert rows(exact_topk.exact_topk(table(spark, few[:1]), IS_QUERY)) == []
    assert rows(exact_topk.exact_topk(table(spark, []), IS_QUERY)) == []


def test_products_of_large_numbers_are_exact():
    rng = np.random.default_rng(8)
    queries = rng.integers(-(1 << 22), 1 << 22, (20, 30)).astype(float)
    rows = rng.integers(-100, 100, (40, 30)).astype(float)
    rows[3] = rng.integers(-(1 << 30), 1 << 30, 30)
    rows[5, 7] = float(10**10) * 64
    rows[6, 0] = float(1 << 45)
    queries[:, 0] = rng.integers(-9, 9, 20)
    expected = [[sum(int(a) * int(b) for a, b in zip(q, x)) for x in rows] for q in queries]
    assert exact_topk._products(queries, rows).tolist() == expected


def test_an_outlier_does_not_slow_a_block():
    import time

    rng = np.random.default_rng(9)
    queries, rows = (np.floor(rng.normal(size=(n, 64)) * 64) for n in (100, 2000))
    rows[17, 5] = 1e13
    started = time.perf_counter()
    exact_topk.search_cell(queries, np.arange(100), rows, np.arange(1000, 3000), 20)
    assert time.perf_counter() - started < 2


def test_finer_levels_leave_fewer_pairs():
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(30, 64)) * 3
    rows = np.floor((centres[rng.integers(30, size=6000)] + rng.normal(size=(6000, 64)) * 0.2) * 64)
    left = np.zeros(1 + len(exact_topk.SEGMENTS))
    exact_topk.search_cell(rows[:100], np.arange(100), rows, np.arange(6000), 20, left)
    share = left / left[0]
    assert all(a >= b for a, b in zip(share, share[1:])) and share[-1] < 0.3


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(1)
    q, x = np.floor(rng.normal(size=(50, 30)) * 64), np.floor(rng.normal(size=(80, 30)) * 64)
    for segments in (1, 4, 16, 64):
        bound = exact_topk.segment_features(q, segments) @ exact_topk.segment_features(x, segments).T
        assert (bound >= q @ x.T - 1e-6).all()


def recall(found, expected):
    got = {(r[0], r[2]) for r in found}
    return sum((r[0], r[2]) in got for r in expected) / len(expected)


def test_nearest_of_the_sample(spark):
    sf = "/root/testdata/sf0.1"
    found = [tuple(r) for r in QUERIES["op4_ann_search"](spark, sf).collect()]
    given = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, matrix = np.array([i for i, _ in given]), np.array([v for _, v in given], dtype=np.float64)
    expected = []
    for at in np.flatnonzero(ids % 20 == 0):
        score = matrix @ matrix[at]
        order = [j for j in np.lexsort((ids, -score)) if j != at][:20]
        expected += [(ids[at], r, ids[j], score[j]) for r, j in enumerate(order, 1)]
    assert len(found) == len(expected)
    assert recall(found, expected) >= 0.92
    scores = {(int(q), int(i)): float(matrix[ids == q][0] @ matrix[ids == i][0]) for q, _, i, _ in found[:200]}
    for q, _, i, score in found[:200]:
        assert score == pytest.approx(scores[q, i], abs=1e-12)


def test_nearest_with_unusable_vectors_and_ties(spark, vectors):
    zero = [(v[0], v[1]) for v in vectors] + [(460, [0.0] * 12)]
    found = rows(ann_search.nearest(table(spark, zero), IS_QUERY, k=7, probed=1.0))
    expected = brute([v for v in zero if v[1] is None or any(v[1])], 7)
    assert recall(found, expected) > 0.95
    assert {r[0] for r in found} == {r[0] for r in expected}
    by_query: dict[int, list] = {}
    for q, rank, i, score in found:
        by_query.setdefault(q, []).append((rank, -score, i))
        assert i != q
    for found_rows in by_query.values():
        order = sorted(found_rows)
        assert [r[0] for r in order] == list(range(1, 1 + len(order)))
        assert [r[1:] for r in order] == sorted(r[1:] for r in order)


def test_nearest_of_few_rows(spark):
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert rows(ann_search.nearest(table(spark, few), IS_QUERY)) == [(0, 1, 1, 0.5)]
    assert rows(ann_search.nearest(table(spark, []), IS_QUERY)) == []


def test_vectors_of_every_length_are_searched(spark):
    rng = np.random.default_rng(4)
    given = [(i, [float(x) for x in rng.normal(size=2 if i < 40 else 3)]) for i in range(100)]
    found = rows(ann_search.nearest(table(spark, given), IS_QUERY, k=5))
    expected = brute(given, 5)
    assert {r[0] for r in found} == {0, 20, 40, 60, 80}
    assert [r[:2] for r in found] == [r[:2] for r in expected] and recall(found, expected) > 0.9


@pytest.mark.parametrize("seed", range(4))
def test_a_query_goes_on_until_it_has_k_rows(spark, seed):
    """Nearly all rows are copies of the vector opposite to the query."""
    rng = np.random.default_rng(seed)
    query = rng.normal(size=8)
    given = [(0, query.tolist())] + [(i, (-query).tolist()) for i in range(1, 700) if i % 20]
    given += [(1000 + i, (query + rng.normal(size=8)).tolist()) for i in range(1, 9)]
    found = rows(ann_search.nearest(table(spark, given), IS_QUERY, probed=0.05))
    assert [r[1] for r in sorted(found, key=lambda r: r[1])] == list(range(1, 21))


def test_clustered_vectors_read_few_lists(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 4
    given = [(i, (centres[i % 40] + rng.normal(size=16) * 0.3).tolist()) for i in range(2000)]
    matrix = np.array([np.float32(v) for _, v in given], dtype=np.float64)
    index = ann_search.fit_index(matrix, float((matrix**2).sum(axis=1).max()), 32)
    assert ann_search.measured_share(index, matrix, 20) < 0.5
    found = rows(ann_search.nearest(table(spark, given), IS_QUERY))
    assert recall(found, brute(given, 20)) >= 0.9
