"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into equal segments. With the mean m and the deviation s (root of the summed
squares around m) of each segment of length n, the squared distance of two vectors is at least
the sum of n (m - m')^2 + (s - s')^2. Since |q|^2 + |x|^2 = d^2 + 2 qx, that bounds the inner product
from above by the sum of n m m' + s s': a product of short matrices. Bounds are taken coarse to
fine; only pairs that may still be among a query's best go on, and the last get exact scores. While
many pairs are left a level is one product of matrices, then it is taken pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmetrics.llm.vectors import TopK, by_dimension, clean_vectors, matrix, ranked

SEGMENTS = (1, 4, 16, 32)  # coarse to fine; segments of one component are the vectors themselves
DENSE = 0.1  # share of a block's pairs above which a level computes all of them
QUERIES_PER_CELL = 2048
ROWS_PER_CELL = 16384
BLOCK = 2048  # rows whose bounds are taken at a time
EXACT = float(1 << 53)


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations whose products add up to the bound."""
    n, dim = vectors.shape
    edges = np.linspace(0, dim, min(segments, dim) + 1).astype(int)
    out = np.empty((n, 2 * (len(edges) - 1)))
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        part = vectors[:, a:b]
        mean = part.mean(axis=1)
        out[:, 2 * i] = mean * np.sqrt(b - a)
        out[:, 2 * i + 1] = np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))
    return out


LIMB = 21  # bits; sums of products of two limbs are exact in doubles


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as integers, exact also where doubles are not.

    Rows whose products may leave the doubles are taken in two limbs, and only rows beyond those in
    whole numbers of any size. A product beyond 64 bits ends the job.
    """
    of_queries, of_rows = np.abs(queries).max(initial=0), np.abs(rows).max(axis=1, initial=0)
    largest = of_rows * of_queries * queries.shape[1]
    safe = largest < EXACT
    if safe.all():
        return (queries @ rows.T).astype(np.int64)
    out = np.empty((len(queries), len(rows)), dtype=np.int64)
    out[:, safe] = (queries @ rows[safe].T).astype(np.int64)
    limbs = ~safe & (largest < float(1 << 62)) & (np.maximum(of_rows, of_queries) < float(1 << 2 * LIMB))
    limbs &= queries.shape[1] < 1 << (53 - 2 * LIMB)
    if limbs.any():
        parts = []
        for x in (queries, rows[limbs]):
            whole = x.astype(np.int64)
            parts.append(((whole >> LIMB).astype(float), (whole & ((1 << LIMB) - 1)).astype(float)))
        (q1, q0), (x1, x0) = parts
        high, low = (q1 @ x1.T).astype(np.int64), (q0 @ x0.T).astype(np.int64)
        middle = (q1 @ x0.T).astype(np.int64) + (q0 @ x1.T).astype(np.int64)
        out[:, limbs] = (high << 2 * LIMB) + (middle << LIMB) + low
    for j in np.flatnonzero(~safe & ~limbs):
        row = [int(x) for x in rows[j]]
        out[:, j] = np.array([sum(int(a) * b for a, b in zip(q, row)) for q in queries], dtype=np.int64)
    return out


def _by_pair(queries: np.ndarray, rows: np.ndarray, who: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Products of the given pairs, in steps of bounded size."""
    out = np.empty(len(who))
    for a in range(0, len(who), 1 << 15):
        part = slice(a, a + (1 << 15))
        out[part] = np.einsum("ij,ij->i", queries[who[part]], rows[which[part]])
    return out


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    """Short blocks first, each twice the one before: every block raises the queries' limits."""
    at, size = 0, BLOCK // 16
    while at < n:
        yield at, min(n, at + size)
        at, size = at + size, min(BLOCK, 2 * size)


def search_cell(
    queries: np.ndarray,
    query_ids: np.ndarray,
    rows: np.ndarray,
    row_ids: np.ndarray,
    k: int,
    left: np.ndarray | None = None,
) -> TopK:
    """Top ``k`` of ``rows`` for each query, a row of the query's own id left out.

    ``left``, if given, is added up to: all pairs, and those that each level leaves.
    """
    top = TopK(len(queries), k, np.int64)
    segments = [s for s in SEGMENTS if s < queries.shape[1]]
    levels = [(segment_features(queries, s), segment_features(rows, s)) for s in segments]
    norm = np.sqrt((queries**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1).max(initial=0))
    slack = 1e-9 * norm + 1e-6  # rounding of the bounds never costs a row
    doubles = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1] < EXACT
    for a, e in _blocks(len(rows)):
        part, ids = rows[a:e], row_ids[a:e]
        need = top.least - slack
        alive, pairs = query_ids[:, None] != ids[None, :], None
        counts = [alive.size]
        for of_queries, of_rows in levels:
            if pairs is None and alive.mean() > DENSE:
                alive &= of_queries @ of_rows[a:e].T >= need[:, None]
            else:
                who, which = np.nonzero(alive) if pairs is None else pairs
                near = _by_pair(of_queries, of_rows[a:e], who, which) >= need[who]
                pairs = who[near], which[near]
            counts.append(int(alive.sum()) if pairs is None else len(pairs[0]))
        if left is not None:
            left[: len(counts)] += counts
        if pairs is None and (not doubles or alive.mean() > DENSE):
            scores = _products(queries, part)
            alive &= scores >= top.least[:, None]
            who, which = np.nonzero(alive)
            scores = scores[who, which]
        else:
            who, which = np.nonzero(alive) if pairs is None else pairs
            if doubles:
                scores = _by_pair(queries, part, who, which).astype(np.int64)
            else:
                scores = np.concatenate(
                    [np.zeros(0, np.int64)] + [_products(queries[i : i + 1], part[which[who == i]])[0] for i in np.unique(who)]
                )
            good = scores >= top.least[who]
            who, which, scores = who[good], which[good], scores[good]
        edges = np.flatnonzero(np.diff(who, prepend=-1))
        for b, c in zip(edges, [*edges[1:], len(who)]):
            top.add(who[b], scores[b:c], ids[which[b:c]])
    return top


def exact_topk(
    df: DataFrame,
    is_query: str,
    k: int = 20,
    scale: float = 64.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest products of floor(scale * x).

    ``is_query`` is a condition over ``vec_id``; every such row is compared to all rows of another
    id. Queries and rows are dealt out to cells of bounded size, and each cell keeps ``k`` rows per
    query. Vectors that are null, empty or hold null or non-finite components take no part, nor do
    rows without an id; of several rows of one id the smallest vector counts; only vectors of
    one length are compared; equal scores go to the smaller id.
    """
    clean = clean_vectors(df, key, vector)
    whole = clean.select(
        "vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v")
    )
    sizes = whole.agg(
        F.count("*").alias("rows"), F.sum(F.expr(f"int({is_query})")).alias("queries")
    ).first()
    down = -(-(sizes["queries"] or 0) // QUERIES_PER_CELL) or 1
    across = -(-sizes["rows"] // ROWS_PER_CELL) or 1
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = whole.filter(is_query).select("*", deal(down, 1).alias("qcell")).select(
        "*", every(across).alias("rcell")
    )
    rows = whole.select("*", deal(across, 2).alias("rcell")).select("*", every(down).alias("qcell"))

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")]
        parts = {p["v"].map(len).iloc[0]: p for p in by_dimension(rows)} if len(rows) else {}
        for q in by_dimension(queries) if len(queries) else ():
            r = parts.get(len(q["v"].iloc[0]))
            if r is not None:
                ids = q["vec_id"].to_numpy()
                top = search_cell(matrix(q["v"]), ids, matrix(r["v"]), r["vec_id"].to_numpy(), k)
                found.append(top.rows(ids).astype("int64"))
        return pd.concat(found)

    cells = queries.groupBy("qcell", "rcell").cogroup(rows.groupBy("qcell", "rcell"))
    return ranked(cells.applyInPandas(run, "query_id bigint, vec_id bigint, score bigint"), k)
