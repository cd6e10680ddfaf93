"""Approximate nearest neighbours: inverted lists with an adaptive scan of dimensions.

Largest inner product becomes smallest distance by one more component, the root of M^2 - |x|^2. The
vectors are rotated at random, so that any few components are a fair sample of the distance. Within
a probed list the components are read in blocks of columns: after d of D of them the partial
distance, scaled up by D / d, is tested against the distance of the query's k-th best, and a
candidate goes when the hypothesis that it is nearer is rejected. What is left gets its exact score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmetrics.llm.vectors import TopK, by_dimension, clean_vectors, matrix, ranked

SAMPLE = 16_384  # rows the lists are fitted on, chosen by hash
ROWS_PER_LIST = 1024
LISTS = (32, 2048)  # fewest and most lists; the sample has rows for the most
RECALL = 0.97  # of the sample's own neighbours, by which the share of lists to read is chosen
HELD_OUT = 256  # sample rows that are searched for among the sample to measure it
COLUMNS = 16  # components per step
EPSILON = 1.3  # the test's width: the larger, the fewer candidates are lost
DENSE = 0.2  # share of a block's pairs above which a step computes all of them
ROWS_PER_CELL = 8192
QUERIES_PER_CELL = 2048


@dataclass(frozen=True)
class Index:
    """Rotation, radius and list centres; all of a size that does not grow with the table."""

    rotation: np.ndarray
    radius2: float
    centres: np.ndarray

    def lift(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Rotated vectors whose distances order as the inner products of the given ones."""
        last = np.zeros(len(vectors))
        if not query:
            last = np.sqrt(np.maximum(0, self.radius2 - (vectors**2).sum(axis=1)))
        return np.column_stack([vectors, last]) @ self.rotation

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        return (self.centres**2).sum(axis=1) - 2 * lifted @ self.centres.T


def fit_index(sample: np.ndarray, radius2: float, lists: int, rounds: int = 10, seed: int = 7) -> Index:
    """k-means over the rotated sample; the first centres are rows spread over it."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    index = Index(rotation, radius2, np.zeros((1, dim)))
    rows = index.lift(sample, query=False)
    centres = rows[rng.permutation(len(rows))[:lists]]
    for _ in range(rounds):
        nearest = Index(rotation, radius2, centres).distances(rows).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, rows)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return Index(rotation, radius2, centres)


def measured_share(index: Index, rows: np.ndarray, k: int, seed: int = 11) -> float:
    """The least share of the nearest lists that holds ``RECALL`` of the true neighbours in the sample."""
    rng = np.random.default_rng(seed)
    asked = rng.permutation(len(rows))[:HELD_OUT]
    lists = len(index.centres)
    own = index.distances(index.lift(rows, query=False)).argmin(axis=1)
    place = np.argsort(np.argsort(index.distances(index.lift(rows[asked], query=True)), axis=1), axis=1)
    scores = rows[asked] @ rows.T
    scores[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : max(1, min(k, len(rows) - 1))]
    needed = np.sort((np.take_along_axis(place, own[near], axis=1) + 1).ravel())
    return float(needed[min(len(needed) - 1, int(RECALL * len(needed)))] / lists)


def scan_list(
    queries: np.ndarray,
    query_ids: np.ndarray,
    rows: np.ndarray,
    row_ids: np.ndarray,
    index: Index,
    k: int,
    block: int = 1024,
) -> TopK:
    """Nearest rows of one list for each query; distances in the rotated space, scores exact."""
    top = TopK(len(queries), k)
    q, x = index.lift(queries, query=True), index.lift(rows, query=False)
    dim = q.shape[1]
    q2, x2 = (queries**2).sum(axis=1), index.radius2
    for a, e in _blocks(len(rows), block):
        part, ids = x[a:e], row_ids[a:e]
        # Squared distance of the k-th best so far, from its score.
        limit = q2 + x2 - 2 * top.least
        alive = query_ids[:, None] != ids[None, :]
        seen, d = np.zeros(alive.shape), 0
        # While many pairs are left a step is one product of matrices, then it is taken by pairs.
        while d < dim and (not d or alive.mean() > DENSE):
            to = min(d + COLUMNS, dim)
            mine, theirs = q[:, d:to], part[:, d:to]
            seen += (mine**2).sum(axis=1)[:, None] + (theirs**2).sum(axis=1) - 2 * mine @ theirs.T
            d = to
            alive &= seen <= _largest(limit, d, dim)[:, None]
        who, which = np.nonzero(alive)
        seen = seen[who, which]
        while d < dim and len(who):
            to = min(d + COLUMNS, dim)
            step = q[who, d:to] - part[which, d:to]
            seen = seen + np.einsum("ij,ij->i", step, step)
            d = to
            near = seen <= _largest(limit, d, dim)[who]
            who, which, seen = who[near], which[near], seen[near]
        if not len(who):
            continue
        scores = np.einsum("ij,ij->i", queries[who], rows[a + which])
        edges = np.flatnonzero(np.diff(who, prepend=-1))
        for b, c in zip(edges, [*edges[1:], len(who)]):
            top.add(who[b], scores[b:c], ids[which[b:c]])
    return top


def _blocks(n: int, size: int) -> Iterator[tuple[int, int]]:
    """A short block first: it gives every query its first limit."""
    first = min(n, size // 4)
    yield 0, first
    for a in range(first, n, size):
        yield a, min(n, a + size)


def _largest(limit: np.ndarray, d: int, dim: int) -> np.ndarray:
    """Largest partial distance at which a candidate may still be nearer than ``limit``."""
    width = 1 + EPSILON / np.sqrt(d) if d < dim else 1 + 1e-9
    return limit * (d / dim) * width**2 + 1e-9


class Indexes:
    """An index for every length of vectors; a length that the sample lacks has one list."""

    def __init__(self, known: dict[int, Index], share: dict[int, float], radius2: float):
        self.known, self.share, self.radius2 = known, share, radius2

    def of(self, dim: int) -> Index:
        if dim not in self.known:
            self.known[dim] = fit_index(np.zeros((1, dim)), self.radius2, 1, rounds=0)
        return self.known[dim]

    def lists(self, vectors: np.ndarray) -> np.ndarray:
        """The list of each row; lists of different lengths are different."""
        dim, index = vectors.shape[1], self.of(vectors.shape[1])
        return index.distances(index.lift(vectors, query=False)).argmin(axis=1) + (dim << 32)

    def probes(self, vectors: np.ndarray, sizes: dict[int, int], k: int) -> list[np.ndarray]:
        """The lists that each query reads: the nearest share, and further ones until they hold k others."""
        dim, index = vectors.shape[1], self.of(vectors.shape[1])
        order = np.argsort(index.distances(index.lift(vectors, query=True)), axis=1)
        lists = len(index.centres)
        size = np.array([sizes.get(i + (dim << 32), 0) for i in range(lists)])
        enough = (np.cumsum(size[order], axis=1) > k).argmax(axis=1) + 1
        enough[size.sum() <= k] = lists
        least = max(1, int(np.ceil(self.share.get(dim, 1.0) * lists)))
        return [row[: max(least, n)] + (dim << 32) for row, n in zip(order, enough)]


def nearest(
    df: DataFrame,
    is_query: str,
    k: int = 20,
    probed: float | None = None,
    sample: int = SAMPLE,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found by inner product.

    The lists are fitted on ``sample`` rows chosen by hash; every row is in one list, and every row
    that meets ``is_query`` searches the nearest ``probed`` share of them (by default the share that
    held ``RECALL`` of the neighbours within the sample), and further lists until they hold ``k``
    other rows: a query has ``k`` rows, or all there are. Vectors are compared with those of their own
    length alone. Large lists are cut into cells of bounded size. Vectors that are null, empty, zero
    or hold null or non-finite components take no part, nor do rows without an id; of several rows of
    one id the smallest vector counts; equal scores go to the smaller id.
    """
    schema = "query_id bigint, vec_id bigint, score double"
    spark = df.sparkSession
    clean = clean_vectors(df, key, vector, allow_zero=False)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    size = clean.agg(F.count("*").alias("n"), F.max(squares).alias("radius2")).first()
    if not size["n"]:
        return ranked(spark.createDataFrame([], schema), k)
    # Rows below a hash that leaves a little more than the sample, whatever the table.
    at = F.pmod(F.xxhash64("vec_id", F.lit(99)), F.lit(1 << 32))
    few = clean.withColumn("at", at).filter(F.col("at") < F.lit(int(min(1.0, 1.2 * sample / size["n"]) * (1 << 32))))
    chosen = few.toPandas().sort_values(["at", "vec_id"])[:sample]
    known, share = {}, {}
    for part in by_dimension(chosen):
        rows = matrix(part["v"])
        lists = int(min(max(LISTS[0], size["n"] // ROWS_PER_LIST), LISTS[1], max(1, len(rows) // 8)))
        index = fit_index(rows, size["radius2"], lists)
        known[rows.shape[1]] = index
        share[rows.shape[1]] = measured_share(index, rows, k) if probed is None else probed
    indexes = Indexes(known, share, size["radius2"])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in by_dimension(batch):
                yield part.assign(list=indexes.lists(matrix(part["v"])))

    kind = "vec_id bigint, v array<double>"
    placed = clean.mapInPandas(assign, f"{kind}, list bigint")
    # Rows per list: one number for each list, however large the table.
    sizes = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in by_dimension(batch):
                yield part.assign(lists=indexes.probes(matrix(part["v"]), sizes, k))

    asked = clean.filter(is_query).mapInPandas(probe, f"{kind}, lists array<bigint>")
    asked = asked.select("vec_id", "v", F.explode("lists").alias("list"))
    wanted = {r["list"]: r["n"] for r in asked.groupBy("list").agg(F.count("*").alias("n")).collect()}
    cells = lambda counts, per: F.create_map(
        *(F.lit(x) for e in sizes for x in (e, max(1, -(-counts.get(e, 0) // per))))
    )[F.col("list")]
    rcells, qcells = cells(sizes, ROWS_PER_CELL), cells(wanted, QUERIES_PER_CELL)
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = asked.filter(rcells.isNotNull()).select("*", deal(qcells, 1).alias("q"), every(rcells).alias("r"))
    right = placed.select("*", deal(rcells, 2).alias("r"), every(qcells).alias("q"))

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, given = queries["vec_id"].to_numpy(), matrix(queries["v"])
        found = scan_list(given, ids, matrix(rows["v"]), rows["vec_id"].to_numpy(), indexes.of(given.shape[1]), k)
        return found.rows(ids)

    on = ("list", "q", "r")
    return ranked(left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(run, schema), k)
