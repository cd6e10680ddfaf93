"""Vectors of a table as blocks: clean rows, matrices per task, the best rows per query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def usable(vector: Column, allow_zero: bool = True) -> Column:
    """Whether a vector has components, and all are finite numbers."""
    limit = F.lit(float("inf"))
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < limit) & ~F.isnan(x))
    if not allow_zero:
        good = good & F.exists(vector, lambda x: x != 0)
    return vector.isNotNull() & (F.size(vector) > 0) & good


def clean_vectors(
    df: DataFrame, key: str, vector: str, convert: Column | None = None, allow_zero: bool = True
) -> DataFrame:
    """(vec_id, v): one row per id, the smallest vector if an id has several; null ids left out."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = df.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("vec_id"), doubles.alias("v")
    )
    rows = rows.filter(usable(F.col("v"), allow_zero))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64, copy=False)


def by_dimension(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of a batch by the length of their vectors: only equal lengths are compared."""
    for _, part in batch.groupby(batch["v"].map(len), sort=False):
        yield part


class TopK:
    """The best rows found so far for each of ``n`` queries: highest score, then smallest id."""

    def __init__(self, n: int, k: int, kind: type = np.float64):
        self.k, self.kind = k, kind
        self.scores: list[np.ndarray] = [np.zeros(0, dtype=kind)] * n
        self.ids: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * n
        self.least = np.full(n, -np.inf)  # a row below this is not among the best

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.ids[query], ids])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[best], ids[best]
        if len(best) == self.k:
            self.least[query] = max(self.least[query], self.scores[query][-1])

    def rows(self, query_ids: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "query_id": np.repeat(query_ids, [len(s) for s in self.scores]).astype(np.int64),
                "vec_id": np.concatenate(self.ids) if self.ids else np.zeros(0, np.int64),
                "score": np.concatenate(self.scores) if self.scores else np.zeros(0, self.kind),
            }
        )


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query over all tasks, with their rank from 1."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
