"""Helpers shared by the operators: bounded slices of a batch, tables written to the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgmetrics.session import shared_dir

if TYPE_CHECKING:
    import pandas as pd  # not loaded by workers that only see Arrow batches

CHUNK_CHARS = 1 << 21  # characters of text whose words a task holds at a time


def text_slices(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive texts of about ``limit`` characters together, one text at least."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def filled(texts: pd.Series) -> list[str]:
    """The texts, a null one as empty."""
    return [t if isinstance(t, str) else "" for t in texts]


#: Types of added columns, in Spark and in Arrow.
LONG = (T.LongType(), pa.int64())
DOUBLE = (T.DoubleType(), pa.float64())
STRING = (T.StringType(), pa.string())
BINARY = (T.BinaryType(), pa.binary())


def array_of(kind: tuple) -> tuple:
    return T.ArrayType(kind[0]), pa.list_(kind[1])


def struct_of(**fields: tuple) -> tuple:
    spark = T.StructType([T.StructField(n, k[0]) for n, k in fields.items()])
    return spark, pa.struct([(n, k[1]) for n, k in fields.items()])


def per_text(
    docs: DataFrame, keep: list[str], text: str, added: dict[str, tuple], make: Callable
) -> DataFrame:
    """The columns ``keep``, untouched, and columns computed from every whole text.

    ``make()`` is called once per task and gives a function from a list of texts, a null one as
    empty, to one tuple of added values per text. Texts are handed over in bounded slices.
    """
    types = [t for _, t in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            rows: list[tuple] = []
            for a, b in text_slices(texts):
                rows += work(texts[a:b])
            columns = list(zip(*rows)) or [()] * len(types)
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            kept = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], [f"c{i}" for i in range(len(kept) + len(arrays))])

    rows = docs.select(
        *(F.col(n).alias(f"c{i}") for i, n in enumerate(keep)), F.col(text).cast("string").alias("text")
    )
    kinds = [docs.schema[n].dataType for n in keep] + [k for k, _ in added.values()]
    schema = T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)])
    return rows.mapInArrow(run, schema).toDF(*keep, *added)


def per_slice(
    rows: DataFrame, keep: list[str], text: str, added: dict[str, tuple], make: Callable, limit: int
) -> DataFrame:
    """As ``per_text``, for results as large as the texts: every slice is handed on before the next.

    A slice has about ``limit`` bytes of text; a longer text is a slice of its own. A kept text goes
    to the workers once.
    """
    once = text in keep and isinstance(rows.schema[text].dataType, T.StringType)
    width = len(keep)
    place = keep.index(text) if once else width
    types = [t for _, t in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            at = 0
            while at < len(lengths):
                end, size = at + 1, lengths[at]
                while end < len(lengths) and size + lengths[end] <= limit:
                    size += lengths[end]
                    end += 1
                part = batch.slice(at, end - at)
                at = end
                found = work([t or "" for t in part.column(place).to_pylist()])
                arrays = [pa.array(c, type=t) for c, t in zip(zip(*found), types)]
                kept = part.columns[:width]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], [f"c{i}" for i in range(len(kept) + len(arrays))])

    sent = [F.col(n).alias(f"c{i}") for i, n in enumerate(keep)]
    chosen = rows.select(*sent, *([] if once else [F.col(text).cast("string").alias("text")]))
    kinds = [rows.schema[n].dataType for n in keep] + [k for k, _ in added.values()]
    schema = T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)])
    return chosen.mapInArrow(run, schema).toDF(*keep, *added)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores after it as long as a column has that name in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class SharedFolder:
    """A folder of its own under ``spark.checkpoint.dir`` for what one operator reads again.

    Written tables cut the lineage and outlive executors.
    """

    def __init__(self, df: DataFrame, operator: str):
        self.folder = f"{shared_dir(df.sparkSession)}/{operator}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
