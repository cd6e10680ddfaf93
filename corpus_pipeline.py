"""From raw documents to packed training sequences, in stages that can be run and checked alone.

Every stage takes the documents that its predecessor kept, as a table read from Parquet.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmetrics.llm import language_id, line_dedup, near_dedup, packing
from orgmetrics.llm.batches import SharedFolder, free_name

SHINGLE_WORDS = 5
TOKENIZER = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows. A missing label is filled in.

    Texts that are null or have no letter go, and those whose score is below the level of their
    language. The network learns languages and noise from the labelled rows of ``docs`` that are not
    held out; the levels come from those that are. Where there are none, only texts without a letter
    go and labels stay as they are. Labels decide nothing: a text in another known language stays.
    """
    held = language_id.held_out(F.col("doc_id"))
    network = language_id.fit(docs.filter(~held), noise=True)
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    names = (free_name("lang_pred", docs.columns), free_name("score", docs.columns))
    found = language_id.identify(docs, network, names=names)
    language, score = (F.col(n) for n in names)
    low = F.lit(False)
    for (name, short), level in sorted(language_id.levels(network, docs.filter(held)).items()):
        low |= (language == name) & (language_id.is_short(F.col("text")) == F.lit(short)) & (score < level)
    known = found.filter((language != language_id.UNKNOWN) & ~low)
    return known.withColumn("lang", F.coalesce("lang", names[0])).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of line runs; one that was nothing else goes."""
    lines, gone = free_name("n_lines", docs.columns), free_name("n_deleted", docs.columns)
    found = line_dedup.line_dedup(docs, counts=(lines, gone))
    left = found.filter((F.col(gone) == 0) | (F.col(gone) < F.col(lines)))
    return left.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, null last.

    A document is an id and a text: unrelated texts of one id are no duplicates of each other, and of
    rows that repeat both the one with the least other columns stays.
    """
    key, check = free_name("row_key", docs.columns), free_name("row_check", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text")).withColumn(check, F.xxhash64(F.lit(1), "doc_id", "text"))
    found = near_dedup.near_duplicates(keyed.select(key, "text"), width=SHINGLE_WORDS, key=key)
    named = keyed.select(key, check, "doc_id").distinct()
    groups = named.select(key, "doc_id").join(found.select(key, "component_id").distinct(), key)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key)
    first = groups.groupBy("component_id").agg(F.min(order).alias("first"))
    # Different documents that share a key by chance all stay.
    clash = named.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key)
    stay = first.select(F.col(f"first.{key}").alias(key)).union(clash).distinct()
    kept = keyed.join(stay, key, "left_semi").groupBy(key, check).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return kept.select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]

# The network, the signatures and the tokenizer are beyond SQL; the tests hold the rows against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = SharedFolder(docs, "pipeline")
    for name, stage in STAGES:
        docs = folder.table(stage(spark, docs, sf_dir), name)
    return docs
