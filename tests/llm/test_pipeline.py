"""The pipeline's stages against brute force, stage by stage, and its place in the entry module."""

from __future__ import annotations

import random
import re
import subprocess
import sys
import zlib
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from orgmetrics.llm import language_id
from tests.conftest import rows
from tests.llm.test_dedup import edited, line_brute, near_brute, prose
from tests.llm.test_tokenizers import check_packing

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, lang_pred string, n_lines int, place int"


def documents(spark):
    rng = random.Random(8)
    german = ["der", "hund", "und", "die", "katze", "sind", "im", "haus", "heute", "nicht", "schön", "ganz"]
    english = ["the", "dog", "and", "cat", "are", "in", "house", "today", "not", "nice", "whole", "with"]
    made = []
    for k in range(120):
        lang, pool = ("de", german) if k % 2 else ("en", english)
        lines = [" ".join(rng.choice(pool) for _ in range(rng.randint(8, 25))) for _ in range(rng.randint(1, 6))]
        made.append((k, "\n".join(lines), lang if k % 5 else None))
    shared = " ".join(prose(rng, 60))
    made += [(200 + k, f"{made[k][1]}\n{shared}", "de") for k in range(10)]
    made += [(300 + k, made[k][1], "en") for k in range(10)]
    base = prose(rng, 200)
    made += [(400 + k, " ".join(edited(rng, base, 0.01)), "en") for k in range(12)]
    made += [(500, None, None), (501, "", "de"), (502, "12 -- 34", "en"), (503, made[3][1], "de"), (503, made[3][1], "de")]
    given = [(k, t, x, "s", len(t or ""), "?", 1, 2) for k, t, x in made]
    return spark.createDataFrame(given, COLUMNS).repartition(3)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id", "text").collect()]


def test_stages_are_the_brute_force_ones(spark, tmp_path):
    docs = documents(spark)
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name == "language_id":
            assert pairs(docs) == [(k, t) for k, t in pairs(before) if re.search(r"[^\W\d_]", t or "")]
            assert docs.filter("lang IS NULL").count() == 0
        elif name == "line_dedup":
            # Rows of one id and text are one document.
            once = sorted(set(pairs(before)))
            expected = {(k, t) for k, t, n, gone in line_brute(once) if gone < n or not gone}
            assert set(pairs(docs)) == expected
            assert docs.filter("n_chars <> char_length(text)").count() == 0
        elif name == "near_dedup":
            once = sorted(set(pairs(before)))
            assert pairs(docs) == sorted((k, t) for k, t in once if (k, True) in {(r[0], r[3]) for r in near_brute(once)})
        if name != "packing":
            assert docs.columns == columns and docs.count() > 0
        else:
            check_packing(docs.collect(), before, 4096, 1)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "packing"]


def test_clean_documents_are_kept(spark):
    rng = random.Random(1)
    clean = [(k, " ".join(prose(rng, 80)), "en", "s", 1, "", 1, 1) for k in range(30)]
    docs = spark.createDataFrame(clean, COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert pairs(after) == pairs(docs)


def test_language_id_rejects_by_the_network(spark):
    """Every document of the sample's languages stays; random letters of their and other scripts go."""
    rng = random.Random(2)
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = [tuple(r) for r in sample.filter("n_chars > 300").select("doc_id", "text", "lang", "source", "n_chars").collect()]

    def gibberish(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(150))

    alphabets = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"]
    planted = [(10**6 + k, gibberish(alphabets[k % 3]), None, "s", 1) for k in range(60)]
    docs = spark.createDataFrame(clean + planted, sample.select("doc_id", "text", "lang", "source", "n_chars").schema)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").select("doc_id").collect()}
    assert not kept & {k for k, *_ in planted}
    assert all(x[0] in kept for x in clean)


def test_labelled_junk_does_not_open_the_gate(spark):
    rng = random.Random(3)
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    clean = [tuple(r) for r in sample.filter("n_chars > 300 AND lang = 'en'").collect()]
    junk = lambda: " ".join("".join(rng.choice("αβγδεζηθικλμνξ") for _ in range(6)) for _ in range(100))
    held = [k for k in range(10**6, 10**6 + 30) if zlib.crc32(str(k).encode()) % 3 == 1]
    labelled = [(k, junk(), "en", "s", 1) for k in held[:2]]
    planted = [(2 * 10**6 + k, junk(), None, "s", 1) for k in range(30)]
    docs = spark.createDataFrame(clean + labelled + planted, sample.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").select("doc_id").collect()}
    assert not kept & {k for k, *_ in planted} and all(x[0] in kept for x in clean)


def test_unrelated_texts_of_one_id_all_stay(spark):
    rng = random.Random(4)
    texts = [" ".join(prose(rng, 60)) for _ in range(6)]
    given = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (8, texts[1]), (None, texts[2]), (None, texts[3]), (9, texts[3]), (None, texts[4])]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "", 1, 1) for k, t in given], COLUMNS)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    expected = [(7, texts[0]), (7, texts[1]), (None, texts[2]), (9, texts[3]), (None, texts[4])]
    assert sorted(pairs(kept), key=str) == sorted(expected, key=str)


def test_empty_tables_go_through(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert rows(stage(spark, docs, "")) == []


def test_entry_loads_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("orgmetrics.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 100 and "pipeline" not in e.queries() and not any(q.startswith("op1_") for q in e.queries())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], timeout=120)
    assert done.returncode == 0


def test_levels_come_from_all_held_out_texts(spark):
    """The 400 texts that a hash of the id puts first score high, all others of the language low."""

    class Scores(language_id.ByteNetwork):
        def predict(self, texts):
            return [("en", float(t.split()[1])) for t in texts]

    network = Scores(["en"], [], None, None, None)
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    first = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(400).withColumn("first", F.lit(True))
    score = F.when(F.col("first"), "0.75").otherwise("0.25")
    held = ids.join(first, "doc_id", "left").select("doc_id", F.concat(F.lit("word "), score).alias("text"), F.lit("en").alias("lang"))
    assert language_id.levels(network, held) == {("en", True): 0.125}
