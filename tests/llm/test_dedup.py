"""Line dedup and near-dedup against brute force, and the plans that must stay native."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from orgmetrics.llm import line_dedup, near_dedup
from orgmetrics.llm.batches import SharedFolder
from orgmetrics.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def near_brute(docs, width=5):
    """(key, size, component, kept) by comparing all pairs."""
    sets = [shingles(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if (both and 100 * both >= 80 * (len(a) + len(sets[j]) - both)) or docs[i][0] == docs[j][0] is not None:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(
        ((k, len(s), least[find(i)] if k is not None else None, k is None or k == least[find(i)])
        for i, ((k, _), s) in enumerate(zip(docs, sets))),
        key=str,
    )


def line_brute(docs, min_chars=60):
    """Text per document: lines within any run that stands earlier and is long enough go."""
    seen, out = set(), []
    for key, text in docs:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = tuple(lines[i:j])
                if run not in seen:
                    break
                if sum(map(len, run)) >= min_chars:
                    gone.update(range(i, j))
            seen.update(tuple(lines[i:j]) for j in range(i + 1, len(lines) + 1))
        left = [x for i, x in enumerate(lines) if i not in gone]
        out.append((key, "\n".join(left), len(lines), len(gone)))
    return sorted(out, key=str)


def table(spark, docs):
    given = [(k, t, "x", 1, 2) for k, t in docs]
    return spark.createDataFrame(given, "doc_id bigint, text string, t string, i int, node int")


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


def prose(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


ODD = [
    (900, None), (901, ""), (902, " \t\n"), (903, "One two"), (904, "one TWO"), (905, "One  two\x0b"),
    (906, "a b c d e"), (907, "A b c d e"), (908, "one two x"), (909, "É b c d e"), (910, "é b c d e"),
    (911, "x " * 4000), (912, "x " * 5000), (913, "y" * 50000), (914, "y" * 50000),
]


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_of_the_sample(spark, width):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += ODD + docs[:2]
    assert rows(near_dedup.near_duplicates(table(spark, docs), width=width)) == near_brute(docs, width)


def test_clusters_of_many_copies(spark, monkeypatch):
    """Regions wider than the window, orders of several blocks, and clusters with links at the border."""
    monkeypatch.setattr(near_dedup, "WINDOW", 8)
    monkeypatch.setattr(near_dedup, "ROWS", 200)
    monkeypatch.setattr(near_dedup, "BEYOND", 16)
    rng = random.Random(4)
    base, docs = prose(rng, 60), []
    for k in range(250):
        docs.append((k, " ".join(edited(rng, base, rng.choice([0.01, 0.03, 0.05])))))
    chain = prose(rng, 120)
    for k in range(300, 330):  # each is near the one before only
        chain = chain[4:] + prose(rng, 4)
        docs.append((k, " ".join(chain)))
    docs += [(400 + k, " ".join(base)) for k in range(30)]
    rng.shuffle(docs)
    assert rows(near_dedup.near_duplicates(table(spark, docs))) == near_brute(docs)


def test_near_duplicates_of_odd_tables(spark):
    docs = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (3, "p q"), (3, "a b c d e f"), (9, "P q")]
    found = rows(near_dedup.near_duplicates(table(spark, docs)))
    assert [r for r in found if r[0] is not None] == [(3, 1, 3, True), (3, 2, 3, True), (5, 2, 3, False), (9, 1, 3, False)]
    assert [r for r in found if r[0] is None] == [(None, 2, None, True)] * 2
    assert rows(near_dedup.near_duplicates(table(spark, []))) == []
    assert rows(near_dedup.near_duplicates(table(spark, [(1, None)]))) == [(1, 0, 1, True)]


def test_lines_of_the_sample(spark):
    ours = QUERIES["op2_line_dedup"](spark, SF).toArrow()
    assert differences(ours, duck(SF).sql(ORACLES["op2_line_dedup"]).to_arrow_table()) == []


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_a_small_alphabet(spark, seed):
    """Nested, overlapping and self-repeating runs."""
    rng = random.Random(seed)
    alphabet = ["a" * 7, "b" * 9, "", "c" * 5, "d" * 30, *(f"only {seed} {i}" for i in range(3))]
    docs = []
    for k in range(25):
        lines = [rng.choice(alphabet[: rng.choice([2, 5, 8])]) for _ in range(rng.randint(1, 30))]
        if docs and rng.random() < 0.4:
            lines += (rng.choice(docs)[1] or "").split("\n")
        docs.append((k, "\n".join(lines)))
    docs += [(50, None), (51, ""), (52, "\n" * 80), (53, "z" * 70), (54, "z" * 70), (55, "\n".join(["r" * 20] * 40))]
    found = line_dedup.line_dedup(table(spark, docs), min_chars=25)
    assert rows(found.select("doc_id", "text", "n_lines", "n_deleted")) == line_brute(docs, 25)
    assert found.columns == ["doc_id", "text", "t", "i", "node", "n_lines", "n_deleted"]


def test_lines_of_odd_tables(spark):
    long = "w" * 80
    docs = [(None, long), (1, f"{long}\nx"), (1, f"x\n{long}"), (2, "own"), (2, "own"), (3, None), (None, None)]
    found = line_dedup.line_dedup(table(spark, docs)).select("doc_id", "text", "n_deleted")
    assert rows(found) == sorted(
        [(None, long, 0), (1, "x", 1), (1, "x", 1), (2, "own", 0), (2, "own", 0), (3, None, 0), (None, None, 0)], key=str
    )
    assert rows(line_dedup.line_dedup(table(spark, []))) == []
    # Rows that repeat a key and a text are one document.
    twice = line_dedup.line_dedup(table(spark, [(7, long), (7, long), (8, long)])).select("doc_id", "text")
    assert rows(twice) == [(7, long), (7, long), (8, "")]


def test_many_lines_in_one_text(spark):
    lines = [f"line {i} " + "v" * 20 for i in range(5000)]
    docs = [(1, "\n".join(lines)), (2, "\n".join(["new", *lines[1000:4000], "end"]))]
    found = rows(line_dedup.line_dedup(table(spark, docs)).select("doc_id", "text", "n_deleted"))
    assert found == [(1, docs[0][1], 0), (2, "new\nend", 3000)]


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_chat_format"])
def test_native_queries_have_no_python_node(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def alike(rng, n, pairs, agreement=0.55, near=0.84):
    """Signatures that agree pairwise on a share of the min-hashes, and planted pairs that agree on more."""
    base = rng.integers(0, 1 << 16, 128)
    signatures = np.where(rng.random((n, 128)) < agreement**0.5, base, rng.integers(0, 1 << 16, (n, 128)))
    for a, b in pairs:
        signatures[b] = np.where(rng.random(128) < near, signatures[a], rng.integers(0, 1 << 16, 128))
    return signatures


def candidates_of(spark, signatures, level=0.8):
    """Loose clusters of nodes with these signatures, and how many rows all sorted orders had."""
    given = [(k, s.astype(">u2").tobytes()) for k, s in enumerate(signatures)]
    nodes = spark.createDataFrame(given, "node bigint, signature binary").repartition(4)
    folder = SharedFolder(nodes, "test")
    clusters = dict(rows(near_dedup._loose_clusters(nodes, level, folder)))
    placed = spark.read.parquet(f"{folder.folder}/order*").count()
    return clusters, placed


def test_planted_pairs_among_thousands_of_similar_texts(spark, monkeypatch):
    """Every region is wider than the window: nodes go through further trees until the pairs are found."""
    monkeypatch.setattr(near_dedup, "WINDOW", 16)
    rng = np.random.default_rng(6)
    pairs = [(k, 4999 - k) for k in range(200)]
    signatures = alike(rng, 5000, pairs)
    clusters, placed = candidates_of(spark, signatures)
    near = [(a, b) for a, b in pairs if (signatures[a] == signatures[b]).mean() >= 0.8]
    assert len(near) > 150
    assert sum(clusters[a] == clusters[b] for a, b in near) >= 0.99 * len(near)
    # Candidates: rows of the orders times the window, whatever the size of a region.
    assert placed <= 5000 * 20 * 25


def test_candidates_grow_with_the_nodes(spark):
    rng = np.random.default_rng(7)
    few, many = (candidates_of(spark, alike(rng, n, []))[1] for n in (1000, 4000))
    assert many <= 4 * 1.5 * few


def test_keys_beside_nulls_keep_all_bits(spark):
    """Links and rows without a second node in one frame: the nodes stay 64-bit integers."""
    large = 2**60 + 1

    def run(group):
        return [(int(x), None if x % 2 else int(x) + 2, 0.5) for x in group["k"]]

    given = spark.createDataFrame([(0, large), (0, large + 1)], "g bigint, k bigint").coalesce(1)
    found = near_dedup._by_key(given, ["g"], run, "a bigint, b bigint, lack double")
    assert sorted(tuple(r) for r in found.collect()) == [(large, None, 0.5), (large + 1, large + 3, 0.5)]
