"""Token alignment, the Merkle manifest and main texts of pages."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orgmetrics.llm import alignment, html_extract, manifest
from orgmetrics.llm.boosting import BoostedTrees
from orgmetrics.llm.bpe_codec import byte_letters
from orgmetrics.llm.dom import Page, naming_words
from orgmetrics.llm.labelled_pages import MARK, NAMES, labelled_pages
from orgmetrics.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
TEXTS = [
    "The quick brown fox.", "a  b   c ", "  two before", "\n\ntab\tx  \n", "é中😀 naïve", "<|endoftext|> <s> hi</s>",
    " ", "x" * 3000 + " y", "▁already", "antidisestablishmentarianism " * 50, "", None, "The quick brown fox.",
]


def library_tokens(text):
    if not text:
        return [], []
    letters = byte_letters()
    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    ids = tokenizer.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(letters[c] for c in tokenizer.id_to_token(i))) for i in ids]
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    same = all(b"".join(s for _, s in x) == whole for x in (a, b))
    return (a, b) if same else ([], [])


def brute_alignment(texts):
    """Per text: ids of A and B, links, groups as text, overlapping tokens of B per token of A."""
    found = []
    for text in texts:
        a, b = library_tokens(text)
        ends = [np.cumsum([len(s) for _, s in x]).tolist() for x in (a, b)]
        links = [(a[i][0], b[ends[1].index(e)][0]) for i, e in enumerate(ends[0]) if e in set(ends[1])]
        groups, start = [], 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            parts = [[str(x[i][0]) for i, y in enumerate(z) if start < y <= e] for x, z in ((a, ends[0]), (b, ends[1]))]
            groups.append("|".join(",".join(p) for p in parts))
            start = e
        over = []
        for i, e in enumerate(ends[0]):
            first = e - len(a[i][1])
            shared = [j for j, y in enumerate(ends[1]) if y > first and y - len(b[j][1]) < e]
            over.append((shared[0], shared[-1]))
        found.append((a, b, links, ";".join(groups), over))
    return found


def test_alignment_report_is_the_brute_force_one(spark):
    given = [(i, t, 1, 2) for i, t in enumerate(TEXTS)] + [(None, "null key", 1, 2), (0, "The quick", 1, 2)]
    table = spark.createDataFrame(given, "doc_id bigint, text string, slots int, n_a int")
    expected = brute_alignment([t for _, t, *_ in given])
    counts = Counter(x for e in expected for x in e[2])
    most = {b: max(n for (_, y), n in counts.items() if y == b) for _, b in counts}
    want = []
    for (key, *_), (a, b, links, groups, _) in zip(given, expected):
        best = sum(counts[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        many = len(links)
        want.append((key, len(a), len(b), many, many, best, sum(counts[x] for x in links), digest))
    assert rows(alignment.alignment_report(table, *PATHS)) == sorted(want, key=str)


def test_alignment_of_an_empty_table(spark):
    table = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.alignment_report(table, *PATHS).collect() == []


def test_overlaps_and_groups(spark):
    table = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    made = {r["doc_id"]: r for r in alignment.align_tokens(table, *PATHS).collect()}
    for i, (a, b, _, groups, over) in enumerate(brute_alignment(TEXTS)):
        r = made[i]
        assert r["a"] == [x for x, _ in a] and r["b"] == [x for x, _ in b]
        assert list(zip(r["b_first"], r["b_last"])) == over
        parts = [g.split("|") for g in groups.split(";")] if groups else []
        assert r["group_a"] == [len(p[0].split(",")) for p in parts]
        assert r["group_b"] == [len(p[1].split(",")) for p in parts]


def test_galloping_finds_what_bisection_finds():
    rng = np.random.default_rng(0)
    for _ in range(300):
        long = np.unique(rng.integers(0, 300, rng.integers(0, 120)))
        short = np.unique(rng.integers(0, 300, rng.integers(0, 60)))
        found = alignment.gallop(short, long, rng.integers(-5, 130, len(short)))
        assert found.tolist() == np.searchsorted(long, short).tolist()


def test_pairs_of_the_sample_are_counted_like_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_alignment([r["text"] for r in docs])
    got = {r["doc_id"]: r for r in QUERIES["op11_alignment"](spark, SF).collect()}
    counts = Counter(x for e in expected for x in e[2])
    for r, (a, b, links, groups, _) in zip(docs, expected):
        found = got[r["doc_id"]]
        assert (found["n_a"], found["n_b"], found["n_links"]) == (len(a), len(b), len(links))
        assert found["count_sum"] == sum(counts[x] for x in links)
        assert found["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(table, columns, fan_out):
    """(key, leaf, subroot, root, path) of every row, tree by tree."""

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + fan_out])) for i in range(0, len(out[-1]), fan_out)])
        return out

    def path(of, i):
        steps = []
        for level in of[:-1]:
            first = i - i % fan_out
            steps.append(("".join(level[first:i]), "".join(level[i + 1 : first + fan_out])))
            i //= fan_out
        return steps

    trees = {}
    for r in table:
        leaf = sha("".join(field(r[c]) for c in columns))
        trees.setdefault(r["lang"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0, leaf), r["doc_id"], leaf))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {n: levels([x[2] for x in sorted(trees[n])]) for n in names}
    top = levels([built[n][-1][0] for n in names]) if names else []
    return [
        (key, leaf, built[n][-1][0], top[-1][0], [*path(built[n], i), *path(top, k)])
        for k, n in enumerate(names)
        for i, (_, key, leaf) in enumerate(sorted(trees[n]))
    ]


@pytest.mark.parametrize("fan_out", [2, 3])
def test_manifest_is_the_brute_force_one(spark, fan_out):
    given = [(i % 700, f"t{i}" if i % 9 else None, "a" if i % 3 else "b" if i % 2 else None, i) for i in range(1500)]
    given += [(None, "null key", "a", 1), (3, "same", "c", None), (3, "same", "c", None), (4, "", "", 0), (5, "x", "é", 0)]
    given += [(9, "equal", "hot", 1)] * 300
    table = spark.createDataFrame(given, "doc_id bigint, text string, lang string, node int")
    columns = ["doc_id", "lang", "text"]
    made = manifest.manifest(table, columns, fan_out=fan_out).withColumn("folded", manifest.folded(manifest.F.col("leaf")))
    found = [
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in made.collect()
    ]
    want = brute_manifest(table.collect(), columns, fan_out)
    assert sorted(found, key=str) == sorted(want, key=str)
    assert {r["folded"] for r in made.select("folded").distinct().collect()} == {want[0][3]}


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(1, "x", "a")], "doc_id bigint, text string, lang string")
    r = manifest.manifest(one, ["text"]).first()
    assert r["leaf"] == r["subroot"] == r["root"] == sha("1:x") and r["path"] == []
    assert manifest.manifest(one.limit(0), ["text"]).collect() == []


def test_a_changed_row_is_seen(spark):
    found = QUERIES["op12_merkle_manifest"](spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in found:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and docs[r["doc_id"]]["n_chars"] is not None
        assert r["verified"] == (not changed)


def test_manifest_equals_sql(spark):
    name = "op12_merkle_manifest"
    ours = QUERIES[name](spark, SF).toArrow()
    assert differences(ours, duck(SF).sql(ORACLES[name]).to_arrow_table()) == []


PROSE = "The quick brown fox jumps over the lazy dog while the sun sets over the hills, and nobody sees it."


@pytest.fixture(scope="module")
def extractor():
    return html_extract.trained()


def article_of(page):
    return "\n".join(b.replace(MARK, "") for b in Page(page).blocks if MARK in b)


def test_held_out_pages(extractor):
    pages = labelled_pages(200, seed=99)
    found = extractor.extract([p.replace(MARK, "") for p in pages])
    right = missing = wrong = 0
    for page, text in zip(pages, found):
        want, got = Counter(article_of(page).split("\n")), Counter(text.split("\n"))
        right += sum(len(b) * n for b, n in (want & got).items())
        missing += sum(len(b) * n for b, n in (want - got).items())
        wrong += sum(len(b) * n for b, n in (got - want).items())
    assert 2 * right / (2 * right + missing + wrong) > 0.98
    assert np.mean([article_of(p) == t for p, t in zip(pages, found)]) > 0.85


def test_names_never_seen_in_training():
    known = {k: v.split()[::2] for k, v in NAMES.items()}
    others = {k: v.split()[1::2] for k, v in NAMES.items()}
    model = html_extract.Extractor(labelled_pages(300, 5, known), rounds=25)
    pages = labelled_pages(100, 6, others)
    found = model.extract([p.replace(MARK, "") for p in pages])
    assert np.mean([article_of(p) == t for p, t in zip(pages, found)]) > 0.6


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<nav><a href=/>Home</a> <a href=/b>Blog</a></nav><article><h1>T one</h1><p>{PROSE}<p><b>a&amp;b</b>c<br>d</article>"
         "<footer>&copy; Site</footer>", f"T one\n{PROSE}\na&bc d"),
        (f"<article><h1>T one</h1><p>{PROSE}</p><aside class=ad>Buy this now, it is great!</aside><p>{PROSE}</p>"
         f"<section class=comments><h3>Comments</h3><p>{PROSE}</p></section></article>", f"T one\n{PROSE}\n{PROSE}"),
        (f"<div class='cookie-notice'>We use cookies on this site.</div><div id=content><h2>T one</h2><p>{PROSE}</p></div>"
         f"<div class=sidebar><h3>Popular</h3><p>{PROSE}</p></div>", f"T one\n{PROSE}"),
        ("", ""), ("<script>var t='</p>'", ""), ("<!-- <p>x</p>", ""), ("<p title='>'>" + PROSE, PROSE),
    ],
)
def test_pages_by_hand(extractor, page, text):
    assert extractor.extract([page]) == [text]


def test_every_sample_page_gives_its_article(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = QUERIES["op13_html_extract"](spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search("<article>(.*)</article>", pages[r["page_id"]], re.DOTALL).group(1)
        blocks = re.split("</?(?:p|h1)>", article.replace("<br>", " "))
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert r["text"] == "\n".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


def test_nulls_repeats_and_clashing_columns(spark):
    table = spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (None, f"<p>{PROSE}", "y"), (2, "", None)], "page_id bigint, html string, n_chars string"
    )
    found = rows(html_extract.extract_main_text(table, ["page_id"]))
    assert found == sorted([(1, "", 0), (1, "", 0), (2, "", 0), (None, PROSE, len(PROSE))], key=str)
    assert html_extract.extract_main_text(table.limit(0), ["page_id"]).collect() == []


def test_decoding_is_consistent_and_best():
    page = Page("<div><p>a</p><ul><li>b</li><li>c</li></ul></div><p>d</p>")
    rng = np.random.default_rng(1)
    model = html_extract.Extractor.__new__(html_extract.Extractor)
    n = len(page.tag)
    for _ in range(50):
        chances = np.log(rng.dirichlet(np.ones(3), n))
        kept = html_extract.Extractor.decode(model, page, chances.copy())
        leaf = [page.end[i] == i + 1 for i in range(n)]
        both = np.logaddexp(chances[:, 0], chances[:, 1])
        best = (-np.inf, None)
        for code in range(3**n):
            state = [code // 3**i % 3 for i in range(n)]
            if any(leaf[i] and state[i] == 2 for i in range(n)):
                continue
            if any(i and state[page.parent[i]] != 2 and state[i] != state[page.parent[i]] for i in range(n)):
                continue
            value = sum(chances[i, state[i]] - (both[i] if leaf[i] else 0) for i in range(n))
            best = max(best, (value, [s == 0 for s in state]))
        assert [k and x for k, x in zip(kept, leaf)] == [k and x for k, x in zip(best[1], leaf)]


def test_trees_learn_what_no_single_feature_tells():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int) + (x[:, 2] > 0.8)
    model = BoostedTrees(3, rounds=30).fit(x[:2000], y[:2000])
    assert (model.log_probability(x[2000:]).argmax(1) == y[2000:]).mean() > 0.9


def test_parsing_hostile_pages_is_linear():
    for piece in ("<div>", "<b>", "<a href='x'>t", "<p><b>t", "</b>", "<i></p>", "<table><td>", "<li>x", '<a title="'):
        page = Page(piece * 30_000)
        assert len(page.tag) == len(page.blocks) == len(page.end)
    assert naming_words('class="side-bar mainNav" href="menu"') == ("side", "bar", "main", "nav")
