"""Token counts, byte-pair codec and packing against the tokenizers' own libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orgmetrics.llm import bpe_codec, packing, token_counts
from tests.conftest import rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", " ", "  ", "a", " a  b ", "\n\n x\n", "ab" * 400, "a" * 3000, " " * 77, "中文字" * 200, "<s></s><unk>",
    "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "\x00\x1c\x1f\x85\xa0　", "İΣΑς ΟΔΟΣ", "é́ é",
    "it's we'll I'M 'S", "12 345,6 ٣ Ⅷ ½", "😀😀‍👩", "▁▁a ▁", "\U000114df\U0001e33a", "-" * 300, "x\r\n\r\ny",
]


def strange(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    bits = [*"aabbtthe  \n\t\x1c\x85▁éßÉİΣΑ中文ｶ😀́'12x٣_-=", "the", "ing", "'ll", "    ", "<|endoftext|>", "\r\n"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def pieces():
    return token_counts.PieceCounter(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.BytePairCodec(BYTES), Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def words():
    return packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)


def test_counts_are_the_librarys(pieces):
    ours, library = pieces
    texts = ODD + strange(3000)
    assert ours.count(texts) == [len(x) for x in library.encode(texts)]


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text_is_counted(pieces, text):
    ours, library = pieces
    assert ours.count([text]) == [len(library.encode(text))]


def test_counts_survive_a_full_cache(pieces, monkeypatch):
    ours, library = pieces
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 50)
    for part in (strange(60, 3), strange(60, 4)):
        assert ours.count(part) == [len(x) for x in library.encode(part)]


def test_encoding_is_the_librarys_and_decodes(codec):
    ours, library = codec
    for text in ODD + strange(3000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ",".join(map(str, ids))
        decoded = ours.decode(np.array(ids, dtype=np.int64)).decode("utf-8", "replace")
        assert decoded == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text_is_encoded(codec, text):
    ours, library = codec
    assert list(bpe_codec.ids_of(ours.encode(text))) == library.encode(text, add_special_tokens=False).ids


def test_decoding_broken_bytes(codec):
    ours, library = codec
    ids = library.encode("é中").ids[:1] + [5, 172]
    assert ours.decode(np.array(ids)).decode("utf-8", "replace") == library.decode(ids)


def test_neighbours_fit_or_merge(codec):
    """The pair table against merging from scratch."""
    ours, library = codec
    rng = random.Random(5)
    plain = [t for t in ours.tokens.values() if ours.length[t] < 6]
    for _ in range(2000):
        a, b = rng.choice(plain), rng.choice(plain)
        text = ours.decode(np.array([a, b]))
        assert ours.compatible(a, b) == (merged(ours, text) == [a, b])


def merged(codec, data: bytes) -> list[int]:
    """Byte pairs merged one at a time, the lowest rank and then the leftmost first."""
    single = {codec.decode(np.array([t])): t for t in codec.tokens.values() if codec.length[t] == 1}
    whole = {ab: t for t, (a, b, _) in codec.parts.items() for ab in [(a, b)]}
    ids = [single[bytes([x])] for x in data]
    while True:
        ranks = [(codec.rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in codec.rank]
        if not ranks:
            return ids
        _, i = min(ranks)
        ids[i : i + 2] = [whole[ids[i], ids[i + 1]]]


def test_word_ids_are_the_librarys(words):
    ours, library = words
    texts = ODD + strange(3000)
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(np.frombuffer(x, dtype="<u4")) for x in ours.encode(texts)] == expected


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text_has_the_librarys_word_ids(words, text):
    ours, library = words
    found = list(np.frombuffer(ours.encode([text])[0], dtype="<u4"))
    assert found == library.encode(text, add_special_tokens=False).ids


def table(spark, texts):
    """Documents with a null id, a null text, repeated rows and columns whose names might clash."""
    given = [(i, t, "x", 1) for i, t in enumerate(texts)]
    given += [(None, "a b", "x", 1), (10**17 + 1, None, "y", 2), (3, texts[3], "x", 1)]
    return spark.createDataFrame(given, "doc_id bigint, text string, key string, n_tokens int")


def test_token_counts_of_a_table(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_counts.token_counts(table(spark, ODD), PIECES, limit=100)
    expected = []
    for r in table(spark, ODD).collect():
        text = r["text"] or ""
        n = len(library.encode(text))
        expected.append((r["doc_id"], len(text.encode()), n, n > 100))
    assert rows(found) == sorted(expected, key=str)
    assert rows(token_counts.token_counts(table(spark, ODD).limit(0), PIECES)) == []


def test_codec_of_a_table(spark):
    library = Tokenizer.from_file(BYTES)
    docs = table(spark, ODD)
    expected = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        expected.append((r["doc_id"], len(ids), digest, text))
    assert rows(bpe_codec.round_trip(docs, BYTES)) == sorted(expected, key=str)
    coded = bpe_codec.encode_texts(docs, BYTES)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert rows(bpe_codec.decode_ids(coded, BYTES)) == sorted(texts, key=str)
    assert rows(bpe_codec.round_trip(docs.limit(0), BYTES)) == []


def check_packing(found, docs, size, end):
    """Every piece once, with the library's ids; sequences full of pieces without gaps."""
    library = Tokenizer.from_file(WORDS)
    expected = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [end]
        for piece, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], dtype="<u4")
            expected.append((r["doc_id"], piece, at, len(part), zlib.crc32(part.tobytes())))
    given = [tuple(r)[:5] for r in found]
    assert sorted(given, key=str) == sorted(expected, key=str)
    sequences: dict[int, list] = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return sequences


def test_packing_a_table(spark):
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice(["the", "dog", "x7", "und"]) for _ in range(rng.randint(1, 300))) for _ in range(300)]
    docs = table(spark, texts)
    found = packing.pack(docs, WORDS, size=128, end=1).collect()
    sequences = check_packing(found, docs, 128, 1)
    total = sum(r["length"] for r in found)
    assert len(sequences) <= -(-total // 128) + 1
    assert packing.pack(docs.limit(0), WORDS).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plans_use_every_piece_once(counts):
    plan = packing.plan_packing(counts, 40)
    used: dict[int, int] = {}
    for pattern in plan:
        assert pattern.times > 0 and sum(pattern.lengths) <= 40
        for x in pattern.lengths:
            used[x] = used.get(x, 0) + pattern.times
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    assert sum(p.times for p in plan) <= max(1, 2 * -(-total // 40))


def test_complements_of_one_two_and_three():
    for counts in ({30: 5, 10: 5}, {20: 4, 13: 4, 7: 4}, {17: 3, 11: 3, 8: 3, 4: 3}, {10: 8}):
        plan = packing.plan_packing(counts, 40)
        assert all(sum(p.lengths) == 40 for p in plan)
