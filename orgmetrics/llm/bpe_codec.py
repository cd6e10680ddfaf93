"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A byte-pair encoding is the only sequence of tokens in which every token encodes to itself and every
two neighbours do not merge over their border. The encoder therefore takes the longest token at
each place, found by an Aho-Corasick automaton in one pass, checks it against its left neighbour,
and falls back on shorter ones or gives up the neighbour. A place once given up is never tried
again, so the work is linear in the length.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from orgmetrics.llm.batches import LONG, STRING, array_of, per_text

CACHE_WORDS = 400_000  # distinct words a worker remembers before it starts afresh
CACHE_PAIRS = 1_000_000  # the same for pairs of tokens
LONG_WORD = 256  # words of more characters are not remembered
NEVER = 1 << 60

# Letters, numbers and white space up to here are the same in every version of Unicode; text beyond
# is cut into words by the vocabulary's library itself.
SETTLED = 0x500


def _class(test) -> str:
    return "".join(re.escape(chr(c)) for c in range(SETTLED) if test(unicodedata.category(chr(c))))


_LETTER, _NUMBER = _class(lambda c: c[0] == "L"), _class(lambda c: c[0] == "N")
_SPACE = r"\t-\r \x85\xa0"
# Fixed value: the words whose bytes are merged, as the vocabulary's library cuts them.
WORDS = re.compile(
    f" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
UNSETTLED = re.compile(f"[^\\x00-{chr(SETTLED - 1)}]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: its own where it prints."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairCodec:
    """Encodes and decodes as the byte-level model in the vocabulary file at ``path``.

    Raises ValueError for files whose texts would be changed or cut in another way.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, words = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or model["end_of_word_suffix"] or model["continuing_subword_prefix"]:
            raise ValueError("not a plain byte-pair vocabulary")
        if spec["normalizer"] or words.get("type") != "ByteLevel" or words["add_prefix_space"]:
            raise ValueError("the vocabulary changes or cuts texts in another way")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens match in another way")
        letters = byte_letters()
        spelled = {t: bytes(letters[c] for c in t) for t in model["vocab"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        texts = [b""] * size
        for token, i in vocab.items():
            texts[i] = spelled[token]
        for token, i in self.added.items():
            texts[i] = token.encode()
        # Decoding: the bytes of all tokens end to end, and where each begins.
        self.blob = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.offset = np.cumsum([0, *map(len, texts)])
        self.length = [len(t) for t in texts]

        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> left, right, rank of its merge
        for r, (a, b) in enumerate(merges):
            self.parts.setdefault(vocab[a + b], (vocab[a], vocab[b], r))
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self.fits: dict[int, bool] = {}
        # Tokens that do not encode to themselves never occur.
        sound: dict[int, bool] = {}
        for token in sorted(vocab.values(), key=lambda t: self.length[t]):
            if token in self.parts:
                left, right, rank = self.parts[token]
                sound[token] = (
                    sound.get(left, False)
                    and sound.get(right, False)
                    and self._merge_over(left, right, rank) is None
                )
            else:
                sound[token] = self.length[token] == 1
        self.tokens = {texts[t].decode("latin-1"): t for t, good in sound.items() if good}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.tokens.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        # The longest token that begins a token and is shorter.
        self.shorter = {
            i: next((self.tokens[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.tokens), None)
            for t, i in self.tokens.items()
        }
        longest_first = sorted(self.added, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, longest_first))) if self.added else None
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.widest = max(map(len, self.tokens))
        self.words: dict[str, str] = {}  # word -> its ids in decimal
        # Every beginning of a token -> the longest token that begins it.
        self.begins: dict[str, int] = {}
        for token, i in sorted(self.tokens.items()):
            for n in range(1, len(token)):
                self.begins.setdefault(token[:n], self.tokens.get(token[:n]) or -1)
            self.begins[token] = i
        for start in sorted(self.begins, key=len):
            if self.begins[start] < 0:
                self.begins[start] = self.begins[start[:-1]]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one edge of ``token`` from a byte to itself, with the rank that ends each."""
        known = self._left if side == 0 else self._right
        if token not in known:
            parts = self.parts.get(token)
            if parts is None:
                known[token] = [(token, NEVER)]
            else:
                inner = self._edge(parts[side], side)
                known[token] = [*inner[:-1], (inner[-1][0], parts[2]), (token, NEVER)]
        return known[token]

    def _merge_over(self, left: int, right: int, before: int = NEVER) -> int | None:
        """Rank of the first merge over the border of two tokens, if any comes before ``before``.

        Both edges grow as merges are applied by rank. Two tokens that meet at the border merge if
        their pair comes up before either is taken up by its own side. Equal pairs go from the
        left: the left side's own merge wins a tie, the right side's loses it.
        """
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.rank.get((x, y), NEVER)
            if rank < before and rank < x_ends and rank <= y_ends:
                return rank
            if x_ends == NEVER and y_ends == NEVER:
                return None
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side; remembered in the table ``fits``."""
        pair = left << 32 | right
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            known = self.fits[pair] = self._merge_over(left, right) is None
        return known

    def _longest(self, text: str, place: int) -> int:
        """The longest token at a place: as far as the automaton goes, then back to a token."""
        return self.begins[text[place : place + self.automaton.longest_prefix(text[place : place + self.widest])]]

    def encode_word(self, word: bytes) -> list[int]:
        text = word.decode("latin-1")
        whole = self.tokens.get(text)
        if whole is not None:
            return [whole]
        # Longest matches end to end, each checked against the one before.
        matches, fits, found, last = self.automaton.iter_long(text), self.fits, [], -1
        for _, token in matches:
            if last >= 0:
                fit = fits.get(last << 32 | token)
                if not (self.compatible(last, token) if fit is None else fit):
                    return self._backtrack(text, found, token)
            found.append(token)
            last = token
        return found

    def _backtrack(self, text: str, found: list[int], token: int | None) -> list[int]:
        """Goes on after ``found``, whose tokens fit; ``token`` is the longest match there."""
        n, length, shorter, fits = len(text), self.length, self.shorter, self.fits
        place = sum([length[t] for t in found])
        closed = set()  # places from which no tokens reach the end
        while True:
            last = found[-1] if found else -1
            while token is not None:
                if place + length[token] not in closed:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | token)
                    if self.compatible(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token is not None:
                found.append(token)
                place += length[token]
                if place == n:
                    return found
                token = self._longest(text, place)
            else:
                # No token fits here after the last one: that one was too long.
                closed.add(place)
                place -= length[last]
                token = shorter[found.pop()]

    def _cut(self, chunk: str) -> list[str]:
        if UNSETTLED.search(chunk):
            return [chunk[a:b] for _, (a, b) in self.library.pre_tokenize_str(chunk)]
        return WORDS.findall(chunk)

    def _encode_plain(self, text: str) -> str:
        """Ids in decimal of a text without added tokens."""
        words, known = self._cut(text), self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        new = set(words).difference(known)
        for word in new:
            known[word] = ",".join(map(str, self.encode_word(word.encode())))
        ids = ",".join(map(known.__getitem__, words))
        for word in new:
            if len(word) > LONG_WORD:
                del known[word]
        return ids

    def encode(self, text: str) -> str:
        """Ids in decimal, joined by commas."""
        ids, done = [], 0
        for hit in self.specials.finditer(text) if self.specials else ():
            ids += [self._encode_plain(text[done : hit.start()]), str(self.added[hit.group()])]
            done = hit.end()
        return ",".join(filter(None, [*ids, self._encode_plain(text[done:])]))

    def decode(self, ids: np.ndarray, step: int = 1 << 18) -> bytes:
        """The bytes of the tokens: one gather per ``step`` tokens from the table of offsets."""
        out = []
        for a in range(0, len(ids), step):
            part = ids[a : a + step]
            begin, lengths = self.offset[part], self.offset[part + 1] - self.offset[part]
            shift = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)
            out.append(self.blob[shift + np.arange(len(shift))].tobytes())
        return b"".join(out)


def ids_of(decimal: str) -> np.ndarray:
    return np.fromstring(decimal, dtype=np.int32, sep=",") if decimal else np.zeros(0, np.int32)


@lru_cache(maxsize=2)
def _codec(path: str) -> BytePairCodec:
    return BytePairCodec(path)


def encode_texts(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (array of ints) of every whole text.

    Row-local. A null text counts as empty and has no ids; repeated rows and null keys are kept.
    """

    def make():
        codec = _codec(path)

        def work(texts: list[str]) -> list[tuple]:
            coded = [ids_of(codec.encode(t)) for t in texts]
            return [(len(c), c) for c in coded]

        return work

    ids = array_of((T.IntegerType(), pa.int32()))
    return per_text(docs, [key], text, {"n_tokens": LONG, "ids": ids}, make)


def decode_ids(coded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` of every array of ids; bytes that are no UTF-8 are replaced.

    Null ids give an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            coded = [np.array(x.as_py() or [], dtype=np.int64) for x in batch.column(1)]
            texts = [codec.decode(x).decode("utf-8", "replace") for x in coded]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    rows = coded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    schema = T.StructType(
        [T.StructField("key", coded.schema[key].dataType), T.StructField("text", T.StringType())]
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens``, and digests of the ids and of the text decoded from them.

    Both directions in one pass, so that the ids of a large table need not be stored to be checked.
    Nulls and repeated rows as in ``encode_texts``.
    """

    def make():
        codec = _codec(path)

        def one(text: str) -> tuple[int, str, str]:
            decimal = codec.encode(text)
            ids = ids_of(decimal)
            decoded = codec.decode(ids).decode("utf-8", "replace").encode()
            return (
                len(ids),
                hashlib.sha256(decimal.encode()).hexdigest(),
                hashlib.sha256(decoded).hexdigest(),
            )

        return lambda texts: [one(t) for t in texts]

    added = {"n_tokens": LONG, "ids_sha256": STRING, "decoded_sha256": STRING}
    return per_text(docs, [key], text, added, make)
