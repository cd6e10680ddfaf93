"""Alignment of the tokens of two tokenizers by galloping intersection of their ends.

Both tokenizers cut the bytes of one text. Where a token of each ends at the same byte, all tokens
since the last such place form a group. The shorter list of ends drives an exponential and then a
binary search into the longer one; the places found slice the groups, and ranks of starts and ends
tell which tokens overlap.

Tokens that end together have one common suffix, so one is a suffix of the other: the pairs that can
ever be linked are the suffixes of both vocabularies, and counts of pairs over a whole corpus are an
array of that length, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgmetrics.llm.batches import LONG, STRING, SharedFolder, array_of, per_slice
from orgmetrics.llm.bpe_codec import BytePairCodec

SLICE_BYTES = 1 << 19  # of texts that are aligned at a time; a longer text is alone
CACHE_WORDS = 200_000  # distinct words a worker remembers before it starts afresh
CACHE_PAIRS = 200_000  # the same for pairs of tokens
LONG_WORD = 256  # words of more characters are not remembered
SINGLE_SPACE = re.compile("(?<=[^ ]) (?=[^ ])")
INTS = array_of((T.IntegerType(), pa.int32()))


class Table:
    """Tokens of a vocabulary: their bytes end to end, and where each begins."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.blob = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.offset = np.cumsum([0, *map(len, spelled)])

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.offset[ids + 1] - self.offset[ids]

    def bytes_of(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        shift = np.repeat(self.offset[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.blob[shift + np.arange(len(shift))]


class Words:
    """Ids of texts from the ids of their words, each word encoded once while it is remembered."""

    def __init__(self, cut: Callable[[str], list[str]], encode: Callable[[list[str]], Iterable[list[int]]]):
        self.cut, self.encode = cut, encode
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.cut(t) if t else [] for t in texts]
        new = list(set().union(*split).difference(self.known))
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list(set().union(*split))
        self.known.update((w, array("i", i).tobytes()) for w, i in zip(new, self.encode(new)))
        found = [np.frombuffer(b"".join(map(self.known.__getitem__, w)), np.int32).astype(np.int64) for w in split]
        for word in new:
            if len(word) > LONG_WORD:
                del self.known[word]
        return found


class PieceEncoder:
    """Ids of whole texts as a sentencepiece model gives them; words are cached where that is exact.

    It is where the model keeps texts as they are and no piece reaches from a word over a space.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.table = Table(
            [
                bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        usual = [
            p
            for i, p in enumerate(pieces)
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
        ]
        probe = " ﬁ  é\tÅ x"
        exact = self.model.decode(self.model.encode(probe)) == probe and not any(
            "▁" in p.lstrip("▁") or (p.startswith("▁▁") and p.strip("▁")) for p in usual
        )
        # Runs of spaces merge among themselves and stay with the words around them.
        cut = (lambda t: SINGLE_SPACE.split(t.replace("▁", " "))) if exact else (lambda t: [t])
        self.words = Words(cut, lambda new: self.model.encode(new, num_threads=1))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.words.ids(texts)


def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For every value of ``short`` the number of values of ``long`` below it; both ascend.

    All values search at once. From its guess each doubles its step until the value is bracketed,
    then halves the bracket.
    """
    n = len(long)
    padded = np.r_[long, np.iinfo(np.int64).max]
    guess = np.clip(guess, 0, n)
    below = np.zeros(len(short), dtype=np.int64)  # all values before this place are smaller
    above = np.full(len(short), n, dtype=np.int64)  # the value here, if any, is not smaller
    for way in (1, -1):
        # To the right of the guess while values there are smaller, else to its left.
        todo = np.flatnonzero((padded[guess] < short) == (way > 0))
        at, step = guess[todo], 0
        while len(todo):
            at = np.clip(at + way * step, 0, n)
            less = padded[at] < short[todo]
            below[todo[less]] = at[less] + 1
            above[todo[~less]] = at[~less]
            more = less if way > 0 else ~less & (at > 0)
            todo, at, step = todo[more], at[more], max(1, 2 * step)
    while True:
        open_ = np.flatnonzero(below < above)
        if not len(open_):
            return below
        middle = (below[open_] + above[open_]) // 2
        less = long[middle] < short[open_]
        below[open_[less]] = middle[less] + 1
        above[open_[~less]] = middle[~less]


def common(a: np.ndarray, b: np.ndarray, guess_a: np.ndarray, guess_b: np.ndarray) -> tuple:
    """Places in ``a`` and in ``b`` of the values that both have; the shorter one is searched for."""
    if len(a) > len(b):
        in_b, in_a = common(b, a, guess_b, guess_a)
        return in_a, in_b
    place = gallop(a, b, guess_a)
    hit = np.flatnonzero(place < len(b))
    hit = hit[b[place[hit]] == a[hit]]
    return hit, place[hit]


class WordCodec(BytePairCodec):
    """The byte-level codec, one word at a time; strings of added tokens are plain text."""

    def cut(self, text: str) -> list[str]:
        return self._cut(text)

    def encode_words(self, words: list[str]) -> Iterator[list[int]]:
        return (self.encode_word(w.encode()) for w in words)


class Aligner:
    """Two tokenizers of the same bytes, and the pairs of tokens that can end together."""

    def __init__(self, path_a: str, path_b: str):
        self.codec = WordCodec(path_a)
        self.words = Words(self.codec.cut, self.codec.encode_words)
        offset, blob = self.codec.offset, self.codec.blob.tobytes()
        self.a = Table([blob[x:y] for x, y in zip(offset, offset[1:])])
        self.pieces = PieceEncoder(path_b)
        self.b = self.pieces.table
        of_a, of_b = _by_bytes(self.a.spelled), _by_bytes(self.b.spelled)
        self.size_b = len(self.b.spelled)
        pairs = {
            i * self.size_b + j
            for i, s in enumerate(self.a.spelled)
            for n in range(len(s))
            for j in of_b.get(s[n:], ())
        }
        pairs.update(
            i * self.size_b + j
            for j, s in enumerate(self.b.spelled)
            for n in range(len(s))
            for i in of_a.get(s[n:], ())
        )
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        # Ids in decimal with what follows them in a group's text.
        decimal = [str(i) for i in range(max(len(self.a.spelled), self.size_b))]
        self.written = [d + end for end in ",|;" for d in decimal]
        self.decimals = len(decimal)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers per text; none where a text's bytes do not come back."""
        if len(self.codec.fits) > CACHE_PAIRS:
            self.codec.fits.clear()
        ids_a = self.words.ids([" " + t if t else "" for t in texts])
        ids_b = self.pieces.encode(texts)
        none = np.zeros(0, dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                whole = np.frombuffer((" " + text).encode(), dtype=np.uint8)
                if not (_spells(self.a, ids_a[i], whole) and _spells(self.b, ids_b[i], whole)):
                    ids_a[i] = ids_b[i] = none
        return ids_a, ids_b

    def align(self, texts: list[str]) -> list[dict]:
        """Per text: ids ``a`` and ``b``; ``ends_a``, ``ends_b``: tokens up to the end of each group."""
        ids_a, ids_b = self.tokens(texts)
        all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
        # One list of ends over all texts: a text's bytes follow those of the one before.
        ends_a, ends_b = np.cumsum(self.a.lengths(all_a)), np.cumsum(self.b.lengths(all_b))
        many_a, many_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
        first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        hit_a, hit_b = common(
            ends_a, ends_b, _guess(many_a, first_a, many_b, first_b), _guess(many_b, first_b, many_a, first_a)
        )
        cuts = np.searchsorted(hit_a, np.r_[first_a, len(all_a)])
        return [
            {"a": a, "b": b, "ends_a": hit_a[x:y] - fa + 1, "ends_b": hit_b[x:y] - fb + 1}
            for a, b, x, y, fa, fb in zip(ids_a, ids_b, cuts, cuts[1:], first_a, first_b)
        ]

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of pairs of ids among all pairs that can end together."""
        return np.searchsorted(self.pairs, a * self.size_b + b)

    def group_text(self, found: dict) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of every group, in order."""
        if not len(found["a"]):
            return ""
        code_a, code_b = found["a"].copy(), found["b"].copy()
        code_a[found["ends_a"] - 1] += self.decimals
        code_b[found["ends_b"] - 1] += 2 * self.decimals
        # A group's first tokens stand after all tokens of the groups before.
        sizes_a = np.diff(found["ends_a"], prepend=0)
        sizes_b = np.diff(found["ends_b"], prepend=0)
        out = np.empty(len(code_a) + len(code_b), dtype=np.int64)
        out[np.arange(len(code_a)) + np.repeat(found["ends_b"] - sizes_b, sizes_a)] = code_a
        out[np.arange(len(code_b)) + np.repeat(found["ends_a"], sizes_b)] = code_b
        return "".join(map(self.written.__getitem__, out.tolist()))[:-1]


def _by_bytes(spelled: list[bytes]) -> dict[bytes, list[int]]:
    found: dict[bytes, list[int]] = {}
    for i, s in enumerate(spelled):
        if s:
            found.setdefault(s, []).append(i)
    return found


def _spells(table: Table, ids: np.ndarray, whole: np.ndarray) -> bool:
    lengths = table.lengths(ids)
    return int(lengths.sum()) == len(whole) and bool((table.bytes_of(ids, lengths) == whole).all())


def _guess(many: np.ndarray, first: np.ndarray, other_many: np.ndarray, other_first: np.ndarray) -> np.ndarray:
    """For each token the place in the other list of the same share of its text."""
    share = other_many / np.maximum(many, 1)
    place = np.arange(many.sum()) - np.repeat(first, many)
    return (np.repeat(other_first, many) + place * np.repeat(share, many)).astype(np.int64)


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _aligned(docs: DataFrame, path_a: str, path_b: str, text: str, key: str, added: dict, row: Callable) -> DataFrame:
    def make():
        aligner = _aligner(path_a, path_b)
        return lambda texts: [row(aligner, found) for found in aligner.align(texts)]

    return per_slice(docs, [key], text, added, make, SLICE_BYTES)


def overlaps(found: dict, aligner: Aligner) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of B that shares a byte with each token of A."""
    ends_a, ends_b = np.cumsum(aligner.a.lengths(found["a"])), np.cumsum(aligner.b.lengths(found["b"]))
    starts = np.r_[0, ends_a[:-1]] if len(ends_a) else ends_a
    shape = np.array([len(ends_a)]), np.zeros(1, int), np.array([len(ends_b)]), np.zeros(1, int)
    guess = _guess(*shape)
    return gallop(starts + 1, ends_b, guess), gallop(ends_a, ends_b, guess)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ids ``a`` and ``b``, and the alignment of every text.

    ``group_a`` and ``group_b`` count the tokens of each group; ``b_first`` and ``b_last`` are the
    tokens of B, from 0, that share bytes with each token of A. A null or empty text, and one that
    either tokenizer does not give back byte by byte behind a space, has no tokens. Row-local;
    repeated rows and null keys are kept, other columns ignored.
    """

    def row(aligner: Aligner, found: dict) -> tuple:
        groups = [np.diff(found[c], prepend=0) for c in ("ends_a", "ends_b")]
        return tuple(x.astype(np.int32) for x in (found["a"], found["b"], *groups, *overlaps(found, aligner)))

    names = ("a", "b", "group_a", "group_b", "b_first", "b_last")
    return _aligned(docs, path_a, path_b, text, key, {n: INTS for n in names}, row)


def link_counts(links: DataFrame) -> DataFrame:
    """(slot, n) of every pair of ids that is linked anywhere, from a table of ``slots``."""
    return links.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))


def alignment_report(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A link is a token of A and one of B that end together; its count is the number of links of the
    same two ids in all rows. ``n_best`` links have the highest count of their B id, ties included;
    ``count_sum`` adds the counts of a row's links. Texts are tokenized once: rows with the places of
    their pairs are written to the shared folder, and read again when all pairs are counted. Only
    the counts, one number per pair that the two vocabularies allow, go through the driver. Rows
    without tokens (see ``align_tokens``) have zeros and an empty ``groups_sha256``.
    """

    def row(aligner: Aligner, found: dict) -> tuple:
        a, b = found["a"], found["b"]
        slots = aligner.slots(a[found["ends_a"] - 1], b[found["ends_b"] - 1])
        written = aligner.group_text(found)
        digest = hashlib.sha256(written.encode()).hexdigest() if written else ""
        return len(a), len(b), len(found["ends_a"]), digest, slots.astype(np.int32)

    added = {"n_a": LONG, "n_b": LONG, "n_groups": LONG, "groups_sha256": STRING, "slots": INTS}
    folder = SharedFolder(docs, "alignment")
    links = folder.table(_aligned(docs, path_a, path_b, text, key, added, row), "links")
    counted = link_counts(links).toArrow()  # at most a row per pair of the vocabularies
    aligner = _aligner(path_a, path_b)
    count = np.zeros(len(aligner.pairs), dtype=np.int64)
    count[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    most = np.zeros(aligner.size_b, dtype=np.int64)
    of_b = aligner.pairs % aligner.size_b
    np.maximum.at(most, of_b, count)
    shared = docs.sparkSession.sparkContext.broadcast((count, count == most[of_b]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shared.value
        for batch in batches:
            slots = batch.column(batch.num_columns - 1)
            flat, many = slots.flatten().to_numpy(), slots.value_lengths().to_numpy()
            at = np.r_[0, np.cumsum(many)]
            sums = [np.r_[0, np.cumsum(x[flat])] for x in (best.astype(np.int64), count)]
            added = [pa.array(s[at[1:]] - s[at[:-1]], pa.int64()) for s in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [f"c{i}" for i in range(7)])

    kept = ["n_a", "n_b", "n_groups", "groups_sha256"]
    rows = links.select(F.col(key).alias("c0"), *(F.col(c).alias(f"c{i + 1}") for i, c in enumerate(kept)), "slots")
    kinds = [docs.schema[key].dataType, *[T.LongType()] * 3, T.StringType(), T.LongType(), T.LongType()]
    schema = T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)])
    scored = rows.mapInArrow(score, schema).toDF(key, *kept, "n_best", "count_sum")
    return scored.select(
        key, "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )
