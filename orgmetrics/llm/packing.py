"""Best-fit packing with exact complements.

Documents are cut into pieces of at most the sequence length, and only the number of pieces of each
length is planned on the driver: a table no longer than the sequence. The plan takes each length
with pieces left, longest first, and looks its gap up among the single lengths, the sums of two and
the sums of three that are still available; a hit fills sequences to the last token, as many at once
as the pieces allow. What finds no complement goes best-fit. The plan becomes ranges of ranks per
length, and every piece finds its sequence by its own rank.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from orgmetrics.llm.batches import SharedFolder, text_slices

CACHE_PARTS = 150_000  # distinct parts a worker remembers before it drops those not in use
BATCH = 10_000  # parts given to the library at a time
LONG_PART = 256  # parts of more characters are not remembered
SLICE = 1 << 20  # characters of text whose parts a task holds at a time
# Characters that are composed, whose lower case is settled, and that no version of Unicode moves.
_PLAIN = re.compile("[^\x00-\u02ff]")


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x300) if unicodedata.category(chr(c))[0] == kind)


_SPACE, _LETTER, _NUMBER = r"\t-\r \x85\xa0", _class("L"), _class("N")
# Fixed value: how the tokenizer cuts plain characters in lower case before it merges.
_PARTS = re.compile(
    f"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
)
_WORDS = regex.compile(r"\P{White_Space}+")
WHOLE = "\n"  # leads words that are left to the library; no part has a line end


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops white space and never reaches over it.

    A text is cut into runs of letters, digits and signs as the tokenizer does, and each distinct
    part is given to the library once. Words beyond plain characters are left to it as a whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        end, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        # Tokens that end a word: they tell the words of a joined text apart.
        self.ends = np.zeros(self.library.get_vocab_size() + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if end and t.endswith(end)]] = True
        # The same merges alone, for parts that are composed, in lower case and cut already.
        self.merger = Tokenizer.from_file(path)
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.parts: dict[str, bytes] = {}
        probe = "Tail  of a “word”,\nİt's 12é!! x-y"
        if self.encode([probe])[0] != self._whole(probe):
            raise ValueError("the tokenizer cuts texts in another way")

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_parts(self, parts: list[str]) -> None:
        texts = [" ".join(parts[a : a + BATCH]) for a in range(0, len(parts), BATCH)]
        coded = (self.merger.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in texts)
        ids = np.concatenate([np.array(c, dtype="<u4") for c in coded])
        edge = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        if len(edge) != len(parts) + 1:
            raise ValueError("the tokenizer cuts words in another way")
        raw = ids.tobytes()
        self.parts.update((p, raw[a:b]) for p, a, b in zip(parts, edge, edge[1:]))

    def _cut(self, text: str) -> list[str]:
        if not _PLAIN.search(text) and not self.added.search(text):
            return _PARTS.findall(text.lower())
        parts = []
        for word in _WORDS.findall(text):
            if _PLAIN.search(word) or self.added.search(word):
                parts.append(WHOLE + word)
            else:
                parts += _PARTS.findall(word.lower())
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [self._cut(t) for t in texts]
        used = set().union(*cut)
        new = used.difference(self.parts)
        if len(self.parts) + len(new) > CACHE_PARTS:
            # Only what these texts use stays: the frequent parts are among it.
            self.parts = {p: self.parts[p] for p in used.difference(new)}
        whole = [p for p in new if p.startswith(WHOLE)]
        self.parts.update((p, self._whole(p[1:])) for p in whole)
        plain = list(new.difference(whole))
        if plain:
            self._learn_parts(plain)
        coded = [b"".join(map(self.parts.__getitem__, parts)) for parts in cut]
        for part in new:
            if len(part) > LONG_PART:
                del self.parts[part]
        return coded


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cut_into_pieces(
    docs: DataFrame, path: str, size: int, end: int, text: str, key: str
) -> DataFrame:
    """``key, piece, start, length, ids_crc32``: every text's ids and the id ``end`` in pieces.

    ``part`` is the task and ``seat`` the rank of a piece among those of its length in that task.
    """

    names = ("piece", "start", "length", "ids_crc32", "part", "seat")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, last = _tokenizer(path), np.array([end], dtype="<u4").tobytes()
        context = TaskContext.get()
        task, seats = context.partitionId() if context else 0, Counter()
        for batch in batches:
            texts, rows, of = [t or "" for t in batch.column(1).to_pylist()], [], []
            for a, b in text_slices(texts, SLICE):
                for i, ids in enumerate(tokenizer.encode(texts[a:b]), a):
                    ids += last
                    for piece, at in enumerate(range(0, len(ids), 4 * size)):
                        part = ids[at : at + 4 * size]
                        length = len(part) // 4
                        rows.append((piece, at // 4, length, zlib.crc32(part), task, seats[length]))
                        seats[length] += 1
                        of.append(i)
            keys = batch.column(0).take(pa.array(of, type=pa.int64()))
            columns = np.array(rows, dtype=np.int64).reshape(-1, len(names)).T
            arrays = [pa.array(c, type=pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([keys, *arrays], ["key", *names])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in names)]
    )
    return rows.mapInArrow(run, schema)


@dataclass
class Pattern:
    """``times`` sequences that hold pieces of these lengths in this order."""

    lengths: tuple[int, ...]
    times: int


class Available:
    """Pieces left of each length, with bit sets of the lengths that are left.

    ``mask`` has bit x for length x, ``mirror`` bit size - x: shifted onto each other they show all
    pairs of lengths with a given sum at once.
    """

    def __init__(self, counts: dict[int, int], size: int):
        self.size, self.left = size, [0] * (size + 1)
        self.mask = self.mirror = 0
        for length, n in counts.items():
            self.put(length, n)

    def put(self, length: int, n: int) -> None:
        """Add ``n`` pieces, or take them if negative."""
        self.left[length] += n
        bit, mirrored = 1 << length, 1 << (self.size - length)
        if self.left[length]:
            self.mask |= bit
            self.mirror |= mirrored
        else:
            self.mask &= ~bit
            self.mirror &= ~mirrored

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two lengths with this sum, the most unequal ones."""
        found = self.mask & (self.mirror >> (self.size - total))
        while found:
            a = found.bit_length() - 1
            if 2 * a != total or self.left[a] > 1:
                return a, total - a
            found ^= 1 << a
        return None

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths with this sum, the longest first."""
        if self.left[gap]:
            return (gap,)
        two = self.pair(gap)
        if two:
            return two
        firsts = self.mask & ((1 << gap) - 1)
        while firsts:
            first = firsts.bit_length() - 1
            firsts ^= 1 << first
            # No pair can hold two of a length of which only one is left beside the first.
            two = self.pair(gap - first)
            if two and first in two:
                self.put(first, -1)
                two = self.pair(gap - first)
                self.put(first, 1)
            if two:
                return (first, *two)
        return None


def plan_packing(counts: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that use up all pieces, given the number of pieces of each length."""
    pieces = Available(counts, size)
    plan = []
    if pieces.left[size]:
        plan.append(Pattern((size,), pieces.left[size]))
        pieces.put(size, -pieces.left[size])
    for length in range(size - 1, 0, -1):
        while pieces.left[length]:
            pieces.put(length, -1)
            found = pieces.complement(size - length)
            pieces.put(length, 1)
            if found is None:
                break
            lengths = (length, *found)
            times = min(pieces.left[x] // lengths.count(x) for x in set(lengths))
            for x in lengths:
                pieces.put(x, -times)
            plan.append(Pattern(lengths, times))
    return plan + _best_fit(pieces.left, size)


def _best_fit(left: list[int], size: int) -> list[Pattern]:
    """Longest first, each piece into the open sequence with the least room that takes it."""
    open_by_room: list[list[Pattern]] = [[] for _ in range(size + 1)]
    for length in range(size, 0, -1):
        n, room = left[length], length
        while n and room <= size:
            if not open_by_room[room]:
                room += 1
                continue
            pattern = open_by_room[room].pop()
            fit = min(room // length, n)
            times = min(pattern.times, n // fit)
            if times < pattern.times:
                open_by_room[room].append(Pattern(pattern.lengths, pattern.times - times))
            filled_up = Pattern(pattern.lengths + (length,) * fit, times)
            open_by_room[room - fit * length].append(filled_up)
            n -= fit * times
            room = length
        if n:
            fit = size // length
            for per, times in ((fit, n // fit), (n % fit, 1)):
                if per and times:
                    open_by_room[size - per * length].append(Pattern((length,) * per, times))
    return [p for patterns in open_by_room for p in patterns]


@dataclass(frozen=True)
class Ranges:
    """For each length: where its ranks go on to the next place, and the first sequence there."""

    places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(plan: list[Pattern]) -> Ranges:
        taken: dict[int, int] = {}
        places: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for pattern in plan:
            offset = 0
            for length in pattern.lengths:
                rank = taken.get(length, 0)
                places.setdefault(length, []).append((rank, first, offset))
                taken[length] = rank + pattern.times
                offset += length
            first += pattern.times
        return Ranges(
            {x: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for x, rows in places.items()}
        )

    def find(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces of one length, by their rank from 0."""
        start, first, offset = self.places[length]
        at = np.searchsorted(start, ranks, side="right") - 1
        return first[at] + ranks - start[at], offset[at]


def pack(
    docs: DataFrame,
    path: str,
    size: int = 4096,
    end: int = 1,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every text.

    Texts longer than ``size`` tokens are cut into pieces of that length, and the last may be
    shorter; no other text is cut. Pieces lie in their sequence without gaps. A null text counts as
    empty and is packed as its end token alone; repeated rows and null keys are packed one by
    one. An empty table gives no rows.

    The pieces, without text or ids, are written once to the shared folder. Their rank within a
    length is the rank within the task that cut them and the number of pieces of earlier tasks, so
    no task ever gathers a length; the driver sees one number per length.
    """
    folder = SharedFolder(docs, "packing")
    pieces = folder.table(cut_into_pieces(docs, path, size, end, text, key), "pieces")
    # One row per length: at most ``size`` of them.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges = Ranges.of(plan_packing(counts, size))

    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("seat") + F.col("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(n).to_numpy() for n in ("length", "rank"))
            sequence, offset = np.zeros_like(ranks), np.zeros_like(ranks)
            for length in np.unique(lengths):
                at = lengths == length
                sequence[at], offset[at] = ranges.find(int(length), ranks[at])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], placed_schema.names
            )

    columns = ["key", "piece", "start", "length", "ids_crc32"]
    placed_schema = T.StructType([pieces.schema[c] for c in columns])
    placed_schema = placed_schema.add("sequence_id", T.LongType()).add("offset", T.LongType())
    placed = ranked.select(*columns, "rank").mapInArrow(place, placed_schema)
    return placed.select(F.col("key").alias(key), F.col("piece").cast("int").alias("piece"), *placed_schema.names[2:])
