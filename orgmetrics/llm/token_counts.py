"""Token counts of a byte-pair piece model by rank-synchronous array merging.

The words of a batch are cut into symbols that lie in one flat array. In each round every word
applies its own pair of the lowest rank, all words at once; words without a pair left drop out and
the symbols they kept are their tokens. Each distinct word of a batch is merged once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmetrics.llm.batches import LONG, per_text

SPACE = "▁"  # how piece models write a space
CACHE_WORDS = 300_000  # distinct words a worker remembers before it starts afresh
LONG_WORD = 256  # words of more characters are not remembered
NO_RANK = np.int64(1) << 60


class PieceCounter:
    """Counts the tokens of texts as the piece model at ``path`` does, without extra tokens.

    Expects a model that keeps texts as they are but for a leading space, merges within words,
    and merges runs of spaces last; raises ValueError for any other.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [
            i
            for i in range(size)
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        ]
        ids = sorted(set(range(size)) - set(special))
        score = {model.id_to_piece(i): model.get_score(i) for i in ids}
        runs = {p: s for p, s in score.items() if len(p) > 1 and not p.strip(SPACE)}
        words = {p: s for p, s in score.items() if p not in runs}
        if any(SPACE in p[1:] for p in words):
            raise ValueError("pieces reach over words")
        self.longest_run = max(map(len, runs), default=1)
        self.run_tokens = [_space_tokens(n, set(map(len, runs))) for n in range(2 * self.longest_run)]
        if len(set(runs.values())) > 1 or any(
            self.run_tokens[n] != 1 + self.run_tokens[n - self.longest_run]
            for n in range(self.longest_run, 2 * self.longest_run)
        ):
            raise ValueError("runs of spaces are not merged from the left")
        if runs and max(runs.values()) >= min(s for p, s in words.items() if len(p) > 1):
            raise ValueError("runs of spaces are not merged last")
        probe = " ﬁ  é\tÅ x"
        if model.decode(model.encode(probe)) != probe or not any(
            model.is_byte(i) for i in range(size)
        ):
            raise ValueError("the model changes texts")

        # Symbols: pieces, and single characters that occur only inside pieces.
        letters = {c for p in words for c in p} - set(words)
        symbols = [*words, *sorted(letters)]
        self.number = {p: i for i, p in enumerate(symbols)}
        self.width = len(symbols) + 1  # one more for characters in no piece
        ranks = {s: r for r, s in enumerate(sorted(set(words.values()), reverse=True))}
        rank = np.array([ranks[s] for s in words.values()], dtype=np.int64)
        # A character that is no piece costs its bytes.
        self.known = np.zeros(self.width, dtype=bool)
        self.known[: len(words)] = True
        keys, merged, early = [], [], np.zeros(self.width, dtype=bool)
        for piece in words:
            new = self.number[piece]
            for cut in range(1, len(piece)):
                left, right = self.number.get(piece[:cut]), self.number.get(piece[cut:])
                if left is None or right is None:
                    continue
                keys.append(left * self.width + right)
                merged.append(new)
                # Parts ranked after the whole: merging one can bring up a pair of a lower rank.
                for part in (left, right):
                    if part < len(words) and len(symbols[part]) > 1 and rank[new] <= rank[part]:
                        early[part] = True
        self.pairs = PairTable(np.array(keys, dtype=np.int64), np.array(merged, dtype=np.int32))
        self.rank = np.r_[rank, NO_RANK]  # the last for no piece: -1
        self.early = early
        self.counts: dict[str, int] = {}
        self.bare: set[str] = set()  # words that keep their space as a token of its own

    def count(self, texts: list[str]) -> list[int]:
        split = [t.replace(SPACE, " ").split(" ") if t else [] for t in texts]
        new = {w for words in split for w in words if w not in self.counts} - {""}
        if len(self.counts) + len(new) > CACHE_WORDS:
            self.counts, self.bare = {}, set()
            new = {w for words in split for w in words} - {""}
        if new:
            self._learn(list(new))
        self.counts[""] = 0
        tokens = [
            sum(map(self.counts.__getitem__, words)) + (self._runs(words) if "" in words else 0)
            for words in split
        ]
        for word in new:
            if len(word) > LONG_WORD:
                del self.counts[word]
                self.bare.discard(word)
        return tokens

    def _runs(self, words: list[str]) -> int:
        """Tokens of the runs of spaces; each empty word stands for one more space."""
        total = spaces = 0
        for empty, group in groupby(words, key=lambda w: w == ""):
            if empty:
                spaces = sum(1 for _ in group)
            elif spaces:
                word = next(group)
                bare = word in self.bare
                total += self._run(spaces + bare) - bare
                spaces = 0
        return total + self._run(spaces)

    def _run(self, spaces: int) -> int:
        whole, rest = divmod(spaces, self.longest_run)
        return whole + self.run_tokens[rest]

    def _learn(self, words: list[str]) -> None:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        text = SPACE + SPACE.join(words)
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        alphabet, place = np.unique(points, return_inverse=True)
        outside = self.width - 1
        ids = np.array([self.number.get(chr(c), outside) for c in alphabet], dtype=np.int64)
        spelled = np.array([len(chr(c).encode()) for c in alphabet], dtype=np.int64)
        symbol = ids[place]
        cost = np.where(self.known[symbol], 1, spelled[place])
        word = np.repeat(np.arange(len(words)), lengths)
        count, first = self._merge(symbol, cost, word, len(words))
        self.counts.update(zip(words, count.tolist()))
        space = self.number[SPACE]
        self.bare.update(words[i] for i in np.flatnonzero(first == space))

    def _merge(self, symbol, cost, word, n: int):
        """(tokens, first symbol) of each of ``n`` words after all merges."""
        count, first = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        pair = np.full(len(symbol), -1, dtype=np.int32)  # what a symbol and the next would make
        fresh = np.arange(len(symbol) - 1)
        while len(symbol):
            pair[fresh] = np.where(
                word[fresh] == word[fresh + 1],
                self.pairs.find(symbol[fresh] * self.width + symbol[fresh + 1]),
                -1,
            )
            rank = self.rank[pair]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(starts, append=len(symbol))
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == NO_RANK
            lowest[over] = -1
            chosen = np.flatnonzero(rank == np.repeat(lowest, lengths))
            if len(chosen):
                # Of pairs that overlap the leftmost goes first: every other one of a run.
                run = np.flatnonzero(np.r_[True, np.diff(chosen) != 1])
                nth = np.arange(len(chosen)) - np.repeat(run, np.diff(run, append=len(chosen)))
                chosen = chosen[nth % 2 == 0]
                # Where a lower rank may come up between, pairs are merged one at a time.
                leftmost = np.r_[True, word[chosen[1:]] != word[chosen[:-1]]]
                chosen = chosen[leftmost | ~self.early[pair[chosen]]]
                symbol[chosen] = pair[chosen]
                cost[chosen] = 1
            keep = np.ones(len(symbol), dtype=bool)
            keep[chosen + 1] = False
            if over.any():
                done = word[starts[over]]
                count[done] = np.add.reduceat(cost, starts)[over]
                first[done] = symbol[starts[over]]
                keep &= ~np.repeat(over, lengths)
            place = np.cumsum(keep) - 1
            symbol, cost, word, pair = symbol[keep], cost[keep], word[keep], pair[keep]
            fresh = place[chosen]
            fresh = np.concatenate([fresh, fresh[fresh > 0] - 1])
            if len(symbol):
                pair[-1] = -1
                fresh = fresh[fresh < len(symbol) - 1]
        return count, first


class PairTable:
    """Pair of symbols -> what they make: a hash table in arrays, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(8 * len(keys) + 1)))))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int32)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] < 0
            slots, which = np.unique(at[left[free]], return_index=True)
            taken = left[free][which]
            self.keys[slots], self.values[slots] = keys[taken], values[taken]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) % size

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for unknown keys."""
        at = self._home(keys)
        there = self.keys[at]
        found = np.where(there == keys, self.values[at], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) % len(self.keys)
            there = self.keys[at[left]]
            same = there == keys[left]
            found[left[same]] = self.values[at[left[same]]]
            left = left[~same & (there >= 0)]
        return found


def _space_tokens(spaces: int, lengths: set[int]) -> int:
    """Tokens of a short run of spaces whose merges all have one rank: the leftmost goes first."""
    run, i = [1] * spaces, 0
    while i < len(run) - 1:
        if run[i] + run[i + 1] in lengths:
            run[i : i + 2] = [run[i] + run[i + 1]]
            i = 0
        else:
            i += 1
    return len(run)


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = 4096
) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every whole text.

    Row-local: no shuffle, one slice of a batch in memory at a time. A null text counts as empty
    and has no bytes and no tokens; repeated rows and null keys are kept; other columns are ignored.
    """

    def make():
        counter = _counter(path)
        return lambda texts: list(zip([len(t.encode()) for t in texts], counter.count(texts)))

    counted = per_text(docs, [key], text, {"n_bytes": LONG, "n_tokens": LONG}, make)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
