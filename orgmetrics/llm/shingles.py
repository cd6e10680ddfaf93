"""Sets of word shingles as 64-bit hashes, and their MinHash signatures, in arrays."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be undone
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Words are runs of anything but space, tab and line ends; A-Z count as a-z.

    A text's set holds the hashes of its distinct sequences of ``width`` words. A text of fewer words
    has one sequence, all of it; without words the set is empty.
    """

    def __init__(self, width: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.width = width
        self.factor = rng.integers(0, 1 << 63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = self.undo = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power))
            one = np.ones(1, dtype=np.uint64)
            self.power = np.cumprod(np.concatenate([one, np.full(n - 1, _BASE)]))
            self.undo = np.cumprod(np.concatenate([one, np.full(n - 1, _INVERSE)]))

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word of all texts, words per text)."""
        coded = [t.encode().lower() for t in texts]
        data = np.frombuffer(b"\n".join(coded) + b"\n", dtype=np.uint8)
        self._powers(len(data))
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        start, stop = edge[::2], edge[1::2]
        sums = np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)])]
        )
        hashed = mix((sums[stop] - sums[start]) * self.undo[start] + (stop - start).astype(np.uint64))
        ends = np.cumsum([len(c) + 1 for c in coded])
        return hashed, np.diff(np.searchsorted(start, ends), prepend=0)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        if not texts:
            return []
        words, count = self.words(texts)
        width, n = self.width, len(words)
        grams = np.zeros(max(0, n - width + 1), dtype=np.uint64)
        for j in range(width):
            grams += words[j : j + len(grams)] * self.factor[j]
        grams = mix(grams)
        out, at = [], 0
        for c in count.tolist():
            if c >= width:
                out.append(np.unique(grams[at : at + c - width + 1]))
            elif c:
                short = (words[at : at + c] * self.factor[:c]).sum(dtype=np.uint64) + np.uint64(c)
                out.append(mix(np.array([short])))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += c
        return out


class MinHash:
    """``n`` smallest hashes of a set, each under its own order of all hashes; 32 bits each."""

    def __init__(self, n: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.turn = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.factor = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signature(self, hashes: np.ndarray, step: int = 1024) -> np.ndarray:
        best = np.full(len(self.factor), np.iinfo(np.uint64).max, dtype=np.uint64)
        for a in range(0, len(hashes), step):
            part = (hashes[a : a + step, None] ^ self.turn) * self.factor
            np.minimum(best, part.min(axis=0), out=best)
        return (best >> np.uint64(32)).astype(np.uint32)
