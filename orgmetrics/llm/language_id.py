"""Language ID by a byte convolutional network, trained in numpy on labelled texts.

A text is cut into windows of fixed length over its UTF-8 bytes. Filters of several widths slide
over a window, each keeps its largest response, and a softmax layer turns the responses into
probabilities of the languages. A filter over bytes is one table of weights per offset, so a
response is a sum of looked-up rows; tables of neighbouring offsets are merged for prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orgmetrics.llm.batches import DOUBLE, STRING, per_slice

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
SAMPLE = 400  # labelled texts per language that the network is fitted on
WINDOWS_PER_TEXT = 8  # of a sampled text, spread over the whole of it
LEAST_STEPS = 600
LANGUAGES = 200  # a bound on what the driver holds; raise it for tables of more languages
UNKNOWN = "und"
LOW = 0.02  # share of a language's held-out texts that its level may be drawn from
SLICE_BYTES = 1 << 20  # of texts that are handed on at a time
STEPS = 1 << 16  # of a score, where levels are drawn
NOISE = "\0noise"  # of the network, never of a text
SCRIPTS = [  # first and last letter, for noise
    (0x61, 0x7A), (0xE0, 0xFE), (0x3B1, 0x3C9), (0x430, 0x44F), (0x561, 0x586), (0x5D0, 0x5EA), (0x627, 0x64A),
    (0x905, 0x939), (0xE01, 0xE2E), (0x10D0, 0x10F0), (0x3041, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
]
_LETTER = regex.compile(r"\p{L}")


def windows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all windows of all texts, windows per text); the last of a text is zero-filled."""
    coded = [t.encode().lower() for t in texts]
    count = np.array([max(1, -(-len(c) // WINDOW)) for c in coded], dtype=np.int64)
    out = np.zeros(int(count.sum()) * WINDOW, dtype=np.uint8)
    for c, at in zip(coded, (np.cumsum(count) - count) * WINDOW):
        out[at : at + len(c)] = np.frombuffer(c, dtype=np.uint8)
    return out.reshape(-1, WINDOW), count


@dataclass
class ByteNetwork:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.dense, self.offset]

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each window, and where it is."""
        best, where = [], []
        for table in self.filters:
            span = WINDOW - len(table) + 1
            sums = sum(table[j][windows[:, j : j + span]] for j in range(len(table)))
            where.append(sums.argmax(axis=1))
            best.append(np.take_along_axis(sums, where[-1][:, None, :], axis=1)[:, 0])
        return np.hstack(best), np.hstack(where)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Largest responses alone, by tables over two bytes at a time."""
        left, right = windows[:, :-1], windows[:, 1:]
        pairs = left.astype(np.int32) * 256 + right
        out = []
        for table, parts in zip(self.filters, self._pair_tables()):
            span = WINDOW - len(table) + 1
            sums = parts[0][pairs[:, :span]]
            for j, part in enumerate(parts[1:], 1):
                at = pairs if len(part) > 256 else windows
                sums += part[at[:, 2 * j : 2 * j + span]]
            while sums.shape[1] > 1:
                # Halves against each other: long rows of memory instead of short ones.
                half = sums.shape[1] // 2
                sums = np.maximum(sums[:, : sums.shape[1] - half], sums[:, -(sums.shape[1] - half) :])
            out.append(sums[:, 0])
        return np.hstack(out)

    def _pair_tables(self) -> list[list[np.ndarray]]:
        if not hasattr(self, "_tables"):
            self._tables = [
                [
                    np.ascontiguousarray((t[j][:, None] + t[j + 1][None]).reshape(65536, -1))
                    if j + 1 < len(t)
                    else np.ascontiguousarray(t[j])
                    for j in range(0, len(t), 2)
                ]
                for t in self.filters
            ]
        return self._tables

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        scores = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def gradients(self, windows: np.ndarray, answer: np.ndarray) -> list[np.ndarray]:
        best, where = self.responses(windows)
        hidden = np.maximum(best + self.bias, 0)
        error = self.probabilities(best)
        error[np.arange(len(answer)), answer] -= 1
        error /= len(answer)
        down = (error @ self.dense.T) * (hidden > 0)
        out = []
        rows = np.arange(len(windows))[:, None]
        for i, table in enumerate(self.filters):
            part = slice(i * FILTERS, (i + 1) * FILTERS)
            grad = np.zeros_like(table)
            for j in range(len(table)):
                # Only the place of the largest response learns.
                np.add.at(grad[j], (windows[rows, where[:, part] + j], np.arange(FILTERS)), down[:, part])
            out.append(grad)
        return [*out, down.sum(axis=0), hidden.T @ error, error.sum(axis=0)]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and mean probability over the windows of each text, by their bytes."""
        windows, count = windows_of(texts)
        found = np.vstack(
            [self.probabilities(self.pooled(windows[a : a + 512])) for a in range(0, len(windows), 512)]
        )
        weight = np.maximum((windows != 0).sum(axis=1), 1)
        starts = np.cumsum(count) - count
        mean = np.add.reduceat(found * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
        if NOISE in self.languages:  # what noise takes is missing from the score
            mean[:, self.languages.index(NOISE)] = -1
        return [
            (self.languages[i], min(1.0, float(p[i]))) if _LETTER.search(t) else (UNKNOWN, 0.0)
            for t, p, i in zip(texts, mean, mean.argmax(axis=1))
        ]


def train(
    windows: np.ndarray, answer: np.ndarray, languages: list[str], rounds: int = 5, batch: int = 64, seed: int = 7
) -> ByteNetwork:
    """Adam over the cross entropy; the same windows always give the same network.

    Few windows are gone through more often, so that any sample gets ``LEAST_STEPS`` steps.
    """
    rounds = max(rounds, -(-LEAST_STEPS * batch // len(windows)))
    rng = np.random.default_rng(seed)
    wide = FILTERS * len(WIDTHS)
    network = ByteNetwork(
        languages,
        [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(wide, dtype=np.float32),
        rng.normal(0, 0.3, (wide, len(languages))).astype(np.float32),
        np.zeros(len(languages), dtype=np.float32),
    )
    parameters = network.parameters()
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    step, steps = 0, rounds * -(-len(windows) // batch) + 1
    for _ in range(rounds):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), batch):
            pick = order[a : a + batch]
            seen = windows[pick]
            # A third of the windows end early, as those of short texts do.
            end = rng.integers(12, 3 * WINDOW, size=(len(pick), 1))
            seen = np.where(np.arange(WINDOW) < end, seen, 0).astype(np.uint8)
            step += 1
            rate = 0.005 * (1 - step / steps)
            for p, m, v, g in zip(parameters, first, second, network.gradients(seen, answer[pick])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def _noise(windows: np.ndarray, count: int, seed: int = 3) -> np.ndarray:
    """Windows in no language: characters of given windows in random order, and random letters."""
    rng, out = np.random.default_rng(seed), np.zeros((count, WINDOW), dtype=np.uint8)
    for k in range(count):
        if k % 2:
            first, last = SCRIPTS[rng.integers(len(SCRIPTS))]
            letters = [chr(c) for c in rng.integers(first, last + 1, WINDOW)]
            for at in np.flatnonzero(rng.random(WINDOW) < 0.15):
                letters[at] = " "
        else:
            given = windows[rng.integers(len(windows))].tobytes().rstrip(b"\0").decode(errors="ignore")
            letters = [given[i] for i in rng.permutation(len(given))]
        coded = "".join(letters).encode()[:WINDOW]
        out[k, : len(coded)] = np.frombuffer(coded, dtype=np.uint8)
    return out


def _chosen(rows: DataFrame, sample: int, lang: str, key: str) -> list:
    """Keys of at most ``sample`` rows of each language, by a hash of the key; texts are not read."""
    order = Window.partitionBy(lang).orderBy(F.xxhash64(F.col(key)), key)
    chosen = rows.select(key, lang).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample)
    return [r[key] for r in chosen.select(key).distinct().collect()]


def fit(
    labelled: DataFrame,
    sample: int = SAMPLE,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    noise: bool = False,
    limit: int = LANGUAGES,
) -> ByteNetwork | None:
    """The network of the languages in ``lang``; None if no row has a label and a letter.

    Learns from at most ``sample`` texts of each of the ``limit`` languages with the most rows, chosen by a
    hash of ``key``, and from ``WINDOWS_PER_TEXT`` windows of each, so the driver holds a number of
    bytes that does not grow with the table. With ``noise`` the network also learns as many windows in
    no language as a language has on average, and a score is low for texts that resemble them.
    """
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    most = rows.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(limit)
    languages = sorted(r[lang] for r in most.collect())
    keys = _chosen(rows.filter(F.col(lang).isin(languages)), sample, lang, key)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for value, name in zip(batch["text"], batch["lang"]):
                if _LETTER.search(value):
                    windows, _ = windows_of([value])
                    spread = np.unique(np.linspace(0, len(windows) - 1, WINDOWS_PER_TEXT).astype(int))
                    found += [(name, windows[i].tobytes()) for i in spread]
            yield pd.DataFrame(found, columns=["lang", "window"])

    read = rows.filter(F.col(key).isin(keys) & F.col(lang).isin(languages))
    read = read.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    cut_rows = read.mapInPandas(cut, "lang string, window binary")
    # Rows may share a key: by hash of the window no more of a language reach the driver than it learns from.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("window"), "window")
    cut_rows = cut_rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample * WINDOWS_PER_TEXT)
    cut_rows = cut_rows.drop("_n").toPandas()
    # A fixed order, whatever order the tasks ended in.
    cut_rows = cut_rows.sort_values(["lang", "window"])
    if not len(cut_rows):
        return None
    languages = sorted(set(cut_rows["lang"]))
    windows = np.frombuffer(b"".join(map(bytes, cut_rows["window"])), dtype=np.uint8).reshape(-1, WINDOW)
    answer = cut_rows["lang"].map(languages.index).to_numpy()
    if noise:
        added = _noise(windows, -(-len(windows) // len(languages)))
        windows = np.vstack([windows, added])
        answer = np.append(answer, np.full(len(added), len(languages)))
        languages = [*languages, NOISE]
    return train(windows, answer, languages)


def levels(
    network: ByteNetwork, held: DataFrame, text: str = "text", lang: str = "lang"
) -> dict[tuple[str, bool], float]:
    """Per language, and for texts within one window and longer ones apart: scores below are too low.

    Half of a low quantile (``LOW``) of the scores of all labelled texts of ``held`` that the network
    finds to be in their language, so that a few pieces of junk with a label do not lower it. Without
    such a text there is no level. Scores are rounded down to ``STEPS`` and counted, so a task holds
    no more than ``STEPS`` numbers of a language whatever the table.
    """
    rows = held.filter(F.col(lang).isin(network.languages) & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), is_short(F.col(text)).alias("short"), F.col(text).alias("text"))
    found = identify(rows, network, keep=["lang", "short"]).filter(F.col("lang") == F.col("lang_pred"))
    steps = found.groupBy("lang", "short", F.floor(F.col("score") * STEPS).alias("step")).agg(F.count("*").alias("n"))
    least = steps.groupBy("lang", "short").agg(F.percentile("step", F.lit(LOW), F.col("n")).alias("step"))
    return {(r["lang"], r["short"]): r["step"] / STEPS / 2 for r in least.collect()}


def is_short(text: Column) -> Column:
    """Texts of one window."""
    return F.octet_length(text) <= WINDOW


def identify(
    docs: DataFrame,
    network: ByteNetwork | None,
    text: str = "text",
    keep: list[str] | None = None,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns ``keep`` (default all) with the language and score of every whole text.

    Row-local; ``names`` are those of the two columns, for tables that have such columns already. A
    text that is null or has no letter is ``und`` with score 0, as is every text if no network could
    be trained. Repeated rows are kept.
    """

    def make():
        if network is None:
            return lambda texts: [(UNKNOWN, 0.0)] * len(texts)
        return network.predict

    kept = docs.columns if keep is None else keep
    return per_slice(docs, kept, text, dict(zip(names, (STRING, DOUBLE))), make, SLICE_BYTES)


def held_out(key: Column) -> Column:
    """Rows that are never learnt from: a third, by a checksum of the key."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1
