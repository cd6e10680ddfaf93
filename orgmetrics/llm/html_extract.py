"""Main text of pages: boosted trees over elements, decoded so that ancestors and descendants agree.

Every element that holds text is described by its subtree (text, links, density of markup), the words
of its attributes and those of its ancestors, its depth, and its neighbours. The trees give three
chances: all of the element's text is article, none is, or some. Decoding takes the assignment of the
highest chance among those in which everything inside an element that is all or nothing is the same.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from orgmetrics.llm.batches import LONG, STRING, per_slice
from orgmetrics.llm.boosting import BoostedTrees
from orgmetrics.llm.dom import TEXT, Page, naming_words
from orgmetrics.llm.labelled_pages import MARK, labelled_pages

PAGES = 700  # labelled pages that are learnt from
SLICE_BYTES = 1 << 20  # bytes of pages that are described at a time; a longer page is alone
CACHE = 100_000  # distinct start tags a worker remembers before it starts afresh
ALL, NONE, SOME = 0, 1, 2

_TAGS = (
    "p h1 h2 h3 div section article main nav header footer aside ul ol li form table tr td blockquote pre figure "
    "figcaption body dl dd dt address"
).split()


def _log(x: np.ndarray) -> np.ndarray:
    return np.log1p(np.maximum(x, 0))


class Extractor:
    """Learns from labelled pages, whose article texts begin with ``MARK``; then extracts."""

    def __init__(self, pages: list[str], **boosting):
        self.number = {t: i + 1 for i, t in enumerate([TEXT, "#page", *_TAGS])}
        self.words: dict[str, np.ndarray] = {}
        self.known: dict[tuple[str, str], tuple] = {}
        parsed = [Page(p) for p in pages]
        labels = [_labels(p) for p in parsed]
        self._learn_words(parsed, labels)
        x, y = self.features(parsed), np.concatenate(labels)
        self.trees = BoostedTrees(3, **boosting).fit(x, y)
        self.known.clear()

    def _learn_words(self, pages: list[Page], labels: list[np.ndarray]) -> None:
        """How much oftener a word, or an element's name, goes with each label than others do."""
        counts = {label: Counter() for label in (ALL, NONE, SOME)}
        totals = Counter()
        for page, label in zip(pages, labels):
            for tag, attributes, one in zip(page.tag, page.attributes, label.tolist()):
                found = {f"<{tag}", *naming_words(attributes)}
                counts[one].update(found)
                totals[one] += 1
        whole = sum(totals.values())
        for word in set().union(*counts.values()):
            n = sum(c[word] for c in counts.values())
            if n >= 5:
                share = [(counts[k][word] + 4 * totals[k] / whole) / (n + 4) for k in counts]
                self.words[word] = np.log([s / (totals[k] / whole) for s, k in zip(share, counts)])

    def _named(self, tag: str, attributes: str) -> tuple:
        """(number of the element's name, its weight, the weights of its words)."""
        key = tag, attributes
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            words = [self.words[w] for w in naming_words(attributes) if w in self.words]
            weights = np.array(words) if words else np.zeros((1, 3))
            own = self.words.get(f"<{tag}", np.zeros(3))
            extreme = (weights[:, ALL].max(), weights[:, NONE].max(), weights[:, SOME].max())
            found = self.known[key] = (
                self.number.get(tag, 0), *own.tolist(), *map(float, extreme), float(weights[:, ALL].min()),
                max(float(own[NONE]), float(extreme[1])), max(float(own[ALL]), float(extreme[0])), len(words),
            )
        return found

    def features(self, pages: list[Page]) -> np.ndarray:
        """One row per element of all pages."""
        named = np.array(
            [self._named(t, a) for p in pages for t, a in zip(p.tag, p.attributes)], dtype=np.float32
        ).reshape(-1, 11)
        n = len(named)
        sizes = np.array([len(p.tag) for p in pages])
        first = np.cumsum(sizes) - sizes
        root = np.repeat(first, sizes)
        parent = np.concatenate([np.array(p.parent) for p in pages]) + root
        own = np.arange(n)
        top = parent < root  # the page itself
        parent[top] = own[top]
        end = np.concatenate([np.array(p.end) for p in pages]) + root
        # What stands above: the strongest weights of the ancestors, and the depth.
        above = np.zeros((n, 3), dtype=np.float32)
        depth, none, full = [0] * n, [0.0] * n, [0.0] * n
        weight_none, weight_all = named[:, 8].tolist(), named[:, 9].tolist()
        for i, p in enumerate(parent.tolist()):
            if p != i:
                depth[i] = depth[p] + 1
                none[i] = max(none[p], weight_none[p])
                full[i] = max(full[p], weight_all[p])
        above[:, 0], above[:, 1], above[:, 2] = depth, none, full

        blocks = [b for p in pages for b in p.blocks]
        chars = np.fromiter(map(len, blocks), dtype=np.float64, count=n)
        words = np.fromiter((b.count(" ") for b in blocks), dtype=np.float64, count=n) + (chars > 0)
        stops = np.fromiter((b[-1:] in ".!?。…:\"”»" if b else False for b in blocks), dtype=np.float64, count=n)
        commas = np.fromiter((b.count(",") + b.count(".") for b in blocks), dtype=np.float64, count=n)
        rights = np.fromiter(("©" in b for b in blocks), dtype=np.float64, count=n)
        links = np.concatenate([np.array(p.links, dtype=np.float64) for p in pages])
        inputs = np.concatenate([np.array(p.inputs, dtype=np.float64) for p in pages])
        tag = named[:, 0]
        paragraphs, items = (tag == self.number["p"]).astype(float), (tag == self.number["li"]).astype(float)

        def inside(x: np.ndarray) -> np.ndarray:
            total = np.r_[0.0, np.cumsum(x)]
            return total[end] - total[own]

        text, links_in, blocks_in = inside(chars), inside(links), inside((chars > 0).astype(float))
        words_in, whole = inside(words), np.maximum(text[root], 1)
        total = np.r_[0.0, np.cumsum(chars)]
        # Neighbours: elements of one parent in page order.
        order = np.lexsort((own, parent, root))
        order = order[~top[order]]
        same = np.r_[False, parent[order][1:] == parent[order][:-1]] if len(order) else np.zeros(0, bool)
        before, after = own.copy(), own.copy()
        before[order[1:][same[1:]]] = order[:-1][same[1:]]
        after[order[:-1][same[1:]]] = order[1:][same[1:]]
        begin = np.flatnonzero(~same)
        many = np.diff(np.r_[begin, len(order)])
        place, siblings = np.zeros(n), np.ones(n)
        place[order] = np.arange(len(order)) - np.repeat(begin, many)
        siblings[order] = np.repeat(many, many)
        density = links_in / np.maximum(text, 1)

        def beside(x: np.ndarray, which: np.ndarray) -> np.ndarray:
            return np.where(which == own, -1, x[which])

        return np.column_stack(
            [
                named, above, _log(text), _log(chars), density, _log(blocks_in), _log(words_in),
                _log(end - own), text / (end - own), words_in / np.maximum(blocks_in, 1),
                inside(stops) / np.maximum(blocks_in, 1), inside(commas) / np.maximum(words_in, 1),
                inside(rights) > 0, _log(inside(inputs)), inside(paragraphs) / np.maximum(blocks_in, 1),
                inside(items) / np.maximum(blocks_in, 1), text / whole, total[own] / whole - total[root] / whole,
                (total[root] + whole - total[end]) / whole, text / np.maximum(text[parent], 1),
                place, siblings, place / siblings, beside(_log(text), before), beside(_log(text), after),
                beside(density, before), beside(density, after), beside(tag, before), beside(tag, after),
                tag[parent], density[parent], named[parent, 4], named[parent, 5],
            ]
        ).astype(np.float32)

    def decode(self, page: Page, chances: np.ndarray) -> list[bool]:
        """Which elements' own texts are article, under the consistent assignment of highest chance."""
        n = len(page.tag)
        cost = -chances
        single = np.array([e - i == 1 for i, e in enumerate(page.end)])
        # An element that is one text is all article or none of it.
        pair = cost[single][:, [ALL, NONE]]
        cost[single, :2] = pair + np.log(np.exp(-pair).sum(1))[:, None]
        totals = np.vstack([np.zeros(2), np.cumsum(cost[:, :2], axis=0)])
        end = np.array(page.end)
        whole = totals[end] - totals[:-1]
        every, nothing = whole[:, ALL].tolist(), whole[:, NONE].tolist()
        some, parent = cost[:, SOME].tolist(), page.parent
        below = [0.0] * n
        state = [SOME] * n
        alone = single.tolist()
        for i in range(n - 1, -1, -1):
            mixed = float("inf") if alone[i] else some[i] + below[i]
            best = min(every[i], nothing[i], mixed)
            state[i] = SOME if best == mixed else ALL if best == every[i] else NONE
            if i:
                below[parent[i]] += best
        for i in range(1, n):
            if state[parent[i]] != SOME:
                state[i] = state[parent[i]]
        return [s == ALL for s in state]

    def extract(self, sources: list[str]) -> list[str]:
        pages = [Page(s) for s in sources]
        chances = self.trees.log_probability(self.features(pages))
        out, at = [], 0
        for page in pages:
            kept = self.decode(page, chances[at : at + len(page.tag)].copy())
            at += len(page.tag)
            out.append("\n".join(b for b, k in zip(page.blocks, kept) if k and b))
        return out


def _labels(page: Page) -> np.ndarray:
    """The label of every element; marks are taken out of the texts."""
    n = len(page.tag)
    good, texts = np.zeros(n + 1), np.zeros(n + 1)
    for i, block in enumerate(page.blocks):
        texts[i + 1], good[i + 1] = bool(block), MARK in block
        if block:
            page.blocks[i] = block.replace(MARK, "")
    texts, good = np.cumsum(texts), np.cumsum(good)
    end = np.array(page.end)
    many, article = texts[end] - texts[:-1], good[end] - good[:-1]
    return np.where(article == 0, NONE, np.where(article == many, ALL, SOME))


@lru_cache(maxsize=2)
def trained(pages: int = PAGES, seed: int = 3) -> Extractor:
    return Extractor(labelled_pages(pages, seed))


def extract_main_text(
    pages: DataFrame,
    keep: list[str],
    html: str = "html",
    pages_learnt: int = PAGES,
    added: tuple[str, str] = ("text", "n_chars"),
) -> DataFrame:
    """The columns ``keep``, and ``text`` and ``n_chars`` of every page's article.

    The trees are learnt on the driver from ``pages_learnt`` labelled pages (a bounded number, drawn
    from layouts of ``labelled_pages``) and sent to the tasks. Row-local; every page is read whole.
    A null page counts as empty and has an empty text, as has one without an article. Repeated rows
    and null keys are kept; other columns are ignored.
    """
    model = trained(pages_learnt)

    def make():
        return lambda sources: [(t, len(t)) for t in model.extract(sources)]

    return per_slice(pages, keep, html, {added[0]: STRING, added[1]: LONG}, make, SLICE_BYTES)
