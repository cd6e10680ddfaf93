"""Elements of landed pages, found by CSS selectors.

The one place that needs Python: Spark has no HTML reader and the pages are not well-formed.
Python only reports which elements matched; all typing and cleaning stays in column expressions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements that never have content, elements whose text is not page text,
# attributes that the selectors' users read.
_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
_NOT_TEXT = frozenset("script style template rt rp".split())
_ATTRIBUTES = ("href", "title", "alt", "src", "data-lat", "data-lng")

_FIELDS = [("sel", pa.string())]
_FIELDS += [(n, pa.int32()) for n in ("start", "stop", "first_text", "end_text")]
_FIELDS += [(a.replace("-", "_"), pa.string()) for a in _ATTRIBUTES]
_NODES = pa.list_(pa.struct(_FIELDS))
_TEXTS = pa.list_(pa.string())
NODES_DDL = (
    "array<struct<sel:string,start:int,stop:int,first_text:int,end_text:int,"
    + ",".join(a.replace("-", "_") + ":string" for a in _ATTRIBUTES)
    + ">>"
)


def _compound(text: str) -> tuple[str, frozenset[str], list[tuple[str, str, str]]]:
    attributes = [
        (name.lower(), op, value.strip("\"'"))
        for name, op, value in re.findall(r"\[([\w-]+)(?:([*]?=)([^\]]*))?\]", text)
    ]
    bare = re.sub(r"\[[^\]]*\]", "", text)
    tag, *classes = bare.split(".")
    return tag.lower(), frozenset(classes), attributes


def _chain(selector: str) -> list:
    return [_compound(part) for part in re.findall(r"(?:[^\s\[]|\[[^\]]*\])+", selector)]


def _fits(compound, element) -> bool:
    tag, classes, attributes = compound
    name, own_classes, own = element[:3]
    if tag and tag != name or not classes <= own_classes:
        return False
    return all(
        key in own and (not op or (value in own[key] if op == "*=" else value == own[key]))
        for key, op, value in attributes
    )


class _Matcher(HTMLParser):
    """Collects the matching elements of one page; end tags are never implied.

    The texts inside matched elements are kept once, in page order; an element holds the range of
    its own, so that elements inside each other cost no more than elements side by side.
    """

    def __init__(self, selectors: dict[str, str]):
        super().__init__(convert_charrefs=True)
        self.rules = [(label, _chain(selector)) for label, selector in selectors.items()]
        self.none = [0] * len(self.rules)

    def nodes(self, html: str) -> tuple[list[dict], list[str]]:
        self.reset()
        self.seen, self.found, self.text, self.texts = 0, [], [], []
        # Open elements, how many of each name and of those without text, and open matched nodes.
        self.stack: list[tuple] = []
        self.names: Counter[str] = Counter()
        self.muted = 0
        self.nodes_open: list[dict] = []
        self.feed(html)
        self.close()
        self._end_text()
        while self.stack:
            self._pop()
        return self.found, self.texts

    def _end_text(self, *_):
        text = "".join(self.text).strip()
        self.text.clear()
        if text and not self.muted and self.nodes_open:
            self.texts.append(text)

    def _pop(self):
        tag, matched, _ = self.stack.pop()
        self.names[tag] -= 1
        self.muted -= tag in _NOT_TEXT
        for _ in range(matched):
            node = self.nodes_open.pop()
            node["stop"], node["end_text"] = self.seen, len(self.texts)

    def handle_starttag(self, tag, attrs):
        self._end_text()
        self.seen += 1
        own = {k: v or "" for k, v in attrs}
        element = (tag, frozenset(own.get("class", "").split()), own)
        matched = 0
        # How many outer steps of each chain the open elements fulfil, from the outermost on.
        steps = self.stack[-1][2] if self.stack else self.none
        after = None
        for i, (label, chain) in enumerate(self.rules):
            outer = len(chain) - 1
            if steps[i] == outer:
                if _fits(chain[-1], element):
                    node = {"sel": label, "start": self.seen, "first_text": len(self.texts)}
                    node.update({a.replace("-", "_"): own.get(a) for a in _ATTRIBUTES})
                    self.nodes_open.append(node)
                    self.found.append(node)
                    matched += 1
            elif _fits(chain[steps[i]], element):
                after = after or list(steps)
                after[i] += 1
        self.stack.append((tag, matched, after or steps))
        self.names[tag] += 1
        self.muted += tag in _NOT_TEXT
        if tag in _VOID:
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        if self.names[tag]:
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        self.text.append(data)

    handle_comment = handle_decl = handle_pi = unknown_decl = _end_text


def match_nodes(
    pages: DataFrame, selectors: dict[str, str], html: str = "html", partitions: int | None = None
) -> DataFrame:
    """Replace the ``html`` column by ``nodes``, every element that one of the selectors matches, and ``texts``.

    Supported: tag, class, compound class, descendant, ``[a]``, ``[a="v"]``, ``[a*="v"]``.
    Each page is read once whatever the number of selectors, in the partitions of the scan: page text
    is never shuffled, unless the caller asks for a number of ``partitions`` because the landed files
    have fewer row groups than there are cores. ``start``/``stop`` number the elements in document
    order: B lies in A when ``A.start < B.start <= A.stop``. ``texts`` holds the page's texts inside
    matched elements; those of an element are ``first_text`` up to ``end_text``, from 0.
    """
    if partitions:
        pages = pages.repartition(partitions)
    keep = [c for c in pages.columns if c != html]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(selectors)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(html))
            found = [matcher.nodes(t.as_py() or "") for t in texts]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            columns.append(pa.array([n for n, _ in found], type=_NODES))
            columns.append(pa.array([t for _, t in found], type=_TEXTS))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "nodes", "texts"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html]
    schema = ", ".join([*fields, f"nodes {NODES_DDL}", "texts array<string>"])
    return pages.select(*keep, html).mapInArrow(read, schema)


def nodes_of(label: str) -> Column:
    return F.filter("nodes", lambda n: n["sel"] == label)


def first_of(*labels: str) -> Column:
    """First element of the first label that matched at all."""
    return F.coalesce(*(F.try_element_at(nodes_of(x), F.lit(1)) for x in labels))


def all_of(*labels: str) -> Column:
    """Elements of the first label that matched at all; an empty array when none did."""
    found = nodes_of(labels[-1])
    for label in reversed(labels[:-1]):
        here = nodes_of(label)
        found = F.when(F.size(here) > 0, here).otherwise(found)
    return found


def node_text(node: Column, separator: str = "") -> Column:
    """The texts of an element of the row's page, joined; NULL for no element."""
    own = F.slice("texts", node["first_text"] + 1, node["end_text"] - node["first_text"])
    return F.array_join(own, separator)


def inside(node: Column, outer: Column) -> Column:
    return (node["start"] > outer["start"]) & (node["start"] <= outer["stop"])
