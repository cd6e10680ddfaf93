"""Pages as flat lists of elements and text, for markup as it is found: unclosed, nested wrongly, cut off."""

from __future__ import annotations

import html
import re

# Start and end tags, comments and declarations; a quoted value may hold ">".
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+>?"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>?",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Attributes whose words say what an element is for.
NAMING = ("class", "id", "role", "itemprop", "aria-label")

# Elements of HTML by how a page lays them out.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset(
    "head script style textarea title iframe noembed noframes xmp template noscript object svg math select "
    "option optgroup datalist button canvas audio video map".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base link meta noscript script style template title".split())
PHRASING = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr picture q rb "
    "rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr br".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p pre section summary table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPE = frozenset("html table td th caption button template object".split())
#: A start tag ends an open element of these, up to the nearest one of those.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "body": (("head",), ()),
}
TEXT = "#text"


def naming_words(attributes: str) -> tuple[str, ...]:
    """The words of the attributes that name an element, lower-cased, in order."""
    if "=" not in attributes:
        return ()
    found = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in NAMING:
            found += [w.lower() for v in values if v for w in _WORD.findall(v)]
    return tuple(found[:24])


class Page:
    """The elements of a page that hold text blocks, in page order, and their texts.

    ``tag``, ``attributes``, ``parent`` and ``end`` describe an element: those from its place up to
    ``end`` are inside. Phrasing elements are part of the text. Where an element holds both text and
    elements, each run of its text is an element ``#text``. ``blocks`` holds the texts of an element,
    white space as one space; ``links`` counts the characters of it inside ``a``.
    """

    def __init__(self, source: str):
        self.tag: list[str] = ["#page"]
        self.attributes: list[str] = [""]
        self.parent: list[int] = [-1]
        self.end: list[int] = [0]
        self.blocks: list[str] = [""]
        self.links: list[int] = [0]
        self.inputs: list[int] = [0]
        self._text: list[str] = []
        self._linked = 0
        self._read(source)

    def _flush(self, owner: int) -> None:
        """Ends a block: its text goes to a node of its own under ``owner``."""
        text = " ".join("".join(self._text).split()) if self._text else ""
        if text:
            self._add(TEXT, "", owner)
            self.end[-1] = len(self.tag)
            self.blocks[-1], self.links[-1] = text, min(self._linked, len(text))
        self._text, self._linked = [], 0

    def _add(self, tag: str, attributes: str, parent: int) -> int:
        self.tag.append(tag)
        self.attributes.append(attributes)
        self.parent.append(parent)
        self.end.append(0)
        self.blocks.append("")
        self.links.append(0)
        self.inputs.append(0)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        # Open elements: name, node (-1 for phrasing), and for every name the places it is open at.
        names, nodes, owner, solid = [], [], [0], []  # solid: places of all but phrasing
        places: dict[str, list[int]] = {}
        unseen = 0

        def pop_to(place: int) -> None:
            nonlocal unseen
            while len(names) > place:
                name, node = names.pop(), nodes.pop()
                places[name].pop()
                unseen -= name in UNSEEN
                if solid and solid[-1] == len(names):
                    solid.pop()
                if node >= 0:
                    self._flush(owner[-1])
                    owner.pop()
                    self.end[node] = len(self.tag)

        def last(some) -> int:
            return max((places[n][-1] for n in some if places.get(n)), default=-1)

        def text(piece: str) -> None:
            if not piece:
                return
            if unseen:
                if names[-1] != "head" or not piece.strip():
                    return
                pop_to(len(names) - 1)  # text ends the head
            if "&" in piece:
                piece = html.unescape(piece)
            self._text.append(piece)
            if places.get("a"):
                self._linked += len(piece.strip())

        at, size = 0, len(source)
        while at < size:
            hit = _MARKUP.search(source, at)
            if hit is None:
                text(source[at:])
                break
            text(source[at : hit.start()])
            at = hit.end()
            closing, opening, attributes = hit.groups()
            if closing is not None:
                name = closing.lower()
                if places.get(name):
                    place = places[name][-1]
                    # Phrasing ends within its block, blocks within their table cell.
                    if name in PHRASING:
                        barrier = solid[-1] if solid else -1
                    else:
                        barrier = -1 if name in SCOPE else last(SCOPE)
                    if place > barrier:
                        pop_to(place)
                elif name == "br":
                    text(" ")
                continue
            if opening is None:
                continue
            name = opening.lower()
            if names and names[-1] == "head" and name not in HEAD:
                pop_to(len(names) - 1)
            if name in CLOSES_P and places.get("p") and places["p"][-1] > last(SCOPE):
                pop_to(places["p"][-1])
            if name in HEADINGS and names and names[-1] in HEADINGS:
                pop_to(len(names) - 1)
            if name in ENDS:
                ended, within = ENDS[name]
                first = min((places[n][-1] for n in ended if places.get(n) and places[n][-1] > last(within)), default=-1)
                if first >= 0:
                    pop_to(first)
            if name == "br":
                text(" ")
            if name == "input" or name in ("select", "textarea", "button"):
                self.inputs[owner[-1]] += 1
            if name in VOID:
                if name == "hr":
                    self._flush(owner[-1])
                continue
            if name in RAW:
                shut = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                at = shut.end() if shut else size
                continue
            node = -1
            if name not in PHRASING:
                solid.append(len(names))
                if not unseen and name not in UNSEEN:
                    self._flush(owner[-1])
                    node = self._add(name, attributes, owner[-1])
                    owner.append(node)
            unseen += name in UNSEEN
            places.setdefault(name, []).append(len(names))
            names.append(name)
            nodes.append(node)
        pop_to(0)
        self._flush(0)
        self.end[0] = len(self.tag)
        self._merge()

    def _merge(self) -> None:
        """An element whose one child is a text takes the text over; elements without text go."""
        size = len(self.tag)
        texts = [0] * (size + 1)
        for i, tag in enumerate(self.tag):
            texts[i + 1] = texts[i] + (tag == TEXT)
        keep, place = [], [0] * (size + 1)
        for i in range(size):
            place[i] = len(keep)
            alone = self.tag[i] == TEXT and self.parent[i] and self.end[self.parent[i]] - self.parent[i] == 2
            if alone:
                p = place[self.parent[i]]
                self.blocks[keep[p]], self.links[keep[p]] = self.blocks[i], self.links[i]
                place[i] = p
            elif i == 0 or texts[self.end[i]] > texts[i]:
                keep.append(i)
        place[size] = len(keep)
        ends = [place[self.end[i]] for i in keep]
        self.parent = [place[self.parent[i]] if i else -1 for i in keep]
        self.end = ends
        for name in ("tag", "attributes", "blocks", "links", "inputs"):
            values = getattr(self, name)
            setattr(self, name, [values[i] for i in keep])

