"""Licence scans: templates with optional and replaceable regions as automata over words.

A template is licence wording with markup: ``<<optional>>...<</optional>>`` may be missing and
``<<var:5>>`` stands for up to five words of any kind. It is compiled into an automaton that accepts
a place of a text only if all mandatory wording stands there word for word, to the licence's end.
Where only the opening of a long wording stands, that is reported as an opening, under a label of
its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmetrics.llm.batches import LONG as BIGINT
from orgmetrics.llm.batches import STRING, array_of, per_text, struct_of

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Licence wording with its optional and replaceable regions.
TEMPLATES = {
    "MIT": (
        "released under the <<optional>>terms of the <</optional>>MIT license",
        "licensed under the <<optional>>terms of the <</optional>>MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the <<optional>>\"<</optional>>Software), to "
        "deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice "
        "<<optional>>(including the next paragraph) <</optional>>shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE <<var:12>> BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "licensed under the <<optional>>terms of the <</optional>>Apache license, version 2.0",
        "released under the <<optional>>terms of the <</optional>>Apache license, version 2.0",
        "Licensed under the Apache License, Version 2.0 (the <<optional>>\"<</optional>>License); you may "
        "not use this file except in compliance with the License. You may obtain a copy of the License at "
        "<<optional>>http<<optional>>s<</optional>>://www.apache.org/licenses/LICENSE-2.0 <</optional>>Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and limitations under "
        "the License.",
    ),
    "GPL": (
        "licensed under the <<optional>>terms of the <</optional>>GNU general public license"
        "<<optional>>, version <<var:1>> <<optional>>or later <</optional>><</optional>>",
        "This program is free software<<optional>>;<</optional>> you can redistribute it and/or modify "
        "it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation<<optional>>,<</optional>> either version <<var:1>> of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    "CC-BY-NC-4.0": (
        "licensed under <<optional>>a <</optional>>CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-4.0": (
        "licensed under <<optional>>a <</optional>>CC BY 4.0",
        "licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: <<optional>>1. <</optional>>"
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer. <<optional>>2. <</optional>>Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. <<optional>><<optional>>3. "
        "<</optional>>Neither the name of <<var:10>> nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission. "
        "<</optional>>THIS SOFTWARE IS PROVIDED BY <<var:12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var:12>> BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT "
        "OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and<<optional>>/or<</optional>> distribute this software for "
        "any purpose with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var:6>> "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var:6>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
}

OPENING = 8  # mandatory words that make an opening, of wordings of ...
LONG = 30  # ... so many mandatory words or more
OPENING_LABEL = "{}-opening"
ANCHOR_WORDS = 3  # mandatory words at a template's start by which its places are found
# Words are runs of digits, lower-case letters and everything beyond ASCII; the rest parts them.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """States are numbers; a state goes on by a word, by any word, or without one."""

    by_word: list[dict[bytes, int]] = field(default_factory=list)
    by_any: list[int | None] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    end: int = 0

    def state(self) -> int:
        self.by_word.append({})
        self.by_any.append(None)
        self.free.append([])
        return len(self.free) - 1

    def reach(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return seen

    def match(self, words: list[bytes], at: int) -> int | None:
        """Place after the longest match that starts at ``at``."""
        states, last = self.reach({0}), None
        while states:
            if self.end in states:
                last = at
            if at == len(words):
                break
            step = {self.by_word[s].get(words[at]) for s in states} | {self.by_any[s] for s in states}
            states = self.reach(step - {None})
            at += 1
        return last


def compile_template(template: str) -> Automaton:
    automaton = Automaton()
    at, opened = automaton.state(), []
    for part in re.split(r"(<<[^<>]*>>)", template):
        if part == "<<optional>>":
            opened.append(at)
        elif part == "<</optional>>":
            automaton.free[opened.pop()].append(at)
            # A state of its own, so that what follows is not taken into the optional region.
            after = automaton.state()
            automaton.free[at].append(after)
            at = after
        elif part.startswith("<<var:"):
            inside = [at]
            for _ in range(int(part[6:-2])):
                after = automaton.state()
                automaton.by_any[inside[-1]] = after
                inside.append(after)
            at = automaton.state()
            for state in inside:
                automaton.free[state].append(at)
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part}")
        else:
            for word in words_of(part):
                after = automaton.state()
                automaton.by_word[at][word] = after
                at = after
    if opened:
        raise ValueError("an optional region is not closed")
    automaton.end = at
    return automaton


def _anchor(template: str) -> bytes:
    words = words_of(template.split("<<")[0])[:ANCHOR_WORDS]
    if not words:
        raise ValueError("a template starts with mandatory wording")
    return b" ".join(words)


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, tuple[str, ...]]):
        self.phrases = [(b" ".join(words_of(p)), label) for p, label in phrases.items()]
        self.templates: dict[bytes, list[tuple[str, Automaton]]] = {}
        self.openings: dict[bytes, list[tuple[str, list[bytes]]]] = {}
        for label, wordings in templates.items():
            for wording in wordings:
                self.templates.setdefault(_anchor(wording), []).append((label, compile_template(wording)))
                first = words_of(wording.split("<<")[0])[:OPENING]
                if len(words_of(re.sub("<<[^<>]*>>", " ", wording))) >= LONG:
                    self.openings.setdefault(_anchor(wording), []).append((label, first))

    def scan(self, text: str) -> tuple[int, list[tuple[str, bool, int, int]]]:
        """(number of words, places: label, kind, first word, word after).

        The kind is phrase, template, or opening where a long template is not met as a whole.
        """
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        places = []
        for phrase, label in self.phrases:
            size = phrase.count(b" ") + 1
            places += [(label, "phrase", at, at + size) for at in _starts(line, phrase)]
        for anchor, automata in self.templates.items():
            for at in _starts(line, anchor):
                met = set()
                for label, automaton in automata:
                    end = automaton.match(words, at)
                    if end is not None:
                        places.append((label, "template", at, end))
                        met.add(label)
                for label, first in self.openings.get(anchor, ()):
                    if label not in met and words[at : at + len(first)] == first:
                        places.append((OPENING_LABEL.format(label), "opening", at, at + len(first)))
        return len(words), sorted(places, key=lambda p: (p[2], p[3], p[0]))


def _starts(line: bytes, phrase: bytes) -> Iterator[int]:
    """Numbers of the words at which ``phrase`` stands in a line of single-spaced words."""
    needle, word, counted = b" " + phrase + b" ", 0, 0
    at = line.find(needle)
    while at >= 0:
        word += line.count(b" ", counted, at)
        counted = at
        yield word
        at = line.find(needle, at + 1)


def license_scan(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: dict[str, tuple[str, ...]] | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key``, ``n_words`` and ``places`` of every whole text, in the order of their first word.

    A place has its label, its kind (phrase, template, opening), its first word and the word after it. Row-local. A null text counts as empty and has no words; repeated rows and null
    keys are kept; other columns are ignored.
    """
    scanner = Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)

    names = ("label", "kind", "first", "until")

    def work(texts: list[str]) -> list[tuple]:
        found = [scanner.scan(t) for t in texts]
        return [(n, [dict(zip(names, p)) for p in places]) for n, places in found]

    place = struct_of(label=STRING, kind=STRING, first=BIGINT, until=BIGINT)
    return per_text(docs, [key], text, {"n_words": BIGINT, "places": array_of(place)}, lambda: work)


def license_report(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: counts and labels; score 1 by a template, 0.75 by an opening, 0.5 by phrases alone."""
    base = F.filter("places", lambda p: p["kind"] == "phrase")
    starts = F.transform(base, lambda p: p["first"])
    names = lambda places: F.array_join(
        F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ","
    )
    return scanned.select(
        key,
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.when(F.exists("places", lambda p: p["kind"] == "template"), 1.0)
        .when(F.exists("places", lambda p: p["kind"] == "opening"), 0.75)
        .when(F.size("places") > 0, 0.5)
        .otherwise(0.0)
        .alias("score"),
    )
