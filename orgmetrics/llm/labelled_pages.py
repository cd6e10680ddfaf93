"""Labelled pages to learn from: layouts drawn at random, every text marked as article or not."""

from __future__ import annotations

import html

import numpy as np

MARK = "\ue000"  # stands before every article text

# Words by which pages name their parts. A name is one or two of them.
NAMES = {
    "content": "article post entry content story text body main page single blog news detail prose copy read document",
    "layout": "container wrapper wrap inner outer row col grid column box block section site layout group region x a1 "
    "c2 flex card holder view root app pure large small",
    "menu": "nav navbar navigation menu topbar breadcrumb breadcrumbs crumbs tabs pager pagination links submenu toc skip",
    "header": "header masthead branding logo top head banner hero site title",
    "footer": "footer foot copyright colophon legal bottom imprint credits siteinfo",
    "side": "sidebar side aside rail widget related recommended popular trending more tags secondary archive teaser "
    "recent also complementary",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promoted promotion banner commercial adslot dfp "
    "affiliate marketing",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay message privacy announcement toast warning "
    "banner infobar disclaimer dialog",
    "form": "form search login signup register newsletter subscribe subscription contact field input mail",
    "comments": "comment comments commentlist respond reply replies disqus discussion reactions responses feedback thread "
    "reader",
    "share": "share sharing social follow buttons tools print like tweet",
}
SEMANTIC = {
    "content": ("article", "main", "article", "section", "div"),
    "menu": ("nav", "nav", "div", "ul"),
    "header": ("header", "header", "div"),
    "footer": ("footer", "footer", "div"),
    "side": ("aside", "aside", "div", "section"),
    "advert": ("div", "div", "aside", "section", "ins"),
    "notice": ("div", "div", "aside", "section", "dialog"),
    "form": ("form", "form", "div"),
    "comments": ("section", "div", "ol", "div", "aside", "article"),
    "share": ("div", "ul", "div"),
}
ROLES = {
    "menu": "navigation", "header": "banner", "footer": "contentinfo", "side": "complementary", "form": "search",
    "notice": "alert", "content": "main",
}
#: Letters of syllables, by script; the last has no spaces between words.
SCRIPTS = ("aeiouybcdfghklmnprst", "аеиоубвгдклмнпрст", "αειοβγδκλμνπρστ", "ابتدرسعفقكلمن", "的一是不了人我在有他这中大来上国")


class _Writer:
    """One page: random words of one script, markup of one style."""

    def __init__(self, rng: np.random.Generator, names: dict[str, list[str]]):
        self.rng, self.names = rng, names
        self.letters = SCRIPTS[rng.choice(len(SCRIPTS), p=[0.7, 0.1, 0.05, 0.05, 0.1])]
        self.space = "" if self.letters == SCRIPTS[-1] else " "
        self.odds = rng.random(8)  # habits of the page
        self.unclosed = rng.random() < 0.25
        self.cue = rng.random() < 0.85  # parts are named or have elements of their own

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, some):
        return some[int(self.rng.integers(len(some)))]

    def words(self, low: int, high: int, end: str = ".") -> str:
        n = int(np.exp(self.rng.uniform(np.log(low), np.log(high + 1))))
        out = []
        for k in range(n):
            size = int(self.rng.integers(1, 9)) if self.space else int(self.rng.integers(1, 4))
            word = "".join(self.letters[i] for i in self.rng.integers(len(self.letters), size=size))
            if k == 0 or self.chance(0.06):
                word = word[:1].upper() + word[1:]
            if self.chance(0.08):
                word += self.pick(",.,.;:!%#&")
            out.append(word)
        return self.space.join(out) + (end if self.chance(0.85) else "")

    def text(self, words: str, article: bool) -> str:
        return (MARK if article else "") + html.escape(words, quote=False)

    def attributes(self, kind: str, named: bool = True) -> str:
        out = ""
        if named:
            known = self.names[kind]
            name = self.pick(("-", "_", " ", "")).join(self.pick(known) for _ in range(self.pick((1, 1, 2))))
            if self.chance(0.3):
                name += self.pick(("-", " ", "_")) + self.pick(self.names["layout"])
            elif self.chance(0.3):
                name = self.pick(self.names["layout"]) + self.pick(("-", " ", "_")) + name
            elif self.chance(0.2):
                name += str(self.rng.integers(1, 99))
            out += f' {"id" if self.chance(0.25) else "class"}="{name}"'
        if kind in ROLES and self.chance(0.08):
            out += f' role="{ROLES[kind]}"'
        return out

    def part(self, kind: str, inside: str) -> str:
        """A part of the page: an element of its own, a name, or both."""
        tag = self.pick(SEMANTIC[kind])
        plain = tag in ("div", "section", "ul", "ol")
        named = (plain and (self.cue or kind in ("advert", "notice", "comments"))) or self.chance(0.5)
        if not self.cue and plain and kind in ("menu", "footer", "header"):
            tag = SEMANTIC[kind][0]
        if tag in ("ul", "ol"):
            tag = "div"
        return f"<{tag}{self.attributes(kind, named)}>{inside}</{tag}>"

    def wrapped(self, inside: str, most: int = 3) -> str:
        for _ in range(int(self.rng.integers(0, most + 1))):
            inside = f"<div{self.attributes('layout', self.chance(0.8))}>{inside}</div>"
        return inside

    def link(self, words: str, article: bool = False) -> str:
        return f'<a href="/{self.rng.integers(9999)}">{self.text(words, article)}</a>'

    def links(self, low: int, high: int) -> str:
        items = [self.link(self.words(1, 4, "")) for _ in range(int(self.rng.integers(low, high + 1)))]
        style = self.rng.integers(4)
        if style == 0:
            return self.pick((" | ", " ", " &middot; ")).join(items)
        if style == 1:
            return "".join(f"<div>{i}</div>" for i in items)
        return f"<ul{self.attributes('layout', self.chance(0.2))}>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"

    def prose(self, article: bool, low: int = 2, high: int = 120) -> str:
        """A paragraph, with phrasing elements inside at times."""
        out = self.text(self.words(low, high), article)
        if self.chance(0.2):
            out = f"<b>{out}</b>" if self.chance(0.5) else out + " " + self.link(self.words(1, 3, ""), article)
            out += " " + self.text(self.words(1, 20), article)
        if self.chance(0.1):
            out += "<br>" + self.text(self.words(1, 30), article)
        if article and self.unclosed and self.chance(0.4):
            return f"<p>{'<b>' if self.chance(0.5) else ''}{out}<br>"
        tag = "div" if self.chance(0.1 * self.odds[0]) else "p"
        return f"<{tag}>{out}</{tag}>"

    def small(self, kind: str) -> str:
        """A part that is no article: its texts look like those of an article at times."""
        r = self.rng
        if kind == "menu":
            return self.part(kind, self.links(2, 12))
        if kind == "header":
            logo = self.pick(("div", "h1", "span", "p", "h2"))
            inside = f"<{logo}>{self.link(self.words(1, 4, ''))}</{logo}>" if self.chance(0.8) else ""
            inside += f"<p>{self.text(self.words(2, 12), False)}</p>" if self.chance(0.4) else ""
            inside += self.small("menu") if self.chance(0.5) else ""
            inside += self.small("form") if self.chance(0.3) else ""
            return self.part(kind, inside or self.links(1, 4))
        if kind == "footer":
            inside = self.links(1, 10) if self.chance(0.5) else ""
            for _ in range(int(r.integers(0, 3))):
                inside += self.prose(False, 3, 60)
            mark = self.pick(("&copy; ", "&copy; 2021 ", "© ", "(c) ", ""))
            text = mark + self.text(self.words(2, 20), False)
            return self.part(kind, inside + (f"<p>{text}</p>" if self.chance(0.5) else text))
        if kind == "side":
            inside = ""
            for _ in range(int(r.integers(1, 4))):
                body = self.links(2, 8) if self.chance(0.6) else self.prose(False, 3, 60)
                inside += self.pick(("<h3>{}</h3>", "<h4>{}</h4>", "<h2>{}</h2>", "<p>{}</p>")).format(
                    self.text(self.words(1, 5, ""), False)
                )
                inside += f"<div>{body}</div>" if self.chance(0.4) else body
            return self.part(kind, inside)
        if kind in ("advert", "notice"):
            inside = self.text(self.words(2, 60), False)
            if self.chance(0.4):
                inside = "".join(self.prose(False, 2, 50) for _ in range(int(r.integers(1, 4))))
            if self.chance(0.4):
                inside += self.link(self.words(1, 4, ""))
            if kind == "notice" and self.chance(0.5):
                inside += f"<button>{self.text(self.words(1, 2, ''), False)}</button>"
            return self.part(kind, inside)
        if kind == "form":
            inside = f"<p>{self.text(self.words(2, 20), False)}</p>" if self.chance(0.6) else ""
            for _ in range(int(r.integers(1, 4))):
                inside += f"<label>{self.text(self.words(1, 3, ''), False)}</label><input type=\"text\">"
            inside += f"<button>{self.text(self.words(1, 2, ''), False)}</button>" if self.chance(0.6) else ""
            return self.part(kind, inside)
        if kind == "share":
            return self.part(kind, self.links(2, 5))
        # Comments read like an article; each has a name and often a link to answer.
        inside = f"<h3>{self.text(self.words(1, 4, ''), False)}</h3>" if self.chance(0.7) else ""
        named, tag = self.chance(0.7), self.pick(("div", "li", "article", "div"))
        for _ in range(int(r.integers(1, 8))):
            who = self.text(self.words(1, 2, ""), False)
            body = f"<div>{who}</div>" if self.chance(0.5) else f"<p><b>{who}</b></p>"
            body = body if self.chance(0.7) else ""
            for _ in range(int(r.integers(1, 3))):
                body += self.prose(False, 2, 80)
            body += self.link(self.words(1, 1, "")) if self.chance(0.4) else ""
            inside += f"<{tag}{self.attributes('comments', named)}>{body}</{tag}>"
        if self.chance(0.3):
            inside += self.small("form")
        return self.part(kind, inside)

    def article(self) -> str:
        r = self.rng
        out = []
        title = self.words(2, 15, "")
        if self.chance(0.85):
            tag = self.pick(("h1", "h1", "h1", "h2", "h3", "p"))
            head = f"<{tag}>{self.text(title, True)}</{tag}>"
            out.append(f"<header>{head}</header>" if self.chance(0.15) else head)
        between = [k for k in ("advert", "share", "side", "notice", "form") if self.chance(0.12)]
        for _ in range(int(np.exp(r.uniform(0, np.log(30))))):
            kind = r.random()
            if kind < 0.72:
                out.append(self.prose(True, 1 if self.chance(0.3) else 8, 150))
            elif kind < 0.80:
                tag = self.pick(("h2", "h3", "h4"))
                out.append(f"<{tag}>{self.text(self.words(1, 8, ''), True)}</{tag}>")
            elif kind < 0.87:
                tag = self.pick(("ul", "ol"))
                one = [
                    f"<li>{self.link(self.words(1, 6, ''), True) if self.chance(0.1) else self.text(self.words(1, 30), True)}"
                    for _ in range(int(r.integers(1, 7)))
                ]
                out.append(f"<{tag}>" + ("" if self.unclosed else "</li>").join(one) + f"</{tag}>")
            elif kind < 0.91:
                inside = self.prose(True, 4, 60) if self.chance(0.5) else self.text(self.words(4, 60), True)
                out.append(f"<blockquote>{inside}</blockquote>")
            elif kind < 0.94:
                rows = "".join(
                    "<tr>" + "".join(f"<td>{self.text(self.words(1, 5, ''), True)}</td>" for _ in range(3)) + "</tr>"
                    for _ in range(int(r.integers(1, 6)))
                )
                out.append(f"<table>{rows}</table>")
            elif kind < 0.97:
                caption = f"<figcaption>{self.text(self.words(2, 20), True)}</figcaption>"
                out.append(f'<figure><img src="/i.png">{caption}</figure>')
            else:
                out.append(f"<pre>{self.text(self.words(3, 40), True)}</pre>")
            if between and self.chance(0.25):
                out.append(self.small(self.pick(between)))
        if self.chance(0.1):
            # A part of sections, each with some of the article.
            cut = int(r.integers(0, len(out) + 1))
            out = [self.wrapped("".join(out[:cut]), 1), self.wrapped("".join(out[cut:]), 1)]
        inside = "".join(out)
        for kind, p in (("share", 0.1), ("comments", 0.12), ("side", 0.08), ("form", 0.05), ("menu", 0.04)):
            if self.chance(p):
                inside += self.small(kind)
        if self.chance(0.1):
            return inside  # stands in the page without an element of its own
        tag = self.pick(SEMANTIC["content"])
        named = tag == "div" or self.chance(0.4)
        if self.chance(0.25):
            inside = self.wrapped(inside, 2)
        return f"<{tag}{self.attributes('content' if self.chance(0.85) else 'layout', named)}>{inside}</{tag}>"

    def page(self) -> str:
        if self.chance(0.04):
            inside = self.article() if self.chance(0.7) else self.text(self.words(2, 100), True)
            return f"<html><body>{inside}</body></html>" if self.chance(0.5) else inside
        before = [k for k, p in (("notice", 0.2), ("header", 0.5), ("menu", 0.6), ("advert", 0.35), ("form", 0.1)) if self.chance(p)]
        after = [k for k, p in (("share", 0.1), ("comments", 0.3), ("side", 0.35), ("advert", 0.2), ("form", 0.12), ("notice", 0.1)) if self.chance(p)]
        article = self.article() if self.chance(0.95) else ""
        side = self.small("side") if self.chance(0.25) else ""
        middle = side + article if self.chance(0.5) else article + side
        for kind in after[:2]:
            middle += self.small(kind)
        middle = self.wrapped(middle)
        top = "".join(self.small(k) for k in before)
        low = "".join(self.small(k) for k in after[2:])
        low += self.small("footer") if self.chance(0.75) else ""
        low += self.small("notice") if self.chance(0.1) else ""
        body = self.wrapped(top + middle + low, 1) if self.chance(0.3) else top + middle + low
        if self.chance(0.1):
            body = f'<form id="page" method="post">{body}</form>'
        title = html.escape(self.words(2, 10, ""))
        end = "</body></html>" if self.chance(0.9) else ""
        return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{body}{end}"


def labelled_pages(n: int, seed: int = 3, names: dict[str, list[str]] | None = None) -> list[str]:
    """``n`` pages; ``MARK`` stands before every text of the article. Equal seeds give equal pages."""
    rng = np.random.default_rng(seed)
    names = names or {k: v.split() for k, v in NAMES.items()}
    return [_Writer(rng, names).page() for _ in range(n)]
