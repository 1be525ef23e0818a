"""HTML to leaf blocks, and labelled pages to learn from; used by ``html_extract.py``."""

from __future__ import annotations

import html as references
import random
import re
from dataclasses import dataclass

#: Element names as the HTML standard groups them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search
section select summary table tbody td template tfoot th thead tr ul""".split())
HIDDEN = frozenset("script style textarea title iframe noembed noframes svg template".split())
#: Of these, the elements that hold other elements, not raw text.
NESTED = frozenset("svg template".split())
SECTIONS = frozenset("article main nav aside footer header form section".split())
#: An element that opens closes an open one of these kinds (up to the stop).
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
          "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}),
          "option": ({"option"}, {"select"})}

_OPEN = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
_OPEN_LOOSE = re.compile(r"<([a-zA-Z][^\s/>]*+)([^>]*+)>")
_CLOSE = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+>")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Place:
    """Where blocks stand: the names that an element adds to its ancestors'."""

    __slots__ = ("up", "name", "new", "sections")

    def __init__(self, up: Place | None, name: str, new: frozenset, sections: tuple):
        self.up, self.name, self.new, self.sections = up, name, new, sections


@dataclass
class Block:
    """A leaf block: its text, the characters of it in links, and where it stands."""

    text: str
    linked: int
    place: Place

    @property
    def parent(self) -> str:
        return self.place.name

    @property
    def sections(self) -> tuple:
        """The two nearest sectioning ancestors, innermost first."""
        return self.place.sections

    @property
    def around(self) -> frozenset:
        """t=<tag> and c=<class, id or role token> of all ancestors."""
        out: set = set()
        at = self.place
        while at is not None:
            out |= at.new
            at = at.up
        return frozenset(out)


class Open:
    """The open elements.  Names are counted and found by position, so neither
    depth nor stray tags cost more than their own number."""

    def __init__(self) -> None:
        self.stack = [Place(None, "", frozenset(), ())]
        self.at: dict[str, list[int]] = {}  # positions of the open elements of a name
        self.held: set[str] = set()  # names around the innermost element

    def nearest(self, names) -> int:
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=0)

    def push(self, name: str, names: set[str]) -> None:
        up = self.stack[-1]
        new = frozenset(names - self.held)
        self.held |= new
        self.at.setdefault(name, []).append(len(self.stack))
        self.stack.append(Place(up, name, new, (name, *up.sections[:1]) if name in SECTIONS else up.sections))

    def cut(self, to: int) -> None:
        """Close the element at position ``to`` and all in it."""
        while to and len(self.stack) > to:
            last = self.stack.pop()
            self.held -= last.new
            self.at[last.name].pop()


def _ends(html: str, name: str) -> dict[int, int]:
    """Of each ``name`` element that is closed: where its tag starts -> its end."""
    out, waiting = {}, []
    for m in re.compile(f"<(/?){name}(?=[\\s/>])[^>]*>", re.I).finditer(html):
        if not m[1]:
            if not m[0].endswith("/>"):
                waiting.append(m.start())
        elif waiting:
            out[waiting.pop()] = m.end()
    return out


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page in order; scripts, styles, comments and form
    fields are no text, formulas, objects and listings (xmp) are.  Text after a
    tag that never ends is part of the tag.  An svg or template goes with all
    that is nested in it; of one that never ends, the tag alone is left out.
    Time and memory grow with the page's length, however deep it is."""
    out: list[Block] = []
    opened = Open()
    ends: dict[str, dict[int, int]] = {}
    parts: list[str] = []
    linked, in_link, p, n = 0, False, 0, len(html)

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, opened.stack[-1]))
            parts.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = references.unescape(text)
        parts.append(text)
        if in_link:
            linked += len(text)

    while p < n:
        lt = html.find("<", p)
        if lt < 0:
            add(html[p:])
            break
        if lt > p:
            add(html[p:lt])
        after = html[lt + 1:lt + 2]
        if after == "/":
            m = _CLOSE.match(html, lt)
            if not m:
                end = html.find(">", lt)
                if end < 0:
                    break
                p = end + 1
                continue
            name, p = m[1].lower(), m.end()
            if name == "a":
                in_link = False
            elif name in BLOCK:
                end_block()
                opened.cut(opened.nearest((name,)))
        elif after.isascii() and after.isalpha():
            m = _OPEN.match(html, lt) or _OPEN_LOOSE.match(html, lt)
            if not m:
                break
            name, p = m[1].lower(), m.end()
            if name in NESTED:
                if not m[2].endswith("/"):
                    if name not in ends:
                        ends[name] = _ends(html, name)
                    p = max(p, ends[name].get(lt, p))
                continue
            if name in HIDDEN:
                if not m[2].endswith("/") or name in ("script", "style", "textarea", "title"):
                    close = re.compile(f"</{name}[^>]*>", re.I).search(html, p)
                    p = close.end() if close else n
                continue
            if name == "xmp":  # raw text: its tags and references are written out
                close = re.compile("</xmp[^>]*>", re.I).search(html, p)
                parts.append(html[p:close.start() if close else n])
                if in_link:
                    linked += len(parts[-1])
                p = close.end() if close else n
                continue
            if name == "br":
                parts.append(" ")
            elif name == "a":
                in_link = True
            elif name in BLOCK:
                end_block()
                in_link = False
                if name == "hr":
                    continue
                if opened.stack[-1].name == "p":
                    opened.cut(len(opened.stack) - 1)
                own, stop = CLOSES.get(name, ((), ()))
                if (k := opened.nearest(own)) > opened.nearest(stop):
                    opened.cut(k)
                names = {f"t={name}"}
                for a, b, c in _NAMES.findall(m[2]) if m[2] else ():
                    names.update(f"c={t}" for t in _TOKEN.findall(_HUMP.sub(" ", a or b or c).lower()) if len(t) <= 20)
                opened.push(name, names)
        elif html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            p = end + 3 if end >= 0 else n
        elif after in ("!", "?"):
            end = html.find(">", lt)
            p = end + 1 if end >= 0 else n
        else:
            add("<")
            p = lt + 1
    end_block()
    return out


# -- labelled pages -------------------------------------------------------------

MARK = ""  # stands before the text of a block to keep

#: How sites name the parts of a page, by part: (tags, class and id names).
PARTS = {
    "nav": (["nav", "div", "ul", "header"], "nav menu navbar navigation breadcrumbs breadcrumb topnav main-menu site-nav tabs pagination toc".split()),
    "header": (["header", "div"], "header site-header masthead topbar top-bar branding logo page-header hero-banner".split()),
    "footer": (["footer", "div"], "footer site-footer copyright legal colophon bottom page-footer credits".split()),
    "aside": (["aside", "div", "section"], "sidebar widget related recommended popular trending more-stories side-bar rail teaser see-also".split()),
    "ad": (["div", "aside", "section", "p"], "ad ads advert advertisement sponsored promo promotion banner ad-slot adbox partner-content".split()),
    "notice": (["div", "section", "dialog", "p"], "cookie-notice cookie consent gdpr notice alert popup modal newsletter subscribe paywall announcement cookie-banner".split()),
    "form": (["form", "div"], "search login signup contact-form search-form subscribe-form register feedback".split()),
    "comments": (["section", "div", "ol", "aside"], "comments comment comment-list respond discussion replies reader-comments disqus responses user-comments".split()),
    "share": (["div", "ul"], "share social social-links share-buttons follow tags tag-list".split()),
}
BODY = (["article", "main", "div", "section", "article", "article"], ["content", "post", "entry", "article-body", "story", "post-content", "entry-content", "article", "main-content", "text", "", "", "", ""])
WRAP = ["page", "wrapper", "container", "site", "layout", "row", "col", "inner", "", ""]
BUTTONS = ["OK", "Search", "Send", "Log in", "Sign up", "Subscribe", "Submit", "Share", "Reply", "Accept", "Close"]


class PageMaker:
    """Pages laid out from given paragraphs and phrases, their body blocks marked."""

    def __init__(self, paragraphs: list[str], phrases: list[str], seed: int = 11):
        self.r = random.Random(seed)
        self.paragraphs = paragraphs or ["a plain sentence of some words, as a page may hold."]
        self.phrases = phrases or ["home"]

    def _text(self, long: bool) -> str:
        r = self.r
        t = r.choice(self.paragraphs if long else self.phrases)
        if not long:
            w = t.split()
            t = " ".join(w[:r.randint(1, 6)])
        elif r.random() < 0.3:  # some paragraphs are short
            w = t.split()
            t = " ".join(w[:r.randint(1, 8)]) + "."
        return references.escape(t, quote=False)

    def _name(self, names: list[str]) -> str:
        r = self.r
        pick = r.choice(names)
        if not pick or r.random() < 0.15:
            return ""
        return f' {r.choice(["class", "class", "class", "id", "role"])}="{pick}{r.choice(["", "", " box", " clearfix"])}"'

    def _wrapped(self, tag: str, names: list[str], inner: str) -> str:
        return f"<{tag}{self._name(names)}>{inner}</{tag}>"

    def part(self, kind: str) -> str:
        r = self.r
        tags, names = PARTS[kind]
        tag = r.choice(tags)
        link = lambda: f'<a href="/{r.randint(1, 99)}">{self._text(False)}</a>'
        if kind in ("nav", "share") or kind == "aside" and r.random() < 0.5:
            items = [link() for _ in range(r.randint(2, 8))]
            inner = "".join(f"<li>{x}</li>" for x in items) if r.random() < 0.7 else r.choice([" ", " | "]).join(items)
            inner = inner if tag == "ul" or not inner.startswith("<li>") else f"<ul>{inner}</ul>"
            if kind == "aside":
                inner = f"<h3>{self._text(False)}</h3>{inner}"
        elif kind == "header":
            inner = r.choice(["<h1>{}</h1>", "<div>{}</div>", "<p>{}</p>", "{}"]).format(r.choice([link(), self._text(False)]))
        elif kind == "footer":
            inner = r.choice(["&copy; {} &middot; {}", "<p>&copy; {}</p><p>{}</p>", "{} {}"]).format(self._text(False), self._text(r.random() < 0.5))
        elif kind == "form":
            inner = (f"<label>{self._text(False)}</label><input type=text><textarea>{self._text(False)}</textarea>"
                     f"<p>{self._text(False)}</p><button>{r.choice(BUTTONS)}</button>")
        elif kind == "comments":
            each = [f"<h3>{self._text(False)}</h3>"] * r.randint(0, 1)
            each += [r.choice(["<div class=\"comment\"><b>{}</b><p>{}</p></div>", "<li class=\"comment\"><p>{1}</p></li>", "<p>{1}</p>"]).format(self._text(False), self._text(True))
                     for _ in range(r.randint(1, 6))]
            inner = "".join(each)
        else:  # adverts and notices, asides of text
            inner = r.choice(["{}", "<p>{}</p>", "<p>{}</p><a href=/x>{}</a>", "<div>{}</div><button>{}</button>"]).format(
                self._text(r.random() < 0.7), r.choice([self._text(False), r.choice(BUTTONS)]))
        if tag == "p":  # it holds no block
            inner = self._text(r.random() < 0.7)
        named = self._name(names)
        while not named and tag in ("div", "p", "section", "ul", "ol", "dialog"):
            named = self._name(names)  # a plain element needs its name to be told apart
        return f"<{tag}{named}>{inner}</{tag}>"

    def body(self) -> str:
        r = self.r
        tags, names = BODY
        tag = r.choice(tags)
        out = [f"<h1>{MARK}{self._text(r.random() < 0.5)}</h1>"]
        if r.random() < 0.25:
            out[0] = f"<header>{out[0]}</header>"
        for _ in range(r.choice([0, 1, 2, 4, 8, 14])):
            kind, t = r.random(), self._text(True)
            if kind < 0.7:
                out.append(f"<p>{MARK}{t}{r.choice(['</p>', '</p>', '</p>', '', '<br>'])}")
            elif kind < 0.78:
                out.append(f"<{(h := r.choice(['h2', 'h3']))}>{MARK}{self._text(False)}</{h}>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{MARK}{self._text(r.random() < 0.5)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.88:
                out.append(f"<blockquote>{MARK}{t}</blockquote>")
            elif kind < 0.91:
                out.append(f"<pre>{MARK}{t}</pre>")
            elif kind < 0.94:
                out.append(f"<figure><img src=x><figcaption>{MARK}{self._text(False)}</figcaption></figure>")
            elif kind < 0.97:
                out.append(f"<p><b>{MARK}{t}<br>")
            else:
                out.append("<table><tr>" + "".join(f"<td>{MARK}{self._text(False)}</td>" for _ in range(r.randint(1, 4))) + "</tr></table>")
            if r.random() < 0.06:
                out.append(self.part(r.choice(["ad", "aside", "form", "share", "notice"])))
        if r.random() < 0.1:
            out.append(self.part("comments"))
        named = ""
        while tag in ("div", "section") and not named:
            named = self._name([x for x in names if x])
        return f"<{tag}{named or self._name(names)}>{''.join(out)}</{tag}>"

    def page(self) -> str:
        r = self.r
        before = [self.part(k) for k in ("notice", "header", "nav", "ad", "form") if r.random() < {"nav": 0.7, "header": 0.4}.get(k, 0.25)]
        after = [self.part(k) for k in ("share", "comments", "aside", "ad", "form", "notice", "footer") if r.random() < {"footer": 0.8, "comments": 0.35, "aside": 0.35}.get(k, 0.2)]
        inner = "".join([*before, self.body(), *after])
        for _ in range(r.randint(0, 2)):
            inner = self._wrapped("div", WRAP, inner)
        page = f"<!DOCTYPE html><html><head><title>{self._text(False)}</title></head><body>{inner}</body></html>"
        return page[:r.randint(len(page) // 2, len(page))] if r.random() < 0.1 else page


def labelled(page: str) -> tuple[list[Block], list[int]]:
    """Blocks of a marked page, and which of them to keep."""
    found = blocks(page)
    keep = [int(MARK in b.text) for b in found]
    for b in found:
        b.text = " ".join(b.text.replace(MARK, "").split())
    kept = [(b, k) for b, k in zip(found, keep) if b.text]
    return [b for b, _ in kept], [k for _, k in kept]
