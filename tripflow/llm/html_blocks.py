"""Blocks of text of an HTML page, with the role their place gives them.

A small tolerant reader: comments, raw-text elements, quoted attributes,
unclosed and stray tags.  Elements that only mark text (b, a, span ...) are
not tracked unless their class or role says that they are not content.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Roles of an element, the higher the surer it is the article; text of the
# first is left out.
CHROME, PLAIN, CONTENT, MAIN, ARTICLE = -1, 0, 1, 2, 3


class Block(NamedTuple):
    role: int
    text: str
    linked: int  # characters of it inside links


# One markup token: comment, declaration or tag.  A quoted value may hold ">";
# one that is not closed within QUOTE characters is no quotation.
QUOTE = 65_536
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]{0,%d}+\"|'[^']{0,%d}+'|[\"'])*+)(?:>|\Z)" % (QUOTE, QUOTE),
    re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Text in these is never content; the first five hold raw text up to their own end tag.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
DROPPED = {"nav", "footer", "aside", "form", "menu", "noscript", "template", "svg", "math", "button", "select",
           "object", "canvas", "audio", "video", "dialog", "head", "fieldset", "datalist", "map", "applet"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
        "frame", "keygen", "basefont", "bgsound"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
         "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CONTAINERS = BLOCK - {"p"}
# A new one ends an open one of the same list, up to the container named.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Words of a class, id or role that say an element is not the article.
ASIDE = frozenset("""
    nav navbar navigation menu menubar submenu breadcrumb breadcrumbs sidebar sidebars rail footer masthead banner
    ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promos promotion promoted
    cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay lightbox
    newsletter subscribe subscription signup signin login register share sharing social related recommended
    recommendations comment comments commentlist disqus reply replies respond reviews discussion pagination pager
    toolbar widget widgets search skip hidden copyright legal disclaimer complementary contentinfo dialog
    teaser teasers trending popular toc feedback survey donate paywall form""".split())
HEADER = frozenset(["header", "topbar"])  # outside the content only,
TITLED = frozenset("article post entry story".split())  # unless it is that of an article
BODY = frozenset("article post entry story content body text main".split())
UNMARKED = {"html", "body", "main", "article"}  # classes of these describe the page


class _Open(NamedTuple):
    tag: str
    role: int
    linked: bool


def _words(value: str) -> list[str]:
    out = []
    for name in value.split():
        words = [w.lower() for w in WORD.findall(name)]
        if words and words[0] not in ("has", "no", "with", "without", "not", "is"):
            out += words
    return out


def _role(tag: str, attributes: str, parent: int) -> int:
    """The role of an element inside one with the role of its parent."""
    if parent == CHROME or tag in DROPPED:
        return CHROME
    role = {"article": ARTICLE, "main": MAIN}.get(tag, PLAIN)
    if tag == "header" and parent == PLAIN:
        return CHROME
    if attributes and not attributes.isspace():
        named = {k.lower(): (v[1:-1] if v[:1] in "\"'" and v else v) for k, v in ATTRIBUTE.findall(attributes)}
        if "hidden" in named or named.get("aria-hidden") == "true" or re.search(
                r"display\s*:\s*none|visibility\s*:\s*hidden", named.get("style", "")):
            return CHROME
        if named.get("role") in ("navigation", "banner", "search", "alert", "alertdialog") and tag not in UNMARKED:
            return CHROME
        words = set(_words(" ".join(unescape(named.get(a, "")) for a in ("class", "id", "role"))))
        if tag not in UNMARKED and (words & ASIDE or parent == PLAIN and words & HEADER and not words & TITLED):
            return CHROME
        if "articleBody" in named.get("itemprop", "") or named.get("role") == "article":
            role = max(role, ARTICLE)
        elif named.get("role") == "main":
            role = max(role, MAIN)
        elif words & BODY and tag not in ("html", "body") and tag in BLOCK:
            role = max(role, CONTENT)
    return max(role, parent)


class _Reader:
    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[_Open] = [_Open("", PLAIN, False)]
        self.count: dict[str, int] = {}
        self.text: list[str] = []
        self.linked = 0
        self.role = PLAIN

    def flush(self) -> None:
        text = " ".join(unescape("".join(self.text)).split())
        if text:
            self.blocks.append(Block(self.role, text, min(self.linked, len(text))))
        self.text, self.linked, self.role = [], 0, PLAIN

    def characters(self, text: str) -> None:
        top = self.open[-1]
        if top.role == CHROME:
            return
        if not text.isspace():
            self.role = max(self.role, top.role)
        self.text.append(text)
        if top.linked:
            self.linked += len(text)

    def pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def close(self, tags: set[str], limits: set[str]) -> None:
        """End the nearest open element of these, inside the containers named."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i].tag in limits:
                return

    def start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCK
        if block:
            self.flush()
            if self.count.get("p") and tag not in ("html", "body", "option", "optgroup", "legend", "summary"):
                self.close({"p"}, CONTAINERS)
            if tag in CLOSES and any(self.count.get(t) for t in CLOSES[tag][0]):
                self.close(*CLOSES[tag])
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        top = self.open[-1]
        role = _role(tag, attributes, top.role)
        linked = top.linked or tag == "a"
        if block or role != top.role or linked != top.linked or tag in DROPPED:
            self.open.append(_Open(tag, role, linked))
            self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.count.get(tag):
            # an end tag of marked text does not end the block around it
            self.close({tag}, set() if tag in BLOCK else BLOCK)


def blocks(html: str) -> list[Block]:
    """The blocks of text in page order; white space collapsed, none empty."""
    reader, at, size = _Reader(), 0, len(html)
    while at < size:
        less = html.find("<", at)
        if less < 0:
            reader.characters(html[at:])
            break
        if less > at:
            reader.characters(html[at:less])
        token = TOKEN.match(html, less)
        if token is None:
            reader.characters("<")
            at = less + 1
            continue
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            reader.end(tag)
        elif tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(html, at)
            at = stop.end() if stop else size
        elif tag == "plaintext":
            reader.characters(html[at:])
            break
        else:
            reader.start(tag, token[3] or "")
    reader.flush()
    return reader.blocks
