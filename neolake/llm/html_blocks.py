"""Leaf blocks of web pages: runs of text between block-level tags, with what stands above them.

Scripts, styles and what only a browser without the element would show (in
frames, media and templates) are no text of the page; nor are the letters of a
drawing, which stand at places of a picture and make no sentence, and on most
pages belong to icons. All else,
``noscript`` and formulas among them, is left for the field to judge. What is
kept for an open element doesn't grow with its depth.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

# Element names of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mspace mpadded mphantom semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe noembed noframes svg canvas audio video".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
LOOK = frozenset("b i em strong span a u small".split())
PLAIN = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre code table thead tbody tr td th figure figcaption b i em strong a span u small sub sup".split())
SCOPES = frozenset("article aside body div footer form header html main nav ol section table td th tr ul".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"'<]|"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>]))*+(?=>|\Z)|[^>]*)(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|itemprop|aria-label|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_SPLIT = re.compile(r"[^a-z]+")


class Above(NamedTuple):
    """The elements above a block: all their names once, the two innermost that structure a text, whether one is an article, and whether all (below that) are plain."""

    names: frozenset[str] = frozenset()
    at: str = ""
    outer: str = ""
    article: bool = False
    plain: bool = True

    def below(self, own: tuple[str, ...], known: frozenset[str] | None) -> Above:
        """With one more element, by its tag and names; of these only ``known`` ones are kept."""
        new = [x for x in own if x not in self.names and (known is None or x in known)]
        names = self.names.union(new) if new else self.names
        at, outer = (self.at, self.outer) if own[0] in LOOK else (own[0], self.at)
        top = own[0] in ("article", "main")
        plain = len(own) == 1 if top else self.plain and (own[0] == "body" or len(own) == 1 and own[0] in PLAIN)
        return Above(names, at, outer, self.article or top, plain)


@dataclass(slots=True)
class Block:
    text: str
    above: Above
    link_chars: int


def _names(attrs: str) -> tuple[str, ...]:
    """Words of class, id and role: as they are, and joined words in parts."""
    out = []
    for key, value in _ATTR.findall(attrs):
        if key.lower() == "hidden":
            out.append(".hidden")
            continue
        value = re.sub(r"([a-z])([A-Z])", r"\1-\2", html.unescape(value.strip("\"'"))).lower()
        out += ["." + w for w in _SPLIT.split(value) if len(w) > 1]
    return tuple(out)


def blocks(page: str | None, known: frozenset[str] | None = None) -> list[Block]:
    """Blocks with text, in page order, with the ``known`` names above them (default: all).

    Broken markup never fails: an open element ends with its parent or the page.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, Above]] = []
    opened: Counter[str] = Counter()
    root = Above()
    parts: list[str] = []
    links, anchors, path = 0, 0, None
    pos, n = 0, len(page)
    names: dict[str, tuple[str, ...]] = {}

    def flush() -> None:
        nonlocal parts, links, path
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, path or root, links))
        parts, links, path = [], 0, None

    def add(raw: str, plain: bool = False) -> None:
        nonlocal links, path
        if not raw:
            return
        text = raw if plain else html.unescape(raw)
        parts.append(text)
        if path is None and not text.isspace():
            path = stack[-1][1] if stack else root
        if anchors:
            links += len(text.strip())

    while pos < n:
        m = _TOKEN.search(page, pos)
        if m is None:
            add(page[pos:])
            break
        add(page[pos : m.start()])
        pos = m.end()
        name = m.group("name")
        if name is None:
            if m.group("data") is not None:
                add(m.group("data"), True)
            continue
        name = name.lower()
        if m.group("end"):
            if name == "br":
                add(" ", True)
                continue
            if name not in INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[i][0] == name:
                    for gone, _ in stack[i:]:
                        opened[gone] -= 1
                        if gone == "a":
                            anchors -= 1
                        if gone not in INLINE:
                            flush()
                    del stack[i:]
                    break
                if name in INLINE and stack[i][0] not in INLINE or name == "p" and stack[i][0] in SCOPES:
                    break  # an end tag without its element
            continue
        attrs = m.group("attrs") or ""
        if name in RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else n
            if name not in INLINE:
                flush()
            continue
        if name == "br":
            add(" ", True)
            continue
        if name not in INLINE:
            flush()
        if name in CLOSES_P or name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            mine = ("p",) if name in CLOSES_P else (name, "p")
            for i in range(len(stack) - 1, -1, -1) if any(opened[x] for x in mine) else ():
                if stack[i][0] in mine:
                    anchors -= sum(x == "a" for x, _ in stack[i:])
                    opened.subtract(x for x, _ in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in SCOPES or stack[i][0] in ("button", "caption", "figure", "blockquote"):
                    break
        if name in VOID or attrs.endswith("/") and name not in INLINE and name not in CLOSES_P:
            continue
        above = stack[-1][1] if stack else root
        key = name + "\0" + attrs
        own = names.get(key)
        if own is None:
            own = names[key] = (name, *(_names(attrs) if attrs else ()))
        stack.append((name, above.below(own, known)))
        opened[name] += 1
        anchors += name == "a"
    flush()
    return out
