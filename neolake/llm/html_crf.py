"""HTML extraction by a linear-chain conditional random field over the leaf blocks of pages.

Blocks are labelled as main text or not. Features are the tags and class words
above a block and what its text looks like; neighbours' labels are tied by
transition weights. The field is trained on labelled pages that are composed
here by rule, and decoded by Viterbi.
"""

from __future__ import annotations

import functools
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import slices
from .html_blocks import Above, Block, blocks

#: Labelled pages, their seed, and the training's steps.
PAGES, SEED, STEPS, L2 = 1500, 11, 150, 0.1
#: Names on fewer pages get no weight.
PAGES_OF_NAME = 3


def features(b: Block, marked: bool) -> list[str]:
    """Names above the block, each once with its kind, the innermost tags, whether plain elements hold it, and where it is in a page that has an article (``marked``)."""
    x = b.above
    out = {"in:" + name for name in x.names if name not in ("html", "body")}
    out.add("at:" + x.at)
    out.add("pair:" + (x.outer + ">" + x.at if x.outer else x.at))
    if x.plain:
        out.add("plain in article" if x.article else "plain" if not marked else "plain outside")
    if marked and not x.article:
        out.add("outside")
    if not marked:
        out.add("at:" + x.at + " unmarked")
    return sorted(out)


def is_marked(page: list[Block]) -> bool:
    """Some block of the page stands in an article or main element."""
    return any(b.above.article for b in page)


def shape(b: Block) -> list[str]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    out = [f"words:{min(words.bit_length(), 7)}", f"links:{min(4, 4 * b.link_chars // max(1, n))}"]
    if b.text[-1] in ".!?…\"”»:":
        out.append("ends")
    if b.text[0] in "©" or "©" in b.text:
        out.append("rights")
    return out


# --- labelled pages -------------------------------------------------------------

# Class and id words of common page templates, by what they mark.
MENU = "nav menu navbar navigation breadcrumb breadcrumbs topnav pagination pager tabs toc skip".split()
TOP = "header banner masthead site-header topbar logo branding".split()
BOTTOM = "footer site-footer copyright colophon legal bottom".split()
SIDE = "sidebar aside related widget recommended popular trending more-stories rail secondary tags".split()
NOTICE = "cookie notice consent gdpr alert popup modal banner-message newsletter subscribe signup warning disclaimer paywall".split()
ADVERT = "ad ads advert advertisement sponsored promo sponsor adsense ad-slot banner-ad commercial".split()
FORM = "form search login contact-form search-form".split()
COMMENT = "comments comment comment-list reply replies discussion respond disqus reader-comments comment-body user-comment".split()
SHARE = "share social social-share byline-share follow toolbar actions".split()
MAIN = "content article post entry main story body-text article-body post-content entry-content main-content page-content text article-content".split()


class Composer:
    """Composes pages with a label for each block."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice("bcdfglmnprstv") + self.r.choice("aeiou") for _ in range(self.r.randint(1, 4)))

    def text(self, lo: int, hi: int, stop: bool = True) -> str:
        t = " ".join(self.word() for _ in range(self.r.randint(lo, hi))).capitalize()
        return t + (self.r.choice("....!?") if stop else "")

    def joined(self, word: str) -> str:
        """A class word by itself, or joined to one that says nothing, or to one that main text has as well."""
        k = self.r.random()
        other = self.r.choice([self.word(), self.r.choice(MAIN)]) if k > 0.6 else ""
        return word if k <= 0.6 else f"{word}-{other}" if k < 0.85 else f"{other}-{word}"

    def loose(self) -> str:
        """The attributes of an element of the main text: mostly none, or words that say nothing, or joined to those of clutter."""
        k = self.r.random()
        if k < 0.8:
            return ""
        clutter = self.r.choice(self.r.choice([MENU, TOP, SIDE, NOTICE, ADVERT, FORM, COMMENT, SHARE]))
        value = f"{self.word()} {self.word()}" if k < 0.88 else f"{clutter}-{self.word()}" if k < 0.95 else f"{self.word()}-{clutter}"
        return f' {self.r.choice(["class", "class", "id"])}="{value}"'

    def name(self, words: list[str]) -> str:
        q = self.r.choice(['"', "'"])
        return f" {self.r.choice(['class', 'class', 'id'])}={q}{self.joined(self.r.choice(words))}{self.r.choice(['', '', ' ' + self.word()])}{q}" if self.r.random() < 0.9 else ""

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.text(1, 3, False)}</a></li>' for _ in range(n))

    def menu(self) -> str:
        x = "<ul>" + self.links(self.r.randint(2, 8)) + "</ul>"
        return f"<nav{self.name(MENU)}>{x}</nav>" if self.r.random() < 0.6 else f'<div{self.r.choice([f""" class="{self.joined(self.r.choice(MENU))}\"""", f""" class="{self.word()}\""""])}>{x}</div>'

    def top(self) -> str:
        tag = self.r.choice(["header", "header", "div"])
        return f'<{tag} class="{self.joined(self.r.choice(TOP))}">{self.r.choice(["<h1>", "<p>", "<span>", "<div>"])}{self.text(1, 6, False)}{self.menu() if self.r.random() < 0.5 else ""}</{tag}>'

    def bottom(self) -> str:
        tag = self.r.choice(["footer", "footer", "div"])
        name = f' class="{self.joined(self.r.choice(BOTTOM))}"' if tag == "div" else self.name(BOTTOM)
        return f"<{tag}{name}>{self.r.choice(['&copy; 2020 ', 'Copyright ', ''])}{self.text(1, 12)}{'<p>' + self.text(3, 12) + '</p>' if self.r.random() < 0.4 else ''}</{tag}>"

    def boxed(self, words: list[str], tags: list[str], lo: int, hi: int) -> str:
        tag = self.r.choice(tags)
        name = "" if tag in ("aside", "form", "dialog") and self.r.random() < 0.5 else f' {self.r.choice(["class", "class", "id"])}="{self.joined(self.r.choice(words))}"'
        if tag == "p":  # holds no block
            return f"<p{name}>{self.text(lo, hi)}</p>"
        body = self.text(lo, hi) if self.r.random() < 0.4 else "".join(f"<p>{self.text(lo, hi)}</p>" for _ in range(self.r.randint(1, 3)))
        return f"<{tag}{name}>{'<h3>' + self.text(1, 3, False) + '</h3>' if self.r.random() < 0.3 else ''}{body}</{tag}>"

    def side(self) -> str:
        if self.r.random() < 0.4:
            return f'<aside{self.name(SIDE)}><h3>{self.text(1, 3, False)}</h3><ul>{self.links(3)}</ul></aside>'
        return self.boxed(SIDE, ["aside", "aside", "div", "section"], 3, 25)

    def form(self) -> str:
        return f'<form{self.name(FORM)}><label>{self.text(1, 4, False)}</label><input name="q"><p>{self.text(2, 12)}</p><button>{self.text(1, 2, False)}</button><select><option>{self.word()}<option>{self.word()}</select></form>'

    def comments(self) -> str:
        outer = self.r.choice(["section", "div", "ol", "ul", "aside"])
        inner = self.r.choice(["div", "article", "p", "li"]) if outer not in ("ol", "ul") else "li"
        one = lambda: f'<{inner} class="{self.joined(self.r.choice(COMMENT))}">{"<b>" + self.word() + "</b> " if self.r.random() < 0.4 else ""}{self.text(3, 40)}</{inner}>'
        return f'<{outer} {self.r.choice(["class", "id"])}="{self.joined(self.r.choice(COMMENT))}">{"<h2>" + self.text(1, 2, False) + "</h2>" if self.r.random() < 0.5 else ""}{"".join(one() for _ in range(self.r.randint(1, 5)))}</{outer}>'

    def clutter(self) -> str:
        k = self.r.randint(0, 6)
        if k == 0:
            return self.boxed(ADVERT, ["div", "div", "aside", "section", "p"], 1, 25)
        if k == 1:
            return self.boxed(NOTICE, ["div", "div", "aside", "section", "dialog", "p"], 3, 25)
        return (self.menu, self.form, self.side, lambda: self.boxed(SHARE, ["div", "ul", "p"], 1, 5), self.comments)[k - 2]()

    def paragraph(self) -> str:
        k = self.r.random()
        t = self.text(2, 80) if k < 0.8 else self.text(1, 6)
        if k < 0.12:
            return f"<{self.r.choice(['h2', 'h2', 'h3'])}{self.loose()}>{self.text(1, 8, False)}</h2></h3>"
        if k < 0.18:
            return f"<ul>{''.join(f'<li>{self.text(1, 20)}</li>' for _ in range(3))}</ul>"
        if k < 0.22:
            return f"<blockquote><p>{t}</p></blockquote>"
        if k < 0.25:
            return f"<table><tr><td>{self.text(1, 4, False)}</td><td>{self.text(1, 4, False)}</td></tr></table>"
        if k < 0.28:
            return f"<pre><code>{t}</code></pre>"
        if k < 0.31:
            return f"<figure><img src=x><figcaption>{t}</figcaption></figure>"
        if k < 0.4:
            return f"<p><b>{t}<br>{self.text(2, 9)}"
        if k < 0.5:
            return f'<p>{t} <a href="/x">{self.text(1, 3, False)}</a> {self.text(2, 9)}</p>'
        if k < 0.55:
            return f"<div{self.loose()}>{t}</div>"
        return f"<p{self.loose()}>{t}</p>"

    def around(self) -> tuple[str, str, bool]:
        """What opens and closes the main text, and whether it has a heading: an article or main element, a class of such pages, or any element whose names say nothing."""
        kind = self.r.random()
        if kind < 0.3:
            before, after = f"<article{self.name(MAIN) if self.r.random() < 0.3 else ''}>", "</article>"
            return ("<main>" + before, after + "</main>", True) if self.r.random() < 0.3 else (before, after, True)
        if kind < 0.4:
            return "<main>", "</main>", True
        if kind < 0.55:
            return f'<div {self.r.choice(["class", "class", "id"])}="{self.joined(self.r.choice(MAIN))}">', "</div>", True
        headed = self.r.random() < 0.6
        if kind < 0.65:
            return "", "", headed
        if kind < 0.72:
            return "<table><tr><td>", "</td></tr></table>", headed
        before, after = "", ""
        for _ in range(self.r.randint(1, 3)):
            tag = self.r.choice(["div", "div", "section"])
            name = self.r.choice(["", f' class="{self.word()}"', f' class="{self.word()}-{self.word()}"', f' id="{self.word()}"'])
            before, after = before + f"<{tag}{name}>", f"</{tag}>" + after
        return before, after, headed

    def page(self) -> tuple[str, list[tuple[str, int]]]:
        """A page as pieces of markup, each with the label of its blocks."""
        pieces: list[tuple[str, int]] = []
        bare = self.r.random() < 0.2  # nothing but the main text, or little after it
        if not bare:
            pieces += [("<!DOCTYPE html><html><head><title>", 0), (self.text(2, 9, False) + "</title><style>p{}</style><script>var a='<p>';</script></head>", 0)]
        pieces.append((self.r.choice(["<body>", "<body>", f'<body class="{self.word()}">']), 0))
        add = lambda x, y=0: pieces.append((x, y))
        if not bare and self.r.random() < 0.6:
            add(self.top())
        for _ in range(0 if bare else self.r.randint(0, 3)):
            add(self.clutter())
        before, after, headed = self.around()
        add(before)
        if headed:
            add(f"<h1{self.loose()}>{self.text(1, 12, False)}</h1>" if self.r.random() < 0.85 else f"<header><h1>{self.text(1, 12, False)}</h1></header>", 1)
        for _ in range(self.r.randint(1, 12)):
            add(self.paragraph(), 1)
            if self.r.random() < 0.25:
                add("</b></p>" + self.clutter())
        add("</b></p>")
        if self.r.random() < 0.2:
            add(self.comments())
        add(after)
        for _ in range(self.r.randint(0, 3)):
            add(self.comments() if self.r.random() < 0.4 else self.clutter())
        if self.r.random() < 0.8:
            add(self.bottom())
        add("</body></html>")
        return "".join(x for x, _ in pieces), pieces


def labelled_pages(n: int = PAGES, seed: int = SEED) -> Iterator[tuple[list[Block], list[int]]]:
    """Blocks and labels (1: main text) of ``n`` composed pages.

    Each piece of text is marked by a sign before the page is cut into blocks, so
    that labels follow the text whatever the cutting does.
    """
    composer = Composer(seed)
    for _ in range(n):
        _, pieces = composer.page()
        marked = "".join(_mark(x) if y else x for x, y in pieces)
        found = blocks(marked)
        labels = [int("\x02" in b.text) for b in found]
        for b in found:
            b.text = b.text.replace("\x02", "") or "x"
        yield found, labels


def _mark(piece: str) -> str:
    """A sign before each run of text of a piece of markup."""
    out, inside = [], False
    for i, c in enumerate(piece):
        if c == "<":
            inside = True
        out.append(c)
        if c == ">":
            inside = False
        if not inside and i + 1 < len(piece) and piece[i + 1] not in "< " and (c == ">" or i == 0):
            out.append("\x02")
    return "".join(out)


# --- the field ------------------------------------------------------------------


class Field:
    """Weights by feature for each of the two labels, and transitions; the first label's start is one of them."""

    def __init__(self, weights: dict[str, tuple[float, float]], move: np.ndarray) -> None:
        self.weights, self.move = weights, move.tolist()
        self.by_path: dict[tuple[Above, bool], tuple[float, float]] = {}
        self.known = frozenset(f[3:] for f in weights if f.startswith("in:"))

    def _score(self, names: list[str]) -> tuple[float, float]:
        w = [self.weights[x] for x in names if x in self.weights]
        return sum(a for a, _ in w), sum(b for _, b in w)

    def decode(self, page: list[Block]) -> list[int]:
        """The labels of the highest total score."""
        (m00, m01), (m10, m11), (s0, s1) = self.move
        back: list[tuple[int, int]] = []
        v0 = v1 = 0.0
        marked = is_marked(page)
        for k, b in enumerate(page):
            e = self.by_path.get((b.above, marked))
            if e is None:
                if len(self.by_path) > 100_000:
                    self.by_path.clear()
                e = self.by_path[b.above, marked] = self._score(features(b, marked))
            t = self._score(shape(b))
            if k == 0:
                v0, v1 = s0 + e[0] + t[0], s1 + e[1] + t[1]
                continue
            to0, to1 = v1 + m10 > v0 + m00, v1 + m11 > v0 + m01
            back.append((to0, to1))
            v0, v1 = (v1 + m10 if to0 else v0 + m00) + e[0] + t[0], (v1 + m11 if to1 else v0 + m01) + e[1] + t[1]
        if not page:
            return []
        y = [int(v1 > v0)]
        for to in reversed(back):
            y.append(int(to[y[-1]]))
        return y[::-1]

    def extract(self, page: str | None) -> str:
        """The main text: its blocks in page order, joined by one space."""
        found = blocks(page, self.known)
        return " ".join(b.text for b, y in zip(found, self.decode(found)) if y)


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS) -> Field:
    """Maximum conditional likelihood with an L2 penalty, by Adam; all pages' chains run side by side, padded."""
    pages = [p for p in pages if p[0]]
    index: dict[str, int] = {}
    rows, cols = [], []
    seen = Counter(f for page, _ in pages for f in {f for b in page for f in (*features(b, True), *features(b, False))})
    longest, n = max(len(p) for p, _ in pages), len(pages)
    y, mask = np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
    for i, (page, labels) in enumerate(pages):
        y[i, : len(page)], mask[i, : len(page)] = labels, True
        marked = is_marked(page)
        for k, b in enumerate(page):
            for f in {*(f for f in features(b, marked) if seen[f] >= PAGES_OF_NAME), *shape(b)}:
                rows.append(i * longest + k)
                cols.append(index.setdefault(f, len(index)))
    rows, cols = np.array(rows), np.array(cols)
    w, move = np.zeros((len(index), 2)), np.zeros((3, 2))
    one = np.eye(2)[y] * mask[:, :, None]
    true_move = np.zeros((3, 2))
    both = mask[:, 1:]
    np.add.at(true_move, (y[:, :-1][both], y[:, 1:][both]), 1)
    np.add.at(true_move, (2, y[:, 0]), 1)
    params, m1, m2 = [w, move], [0.0, 0.0], [0.0, 0.0]
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for step in range(1, steps + 1):
        e = np.stack([np.bincount(rows, w[cols, c], n * longest) for c in (0, 1)], axis=1).reshape(n, longest, 2)
        a, b = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        a[:, 0] = move[2] + e[:, 0]
        for k in range(1, longest):
            a[:, k] = np.where(mask[:, k, None], lse(a[:, k - 1, :, None] + move[None, :2], 1) + e[:, k], a[:, k - 1])
        for k in range(longest - 2, -1, -1):
            b[:, k] = np.where(mask[:, k + 1, None], lse(move[None, :2] + (e[:, k + 1] + b[:, k + 1])[:, None, :], 2), 0)
        z = lse(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None]) * mask[:, :, None]
        pair = np.exp(a[:, :-1, :, None] + move[None, None, :2] + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[:, :, None, None]
        expect = np.concatenate([pair.sum(axis=(0, 1)), p[:, 0].sum(axis=0)[None]])
        diff = (one - p).reshape(-1, 2)
        grads = [np.stack([np.bincount(cols, diff[rows, c], len(index)) for c in (0, 1)], axis=1) - L2 * w, true_move - expect - L2 * move]
        for j, g in enumerate(grads):
            m1[j] = 0.9 * m1[j] + 0.1 * g
            m2[j] = 0.99 * m2[j] + 0.01 * g * g
            params[j] += 0.1 * (m1[j] / (1 - 0.9**step)) / (np.sqrt(m2[j] / (1 - 0.99**step)) + 1e-8)
    return Field({f: (float(w[i, 0]), float(w[i, 1])) for f, i in index.items()}, move)


@functools.cache
def default_field() -> Field:
    return train(list(labelled_pages()))


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row of ``pages`` (page_id, url, html), from the whole html.

    A null or empty page, or one without main text, gives an empty text. Repeated
    rows are kept; other columns are ignored.
    """
    field = field or default_field()
    weights, move = field.weights, np.array(field.move)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(weights, move)
        for batch in batches:
            for b in slices(batch, "html"):
                texts = [own.extract(x) for x in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
