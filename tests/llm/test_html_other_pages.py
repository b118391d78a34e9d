"""Main text of pages that share no template with those that the field is trained on."""

from __future__ import annotations

import random

import pytest

from neolake.llm import html_blocks, html_crf

TEXT = "<p>The council met on Tuesday to talk about the new bridge, which has been planned for many years.</p><p>Its members agreed that work should begin in spring and end within two years at the latest.</p>"
PLAIN = TEXT.replace("</p><p>", " ").replace("<p>", "").replace("</p>", "")
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li></ul>'
CASES = {
    "div": (f"<body><div>{TEXT}</div></body>", PLAIN),
    "body": (f"<body>{TEXT}</body>", PLAIN),
    "heading": (f"<body><h1>A new bridge</h1>{TEXT}</body>", "A new bridge " + PLAIN),
    "section": (f"<body><section><h2>A new bridge</h2>{TEXT}</section></body>", "A new bridge " + PLAIN),
    "foreign class": (f'<body><div class="beitrag">{TEXT}</div></body>', PLAIN),
    "after a menu": (f'<body><nav>{MENU}</nav><div class="prose"><h1>Bridge</h1>{TEXT}</div></body>', "Bridge " + PLAIN),
    "role": (f'<body><div role="main">{TEXT}</div></body>', PLAIN),
    "itemprop": (f'<body><div itemprop="articleBody">{TEXT}</div></body>', PLAIN),
    "layout table": (f"<body><table><tr><td>{MENU}</td><td>{TEXT}</td></tr></table></body>", PLAIN),
    "clutter's word": (f'<body><article><p class="comment-free">Nobody had anything to say about the bridge before the vote.</p>{TEXT}</article></body>', "Nobody had anything to say about the bridge before the vote. " + PLAIN),
    "signs in quotes": (f'<body><article><p>See <a title="a > b < c" href="/x">linked words</a> here.</p>{TEXT}</article></body>', "See linked words here. " + PLAIN),
    "open quote": (f'<body><article><p class="a>Broken but readable, as "some" pages are, on and on.</p><p id="x">{TEXT[3:]}</article></body>', "Broken but readable, as \"some\" pages are, on and on. " + PLAIN),
    "whole page": (
        f'<body><div id="top"><a href="/">Site</a></div><div class="menu">{MENU}</div><div class="x1"><div class="y2"><h1>Bridge</h1>{TEXT}</div></div><div class="sidebar"><h3>Related</h3>{MENU}</div>'
        '<div class="comments"><p>I disagree with that.</p><p>So do I, and my neighbours.</p></div><div id="foot">&copy; 2020 Site</div></body>',
        "Bridge " + PLAIN,
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, want = CASES[name]
    assert html_crf.default_field().extract(page) == want


def other_page(r: random.Random) -> list[tuple[str, int]]:
    """(markup, whether it is main text): built from lists of parts, with words of its own."""
    words = "river stone market harbour winter letter engine doctor garden window silver theatre captain orchard village mirror".split()
    say = lambda lo, hi: " ".join(r.choice(words) for _ in range(r.randint(lo, hi))).capitalize() + r.choice(".!?")
    link = lambda: f'<a class="lnk" href="#{r.choice(words)}">{r.choice(words)}</a>'
    wrap = r.choice([("<article>", "</article>"), ("<main id=m>", "</main>"), ("<div>", "</div>"), ('<div class="col-8"><div class="row">', "</div></div>"), ("<section>", "</section>"), ("<table><tr><td>", "</td></tr></table>"), ("", "")])
    head = [
        (f'<div class="site-nav">{" | ".join(link() for _ in range(5))}</div>', 0), (f"<nav><ol>{''.join(f'<li>{link()}</li>' for _ in range(4))}</ol></nav>", 0), (f"<header><span>{say(1, 4)}</span></header>", 0),
        (f'<aside><h4>{say(1, 2)}</h4><p>{say(3, 12)}</p></aside>', 0), (f'<div class="cookie-bar"><p>{say(5, 12)}</p></div>', 0), (f'<form><label>{say(1, 2)}</label><button>{r.choice(words)}</button></form>', 0),
    ]
    tail = [
        (f"<footer><p>{say(3, 8)}</p><p>&copy; {r.randint(1990, 2030)}</p></footer>", 0), (f'<section class="reader-comments">{"".join(f"<div class=reply>{say(4, 30)}</div>" for _ in range(3))}</section>', 0),
        (f'<div class="related-links">{"".join(f"<p>{link()}</p>" for _ in range(3))}</div>', 0), (f'<div class="advert"><p>{say(3, 12)}</p></div>', 0),
    ]
    body = [(f"<h1>{say(2, 8)}</h1>", 1)] + [(f"<p>{say(20, 70)}</p>", 1) if r.random() < 0.8 else (f"<h2>{say(2, 5)}</h2><p>{say(15, 60)}</p>", 1) for _ in range(r.randint(2, 7))]
    return [("<html><body>", 0), *r.sample(head, r.randint(0, 3)), (wrap[0], 0), *body, (wrap[1], 0), *r.sample(tail, r.randint(0, 3)), ("</body></html>", 0)]


def test_another_composer():
    field, r = html_crf.default_field(), random.Random(21)
    right = total = 0
    for _ in range(300):
        pieces = other_page(r)
        found = html_blocks.blocks("".join(html_crf._mark(x) if y else x for x, y in pieces))
        labels = [int("\x02" in b.text) for b in found]
        got = field.decode(html_blocks.blocks("".join(x for x, _ in pieces)))
        assert len(got) == len(labels)
        right, total = right + sum(a == b for a, b in zip(got, labels)), total + len(labels)
    print("blocks of another composer:", right / total)
    assert right / total > 0.95
