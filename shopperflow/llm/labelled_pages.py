"""Labelled pages: layouts of our own, filled with invented words from a fixed seed.

In a layout, {m} is a paragraph of the article, {h} its headline, {b} a long and {s} a short piece of
anything else, {l} a list of links. Pieces of the article begin with the character U+0001.
"""

from __future__ import annotations

import random

_HEADS = [
    "",
    '<header class="site-header"><a href="/">{s}</a><p>{s}</p></header>',
    '<div id="header"><h2>{s}</h2><form class="search"><label>{s}</label><input name="q"></form></div>',
    '<header><h1>{s}</h1><nav>{l}</nav></header>',
    '<div class="topbar">{s}</div><div class="logo">{s}</div>',
]
_MENUS = [
    "<nav>{l}</nav>",
    '<ul class="menu">{l}</ul>',
    '<div class="navbar"><a href="/a">{s}</a> | <a href="/b">{s}</a></div>',
    '<nav role="navigation"><ul><li><a href="/x">{s}</a></li><li>{s}</li></ul></nav><ol class="breadcrumb"><li>{s}</li></ol>',
    "",
]
_NOTICES = [
    "",
    '<div class="cookie-banner"><p>{b}</p><button>{s}</button></div>',
    '<div class="notice">{b}</div>',
    '<section id="newsletter-popup"><h3>{s}</h3><p>{b}</p><form><input><button>{s}</button></form></section>',
    '<div role="alert"><p>{b}</p></div>',
    '<div class="ad">{b}</div>',
]
_SIDES = [
    "",
    "<aside><h3>{s}</h3><p>{b}</p>{l}</aside>",
    '<div class="sidebar"><h2>{s}</h2><p>{b}</p><p>{b}</p></div>',
    '<div id="related"><h3>{s}</h3>{l}</div>',
    '<aside class="widget"><div>{b}</div></aside><div class="sponsored"><p>{b}</p></div>',
]
_COMMENTS = [
    "",
    '<section class="comments"><h2>{s}</h2><div class="comment"><b>{s}</b><p>{b}</p></div><div class="comment"><p>{b}</p><p>{b}</p></div></section>',
    '<div id="comments"><ol><li><p>{s}</p><p>{b}</p></li><li><p>{b}</p></li></ol></div>',
    '<section id="disqus_thread"><p>{b}</p></section>',
    '<ul class="replies"><li>{b}</li><li>{b}</li></ul>',
]
_FEET = [
    "<footer>{s}</footer>",
    '<footer><p>{b}</p><nav>{l}</nav></footer>',
    '<div id="footer"><p>© {s}</p><p>{b}</p></div>',
    '<div class="copyright">{b}</div>',
    "<footer>&copy; example.org &middot; {b}</footer>",
]
_FORMS = ["", '<form action="/join"><p>{b}</p><label>{s}</label><input></form>', '<form><fieldset><p>{s}</p></fieldset></form>']
_BODIES = [
    "<article><h1>{h}</h1><p>{m}</p><p>{m}</p><p>{t}</p>%in%<p>{m}</p></article>%out%",
    "<main><h1>{h}</h1>%in%<p>{m}</p><h2>{h}</h2><p>{m}</p><ul><li>{t}</li><li>{m}</li></ul><p>{t}</p></main>%out%",
    '<div class="content"><h1>{h}</h1><p>{m}</p><blockquote><p>{m}</p></blockquote>%in%<p>{m}</p></div>%out%',
    '<div id="main"><div class="post"><h2>{h}</h2><div class="entry"><p>{m}<p>{t}<p>{m}</div>%in%</div>%out%</div>',
    "<article><header><h1>{h}</h1><p class=\"byline\">{s}</p></header><section><h2>{h}</h2><p>{m}</p><pre>{m}</pre></section>%in%<p>{t}</p></article>%out%",
    "<main><article><h1>{h}</h1><div><p>{m}</p><p>{m}</p></div><figure><figcaption>{t}</figcaption></figure><table><tr><td>{t}</td><td>{t}</td></tr></table>%in%</article>%out%</main>",
    '<div><h1>{h}</h1><p>{m}</p><p>{m}</p><p>{t}</p><p>{m}</p></div>%in%%out%',
    "<article><h1>{h}</h1>{m}<br>{m}%in%</article>%out%",
    "<h1>{h}</h1><p>{m}</p><p>{m}</p>%in%<p>{t}</p><p>{m}</p>%out%",
    "<p>{m}</p><p>{m}</p>%in%%out%",
    '<div class="story-body"><h1>{h}</h1><div>{m}</div><div>{m}</div>%in%<div>{t}</div></div>%out%',
]


def _words(rng: random.Random, least: int, most: int) -> str:
    words = ["".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(least, most))]
    words = [w + "," if rng.random() < 0.1 else w for w in words]
    return " ".join(words).capitalize() + rng.choice("....!?")


def _filled(rng: random.Random, layout: str) -> str:
    make = {
        "{m}": lambda: "\x01" + " ".join(_words(rng, 5, 30) for _ in range(rng.randint(1, 8))),
        "{t}": lambda: "\x01" + _words(rng, 1, 6),
        "{h}": lambda: "\x01" + _words(rng, 2, 12).rstrip(".?!"),
        "{b}": lambda: " ".join(_words(rng, 4, 25) for _ in range(rng.randint(1, 4))),
        "{s}": lambda: _words(rng, 1, 4).rstrip(".?!"),
        "{l}": lambda: "<ul>" + "".join(f'<li><a href="/{i}">{_words(rng, 1, 5).rstrip(".")}</a></li>' for i in range(rng.randint(2, 7))) + "</ul>",
    }
    for key, piece in make.items():
        while key in layout:
            layout = layout.replace(key, piece(), 1)
    return layout


def labelled(number: int = 240) -> list[str]:
    rng = random.Random(20)
    pages = []
    for i in range(number):
        inside = rng.choice(_COMMENTS + _FORMS + _NOTICES + ["", "", "", '<div class="share"><a href="/s">{s}</a></div>', "<aside>{b}</aside>"])
        outside = rng.choice(_SIDES) + rng.choice(_COMMENTS) + rng.choice(_FORMS)
        body = _BODIES[i % len(_BODIES)].replace("%in%", inside).replace("%out%", outside)
        page = "".join(rng.choice(x) for x in (_HEADS, _MENUS, _NOTICES)) + body + rng.choice(_NOTICES) + rng.choice(_FEET)
        pages.append(f"<html><head><title>{{s}}</title></head><body>{page}</body></html>" if i % 5 else page)
    return [_filled(rng, p) for p in pages]
