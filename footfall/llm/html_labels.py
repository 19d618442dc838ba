"""A small labelled table of pages: each text block of the body is marked as main text or not.

Within a page `+` before a line says that its block is main text, `-` that it is not; other lines are markup alone. Some pages are
written by hand; the others follow layouts, most of them without any helpful name, with texts of drawn lengths: what is
learned looks at lengths and links, not at words.
"""

from __future__ import annotations

from collections.abc import Callable
from random import Random

PAGES = (
    """
    <html><head><title>Harbour news</title></head><body><nav><ul>
-<li><a href="/">Home</a></li>
-<li><a href="/sport">Sport</a></li>
-<li><a href="/about">About us</a></li>
    </ul></nav>
-<div class="ad">Buy two tickets, get one free, only this week.</div>
    <article>
+<h1>Harbour reopens after the storm</h1>
+<p>The harbour reopened on Monday after crews had cleared the debris that the storm left behind in the main channel.</p>
+<p>Ferries run again.</p>
+<p>Most of the boats that were torn loose have been found, the <a href="/master">harbour master</a> said, and only two are still missing.</p>
+<p>No one was hurt.</p>
    </article>
-<footer>&copy; harbour.example.com &middot; All the news of the coast.</footer>
    </body></html>
    """,
    """
    <html><body><header>
-<div class="logo">The Daily Kettle</div>
-<p>News and views since 1901</p>
    </header><div id="menu">
-<a href="/tea">Tea</a> <a href="/coffee">Coffee</a> <a href="/cups">Cups</a>
    </div><main><div class="post-content">
+<h2>How to boil water</h2>
+<p>Fill the kettle with fresh cold water and set it on the stove. Wait until large bubbles rise without pause.</p>
+<ul><li>One kettle</li>
+<li>One litre of cold water from the tap</li></ul>
+<p>Done.</p>
    </div></main><aside>
-<h3>Read also</h3>
-<p><a href="/a">How to warm the pot</a></p>
-<p>Our editor picks the three best books about tea that were printed in this year, and tells why.</p>
    </aside><div class="comments">
-<p>Anna: I have always done it in another way, and it has served me well for thirty years or more.</p>
-<p>Great!</p>
    </div><form>
-<label>Your name</label>
<button>Send</button>
    </form><footer>
-<p>Imprint and contact: write to the editor at any time, letters are read on weekdays.</p>
    </footer></body></html>
    """,
    """
    <html><body><div class="cookie-notice">
-<p>We use cookies to make this site better for you. Read on to accept them all or change your settings.</p>
    </div><div class="breadcrumb">
-<a href="/">Start</a> &gt; <a href="/garden">Garden</a>
    </div><article><header>
+<h1>Roses in winter</h1>
    </header><section>
+<p>Cover the roots with leaves before the first frost and leave them there until the end of March.</p>
+<blockquote>A rose that sleeps well blooms well.</blockquote>
+<p>Cut old wood in spring, when the forsythia blooms, and always a little above an eye that looks outwards.</p>
    </section><div class="advert">
-<p>Garden shears at half price, delivered to your door within two days, by the shop that gardeners trust.</p>
    </div>
+<p>Water them rarely.</p>
    <div class="share"><ul>
-<li><a href="/f">Share</a></li>
-<li><a href="/m">Send by mail</a></li>
    </ul></div></article><section id="comments">
-<h3>3 comments</h3>
-<p>My roses froze last winter although I did all that, so perhaps the sort matters more than the leaves.</p>
    </section><div class="sidebar">
-<p>Popular</p>
-<p><a href="/l">Lawn care for the lazy in seven steps</a></p>
    </div></body></html>
    """,
    """
    <html><body>
-<div><a href="/1">Latest</a> | <a href="/2">Archive</a> | <a href="/3">Search</a> | <a href="/4">Contact</a></div>
+<h1>A walk along the river</h1>
+<p>From the old bridge the path follows the left bank for about two miles, first through meadows and then under tall poplars.</p>
+<p>Herons stand in the shallows.</p>
+<p>At the weir a bench invites to rest; from there the way back takes an hour, or less with the <a href="/bus">bus</a> that stops above.</p>
+<p>Bring good shoes, since the last part is often wet, and a coat for the wind that comes up in the evening.</p>
-<div class="related"><a href="/w2">A walk around the lake</a> <a href="/w3">A walk in the hills</a></div>
-<div class="copyright">All rights reserved.</div>
    </body></html>
    """,
    """
    <html><body><nav>
-<p>Choose a chapter below to begin reading, or go back to the list of books that we hold.</p>
    </nav><div role="main">
+<h1>Chapter two</h1>
+<p>In the morning the snow had gone.</p>
+<p>She opened the window, and the smell of wet earth came in; below, in the yard, the dog lay in the sun as if it had never been winter.</p>
+<table><tr><td>Snow in January</td>
+<td>forty days</td></tr></table>
+<p>So it was.</p>
    </div><div class="newsletter">
-<p>Subscribe to our letter and get a new chapter each Friday, free of charge, until the book has ended.</p>
    </div><div class="banner">
-<p>Now in shops.</p>
    </div></body></html>
    """,
)


def _words(draw: Random, least: int, most: int) -> str:
    return " ".join("abcdefgh"[: draw.randint(1, 8)] for _ in range(draw.randint(least, most)))


def _link(draw: Random, least: int = 1, most: int = 3) -> str:
    return f'<a href="/">{_words(draw, least, most)}</a>'


def _menu(draw: Random, least: int = 3, most: int = 8) -> list[str]:
    """Links in a row, or one below the other."""
    links = [_link(draw) for _ in range(draw.randint(least, most))]
    return ["-<div>" + " | ".join(links) + "</div>"] if draw.random() < 0.4 else [f"-<div>{link}</div>" for link in links]


def _teasers(draw: Random) -> list[str]:
    """Titles of other pages, each a link, below a short title."""
    return [f"-<div>{_words(draw, 1, 3)}</div>", *(f"-<div>{_link(draw, 3, 11)}</div>" for _ in range(draw.randint(2, 5)))]


def _paragraph(draw: Random) -> str:
    long, kind = _words(draw, 14, 110), draw.random()
    if kind < 0.2:
        return f"+<p>{_words(draw, 1, 8)}</p>"
    if kind < 0.4:
        return f"+<p>{long} {_link(draw, 1, 4)} {_words(draw, 8, 30)}</p>"
    return f"+<p>{long}</p>"


def _article(draw: Random, links: bool = True) -> list[str]:
    """A heading and paragraphs, some short, a few one link alone, with titles and lists between them."""
    lines = [f"+<h1>{_words(draw, 2, 12)}</h1>", f"+<p>{_words(draw, 18, 90)}</p>"]
    for _ in range(draw.randint(1, 6)):
        kind = draw.random()
        if kind < 0.15:
            lines += [f"+<h2>{_words(draw, 1, 6)}</h2>", f"+<p>{_words(draw, 18, 90)}</p>"]
        elif kind < 0.25:
            lines += [f"+<li>{_words(draw, 4, 18)}</li>" for _ in range(3)]
        elif kind < 0.35 and links:
            lines += [f"+<p>{_words(draw, 18, 90)}</p>", f"+<p>{_link(draw, 5, 14)}</p>", f"+<p>{_words(draw, 18, 90)}</p>"]
        else:
            lines.append(_paragraph(draw))
    return lines if draw.random() < 0.3 else [*lines, f"+<p>{_words(draw, 18, 90)}</p>"]


def _short_article(draw: Random) -> list[str]:
    """Little text, which only its container tells from the rest."""
    return [f"+<p>{_words(draw, 1, 9)}</p>" for _ in range(draw.randint(1, 4))]


def _imprint(draw: Random) -> list[str]:
    line = _words(draw, 2, 9) + (f" {_link(draw, 1, 4)}" if draw.random() < 0.4 else "")
    return [f"-<div>{line}</div>", *(["-<div>" + " ".join(_link(draw) for _ in range(3)) + "</div>"] if draw.random() < 0.5 else [])]


def _bare(draw: Random) -> list[str]:
    return ["<div>", *_menu(draw), "</div><div>", *_article(draw), "</div><div>", *_imprint(draw), "</div>"]


def _bare_with_title(draw: Random) -> list[str]:
    return [f"-<div>{_words(draw, 1, 4)}</div>", *_menu(draw), *_article(draw), *_menu(draw), *_imprint(draw)]


def _bare_with_teasers(draw: Random) -> list[str]:
    return [*_menu(draw), *_article(draw), "<div>", *_teasers(draw), "</div>", *_menu(draw), *_imprint(draw)]


def _bare_columns(draw: Random) -> list[str]:
    return ["<table><tr><td>", *_teasers(draw), *_menu(draw), "<td>", *_article(draw), "<td>", *_teasers(draw), "</table>", *_imprint(draw)]


def _elements(draw: Random) -> list[str]:
    """Elements that say what they hold; whatever the lengths are."""
    article = _short_article(draw) if draw.random() < 0.5 else _article(draw)
    other = [f"-<p>{_words(draw, 2, 60)}</p>", *_teasers(draw)]
    return ["<nav>", *_menu(draw), f"-<p>{_words(draw, 1, 40)}</p>", "</nav><article>", *article, "</article><aside>", *other, "</aside><footer>", *_imprint(draw), "</footer>"]


def _named(draw: Random) -> list[str]:
    article = _short_article(draw) if draw.random() < 0.5 else _article(draw)
    before = ['<div class="banner">', f"-<p>{_words(draw, 2, 60)}</p>", "</div>"]
    within = ['<div class="share">', *_menu(draw, 2, 4), f"-<p>{_words(draw, 1, 12)}</p>", "</div>"]
    after = ['<div id="comments">', *(f"-<p>{_words(draw, 1, 70)}</p>" for _ in range(draw.randint(1, 4))), "</div>"]
    return [*before, *_menu(draw), '<div class="post-content">', *article, *within, "</div>", *after, *_imprint(draw)]


def _alone(draw: Random) -> list[str]:
    """Nothing but an article, with or without an element that says so."""
    if draw.random() < 0.3:
        return _article(draw)
    return ["<article>", *(_short_article(draw) if draw.random() < 0.5 else _article(draw)), "</article>"]


def _broken_up(draw: Random) -> list[str]:
    """An article between whose paragraphs other content stands: notices, and links that are sentences."""
    lines = ["<main>", *_article(draw)]
    for _ in range(draw.randint(1, 3)):
        other = [f"-<p>{_link(draw, 3, 30)}</p>", f"-<p>{_words(draw, 2, 40)} {_link(draw, 2, 30)}</p>"]
        lines += ["<aside>", *other[: draw.randint(1, 2)], "</aside>", *_article(draw)[1:]]
    return [*lines, "</main>"]


#: Layouts of the training pages.
LAYOUTS: tuple[Callable[[Random], list[str]], ...] = (
    _bare,
    _bare_with_title,
    _bare_with_teasers,
    _bare_columns,
    _elements,
    _named,
    _alone,
    _broken_up,
)


def drawn_pages(layouts: tuple[Callable[[Random], list[str]], ...], seed: int, each: int) -> list[str]:
    """`each` pages of every layout."""
    draw = Random(seed)
    return ["\n".join(["<html><body>", *layout(draw), "</body></html>"]) for layout in layouts for _ in range(each)]


def training_pages(each: int = 20) -> list[str]:
    """The table: the pages written by hand, and `each` of every layout."""
    return [*PAGES, *drawn_pages(LAYOUTS, 1, each)]
