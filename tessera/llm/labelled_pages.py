"""The labelled table: small hand-made pages as (markup, label) pieces.

Label 1: main text, 0: anything else, None: markup without text. The pages
cover layouts with and without an article element, unclosed paragraphs, short
and long paragraphs, menus, adverts, notices, forms, sidebars, comments and
footers inside and outside the main element; names that mislead, names that
are missing, articles that hold lists of links, and pages that are one form.
"""

LONG = ("The harbour was rebuilt over three summers and now holds twice as many boats as before, which pleased the town "
        "council more than the fishermen, who had asked for a crane and got a promenade instead.")
LONGER = LONG + " " + ("Nobody remembers who drew the first plan, but the second one hangs framed in the library, next to a "
                       "photograph of the old pier and a list of those who paid for it.")
SHORT = "It rained."
WORD = "Still."


STORY = (LONGER + " The crane came in the end, second-hand and painted green, on a barge that had to wait four days for the wind to drop. "
         "It lifts three tons, or did until the winter of the long frost, and it is the only thing on the quay that children are "
         "not allowed to climb. Boats that need it book a week ahead with the harbour master, who keeps the list in pencil.").split()


def words(n: int, at: int = 0) -> str:
    """``n`` words of the story from word ``at`` on."""
    return " ".join((STORY + STORY)[at:at + n])


def paragraphs(*sizes: int) -> str:
    return "".join(f"<p>{words(n, 7 * k % 60)}</p>" for k, n in enumerate(sizes))


def links(*sizes: int, tag: str = "div") -> str:
    return "".join(f'<{tag}><a href="/{k}">{words(n, 5 * k % 60)}</a></{tag}>' for k, n in enumerate(sizes))


def menu(*names: str) -> str:
    return "<nav><ul>" + "".join(f'<li><a href="/{n}">{n}</a></li>' for n in names) + "</ul></nav>"


HEAD = ("<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>Harbour news</title><style>p{margin:0}</style>"
        "<script>var a='</p>';</script></head><body>", None)
FOOT = ("<footer>&copy; harbour.example &middot; All rights reserved by the editors of this page.</footer></body></html>", 0)

PAGES: list[list[tuple[str, int | None]]] = [
    [HEAD, (menu("home", "news", "sport"), 0), ('<div class="ad">Buy one boat and get the second one for half of its price.</div>', 0),
     ("<article><h1>Harbour opens</h1>", 1), (f"<p>{LONG}</p><p>{SHORT}</p><p>{LONGER}</p><p>{WORD}</p>", 1), ("</article>", None), FOOT],
    [HEAD, (menu("a", "b", "c", "d"), 0), ("<article><h1>Wind</h1>", 1), (f"<p><b>{LONG}<br><p>{SHORT}<p>{WORD}<p>{LONG}", 1),
     ("</article>", None), ('<aside class="related"><h3>More to read</h3><p>' + LONG + "</p></aside>", 0), FOOT],
    [HEAD, ('<header><h1>The Harbour Times</h1><p>News from the coast since the old pier burnt down.</p></header>', 0),
     ("<main>", None), (f"<h2>Tides</h2><p>{SHORT}</p><p>{LONG}</p><ul><li>High water at nine</li><li>Low water at three</li></ul>", 1),
     ('<p>Read <a href="/x">the tide table</a> before you sail.</p>', 1), ("</main>", None),
     (f'<section class="comments"><h3>Comments</h3><div><p>{LONG}</p></div><div><p>Nonsense.</p></div></section>', 0), FOOT],
    [HEAD, ('<div id="cookie-notice"><p>We use cookies to make this page work better for you and our partners.</p><button>OK</button></div>', 0),
     ('<div class="menu"><a href="/1">One</a> <a href="/2">Two</a> <a href="/3">Three</a></div>', 0),
     (f'<div class="content"><h1>Gulls</h1><p>{LONG}</p><p>{LONGER}</p><p>{LONG}</p></div>', 1),
     ('<div class="sidebar"><p>' + LONG + "</p></div>", 0), ('<form><p>Write to us and we will answer within a week or two.</p></form>', 0),
     ("<div><a href=/i>Imprint</a> <a href=/p>Privacy</a></div>", 0)],
    [HEAD, ('<table><tr><td><a href="/a">Start</a></td><td><a href="/b">Archive of all the years</a></td></tr></table>', 0),
     (f"<div><p>{LONGER}</p><p>{LONG}</p><p>{LONGER}</p></div>", 1), ('<p><a href="/next">Next page of this long story</a></p>', 0),
     ("<p>Page 3</p>", 0)],
    [HEAD, (menu("x", "y"), 0), ("<article><h1>Nets</h1>", 1), (f"<p>{LONG}</p>", 1),
     ('<div class="advert"><p>' + LONG + "</p></div>", 0), (f"<p>{SHORT}</p>", 1),
     ('<div class="newsletter"><form><p>Get the weekly letter of the harbour for free.</p></form></div>', 0), (f"<p>{LONGER}</p><p>{WORD}</p>", 1),
     ('<div class="share"><a href="/s">Share this</a></div>', 0), ('<div id="comments"><p>' + LONG + "</p><p>Well said.</p></div>", 0),
     ("</article>", None), FOOT],
    [HEAD, ('<div role="navigation"><p><a href=/h>Home</a></p><p><a href=/k>Contact</a></p></div>', 0),
     ("<article><header><h1>Storm</h1></header>", 1), (f"<h2>Night</h2><p>{WORD}</p><p>{LONG}</p><blockquote>{LONG}</blockquote>", 1),
     ("<footer><p>Filed under weather by the night desk of the paper.</p></footer>", 0), ("</article>", None),
     ('<div class="widget"><p>Most read this week among our readers in town.</p></div>', 0), FOOT],
    # no names and no main element: length, links and neighbours decide
    [("<html><body>", None), (links(1, 1, 2, 1), 0), ("<div>The Quay</div>", 0), (f"<div>{words(13, 4)} <a href=/c>{words(2)}</a></div>", 0),
     (f"<h1>{words(6)}</h1>", 1), (paragraphs(44, 4, 61, 28, 2, 52, 19), 1), (links(5, 4, 7), 0), (f"<div>{words(9, 3)}</div>", 0)],
    [("<html><body>", None), ("<div>Harbour paper</div>", 0), (links(2, 1, 1), 0), (f"<h2>{words(8, 9)}</h2>", 1), (f"<div>{words(5)}</div>", 1),
     (paragraphs(33, 70, 8, 25, 1, 38), 1), ("<div>Page 3</div>", 0), (links(1, 3), 0), (f"<div>{words(12, 11)}</div>", 0)],
    [("<html><body>", None), (f"<div>{words(16, 2)} <a href=/ok>{words(1)}</a></div>", 0), (links(1, 2, 1, 1, 2, tag="td"), 0),
     (paragraphs(58, 23, 31, 6, 47), 1), (links(6, 8, 5), 0), (f"<div>{words(7, 8)}</div>", 0)],
    [("<html><body>", None), (links(1, 1), 0), (f"<p>{words(10, 20)}</p>", 0), (links(2), 0), (paragraphs(26, 90, 3, 41), 1),
     (f"<p>{words(6)} <a href=/t>{words(3, 9)}</a> {words(14, 12)}</p>", 1), (paragraphs(36, 22), 1), (links(4, 3, 1, tag="p"), 0),
     (f"<p>{words(8)} <a href=/i>{words(1)}</a></p>", 0)],
    [("<html><body>", None), (f"<div>{words(3)}</div>", 0), (f"<div>{words(8, 5)}</div>", 0), (links(1, 1, 1, 1), 0), (f"<h1>{words(4)}</h1>", 1),
     (paragraphs(49, 30, 5, 66), 1), (f"<ul><li>{words(6)}</li></ul>", 1), (paragraphs(40), 1), (f"<div>{words(11, 6)}</div>", 0)],
    # outside the article without a name that says so
    [HEAD, (f"<div>{words(15, 3)}</div>", 0), (menu("p", "q"), 0), ("<article><h1>Ropes</h1>", 1), (paragraphs(35, 2, 48), 1), ("</article>", None),
     (f"<div><p>{words(24, 9)}</p><p>{words(31, 2)}</p></div>", 0), (f"<div>{words(7)}</div>", 0), ("</body></html>", None)],
    [HEAD, (f"<div>{words(40, 30)}</div>", 0), ("<main><h1>Sails</h1>", 1), (paragraphs(12, 1, 27, 33, 9), 1), ("</main>", None),
     (f"<div>{words(5)} <a href=/m>{words(2)}</a></div>", 0), ("</body></html>", None)],
    # links are part of an article
    [HEAD, ("<article><h1>Where to read on</h1>", 1), (f"<p>{words(30)}</p><p><a href=/w>{words(6)}</a></p><p>{words(21)}</p>", 1),
     (f"<ul>{links(4, 7, 3, tag='li')}</ul>", 1), (f"<p><a href=/z>{words(12)}</a></p>", 1), ("</article>", None), FOOT],
    [HEAD, (menu("k", "l"), 0), (f"<main><p>{words(18)}</p><ol>{links(2, 1, 9, tag='li')}</ol><p>{words(4)}</p>", 1), ("</main>", None), FOOT],
    # names that mislead, and names that don't quite
    [HEAD, (menu("m"), 0), ("<article><h1>Work</h1>", 1), (f"<section class='social history'>{paragraphs(37, 5, 46, 20)}</section>", 1),
     (f"<p>{words(20)}</p>", 1), ("</article>", None), FOOT],
    [HEAD, (links(1, 2), 0), (f"<div id='content'><section class='search-and-rescue'><h2>{words(5)}</h2>{paragraphs(42, 29, 7, 55)}</section></div>", 1), FOOT],
    [HEAD, (links(1, 1), 0), (f"<div class='job-notice'><h1>{words(6)}</h1>{paragraphs(50, 24, 32)}</div>", 1),
     (f"<div class='notice winter'><p>{words(8)}</p></div>", 0), (links(3, 2), 0)],
    [HEAD, ("<div class='share kiosk'><p>Pass it on</p></div>", 0), (f"<div class='content sidebar-right'><h1>{words(5)}</h1>{paragraphs(60, 34, 27)}</div>", 1),
     (f"<div class='widget tide'><p>{words(9)}</p></div>", 0), (links(2, 2), 0)],
    # articles of teasers beside the text
    [HEAD, (f"<div><h1>{words(6)}</h1>{paragraphs(64, 51, 43, 70)}</div>", 1), (f"<div class=related><article><p>{words(12)}</p></article></div>", 0), FOOT],
    # one form around the page
    [HEAD, ("<form id=page>", None), (menu("r", "s"), 0), (f"<article><h1>{words(4)}</h1>{paragraphs(38, 3, 26)}</article>", 1), (f"<div class='search-box'>{words(5)}</div>", 0),
     ("</form></body></html>", None)],
    # articles that end the page, or that links follow; short paragraphs in a row
    [("<html><body>", None), (menu("t"), 0), (f"<article><h1>{words(5)}</h1>{paragraphs(30, 4)}", 1)],
    [("<html><body>", None), (links(2, 1), 0), (f"<article><h1>{words(3)}</h1>{paragraphs(6, 3, 9, 2, 1, 5, 11)}</article>", 1), (links(3, 2, 4), 0)],
    [("<html><body>", None), (f"<main>{paragraphs(3)}", 1)],
    [("<html><body>", None), (f"<main><h2>{words(7)}</h2>{paragraphs(2, 8, 4)}<p><a href=/v>{words(5)}</a></p></main>", 1), (links(1, 1, 1), 0)],
    [("<html><body>", None), (links(1, 2, 3), 0), (f"<article>{links(3, 1, 6, 2)}<p>{words(3)}</p></article>", 1), (links(1, 1), 0), (f"<div>{words(6)}</div>", 0)],
    [("<html><body>", None), (f"<article><p>{words(9)} <a href=/u>{words(4)}</a></p><p><a href=/y>{words(8)}</a> {words(3)}</p></article>", 1), (links(2, 2), 0)],
    [("<html><body>", None), (f"<div>{words(10)}</div>", 0), (f"<main><ul>{links(1, 5, tag='li')}</ul>{paragraphs(7, 1)}<p>{words(2)} <a href=/q>{words(6)}</a></p></main>", 1),
     (f"<div>{words(13, 2)} <a href=/b>{words(1)}</a></div>", 0)],
    [("<html><body>", None), (f"<article><h1>{words(4)}</h1>{paragraphs(15, 2)}<p><a href=/n>{words(3)}</a></p></article>", 1), (f"<p>{words(8)}</p>", 0), (links(2), 0)],
    # the last paragraph of a page without names
    [("<html><body>", None), (links(1, 1, 2), 0), (f"<h1>{words(5)}</h1>{paragraphs(45, 38, 29)}", 1)],
    [("<html><body>", None), (f"<div>{words(2)}</div>", 0), (f"{paragraphs(52, 3, 35, 24, 41)}", 1)],
    # side parts with long texts where no main element is
    [("<html><body>", None), (f"<div class=sidebar>{paragraphs(40, 28)}</div>", 0), (f"<h1>{words(5)}</h1>{paragraphs(55, 31, 44)}", 1),
     (f"<div class=comments>{paragraphs(33, 5, 21)}</div>", 0), (f"<aside>{paragraphs(26, 3)}</aside>", 0)],
    [("<html><body>", None), (f"<div id=cookie-banner>{paragraphs(38)}</div>", 0), (f"{paragraphs(48, 4, 37, 60)}", 1),
     (f"<form>{paragraphs(23, 30)}</form>", 0), (f"<footer>{paragraphs(50, 2)}</footer>", 0)],
    [("<html><body>", None), (f"<header><h2>{words(4)}</h2>{paragraphs(27)}</header>", 0), (f"<div>{paragraphs(39, 6, 42)}</div>", 1),
     (f"<div class='newsletter box'>{paragraphs(29, 22)}</div>", 0), (f"<section id=related-posts><h3>{words(3)}</h3>{paragraphs(32, 47)}</section>", 0)],
    # short lines after paragraphs of any length
    [("<html><body>", None), (f"<article>{paragraphs(25, 95)}</article>", 1), (f"<footer>{words(9)}</footer>", 0)],
    [("<html><body>", None), (f"<article>{paragraphs(110)}</article>", 1), (f"<aside>{words(4)}</aside>", 0), (f"<footer>{words(14)}</footer>", 0)],
    [("<html><body>", None), (f"<main>{paragraphs(72, 130)}</main>", 1), (f"<div>{words(8)}</div>", 0)],
    [("<html><body>", None), (f"<div>{paragraphs(20, 84)}</div>", 1), (f"<footer>{words(11)}</footer>", 0)],
    [("<html><body>", None), (f"<div>{paragraphs(63, 140)}</div>", 1), (f"<div>{words(10)}</div>", 0), (links(2, 1), 0)],
    [("<html><body>", None), (f"<p>{words(100)}</p><p>{words(4)}</p><p>{words(120)}</p>", 1), (f"<div>{words(5)} <a href=/j>{words(3)}</a></div>", 0)],
    # side parts right before paragraphs and headings of any length
    [("<html><body>", None), (f"<div class=ad>{words(9)}</div>", 0), (paragraphs(36, 74), 1), (f"<div class=advert>{words(4)}</div>", 0), (paragraphs(28, 41), 1)],
    [("<html><body>", None), (f"<div class=banner>{words(15)}</div>", 0), (f"<h1>{words(26)}</h1>{paragraphs(50)}", 1), (f"<div class=related>{words(2)}</div>", 0),
     (paragraphs(62), 1)],
    [("<html><body>", None), (f"<aside>{words(12)}</aside>", 0), (f"<h1>{words(24)}</h1>{paragraphs(34)}", 1), (f"<aside>{words(7)}</aside>", 0), (paragraphs(45, 39), 1)],
    [("<html><body>", None), (f"<nav>{words(3)}</nav>", 0), (paragraphs(88), 1), (f"<div id=newsletter>{words(17)}</div>", 0), (paragraphs(53, 33), 1)],
    [("<html><body>", None), (f"<div class=cookie-notice>{words(11)}</div>", 0), (f"<div class=ad>{words(6)}</div>", 0), (f"<article><h1>{words(25)}</h1></article>", 1)],
    [("<html><body>", None), (f"<div class=sponsor>{words(14)}</div>", 0), (f"<article><h1>{words(30)}</h1><p>{words(2)}</p></article>", 1), (f"<footer>{words(10)}</footer>", 0)],
    # articles that begin the page, and articles whose last words follow links
    [("<html><body>", None), (f"<article><h1>{words(1)}</h1>{paragraphs(30, 4)}</article>", 1), (links(1, 2), 0)],
    [("<html><body>", None), (f"<article><p>{words(2)}</p>{paragraphs(3, 42)}</article>", 1), (f"<div>{words(9)}</div>", 0)],
    [("<html><body>", None), (f"<main><h2>{words(3)}</h2>{links(4, 2)}<p>{words(3)}</p></main>", 1)],
    [("<html><body>", None), (f"<article><p>{words(3)}</p><p>{words(20)}</p>{links(2, 5)}<p>{words(12)}</p></article>", 1)],
    [("<html><body>", None), (links(1, 1), 0), (f"<article>{paragraphs(22)}{links(3)}<p>{words(5)}</p>", 1)],
    [("<html><body>", None), (f"<article><h1>{words(2)}</h1>{links(7)}<p>{words(1)}</p></article>", 1)],
]
