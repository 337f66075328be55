"""The small labelled table that the block classifier learns from: made-up pages whose blocks begin with + (article) or -."""

from __future__ import annotations

_LONG = "+The river rose in the night and by morning the lower road was under water, so the school stayed closed and the market moved up the hill."
_MID = "+Nobody had seen so much snow in May, the baker said, and laughed."
_LINKED = '+More on this can be read in <a href="/r">the report of the year before</a>, which the town has put on its pages for all to read.'
_LINKS = "".join(f'<li><a href="/{w}">-{w}</a></li>' for w in ("Home", "News", "Sport", "Contact"))

PAGES = [
    f"<html><body><nav><ul>{_LINKS}</ul></nav><article><h1>+Flood in the valley</h1><p>{_LONG}</p><p>+Short.</p><p>{_LINKED}</p></article><footer>-(c) paper - all rights kept by the paper and those who write for it</footer></body></html>",
    f"<body><header><h1>-The Daily</h1><p>-News from the valley and beyond since the year of the great fire</p></header><main><h2>+Snow</h2><p>{_MID}<br>+Yes.</p><p>{_LONG}</p></main><aside><p>-Also read: what the mayor said about the long winter and the price of salt this year</p></aside></body>",
    f'<div class="cookie-notice"><p>-We use cookies to make this page better for you and to count how many people read it every day.</p></div><article><p>{_LONG}</p><p>+Ah.</p><div class="ad">-Buy two lamps and get a third one free at the shop by the bridge until the end of the month.</div><p>{_MID}</p></article>',
    f'<article><h1>+Harvest</h1><p>{_MID}</p><p>+<a href="/x">Read the list</a></p></article><section id="comments"><p>-I was there too and it was not half as bad as they say in this story, believe me or not.</p><p>-Ha!</p></section>',
    f'<div id="sidebar"><h3>-Most read</h3><ul>{_LINKS}</ul><p>-The ten stories that most people have read in the last week on our pages</p></div><div><h2>+A plain page</h2><p>{_LONG}</p><p>{_LINKED}</p><p>{_MID}</p></div><div>-(c) 2001</div>',
    f'<table><tr><td><a href="/a">-Start</a></td><td><a href="/b">-Archive</a></td><td><a href="/c">-Imprint of this page</a></td></tr></table><p>{_LONG}</p><p>{_MID}</p><p>{_LONG}</p><p>-<a href="/top">Back to top</a></p>',
    f'<form action="/s"><p>-Write to us with the form below and we will come back to you within a few working days.</p><label>-Name</label><button>-Send</button></form><article><p>{_LONG}</p><p>+End.</p></article>',
    f'<article><p>{_LONG}</p><aside class="promo">-Our letter brings you the best stories of the week on Friday, free of charge, and you can leave any time.</aside><p>{_LINKED}</p><h2>+Why</h2><p>+Because.</p></article><div class="comments"><article class="comment"><p>-A fine story, thank you, I have sent it to my sister who lives by the same river.</p></article></div>',
    f'<div class="menu">{_LINKS}</div><div class="content"><h1>+Bees</h1><p>{_MID}</p><p>+No.</p><ul><li>+Honey is sold at the gate in the morning hours</li><li>+Wax</li></ul></div><div class="footer"><p>-Printed in the valley on paper made from old paper, by people who like to read.</p></div>',
    f'<p>-<a href="/">Home</a> | <a href="/n">News</a> | <a href="/s">Sport</a></p><h1>+Mill for sale</h1><p>{_LONG}</p><p>{_MID}</p><p>{_LINKED}</p><p>-<a href="/1">Next story</a> <a href="/2">Story before</a></p>',
    f'<div role="banner">-The Evening Post, the paper that is read on the train home by most people in the valley</div><div role="main"><p>{_MID}</p><p>+So.</p></div><div role="contentinfo">-Write to the Evening Post at the old station house, second door on the left.</div>',
    f'<article><p>{_MID}</p><ul><li>+<a href="/m">Map</a></li><li>+<a href="/t">Timetable of all trains</a></li></ul><footer>-Filed under floods, rivers, schools and markets by the desk for the valley</footer></article><div>-This page was made by the paper and may not be copied without asking the paper first, thank you.</div>',
    f'<div><p>-Rain in the west today, dry in the east, with a light wind from the north in the evening hours.</p><p>-Tides at noon.</p></div><article><h2>+Ferry</h2><p>{_MID}</p><p>+Late.</p><p>{_LONG}</p></article><div><p>-The paper is made by twelve people in a house by the bridge, and it has been so for forty years.</p><p>-Find us there.</p></div>',
    f'<p>-Today is the day of the saint of all who mend nets, and the shops close early in the lower town.</p><main><p>{_LONG}</p><p>+Well.</p><p>{_LINKED}</p></main><p>-For the winners of last week see the list that hangs in the window of the office.</p><p>-Good luck.</p>',
    f'<div>-A word before all: the office stays closed on Monday, and letters will be read on the day after that.</div><article><p>+One.</p><p>{_MID}</p><p>+Two words.</p></article><div>-The next paper comes out on Friday with the plan of the new harbour as a large map for the wall.</div><div>-Bye.</div>',
]

# Wrappers whose class has a word of a side part.
PAGES += [
    f'<body class="has-sidebar"><article><h1>+Tower</h1><p>{_LONG}</p><p>+Tall.</p></article><aside><p>-Most read this week: the winter, the price of salt and the new bridge over the river.</p></aside></body>',
    f'<div id="page" class="header-fixed"><main><p>{_MID}</p><p>+So.</p><p>{_LINKED}</p></main><div class="comments"><p>-I was there and saw it all, and it was just as the paper says it was.</p></div></div>',
]

# Every kind of side part, with texts of every length, in pages with and without a main part.
_PLAIN = ["Two words.", "A line of about eight words and no more.", "A longer text of some twenty words which says one thing and then another, as notes at the side of a page do.",
          "A very long text, of forty words or more, that could be part of a story by its length alone: it tells of the weather, the roads, the price of fish, and of those who came home late in the week, as the paper has always done, since it began."]
_SIDES = ["nav", "footer", "aside", "form", 'div class="sidebar"', 'div class="cookie-notice"', 'div class="ad"', 'section id="comments"', 'div class="related"', 'div role="complementary"']


def _of(sign: str, texts: list[str]) -> str:
    return "".join(f"<p>{sign}{t}</p>" for t in texts)


for _k, _side in enumerate(_SIDES):
    _own, _body = _PLAIN[_k % 4 :] + _PLAIN[: _k % 4], _PLAIN[3 - _k % 4 :] + _PLAIN[: 3 - _k % 4]
    _part = f"<{_side}>{_of('-', _own)}</{_side.split()[0]}>"
    _main = f"<article>{_of('+', _body)}<p>+<a href='/x'>A link of four words</a></p></article>"
    PAGES.append(f"{_part}{_main}<div>{_of('-', _own[:2])}</div>" if _k % 2 else f"<div>{_of('-', _own[2:])}</div>{_main}{_part}")
    PAGES.append(f"{_part}<div>{_of('+', [_PLAIN[3], _PLAIN[2], _PLAIN[_k % 2], _PLAIN[3]])}</div>" if _k % 2 else f"<div>{_of('+', [_PLAIN[3], _PLAIN[0], _PLAIN[2]])}</div>{_part}")
    PAGES.append(f"<article>{_of('+', _body[:2])}{_part}{_of('+', _body[2:])}</article>")
