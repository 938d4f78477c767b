"""Pages of common and odd markup, and the style tree of a small site by brute force."""

from __future__ import annotations

import math
import time
from collections import Counter, defaultdict

import pytest

from tablecraft.llm import htmltext


def text(html):
    return htmltext.PageReader().read(html).text()


ARTICLE = "<article><h1>Title</h1><p>Story</p></article>"


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (f"<body><form id='aspnetForm'>{ARTICLE}<input value='x'></form></body>", "Title\nStory"),
        ("<body><form id='f'><div class='c'><p>A long story of the page.</p><button>Send</button></div></form><p>x</p></body>", "A long story of the page.\nx"),
        ("<body><p>A long story of the page.</p><form><label>Your name</label><input></form></body>", "A long story of the page."),
        ("<article><p>Story</p><form><label>A very long label of a form</label></form></article>", "Story"),
        ("<article><h1>T</h1><div class='market-share-report'><p>Shares</p></div></article>", "T\nShares"),
        ("<article><h1>T</h1><div class='ad-hoc-teams'><p>Teams</p></div></article>", "T\nTeams"),
        ("<article><h1>T</h1><section id='search-algorithms'><p>Sorting</p></section></article>", "T\nSorting"),
        ("<article><h1>T</h1><p class='share-price'>12 euros</p><div class='restaurant-menu'>Soup</div></article>", "T\n12 euros\nSoup"),
        (f"<body><nav><ul><li><a>Menu</a></li></ul>{ARTICLE}</body>", "Title\nStory"),
        (f"<body><nav><ul><li><a>Menu</a></li></ul><div>{ARTICLE}</div></body>", "Title\nStory"),
        (f"<body><nav>Menu<article>Teaser</article></nav>{ARTICLE}</body>", "Title\nStory"),
        (f"<body><header><nav>Menu<article>Teaser</article></header><aside><article>Other</article></aside>{ARTICLE}</body>", "Title\nStory"),
        ("<body><h1>Title</h1><p>Lead</p><article><p>Story</p></article><p>After</p></body>", "Title\nLead\nStory"),
        ("<body><h1>Site</h1><article><h1>Title</h1><p>Story</p></article></body>", "Title\nStory"),
        ("<body><p>Before</p><article><p>Story</p></article></body>", "Story"),
        ("<article><p>Story</p><aside class='pullquote'>Said</aside><aside>Links</aside></article>", "Story\nSaid"),
        ("<article><p>Story</p><div class='share'>Share</div><div class='ad-slot'>Buy</div><div class='post-comments'>Reader</div></article>", "Story"),
        ("<article><p>Story</p><div id='comments'>Reader</div><div class='shareButtons'>x</div><div class='related-posts'>y</div></article>", "Story"),
        ("<body><div class='shop-navbar'>Menu</div><div class='left-sidebar'>Side</div><div class='cookie-notice'>Ok</div><p>Story</p></body>", "Story"),
        ("<article><p>a &lt;b&gt; &amp;amp; &#233; &hellip;</p></article>", "a <b> &amp; é …"),
        ("<article><p>One <p>Two<li>Three<li>Four</article>", "One\nTwo\nThree\nFour"),
    ],
)
def test_common_markup(html, expected):
    assert text(html) == expected


@pytest.mark.parametrize(
    "odd",
    [
        "<b>" * 100_000 + "</i>" * 100_000, "<a " * 100_000, "<!--" * 100_000, "<p>x" * 100_000, "<div>" * 50_000, "</p>" * 100_000,
        "<b>" * 50_000 + "<div></div>" * 50_000, "<ul><li><b>" * 30_000, "<b>x</i>" * 50_000, "<form><nav>" * 20_000, "&amp" * 100_000,
        "<table>" + "<tr><td>x" * 50_000, "<a b='" * 50_000 + ">", "</a " * 100_000, "<![CDATA[" * 50_000,
    ],
    ids=lambda odd: odd[:12],
)
def test_odd_markup_takes_time_in_proportion(odd):
    def seconds(part):
        start = time.process_time()
        htmltext.PageReader(tree=True).read("<article><p>Story</p></article>" + part).text()
        return time.process_time() - start

    assert text("<article><p>Story</p></article>" + odd[:3000]).startswith("Story")
    assert seconds(odd) < 15


def test_comments_that_never_close_hide_nothing_before_them():
    assert text("<p>Story</p><!-- open <p>x</p>").startswith("Story")
    assert text("<p>Story</p>" + "<!-- x --><p>y</p>" * 30) == "\n".join(["Story"] + ["y"] * 30)


def test_importance_equals_brute_force(spark):
    """Entropies of presentations, contents and all that is held, from the records of each page."""
    pages = []
    for i in range(12):
        rows = "".join(f"<li>{w}</li>" for w in ("Start", "Shop", f"Day {i % 3}"))
        pages.append(f"<body><div class='m'><ul>{rows}</ul></div><div class='c'>{'<b>x</b>' * (i % 2)}Story {i}</div><div class='f'>Same</div></body>")
    frame = spark.createDataFrame([("h.example", p) for p in pages] + [(None, pages[0])], "host string, html string")
    found = {r.path: (r.importance, r.n_pages) for r in htmltext.site_tree(frame).collect()}
    seen, kinds = Counter(), defaultdict(Counter)
    for page in pages:
        for path, value in set(htmltext.PageReader(tree=True).read(page).records):
            if value == htmltext.SEEN:
                seen[path] += 1
            else:
                kinds[path, value % 2][value] += 1

    def entropy(counts):
        m = sum(counts.values())
        return -sum(n / m * math.log(n / m) for n in counts.values()) / math.log(m) if m > 1 else None

    assert set(found) == set(seen)
    for path, (importance, n_pages) in found.items():
        own, whole = entropy(kinds[path, 1]), entropy(kinds[path, 0])
        expected = max(x for x in (1.0 if own is None else own, whole) if x is not None)
        assert n_pages == seen[path] and importance == pytest.approx(expected, abs=1e-9)
