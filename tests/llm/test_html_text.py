import random
import time

import pytest

from quayside.llm import html_text
from quayside.llm.html_text import extract_pages, main_text, min_cut

ARTICLE = "<h1>Title &amp; more</h1><p>First  <b>bold</b>\n text of&nbsp;it.<p>Second, with <a href='/x'>a link</a> in it, goes on for a while."
TEXT = "Title & more\nFirst bold text of it.\nSecond, with a link in it, goes on for a while."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("  \n", ""),
    (f"<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>&copy; X</footer>", TEXT),
    (f"<body><header><h2>Site name</h2></header><main>{ARTICLE}</main><aside><p>Read this other story, it is long and has full stops.</p></aside>", TEXT),
    (f"<div class='cookie-notice'><p>We use cookies. Accept them all.</p></div><div id=content>{ARTICLE}</div>", TEXT),
    (f"<article>{ARTICLE}<div class=ad>Buy now. Cheap things for everybody here.</div></article>", TEXT),
    (f"<article>{ARTICLE}</article><section id='comments'><p>I like this article a lot, thank you for it.</p></section>", TEXT),
    (f"<article>{ARTICLE}<section class='comments'><article><p>Me too, a reader says at some length.</p></article></section></article>", TEXT),
    (f"<script>var a='</p><p>no text';</script><style>p{{}}</style><!-- <p>gone</p> --><article>{ARTICLE}</article><form><p>Your name please.</p><input></form>", TEXT),
    (f"<article>{ARTICLE}<!-- unclosed <p>x", TEXT), (f"<article>{ARTICLE}<script>unclosed <p>x", TEXT),
    ("<article><p>a &lt; b<br>c</p></article>", "a < b c"),
    ("<article><p title=it's data-x = 'a > b' y=\"<p>\">It isn't lost, nor is 'this'.<img src='/a>b.png'/> End.</p></article>", "It isn't lost, nor is 'this'. End."),
    ("<article><p title=\"unclosed>One.</p><p>Two.</p></article>", "One.\nTwo."),
    (f"<article>{ARTICLE}</article><div role='banner'><p>Some banner that speaks in sentences.</p></div>", TEXT),
    ("<article><p>1 < 2 and 3 > 2, \"quoted\" it's</p></article>", "1 < 2 and 3 > 2, \"quoted\" it's"),
])
def test_pages(page, text):
    assert main_text(page) == text


# Pages without telling names, labelled by hand: a 1 or 0 for each block, content or not.
LONG = "This sentence is one of several that make up the article's body, and it is not a short one at all."
BY_HAND = [
    (f"<div><div>{LONG}</div><div>Then came the rain</div><div>{LONG}</div><div>{LONG}</div></div>", "1111"),
    (f"<div><div>{LONG}</div><div>Three facts</div><div>It was late</div><div>{LONG}</div></div>", "1111"),
    (f"<div><p>{LONG}</p><div>Figure 2</div><p>{LONG}</p></div>", "111"),
    (f"<div><p>{LONG}</p><table><tr><td>Year</td><td>1987</td></tr><tr><td>Place</td><td>Oslo</td></tr></table><p>{LONG}</p></div>", "111111"),
    (f"<div><div><a href=/>Home</a></div><div><a href=/n>News</a></div><div><a href=/s>Sport</a></div></div><div><p>{LONG}</p><p>{LONG}</p></div>", "00011"),
    (f"<div><div>Contents</div><div><a href=#1>One</a></div><div><a href=#2>Two</a></div></div><div><p>{LONG}</p></div>", "0001"),
    (f"<div><p>{LONG}</p><p>Why?</p><p>{LONG}</p></div><div><span>Legal</span><p><a href=/t>Terms and conditions</a></p><p><a href=/p>Privacy</a></p></div>", "111000"),
    (f"<div><div>{LONG}</div><div>He said no</div><div>She said yes</div><div>{LONG}</div></div><div><div><a href=/a>About</a></div><div>Since 1999</div><div><a href=/c>Contact</a></div></div>", "1111000"),
    (f"<body><div>{LONG}</div><div>A pause</div><div>{LONG}</div></body>", "111"),
]


def test_the_cut_mends_labels_that_blocks_alone_get_wrong():
    by_sign = by_cut = changed = total = 0
    for page, truth in BY_HAND:
        found = html_text.blocks(page)
        html_text.edges(found)
        alone = [b.evidence > 0 for b in found]
        cut = min_cut([b.evidence for b in found], [b.links for b in found])
        want = [c == "1" for c in truth]
        assert len(found) == len(want), (page, [b.text for b in found])
        by_sign += sum(x != y for x, y in zip(alone, want))
        by_cut += sum(x != y for x, y in zip(cut, want))
        changed += sum(x != y for x, y in zip(alone, cut))
        total += len(want)
    assert (total, by_sign, by_cut, changed) == (42, 11, 4, 7)  # the four: cells of a small table


@pytest.mark.parametrize("page", ["<div>x y z" * 100_000, "<div><p>x" * 50_000 + "</p>" * 50_000, "<span>" * 100_000 + "<p>a</b>" * 50_000,
                                  "<p><div>" + "<b>" * 50_000 + "<h2>t</i>" * 50_000, "<ul><li>" * 30_000 + "</ul></li>" * 30_000])
def test_deep_pages_take_time_in_proportion(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 30


def cost(label, gain, links):
    return sum(abs(g) for g, x in zip(gain, label) if (g > 0) != x and g) + sum(w for k, of in enumerate(links) for j, w in of if j < k and label[j] != label[k])


def test_minimum_cut_matches_enumeration():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 9)
        gain = [rng.choice([-1, 1]) * rng.random() * 2 for _ in range(n)]
        links = [[] for _ in range(n)]
        for a in range(n):
            for b in range(a):
                if rng.random() < 0.6:
                    w = rng.random() * 1.5
                    links[a].append((b, w))
                    links[b].append((a, w))
        best = min(cost([m >> k & 1 == 1 for k in range(n)], gain, links) for m in range(1 << n))
        assert cost(min_cut(gain, links), gain, links) == pytest.approx(best)


def test_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x"), (1, "u", f"<article>{ARTICLE}</article>", "x"), (None, None, None, None),
            (2, "v", "<p>" * 3000 + "deep and long text that is an article. " * 400, "y"), (3, "w", "no tags at all, but a sentence that goes on and on, as they do. " * 3, "z")]
    out = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")).collect()
    assert len(out) == 5 and all(r["n_chars"] == len(r["text"]) for r in out)
    assert [r["text"] for r in out if r["page_id"] == 1] == [TEXT, TEXT]
    assert next(r for r in out if r["page_id"] == 2)["n_chars"] == 39 * 400 - 1
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
