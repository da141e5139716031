"""Main text of pages: markup, labelled pages that the field did not see, Viterbi by all paths, edge cases."""

import itertools
import random

import numpy as np
import pytest

from millrace.llm import dom, extraction, pages


def blocks(page):
    return [b.text for b in dom.read(page).blocks]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<p>a <b>b</b>c\n\n d&amp;&nbsp;&eacute;&#x41;<p>e", ["a bc d& éA", "e"]),
        ("<div>x<br>y<script>var t='</p>';<b></script>z</div>w", ["x yz", "w"]),
        ("<style>p{}</style><!-- <p>no</p> --><!DOCTYPE html><p title='a>b' class=\"c>d\">in</p>", ["in"]),
        ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>", ["one", "two", "deep", "three"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("</p></div>text</article><h1>T", ["text", "T"]),
        ("1 < 2 and <3 &lt;p&gt; &bogus; &#0;", ["1 < 2 and <3 <p> &bogus; �"]),
        ("<p class='open>never closed", ["never closed"]),
        ("<textarea>typed</textarea><p>x", ["typed", "x"]),
        ("", []),
        ("<script>all", []),
    ],
)
def test_blocks(page, expected):
    assert blocks(page) == expected


def test_what_stands_around_a_block():
    page = dom.read("<title>T &amp; t</title><body><div id=mainContent class='post-body x1'><p>first<section><p><i>second</i></section>third</div>")
    assert page.title == "T & t"
    first, second, third = page.blocks
    assert set(first.around) == {"body", "div", "p", ".main", ".content", ".post", ".body", ".x"}
    assert second.within == ("section",) and second.path == "section>div>body" and second.tag == "p"
    assert third.within[0] == "div" and "section" not in third.around


def test_viterbi_by_every_path():
    r = np.random.default_rng(3)
    for n in range(1, 8):
        field = extraction.Field(np.zeros((extraction.WEIGHTS, 2)), r.normal(size=(2, 2)))
        emit = r.normal(size=(n, 2))
        score = lambda path: sum(emit[i, s] for i, s in enumerate(path)) + sum(field.moves[a, b] for a, b in itertools.pairwise(path))  # noqa: E731, B023
        assert tuple(field.tags(emit)) == max(itertools.product(range(2), repeat=n), key=score)
    assert field.tags(np.zeros((0, 2))) == []


def test_held_out_labelled_pages():
    field, right, wrong, exact = extraction.train(), 0, 0, 0
    for k in range(50_000, 50_200):
        read, tags = extraction.labelled(pages.labelled_page(k))
        got = np.array(field.tags(field.emissions(extraction.features(read))))
        right, wrong, exact = right + int((got == tags).sum()), wrong + int((got != tags).sum()), exact + bool((got == tags).all())
    assert wrong / (right + wrong) < 0.02 and exact > 170


def article(r, n):
    return " ".join("".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 9))) for _ in range(n)) + "."


@pytest.mark.parametrize("around", ["<article>{}</article>", "<article class='story'>{}</article>", "<main><article>{}</article></main>", "<div class='post-content'>{}</div>", "<main>{}</main>"])
def test_layouts_of_another_hand(around):
    r, field = random.Random(5), extraction.train()
    parts = [article(r, n) for n in (6, 40, 70, 25)]
    body = f"<h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts[1:])
    page = f"""<html><head><title>{parts[0]}</title></head><body><div class="cookie-banner"><p>We use cookies on this site.</p><button>OK</button></div>
    <header><a href="/">Site</a></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li></ul></nav>
    <div class="ad">{article(r, 12)}</div>{around.format(body)}
    <aside class="sidebar"><h3>Most read</h3><ul><li><a href="/c">{article(r, 5)}</a></li></ul></aside>
    <section class="comments"><h3>2 comments</h3><div class="comment"><p>{article(r, 20)}</p></div><div class="comment"><p>{article(r, 9)}</p></div></section>
    <form class="newsletter"><label>Your e-mail</label><input><button>Subscribe</button></form><footer>&copy; 2024 {article(r, 8)}</footer></body></html>"""
    assert extraction.main_text(page, field) == " ".join(parts)


def test_rows(spark):
    r = random.Random(2)
    long = [article(r, 12) for _ in range(20_000)]
    whole = "<body><article>" + "".join(f"<p>{p}" for p in long) + "</article><footer>&copy; x</footer>"
    deep = "<div>" * 30_000 + "<p>deep</p>" + "</span>" * 1000
    rows = [(1, "u", "<body><article><p>Some words of an article.</p></article></body>", "x"), (1, "u", "<body><article><p>Some words of an article.</p></article></body>", "x"), (None, None, None, None), (2, "v", "", "y"), (3, "w", whole, "z"), (4, "w", deep, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extraction.extract(df).collect()
    assert [x.page_id for x in out] == [1, 1, None, 2, 3, 4]
    assert [x.text for x in out[:4]] == ["Some words of an article."] * 2 + ["", ""] and [x.n_chars for x in out[:4]] == [25, 25, 0, 0]
    assert out[4].text == " ".join(long) and out[4].n_chars == len(out[4].text)
    assert extraction.extract(df.limit(0)).count() == 0


def test_nothing_to_learn_from():
    assert extraction.main_text("<p>a", extraction.fit([])) == ""
