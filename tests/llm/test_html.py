from __future__ import annotations

import html
import re
import time

import numpy as np
import pytest

from shiftledger.llm import html_crf as H
from shiftledger.llm.common import table
from shiftledger.llm.html_blocks import blocks


@pytest.fixture(scope="module")
def model(spark):
    return H.train(table(spark, "/root/testdata/sf0.001", "pages"), sample=40)


def test_article_of_the_given_pages(spark, model):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {x.page_id: x for x in H.extract(pages, model).collect()}
    for x in pages.collect():
        inner = x.html.split("<article>", 1)[1].split("</article>")[0]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[x.page_id].text == want and got[x.page_id].n_chars == len(want)


def test_held_out_layouts(model):
    right = total = 0
    for chain, labels in H.composed(120, seed=77):
        right += int(np.sum(np.array(model.decode(chain)) == np.array(labels)))
        total += len(labels)
    assert right / total > 0.97


def test_parts_of_a_page_that_are_no_article(model):
    page = """<html><head><title>no</title><style>p{}</style></head><body>
    <div class="cookie-notice"><p>We use cookies, agree please.</p></div><header><a href=/>Site</a></header>
    <nav><ul><li><a href=/a>menu</a><li><a href=/b>more</a></ul></nav>
    <div id="content"><h1>A title here</h1><p>Fine&nbsp;text &amp; <b>bo</b>ld, with   many words in it.
    <p>Another para&#103;raph follows, with more words.</div>
    <aside class="sidebar"><p>Related things to read, maybe.</p></aside>
    <form action=/s><label>Search</label><p>Type here</p></form>
    <section id="comments"><p>First reader says a few words.</p></section>
    <script>var x = "<p>no</p>";</script><!-- <p>no</p> --><footer>&copy; us</footer></body>"""
    assert model.text(page) == "A title here Fine text & bold, with many words in it. Another paragraph follows, with more words."


def test_broken_and_empty_pages(spark, model):
    odd = [None, "", "   ", "<", "<p", "<!-- open", "<script>x", "plain words", "<p>a<div>b</p>c", "</p></div>", "&#0; &bogus; &am", "<a href='>x", "<p>" * 2000 + "deep"]
    pages = spark.createDataFrame(
        [(i, None if i == 2 else "u", h, 1) for i, h in enumerate(odd)] + [(None, "u", "<p>x</p>", 1)] * 2,
        "page_id long, url string, html string, text int",
    )
    got = H.extract(pages, model).collect()
    assert len(got) == len(odd) + 2 and all(x.text is not None and x.n_chars == len(x.text) for x in got)
    assert all(x.text == "" for x in got if x.page_id in (0, 1, 2))
    assert H.extract(pages.where("false"), model).count() == 0
    assert H.train(pages.where("false")).index  # composed pages alone


def test_blocks():
    got = [(b.text, b.tags) for b in blocks("<div><p>a <i>b</i>c<br>d<ul><li>x<li>y &lt;</ul>tail</div>")]
    assert [t for t, _ in got] == ["a bc", "d", "x", "y <", "tail"]
    assert got[2][1] == ("div", "ul", "li") and got[4][1] == ("div",)


def test_viterbi_is_the_best_sequence():
    r = np.random.default_rng(0)
    chain = [b for b, _ in zip(blocks("<p>a</p><h1>b</h1><li>c</li><nav>d</nav>"), range(4))]
    index = {f: i for i, f in enumerate(sorted({f for fs in H.features(chain) for f in fs}))}
    for _ in range(30):
        model = H.Chain(index, r.standard_normal((len(index), 2)), r.standard_normal((2, 2)))
        e = np.array(model.emissions(chain))
        best = max(
            ((sum(e[i, y] for i, y in enumerate(ys)) + sum(model.step[a, b] for a, b in zip(ys, ys[1:]))), ys)
            for ys in np.ndindex(2, 2, 2, 2)
        )[1]
        assert model.decode(chain) == list(best)


@pytest.mark.parametrize("attrs", [
    'style="overflow:hidden"', "style=overflow:hidden", 'class="overflow-hidden"', 'class="hidden-xs"',
    'id="the-hidden-cost"', 'href="/hidden-gems"', 'title="the hidden part"', "title='display:none'", 'data-hidden="1"',
    'aria-hidden="false"', 'aria-hidden="true"', "aria-hidden=TRUE", 'aria-label="hidden"', 'title="a > b hidden"', 'style="background:url(a;display:none)"',
    'style="/* display:none */ color:red"', 'style="display:none;display:block"', 'data-style="display:none"',
])
def test_words_of_hiding_that_hide_nothing(attrs):
    for tag in ("body", "div", "h1", "a"):
        assert [b.text for b in blocks(f"<{tag} {attrs}>seen <i>words</i></{tag}>")] == ["seen words"]


@pytest.mark.parametrize("attrs", [
    "hidden", "HIDDEN", 'hidden=""', "class=x hidden", 'style="display:none"',
    "style=display:none", "style='color:red; Display : NONE !important'", 'style="display:none!important;display:block"',
    'style="visibility:hidden"', "class='a'hidden", 'style="display&#58;none"',
])
def test_hidden_elements(attrs):
    page = f"<div>a<div {attrs}>no <p>nor this</p></div>b</div>"
    assert [b.text for b in blocks(page)] == ["a", "b"]


def test_visibility_set_anew_inside():
    page = '<div style="visibility:hidden">no<p style="visibility:visible">yes</p><p>no</p></div>z'
    assert [b.text for b in blocks(page)] == ["yes", "z"]


@pytest.mark.parametrize("page", [
    "<html><head><title>t</title><body><article><p>One <b>two</b></article></body></html>",
    "<head><title>t</title><meta charset=x><link rel=x href=y><base href=/><article><p>One two</article>",
    "<head><style>p{}</style><script>x</script><noscript>n</noscript><template><p>no</p></template><p>One two",
    "<html><head><html><head><title>t</title></head><body>One two",
    "<head><title>t</title> One two", "<head><a href=/x>One</a> two", "<head><meta charset=x></html>One two",
])
def test_head_without_its_end_tag(page):
    assert [b.text for b in blocks(page)] == ["One two"]


def test_article_of_a_page_without_the_end_of_its_head(model):
    rest = "<body><article><h1>A title here</h1><p>Fine text, with many words in it.</p></article></body></html>"
    want = model.text("<html><head><title>t</title></head>" + rest)
    assert want and model.text("<html><head><title>t</title>" + rest) == want


@pytest.mark.parametrize("page,want", [
    # a quote opens a value only where the value begins
    ("<p class=it's>Don't lose this text.</p><p>It's second.</p>", ["Don't lose this text.", "It's second."]),
    ('<p title=5">Five inches</p><p>6" more</p>', ["Five inches", '6" more']),
    ("<p data-x='a > b' class=y>One</p>", ["One"]),
    ('<a href=/x/>link</a> on', ["link on"]),
    ("<p a=1b='2'c>One</p>", ["One"]),
    # pictures, fields and icons stand inside words
    ("a<img src=x>b c", ["ab c"]),
    ("wo<input type=hidden>rd <svg><text>no</text></svg>s", ["word s"]),
    ("wo<script>no()</script>rd", ["word"]),
    ('<p><span aria-hidden="true">O</span>nce upon</p>', ["Once upon"]),
    # marks that begin no tag
    ("<p>1 < 2 and <3 and a<b c</p>", ["1 < 2 and <3 and a"]),
    ("a</ no >b<!x>c<?y?>d<!-->e<!-- <p>no --!>f", ["abcdef"]),
    ("<p>kept</p><a href='never closed>all this", ["kept"]),
    ("<custom/>a<br/>b", ["a", "b"]),
])
def test_words_are_neither_lost_nor_cut(page, want):
    assert [b.text for b in blocks(page)] == want


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<div>a" * 180_000, "<div>" * 200_000 + "</span>" * 100_000, "<" * 1_000_000, "<p a='" * 180_000,
    "<p><table><td>" + "<div>" * 60_000 + "<li>x" * 60_000, "<b>x" * 250_000, "<a " + " " * 1_000_000, "<!--" * 250_000,
    "<div class='a b c d'>x</b>" * 40_000, "<script>" * 120_000, "&amp" * 250_000, "<svg/><a b" * 100_000,
])
def test_a_page_of_a_megabyte_takes_seconds(model, page):
    start = time.perf_counter()
    model.text(page)
    H.marked(page)
    assert time.perf_counter() - start < 20


def test_places_give_all_features_of_all_ancestors():
    page = "<main class=post><div id=menu><div class=menu><p>a</p></div>b<div class='ad x'>c</div></div>d</main>e<nav>f"
    chain = blocks(page)
    H.settle(chain)
    for b in chain:
        want, near = {"bias", f"tag={b.tags[-1] if b.tags else ''}"}, ""
        for place in reversed(list(b.place.up()) if b.place else []):
            own, group = H._own_features(place)
            want |= set(own)
            near = group or near
        assert set(H.place_features(b.place)) == want | {f"near={near}"}
        assert len(H.place_features(b.place)) == len(want) + 1
    assert [b.text for b in chain] == list("abcdef")


def test_training_reads_one_page_of_an_id(spark):
    pages = spark.createDataFrame([(1, "<main><p>one</p></main>"), (1, "<p>two"), (None, "x"), (None, None)], "page_id long, html string")
    assert H.train(pages).index
