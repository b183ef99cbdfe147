import pytest

from larder.llm.pages import page_text, render

CASES = [
    ("", ""),
    ("plain &amp; text", "plain & text"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>a</div><div>b<br>c</div>", "a\nb\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x</li><li><p>y</p><p>z</p></li></ol>", "3. x\n4. y\n   z"),
    ("<table><tr><th>name<th>n<tr><td>long value<td>1<tr><td colspan=2>all</table>", "name        n\nlong value  1\nall"),
    ("<table><tfoot><tr><td>sum</tfoot><thead><tr><td>head</thead><tr><td>a<br>b<td>c</table>", "head\na     c\nb\nsum"),
    ("<p>a <b>b</b>  c</p> <script>var x = '<p>no</p>';</script><style>.h{display:none}</style><i class='x h'>gone</i>d", "a b c\n\nd"),
    ("<p hidden>no<p style='display: none'>no<p>yes<input type=hidden value=no><!-- no --></p>", "yes"),
    ("<pre>a  b\n  c</pre>", "a  b\n  c"),
    ("<html><head><title>t</title><meta x><body>b</html>", "b"),
    ("<p>a</div></span>b", "ab"),
    ("<h1>T</h1>x<blockquote>q</blockquote>", "T\n\nx\n\n  q"),
    ("<dl><dt>k<dd>v<dt>k2<dd>v2</dl>", "k\n  v\nk2\n  v2"),
    ("a<b", "a"),
    ("2 < 3 &lt;x&gt; <3", "2 < 3 <x> <3"),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_rendering(html, text):
    assert render(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tr><td rowspan=3 colspan=2>a<td>b<tr><td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "a     b\n      c\n      d\ne  f  g"),
    ("<table><tr><td colspan=2>wide cell<td>x<tr><td>a<td>b<td>c</table>", "wide cell   x\na  b        c".replace("   x", "  x").replace("b        c", "b       c")),
    ("<table><tr><td colspan=1000>a<td>b</table>", "a  b"),
    ("a <textarea> x &amp; y\n z</textarea><xmp><b>&amp;</b></xmp>", "a\n x & y\n z\n<b>&amp;</b>"),
    ("<p>pick <select><option>one<option selected>two<option>three</select> now", "pick two now"),
    ("<select multiple><option>one<option>two</select>", "one\ntwo"),
    ("<svg><title>no</title><text>label</text></svg> <math><mi>x</mi><annotation>no</annotation></math>", "label x"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>", "yes"),
    ("<style>p{display:none} p.on{display:block}</style><p>no<p class=on>yes", "yes"),
    ("<style>.c{display:none}</style><p class=c style='display:block'>yes<p class=c>no", "yes"),
    ("<style>.c{display:none!important}</style><p class=c style='display:block'>no</p>x", "x"),
    ("<style>#a{display:block} .c{display:none} *{color:red}</style><p id=a class=c>yes", "yes"),
    ("<p hidden style='display:block'>yes<p hidden>no", "yes"),
])
def test_spans_boxes_and_cascade(html, text):
    assert render(html) == text


def test_depth_changes_nothing():
    inner = "<ul><li>a x<b>y</b>z<table><tr><td>c<td>d</table><img alt=pic></ul>"
    for tag in ("div", "b", "blockquote"):
        for depth in (0, 160, 3000):
            got = render(f"<{tag}>" * depth + inner)
            assert [line.strip() for line in got.split("\n") if line] == ["- a xyz", "c  d", "pic"]


@pytest.mark.parametrize("piece", ["<b>", "</i>", "<div>", "</p>", "<ul><li>", "<table>", "<table><tr><td>", "<p>", "<td>", "<select>", "<b></i>", "<div></p>", "<td colspan=1000 rowspan=9>", "<li>", "<span class=a>"])
def test_time_is_linear(piece):
    import time

    began = time.process_time()
    text = render("<style>.a{color:red} .b{display:none}</style><table>" * (piece == "<td colspan=1000 rowspan=9>") + piece * (100_000 if "colspan" not in piece else 3000) + "end")
    assert text.endswith("end") and time.process_time() - began < 12


def _random_page(rng, depth=0):
    """(html, visible words in order) of a random well-formed tree, by its own rules and not by the renderer's."""
    html, words = [], []
    for _ in range(rng.randint(1, 5)):
        kind = rng.random()
        word = "w" + "".join(rng.choice("abcdé") for _ in range(6))
        if kind < 0.35 or depth > 7:
            html.append(f" {word} ")
            words.append(word)
            continue
        inner, inside = _random_page(rng, depth + 1)
        if kind < 0.6:
            tag = rng.choice(["div", "b", "span", "section", "blockquote", "h2", "em", "a"])
            hide = rng.choice(["", "", "", " hidden", " style='display:none'", " class='x gone'", " id=off"])
            html.append(f"<{tag}{hide}>{inner}</{tag}>")
            words += [] if hide else inside
        elif kind < 0.7:
            items = [_random_page(rng, depth + 2) for _ in range(rng.randint(1, 3))]
            html.append("<ul>" + "".join(f"<li>{h}" + rng.choice(["", "</li>"]) for h, _ in items) + "</ul>")
            words += [w for _, ws in items for w in ws]
        elif kind < 0.8:
            cells = [[f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 3))]
            html.append("<table>" + "".join("<tr>" + "".join(f"<td>{w}" for w in row) for row in cells) + "</table>")
            words += [w for row in cells for w in row]
        elif kind < 0.9:
            html.append(rng.choice([f"<script>var {word}</script>", f"<!-- {word} -->", f"<style>.{word}{{}}</style>", f"<template>{inner}</template>", f"<noscript>{inner}</noscript>"]))
        else:
            html.append(f"<pre>{word}\n  {word}</pre><img alt='{word}'><br>")
            words += [word, word, word]
    return "".join(html), words


def test_all_visible_words_in_order():
    """Random pages against the words their own tree shows."""
    import random

    rng = random.Random(12)
    for _ in range(400):
        html, words = _random_page(rng)
        page = "<!doctype html><head><title>no</title><style>.gone, #off {display:none}</style></head><body>" + html
        assert render(page).replace("- ", " ").split() == words


def test_deep_and_broken_pages():
    assert render("<div>" * 5000 + "x") == "x"
    assert "y" in render("<table>" * 300 + "<td>y")
    assert render("<" * 2000 + "a") is not None
    assert render("<p title='unclosed>text") == ""


@pytest.mark.parametrize(("html", "text"), [
    ('<img alt="5" tall">visible <b>text</b>', "5visible text"),
    ("<a href=it's>one</a> two <i title='x'>three</i>", "one two three"),
    ('<table><tr><td width=5">a<td class="c">b</table>', "a  b"),
    ('<p class="a"id="b">x<p title = "1 > 0">y', "x\n\ny"),
    ("<p hidden=>no</p><p a='b'c'>yes", "yes"),
    ('<p "hidden">yes', "yes"),
    ("<br/><p title=/x/>y", "y"),
])
def test_stray_quotes_keep_the_text(html, text):
    assert render(html) == text


@pytest.mark.parametrize(("css", "text"), [
    ("@media print { .c { display:none } }", "x"),
    ("@media (max-width:600px) { .b {color:red} .c { display:none } } .d{display:none}", "x"),
    ("@media screen { .c { display:none } }", ""),
    ("@media print, all { .c { display:none } }", ""),
    ("@media only screen and (min-width:9px) { .c { display:none } }", "x"),
    ("@supports (display:grid) { .c { display:none } }", "x"),
    ("@import 'a.css'; @charset \"u\"; .c{display:none}", ""),
    ("@font-face{src:url(a)} @keyframes k { from {top:0} .c {display:none} } p{color:red}", "x"),
    (".c{display:none} .c{color:red;display:block}", "x"),
    (".c{display:none!important} .c{display:block}", ""),
    (".c{display:block} .c { visibility: hidden; }", ""),
    (".c:before{content:'}'} /* } */ .d, .c{display : NONE", ""),
    ("@layer a{.c{display:none}}", ""),
])
def test_style_rules_keep_their_conditions(css, text):
    assert render(f"<style>{css}</style><p class=c>x") == text


def test_style_sheets_for_other_media():
    assert render("<style media=print>.c{display:none}</style><p class=c>x") == "x"
    assert render("<style media=screen>.c{display:none}</style><style>.d{display:none}</style><p class=c>x<p class=d>y") == ""


def test_table(spark):
    rows = [(1, "u", "<p>x", "k"), (None, None, None, None), (1, "u", "<p>x", "k"), (2, "v", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text, r.n_chars, r.n_lines) for r in page_text(pages).collect())
    assert got == [("1", "x", 1, 1), ("1", "x", 1, 1), ("2", "", 0, 0), ("None", "", 0, 0)]
    assert page_text(pages.limit(0)).count() == 0


def test_all_article_words_stay(spark):
    """Every word of the driver's pages outside markup, scripts and titles is in the text."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in page_text(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"(?s)<(script|style|title|noscript|template)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ", r.html or "")
        wanted = set(re.findall(r"[A-Za-zÀ-ÿ]{4,}", re.sub(r"&\w+;", " ", body)))
        missing = wanted - set(re.findall(r"[A-Za-zÀ-ÿ]{4,}", texts[r.page_id]))
        assert len(missing) <= 0.02 * len(wanted), (r.page_id, missing)
