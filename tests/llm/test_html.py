from __future__ import annotations

import html
import re
import time

import pyarrow.parquet as pq
import pytest

from orelode.llm.html_layout import extract, render, title

PAGES = [
    ("<p>one<p>two <b>bold</b> text", "one\n\ntwo bold text"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>after", "- a\n- b\n  3. c\n  4. d\n- e\n\nafter"),
    (
        "<table><tr><th>name<th>n<tr><td>apple</td><td>12</td></tr><tr><td>fig<td>3</table>",
        "name   n\napple  12\nfig    3",
    ),
    ("<table><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide     z\na     b  c"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td>x<br>y<td>1</table>", "x  1\ny"),
    ("a<span hidden>no</span><div style='color:red; display: none'>no</div>b", "ab"),
    ("a<script>var x='</p>';</script>b<style>p{}</style><!-- c -->d<template>t</template>", "abd"),
    ("<head><title>T &amp; U</title></head>x", "x"),
    ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
    ("a<br>b<hr>c", "a\nb\n\nc"),
    ("5 &lt; 6 & 7 < 8 &copy; &am", "5 < 6 & 7 < 8 © &am"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
    ("<h1>h</h1><div>x</div><div>y</div>", "h\n\nx\ny"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("text <a href='x>y'>link</a>", "text link"),
    ("kept <unfinished", "kept"),
    ("", ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_layout(page, text):
    assert render(page) == text


def test_deep_and_broken_pages_end_soon():
    start = time.process_time()
    assert render("<div>" * 50_000 + "x") == "x"
    assert render("<table><tr><td>" * 1500 + "x") == "x"
    render('<a "' * 30_000)
    render("<p>" * 50_000 + "</b>" * 50_000)
    assert time.process_time() - start < 30


def test_all_visible_words_of_the_test_pages():
    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["html"])["html"].to_pylist()
    for page in pages:
        plain = re.sub(r"<!--.*?-->|<(script|style|title)\b.*?</\1>", "", page, flags=re.DOTALL)
        plain = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:a|b)\b[^>]*>", "", plain)))
        shown = [w for line in render(page).split("\n") for w in re.sub(r"^\s*- ", "", line).split()]
        assert shown == plain.split()


def test_extract(spark):
    rows = [(1, "<title>t</title><p>a<p>b", "x"), (2, None, "y"), (2, None, "y"), (None, "", "z")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = sorted((r.page_id or 0, r.title, r.text, r.n_lines) for r in extract(df).collect())
    assert out == [(0, "", "", 0), (1, "t", "a\n\nb", 3), (2, "", "", 0), (2, "", "", 0)]
    assert extract(df.limit(0)).collect() == [] and title("<TITLE>a\n b") == "a b"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds", "so x=2 holds"),
        ("<math><semantics><mi>y</mi><annotation>\\y</annotation></semantics></math>", "y"),
        ("<p>a<textarea rows=2>\n  one &lt;b>\n\ntwo</textarea>b", "a\n  one <b>\n\ntwo\nb"),
        (
            "a<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><style>no</style>no<g><text x=1>one "
            "<tspan>two</tspan></text><line x1='0'/><text>three</text></g></svg>b",
            "a\none two\nthree\nb",
        ),
        ("<svg><foreignObject><p>inner</foreignObject>no</svg>after", "inner\n\nafter"),
        ("<svg><defs/><title/><text>label</text></svg><svg viewBox='0 0 1 1'/>after", "label\nafter"),
        ("<object data=x><param name=p>instead <b>of it</b></object>", "instead of it"),
        ("<text>plain</text> <canvas>no</canvas>x", "plain x"),
    ],
)
def test_formulas_drawings_text_areas_and_fallbacks(page, text):
    assert render(page) == text
