"""Text of pages: tree building, visibility and layout."""

import re

import pytest

from plumbline.llm.html_text import extract, page_text

CASES = [
    ("", ""),
    ("plain", "plain"),
    ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<b>x</b> <i>y</i>z", "x yz"),
    ("  a \n\t b&nbsp;c  ", "a b\xa0c"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>tail", "- a\n- b\n  3. x\n  4. y\n- c\n\ntail"),
    ("<ol><li value=7>q<li>r</ol>", "7. q\n8. r"),
    ("<table><tr><td>1<td>22<tr><td>333<td>4</table>", "1    22\n333  4"),
    ("<table><tr><th colspan=2>head<th>x<tr><td>a<td>b<td>c</table>", "head     x\na     b  c"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table>out<tr><td>in</table>", "out\n\nin"),
    ("<table><td>no row<p>two</table>after", "no row two\n\nafter"),
    ("<table><tr><td><table><tr><td>x<td>y</table><td>z</table>", "x y  z"),
    ("<script>var a = '<p>no</p>';</script>yes<style>p{}</style>", "yes"),
    ("<head><title>t</title></head><body>b", "b"),
    ("<title>t</title><p>b", "b"),
    ("<div hidden>no</div><span style='color:red; display : none'>no</span>yes", "yes"),
    ("<details><summary>s</summary>d</details><details open><summary>s</summary>d</details>", "s\ns\nd"),
    ("<pre>\n a\n   b\n\nc</pre>d", " a\n   b\n\nc\n\nd"),
    ("<!-- x > y -->a<!-->b<!doctype html>c<?php x ?>d", "abcd"),
    ("1 < 2 &lt; 3 &amp;amp; &copy; &#8364;", "1 < 2 < 3 &amp; © €"),
    ("<a title='a > b' href=x>link</a><img alt=no src=x>", "link"),
    ("<p>a</p></p><p>b", "a\n\nb"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<textarea>\n x <b>\n</textarea>", " x <b>"),
    ("text <b", "text"),
    ("</div>x</span></body>y", "xy"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"),
    ("<h1>a</h2><h3>b", "a\n\nb"),
    ("<body hidden>x", ""),
]


@pytest.mark.parametrize("source, text", CASES)
def test_pages(source, text):
    assert page_text(source) == text


def test_hostile_pages_take_no_time():
    for source in ("<div>" * 50_000 + "x", "<p><table><tr><td>" * 3000 + "x", "<a '" * 20_000, "<!--" * 20_000, "<" * 100_000, "<table><tr><td colspan=1000 rowspan=65534>x" * 50, "<li>" * 30_000, "&" * 50_000, "<b><p>" * 20_000):
        assert isinstance(page_text(source), str)


def test_all_words_of_paragraphs_come_through_in_order(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        seen = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->", "", row["html"])
        words = re.sub(r"<[^>]*>", " ", seen).split()
        import html

        want = [w for x in words for w in html.unescape(x).split()]
        got = [w for w in page_text(row["html"]).split() if w != "-"]
        assert "".join(got) == "".join(w for w in want if w != "-")


def test_table_of_pages(spark):
    rows = [(1, "<p>a"), (1, "<p>a"), (2, None), (3, ""), (None, "<b>x")]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "1 as text", "2 as url")
    assert sorted((tuple(r) for r in extract(df).collect()), key=repr) == sorted([(1, "a"), (1, "a"), (2, ""), (3, ""), (None, "x")], key=repr)
    assert extract(df.limit(0)).collect() == []
