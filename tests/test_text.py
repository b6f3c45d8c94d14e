"""Text evidence on hand-made lines."""

import base64
import json
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from plumbline.functions import values as v
from plumbline.functions import vocabulary as vocab
from plumbline.operators import evidence as e
from plumbline.operators import links

from .conftest import rows


@pytest.mark.parametrize(
    "line, alias, unit, want",
    [
        ("就业率为 92.5% ，其他 10%", "就业率", "ratio", 0.925),
        ("上年 88% 就业率。 10%", "就业率", "ratio", 0.88),
        ("就业率。92%", "就业率", "ratio", None),
        ("总人数 12 人，满意 90 分", "总人数", "number", 12.0),
        ("得分 430 与 88.5", "得分", "score", 88.5),
        ("95 430 得分 101", "得分", "score", 95.0),
        ("95 and much more before 得分 430", "得分", "score", None),
        ("得分 7", "得分", "score", 7.0),
        ("12.5 得分", "得分", "number", 12.5),
        ("12.5 and many words before 得分", "得分", "number", None),
        ("编号1234得分", "得分", "number", None),
        ("就业率 12395.2%", "就业率", "ratio", 0.052),
        ("就业率高，升学 20%", "就业率", "ratio", None),
        ("升学 120 人，占 20%", "升学", "ratio", 0.2),
        ("国内升学 120 人，占 20%", "升学", "ratio", None),
        ("升学率 20%", "升学", "ratio", None),
    ],
)
def test_nearest_value(frame, line, alias, unit, want):
    got = frame("line string", (line,)).select(e.nearest_value(F.col("line"), F.lit(alias), unit).alias("x")).first().x
    assert got == (pytest.approx(want) if want is not None else None)


def test_candidates_respect_context_and_keep_the_first_line(frame):
    metrics = [{"metric_key": "rate", "label": "就业率", "unit": "ratio", "aliases": ["落实率"], "blocked_context_any": ["满意度"], "required_context_any": ["本科"]}]
    lines = frame(
        "doc int, line_no int, line string, context string",
        (1, 0, "本科落实率 90%", "本科落实率 90%"),
        (1, 5, "本科落实率 90%", "本科落实率 90%"),
        (1, 6, "本科就业率 80%", "本科就业率 80% 满意度"),
        (1, 7, "就业率 70%", "就业率 70%"),
        (2, 1, "本科就业率", "本科就业率 61%"),
    )
    got = e.metric_candidates(lines, ["doc"], metrics)
    assert rows(got, "doc", "line_no", "candidate_value", "match_alias", "confidence") == [(1, 0, 0.9, "落实率", "low"), (2, 1, 0.61, "就业率", "medium")]


@pytest.mark.parametrize(
    "quote, want",
    [
        ("2024届本科毕业生初次就业率，男生升学", "2024届，本科毕业生，性别分组，不是学校总体就业率或本科总体口径，升学，初次毕业去向"),
        ("２０２３ 届高职，截至 2023年8月31日", "２０２３届，专科/高职毕业生，截至2023年8月31日"),
        ("截至12月1日", "截至12月1日"),
        ("软件工程专业就业率", "专业口径，不是学校总体就业率或本科总体口径，就业率"),
        ("就业率较去年上升", "变化幅度，不是学校总体就业率或本科总体口径，就业率"),
        ("就业率。人数上升", "就业率"),
        ("nothing", ""),
    ],
)
def test_scope_tags(frame, quote, want):
    assert frame("q string", (quote,)).select(e.scope_tags(F.col("q"), vocab.SCOPE_RULES).alias("s")).first().s == want


def test_printed_numbers(frame):
    df = frame("t string", ("650 1,234 12345，678",), ("600123",), ("1234567 8.900",), ("12,",))
    got = [r.n for r in df.select(e.printed_numbers(F.col("t")).alias("n")).collect()]
    assert got == [[650, 1234, 123, 45678], [600, 123], [123, 4567, 8900], [12]]


def test_lookalikes_and_count(frame):
    df = frame("t string", ("l0O 25",))
    row = df.select(e.lookalike_numbers(F.col("t")).alias("n")).select("n", e.pick_count(F.col("n")).alias("small"), e.pick_count(F.col("n"), "last_positive").alias("last")).first()
    assert (row.n, row.small, row.last) == ([100, 25], 25, 25)


def test_table_rows(frame):
    html = "<table><tr><th>a<td>1-02<td>  two   <b>words</b></td></tr><tr><td></td></tr></table><table><tr><td>9-9-9</td><td>7</td><td>x</td></tr></table>"
    got = e.html_table_rows(frame("p long, h string", (1, html), (2, None)), "p", "h")
    assert rows(e.code_name_rows(got, "p"), "p", "code", "name", "level") == [(1, "9-9-9", "x", 3)]


def test_ranking_reports_a_short_list(frame):
    df = frame("p int, h string", (1, "<p>本季 排行前3个紧缺职业分别为 甲、乙。</p>"), (2, "none"))
    assert rows(e.ranking_rows(df, "p", "h")) == [(1, 1, "甲", 3, True), (1, 2, "乙", 3, True)]


def test_link_score(frame):
    df = frame("h string, f string, l string", ("http://x/report.pdf", "report.pdf", "x"), ("/a/b.doc", "b.doc", "The Report here"), ("/a", "a", "none"), ("/r?x=report.pdf", "r", ""), ("/z.xls", "z.xls", ""))
    scored = df.select("h", links.link_score(F.col("h"), F.col("f"), F.col("l"), F.lit(" report.pdf ")).alias("s"))
    assert dict(rows(scored)) == {"http://x/report.pdf": 10 + 8 + 5 + 2 + 1, "/a/b.doc": 5 + 2 + 1, "/a": 0, "/r?x=report.pdf": 8 + 5 + 2 + 1, "/z.xls": 0}


PAGE = "http://site.cn/jy/2024/index.htm?page=2"


@pytest.mark.parametrize(
    "html, href, label",
    [
        ("<a href='report.pdf'>2024 Report</a>", "http://site.cn/jy/2024/report.pdf", "2024 Report"),
        ("<a class=x href=../b/r.pdf target=_blank><b>The</b>\n report<i> file</i></a>", "http://site.cn/jy/b/r.pdf", "The\n report file"),
        ('<A HREF="/down?id=3&amp;n=r.pdf">r&eacute;port</A>', "http://site.cn/down?id=3&n=r.pdf", "r\xe9port"),
        ('<a href="?file=r.pdf">q</a>', "http://site.cn/jy/2024/index.htm?file=r.pdf", "q"),
        ('<a href="//cdn.cn/r.pdf">cdn</a>', "http://cdn.cn/r.pdf", "cdn"),
        ('<a href="/view?fileUrl=http%3A%2F%2Fcdn.cn%2Fa.pdf">v</a>', "http://cdn.cn/a.pdf", "v"),
        ('<a href="/view?fileUrl=http%3A%2F%2Fcdn.cn%2Fa.png">v</a>', "http://site.cn/view?fileUrl=http%3A%2F%2Fcdn.cn%2Fa.png", "v"),
    ],
)
def test_addresses_as_pages_print_them(html, href, label):
    assert links.links_of(PAGE, html) == [(links.ANCHOR, href, label)]


def test_odd_anchors():
    assert links.links_of(PAGE, '<a href="#top">up</a><a>none</a><a name="n">n</a><a href="">e</a><a href="http://[bad">b</a><a href="/open">never closed') == []
    nested = links.links_of("", '<a href="/one">one <a href="/two">two</a> rest</a>')
    assert nested == [(links.ANCHOR, "/two", "two")]


def test_tiers(frame):
    told = base64.b64encode(quote(json.dumps({"att_clouddisk": {"downPath": "/cloud/report.pdf", "playUrl": " http://p.cn/report.pdf "}})).encode()).decode()
    cloud, viewer = f'<iframe name="{told}"></iframe><iframe name="!!"></iframe>', "<script>showVsbpdfIframe('/v/report.pdf?x=1', 1)</script>"
    anchor, unfit = '<a href="/other/file.zip">get</a>', '<a href="/about">about</a>'
    pages = frame(
        "page_id int, url string, html string",
        (1, PAGE, anchor + cloud + viewer), (2, PAGE, unfit + cloud + viewer), (3, PAGE, unfit + viewer), (4, PAGE, unfit), (5, PAGE, None), (6, None, "<a href='a%2Freport.pdf'>x</a>"),
    )
    found = links.page_links(pages, "page_id", "url", "html")
    best = links.best_links(found, "page_id", links.link_score(F.col("address"), F.col("file"), F.col("label"), F.lit("report.pdf")))
    assert rows(best) == [
        (1, "http://site.cn/other/file.zip", 3),
        (2, "http://site.cn/cloud/report.pdf", 26),
        (3, "http://site.cn/v/report.pdf?x=1", 24),
        (6, "a%2Freport.pdf", 26),
    ]


def test_catalog_and_long_documents(frame):
    base = e.CHUNK_LINES * 3
    lines = frame(
        "doc int, line_no long, text string",
        (1, 0, "01 学科门类：哲学"), (1, 1, "0101 哲学类"), (1, 2, "010101 哲学"), (1, base, "010102K 逻辑学（注：可授理学学士）"),
        (1, base + 1, "学科门类：经济学"), (1, base + 2, "020101 经济学"), (1, base * 2, "0201 经济学类"), (1, base * 3, "020102 统计学"),
    )
    assert rows(e.catalog_rows(lines, ["doc"], "line_no", "text"), "major_code", "major_name", "major_category", "major_class", "degree_type") == [
        ("010101", "哲学", "哲学", "哲学类", "哲学学士"),
        ("010102K", "逻辑学", "哲学", "哲学类", "可授理学学士"),
        ("020102", "统计学", "经济学", "经济学类", "经济学学士"),
    ]


def test_names_urls_and_regions(frame):
    df = frame("t string", ("HTTPS://WWW.Example.org/a/b/?x=1#f",))
    assert df.select(v.canonical_url(F.col("t")).alias("u")).first().u == "https://example.org/a/b?x=1"
    df = frame("t string", ("内蒙古自治区",), ("广西壮族自治区",), ("吉林市",))
    from plumbline.plans.projections import CITY_SUFFIXES, REGION_SUFFIXES

    assert [r[0] for r in df.select(v.strip_suffixes(F.col("t"), REGION_SUFFIXES, True)).collect()] == ["内蒙古", "广西", "吉林"]
    assert [r[0] for r in df.select(v.strip_suffixes(F.col("t"), CITY_SUFFIXES, False)).collect()] == ["内蒙古自治区", "广西壮族自治区", "吉林"]
    df = frame("t string", (" 理 学（中外） ；a",))
    assert df.select(v.unify_separators(F.col("t"))).first()[0] == "理学(中外),a"


def test_html_pages_of_one_file_are_dealt_out(spark):
    pages = spark.range(0, 40_000, 1, 1).selectExpr("id AS page", "concat('<table><tr><td>', repeat('x', 400), id, '</td></tr></table>') AS html")
    found = e.html_table_rows(pages, "page", "html")
    assert "Exchange hashpartitioning(page" in found._jdf.queryExecution().executedPlan().toString()
    assert found.selectExpr("sum(row_no)", "count(*)", "count_if(cells[0] = concat(repeat('x', 400), page))").collect()[0][:] == (0, 40_000, 40_000)
