"""T: evidence from text and scalar helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import scoring as sc
from plumbline.functions import values as v
from plumbline.functions import vocabulary as vocab
from plumbline.operators import evidence as e
from plumbline.operators import links
from plumbline.operators.sequence import context_lines
from plumbline.plans.registry import fx, query
from plumbline.plans.windows import CONTEXT, OBS, observations
from plumbline.rules import first_match

METRICS = [
    {"metric_key": "license_version", "label": "License, Version", "unit": "number", "aliases": ["Public License, version"], "blocked_context_any": ["forbidden"]},
    {"metric_key": "area_code", "label": "+1 (", "unit": "number"},
    {"metric_key": "cc_version", "label": "Creative Commons", "unit": "score", "aliases": ["Licensed under CC"], "required_context_any": ["BY"]},
]


def first_number(alias: str) -> str:
    """SQL twin of the search after an alias: the text from the alias' last character on."""
    tail = f"substr(context, instr(context, {alias}) + length({alias}) - 1)"
    return f"CAST(nullif(regexp_extract({tail}, '[^0-9]([0-9]{{1,3}}([.][0-9]+)?)([^0-9]|$)', 1), '') AS DOUBLE)"


@query(
    "t01_metric_candidates",
    f"""WITH {CONTEXT}, a AS (SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, context, 'license_version' AS metric_key, CASE WHEN contains(line, 'License, Version') THEN 'License, Version' ELSE 'Public License, version' END AS alias, 'License, Version' AS label FROM context
          WHERE (contains(line, 'License, Version') OR contains(line, 'Public License, version')) AND NOT contains(context, 'forbidden')
        UNION ALL SELECT doc_id, CAST(line_no AS INTEGER), context, 'area_code', '+1 (', '+1 (' FROM context WHERE contains(line, '+1 (')
        UNION ALL SELECT doc_id, CAST(line_no AS INTEGER), context, 'cc_version', CASE WHEN contains(line, 'Creative Commons') THEN 'Creative Commons' ELSE 'Licensed under CC' END, 'Creative Commons' FROM context
          WHERE (contains(line, 'Creative Commons') OR contains(line, 'Licensed under CC')) AND contains(context, 'BY')),
        n AS (SELECT *, {first_number('alias')} AS candidate_value FROM a)
        SELECT doc_id, min(line_no) AS line_no, metric_key, candidate_value, arg_min(alias, line_no) AS match_alias, CASE WHEN arg_min(alias, line_no) = any_value(label) THEN 'medium' ELSE 'low' END AS confidence, md5(substr(context, 1, 240)) AS quote_md5
        FROM n WHERE candidate_value IS NOT NULL AND (metric_key <> 'cc_version' OR candidate_value <= 100) GROUP BY doc_id, metric_key, candidate_value, substr(context, 1, 240)""",
)
def t01(t):
    found = e.metric_candidates(context_lines(t.documents, ["doc_id"], "text", 3), ["doc_id"], METRICS)
    return found.select("doc_id", "line_no", "metric_key", "candidate_value", "match_alias", "confidence", F.md5("evidence_quote").alias("quote_md5"))


SCOPES = (
    ((("Apache",), "apache"), (("GNU",), "gnu"), (("License", "license"), "licensed")),
    ((("@",), "contact"),),
    (((" the ", " The "), "english"), ((" le ", " les "), "french")),
)


@query(
    "t02_scope_tags",
    """SELECT doc_id, concat_ws(',', CASE WHEN contains(text, 'Apache') THEN 'apache' WHEN contains(text, 'GNU') THEN 'gnu' WHEN contains(text, 'License') OR contains(text, 'license') THEN 'licensed' END,
       CASE WHEN contains(text, '@') THEN 'contact' END, CASE WHEN contains(text, ' the ') OR contains(text, ' The ') THEN 'english' WHEN contains(text, ' le ') OR contains(text, ' les ') THEN 'french' END) AS scope FROM documents""",
)
def t02(t):
    return t.documents.select("doc_id", e.scope_tags(F.col("text"), SCOPES, ",").alias("scope"))


@query(
    "t02_report_scopes",
    """WITH q AS (SELECT o_orderkey, year(o_orderdate) || '届' || CASE o_orderkey % 4 WHEN 0 THEN '本科毕业生初次就业率' WHEN 1 THEN '高职学生' WHEN 2 THEN '软件工程专业就业率' ELSE '就业率较去年上升' END
          || CASE WHEN o_orderkey % 3 = 0 THEN '，截至' || month(o_orderdate) || '月' || day(o_orderdate) || '日' ELSE '' END AS quote FROM orders)
        SELECT o_orderkey, concat_ws('，', substr(quote, 1, 4) || '届', CASE o_orderkey % 4 WHEN 0 THEN '本科毕业生' WHEN 1 THEN '专科/高职毕业生' WHEN 2 THEN '专业口径，不是学校总体就业率或本科总体口径' ELSE '变化幅度，不是学校总体就业率或本科总体口径' END,
          CASE o_orderkey % 4 WHEN 0 THEN '初次毕业去向' WHEN 2 THEN '就业率' WHEN 3 THEN '就业率' END, CASE WHEN contains(quote, '截至') THEN substr(quote, strpos(quote, '截至')) END) AS scope FROM q""",
)
def t02_reports(t):
    kind = F.col("o_orderkey") % 4
    words = F.when(kind == 0, "本科毕业生初次就业率").when(kind == 1, "高职学生").when(kind == 2, "软件工程专业就业率").otherwise("就业率较去年上升")
    until = F.concat(F.lit("，截至"), F.month("o_orderdate"), F.lit("月"), F.dayofmonth("o_orderdate"), F.lit("日"))
    quote = F.concat(F.year("o_orderdate"), F.lit("届"), words, F.when(F.col("o_orderkey") % 3 == 0, until).otherwise(""))
    return t.orders.select("o_orderkey", e.scope_tags(quote, vocab.SCOPE_RULES).alias("scope"))


@query(
    "t03_html_tables",
    """SELECT p_partkey AS page_id, '2-' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS code, p_name AS name, CAST(2 AS INTEGER) AS level FROM part WHERE p_size < 100""",
)
def t03(t):
    code = F.concat(F.lit("2-"), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    html = F.concat(
        F.lit("<html><table><tr><th>no</th><th>code</th><th>name</th></tr><tr><td>1</td><td> "), code, F.lit("</td><td><b>"), F.replace("p_name", F.lit(" "), F.lit("</b> ")),
        F.lit("</td></tr><tr><td></td></tr><tr><td>"), code, F.lit("</td><td>later</td></tr></table></html>"),
    )
    rows = e.html_table_rows(t.part.select(F.col("p_partkey").alias("page_id"), html.alias("html")), "page_id", "html")
    return e.code_name_rows(rows, "page_id")


@query(
    "t03_page_text",
    r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS text_md5,
        length(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title_length FROM pages""",
)
def t03_text(t):
    bare = F.regexp_replace("html", r"(?s)<(script|style)>.*?</(script|style)>", " ")
    bare = F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<!--.*?-->|<[^>]*>", " "), r"\s+", " "))
    return t.pages.select("page_id", F.md5(bare).alias("text_md5"), F.length(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).cast("bigint").alias("title_length"))


@query(
    "t04_ranking_sentence",
    """WITH d AS (SELECT DISTINCT l_suppkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey),
       n AS (SELECT l_suppkey, p_brand, row_number() OVER (PARTITION BY l_suppkey ORDER BY p_brand) AS rank, count(*) OVER (PARTITION BY l_suppkey) AS n FROM d)
       SELECT l_suppkey, CAST(rank AS INTEGER) AS rank, p_brand AS name, 20 AS declared_count, n < 20 AS count_mismatch, p_brand IN (SELECT p_brand FROM part WHERE p_size = 1) AS is_planned FROM n""",
)
def t04(t):
    """Brands of a supplier's parts as a ranking; planned are the brands that have parts of the smallest size."""
    brands = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).groupBy("l_suppkey").agg(F.sort_array(F.collect_set("p_brand")).alias("b"))
    html = F.concat(F.lit("<p>本季度 排行前20个紧缺职业分别为"), F.array_join("b", "、"), F.lit("。</p>"))
    ranked = e.ranking_rows(brands.select("l_suppkey", html.alias("html")), "l_suppkey", "html")
    planned = t.part.filter("p_size = 1").select(F.col("p_brand").alias("name"), F.lit(True).alias("is_planned")).distinct()
    return ranked.join(planned, "name", "left").withColumn("is_planned", F.coalesce("is_planned", F.lit(False)))


@query(
    "t05_attachment_links",
    """WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS host, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2)) AS label,
         lower(regexp_extract(html, '<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2)) AS stem FROM pages),
       s AS (SELECT page_id, host || href AS href, CASE WHEN stem <> '' AND contains(lower(host || href) || ' ' || lower(trim(label)), stem) THEN 5 ELSE 0 END AS score FROM l WHERE starts_with(href, '/'))
       SELECT page_id, href, score FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, href DESC) AS rn FROM s WHERE score > 0) WHERE rn = 1""",
)
def t05(t):
    """Every page is searched for the file that its first link's label names; the tables' links are paths on their page's host."""
    first = F.regexp_extract("html", '<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2)
    targets = t.pages.select("page_id", F.concat(first, F.lit(".pdf")).alias("target"))
    found = links.page_links(t.pages, "page_id", "url", "html").join(targets, "page_id")
    return links.best_links(found, "page_id", links.link_score(F.col("address"), F.col("file"), F.col("label"), F.col("target")))


def catalog_lines(t):
    """A catalog in lines: regions as categories, nations as classes, customers as majors."""
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    regions = t.region.select(F.col("r_regionkey").alias("doc"), F.lit(0).cast("bigint").alias("line_no"), F.concat(F.lpad(F.col("r_regionkey").cast("string"), 2, "0"), F.lit(" 学科门类："), "r_name").alias("text"))
    classes = nation.select(F.col("n_regionkey").alias("doc"), ((F.col("n_nationkey").cast("bigint") + 1) * 1000000000).alias("line_no"), F.concat(F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit(" "), "n_name", F.lit("类")).alias("text"))
    note = F.when(F.col("c_mktsegment") == "BUILDING", "（注：工学）").otherwise("")
    code = F.substring(F.lpad((F.col("c_custkey") % 1000000).cast("string"), 6, "0"), 1, 6)
    majors = t.customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("n_regionkey").alias("doc"), ((F.col("c_nationkey").cast("bigint") + 1) * 1000000000 + F.col("c_custkey") + 1).alias("line_no"), F.concat(code, F.lit(" "), "c_name", note).alias("text")
    )
    return regions.unionByName(classes).unionByName(majors)


@query(
    "t06_catalog_lines",
    """SELECT n_regionkey AS doc, lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS major_code, c_name AS major_name, r_name AS major_category, n_name || '类' AS major_class,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '工学' ELSE r_name || '学士' END AS degree_type FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def t06(t):
    return e.catalog_rows(catalog_lines(t), ["doc"], "line_no", "text")


@query(
    "t07_section_rows",
    """SELECT s_suppkey AS row_key, 'NATION_' || s_nationkey AS section, s_name AS school_name, CASE WHEN s_acctbal > 5000 THEN 'private' WHEN s_acctbal < 0 THEN 'joint' END AS ownership FROM supplier""",
)
def t07(t):
    """A list of schools for each region, a section for each nation."""
    base = 1000000000
    heads = t.nation.select(F.col("n_regionkey").alias("doc"), ((F.col("n_nationkey").cast("bigint") + 1) * base).alias("line_no"), F.concat("n_name", F.lit("（12所）")).alias("first_cell"), F.lit(None).cast("string").alias("school_name"), F.lit(None).cast("string").alias("note"))
    note = F.when(F.col("s_acctbal") > 5000, "民办").when(F.col("s_acctbal") < 0, "中外合作办学").otherwise("")
    located = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    rows = located.select(F.col("n_regionkey").alias("doc"), ((F.col("s_nationkey").cast("bigint") + 1) * base + F.col("s_suppkey") + 1).alias("line_no"), F.col("s_suppkey").cast("string").alias("first_cell"), F.col("s_name").alias("school_name"), note.alias("note"))
    found = e.section_rows(heads.unionByName(rows), ["doc"], "line_no", "first_cell")
    ownership = first_match([(F.col("note").contains("民办"), "private"), (F.col("note").contains("中外合作"), "joint")])
    return found.select(F.col("first_cell").cast("bigint").alias("row_key"), "section", "school_name", ownership.alias("ownership"))


@query(
    "t08_distribution_lines",
    rf"""WITH {OBS}, m AS (SELECT subject, score_year, image, block, position, unnest(regexp_extract_all(raw_text, '(\d{{2,3}})\s+([\d,]+)\s+([\d,]+)', 1)) AS score,
          unnest(regexp_extract_all(raw_text, '(\d{{2,3}})\s+([\d,]+)\s+([\d,]+)', 2)) AS n, unnest(regexp_extract_all(raw_text, '(\d{{2,3}})\s+([\d,]+)\s+([\d,]+)', 3)) AS cum FROM obs),
        r AS (SELECT *, row_number() OVER (PARTITION BY subject, score_year, score ORDER BY image DESC, block DESC, position DESC) AS rn FROM m)
        SELECT subject, score_year, CAST(score AS BIGINT) AS score, CAST(n AS BIGINT) AS score_count, CAST(cum AS BIGINT) AS cumulative_rank FROM r WHERE rn = 1""",
)
def t08(t):
    """Every printed line, readable or not; what is no row of two or three digits and two numbers is no score."""
    return e.distribution_rows(observations(t), ["subject", "score_year"], ["image", "block", "position"], "raw_text")


@query(
    "t09_printed_numbers",
    r"""WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey > 999 THEN CAST(o_custkey AS VARCHAR) ELSE lpad(CAST(o_custkey AS VARCHAR), 3, '0') END AS a, lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS b FROM orders)
        SELECT o_orderkey, CASE WHEN length(a) IN (3, 4) THEN substr(a || b, 1, 3) :: BIGINT || ' ' || substr(a || b, 4) :: BIGINT ELSE CAST(CAST(a || b AS BIGINT) AS VARCHAR) END || ' 12 1234' AS numbers, CAST(CAST(b || '01' AS BIGINT) AS VARCHAR) AS cell_numbers FROM o""",
)
def t09(t):
    a = F.lpad(F.col("o_custkey").cast("string"), 3, "0")
    a = F.when(F.length(F.col("o_custkey").cast("string")) > 3, F.col("o_custkey").cast("string")).otherwise(a)
    b = F.lpad((F.floor("o_totalprice") % 1000).cast("string"), 3, "0")
    printed = F.concat(a, b, F.lit("，  12 1,234"))
    recognised = F.concat(F.translate(b, "01", "Ol"), F.lit(",Ol"))
    texts = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), " ")
    return t.orders.select("o_orderkey", texts(e.printed_numbers(printed)).alias("numbers"), texts(e.lookalike_numbers(recognised)).alias("cell_numbers"))


@query(
    "t10_position_projection",
    """SELECT event_type AS position_name, CAST(event_id AS VARCHAR) AS position_code, CAST(floor(value) AS BIGINT) AS recruit_count FROM events WHERE value >= 1""",
)
def t10(t):
    raw = t.events.select(F.format_string("%d.0", "event_id").alias("职位代码"), F.concat(F.lit(" "), "event_type").alias("招考职位"), F.when(F.col("value") >= 1, F.format_string("%.1f", F.floor("value").cast("double"))).alias("招考人数"))
    rows = raw.select(
        v.clean_text(F.col("招考职位")).alias("position_name"),
        v.lenient_int(F.col("职位代码")).cast("string").alias("position_code"),
        v.lenient_int(F.col("招考人数")).alias("recruit_count"),
    )
    return rows.filter(F.col("recruit_count").isNotNull())


@query(
    "t11_tie_breakers",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN '{"size":"' || p_size || '","type":"' || p_type || '"}' ELSE '{"type":"' || p_type || '"}' END AS tie_breaker FROM part""",
)
def t11(t):
    values = F.array(F.when(F.col("p_size") > 40, F.col("p_size").cast("string")).otherwise(""), F.col("p_type"), F.lit(None))
    pairs = F.map_filter(F.map_from_arrays(F.array(F.lit("size"), F.lit("type"), F.lit("rank")), values), lambda k, x: F.coalesce(x, F.lit("")) != "")
    return t.part.select("p_partkey", F.to_json(pairs).alias("tie_breaker"))


@query(
    "t12_evidence_quote",
    """SELECT conv_id, turn, CASE WHEN length(role || '：' || text) > 180 THEN substr(role || '：' || text, 1, 177) || '...' ELSE role || '：' || text END AS quote FROM conversations""",
)
def t12(t):
    return t.conversations.select("conv_id", "turn", e.quote([F.col("role"), F.lit("："), F.col("text")]).alias("quote"))


@query(
    "t13_math",
    f"""SELECT s_suppkey, {fx('greatest(0.0, least(100.0, s_acctbal / 50.0))')} AS clipped, {fx('ln(1.0 + greatest(0.0, s_acctbal))')} AS log_balance,
        {fx('2 * 6371.0 * asin(sqrt(pow(sin(radians(s_acctbal / 200.0 - 10.0) / 2), 2) + cos(radians(10.0)) * cos(radians(s_acctbal / 200.0)) * pow(sin(radians(s_nationkey - 20.0) / 2), 2)))')} AS km FROM supplier""",
)
def t13(t):
    balance = F.col("s_acctbal")
    km = sc.haversine_km(F.lit(10.0), F.lit(20.0), balance / 200.0, F.col("s_nationkey").cast("double"))
    return t.supplier.select(
        "s_suppkey",
        v.fixed6(sc.clip(balance / 50.0)).alias("clipped"),
        v.fixed6(F.log1p(F.greatest(F.lit(0.0), balance))).alias("log_balance"),
        v.fixed6(km).alias("km"),
    )


@query(
    "t14_dates",
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'P') AS unreadable_dates, max(CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END) AS latest_date FROM orders GROUP BY 1""",
)
def t14(t):
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    date = F.try_to_date(text, "yyyy-MM-dd")
    return t.orders.groupBy("o_custkey").agg(F.count_if(date.isNull()).alias("unreadable_dates"), F.max(date).cast("string").alias("latest_date"))


@query(
    "t15_json",
    """SELECT event_id, CASE WHEN value > 40 THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k, CASE WHEN value > 40 THEN '{"t":"' || event_type || '"}' ELSE '{"k":"' || json_extract_string(props, '$.k') || '","t":"' || event_type || '"}' END AS canonical FROM events""",
)
def t15(t):
    text = F.when(F.col("value") > 40, F.substring("props", 1, 4)).otherwise(F.col("props"))
    parsed = F.from_json(text, "k int")
    entries = F.array_sort(F.array_compact(F.array(F.struct(F.lit("t").alias("k"), F.col("event_type").alias("v")), F.when(parsed["k"].isNotNull(), F.struct(F.lit("k").alias("k"), parsed["k"].cast("string").alias("v"))))))
    return t.events.select("event_id", F.coalesce(parsed["k"], F.lit(-1)).alias("k"), F.to_json(F.map_from_entries(entries)).alias("canonical"))


@query("t16_hashes", "SELECT doc_id, md5(text) AS text_md5, sha1(text) AS text_sha1, sha256(text) AS text_sha256 FROM documents")
def t16(t):
    return t.documents.select("doc_id", F.md5("text").alias("text_md5"), F.sha1("text").alias("text_sha1"), F.sha2("text", 256).alias("text_sha256"))


@query(
    "t17_source_instance",
    """SELECT page_id, 'page_outcome:' || page_id || ':' || substr(sha256(trim(url)), 1, 16) AS source_instance_key, CASE WHEN lower(regexp_extract(url, '^[^:/]+://[^/?#]*([^?#]*)', 1)) LIKE '%5' OR page_id < 5 THEN 'report_pdf' ELSE 'web_page' END AS artifact_kind FROM pages""",
)
def t17(t):
    url = F.col("url")
    key = F.concat_ws(":", F.lit("page_outcome"), F.col("page_id").cast("string"), F.lit(None).cast("string"), F.substring(F.sha2(F.trim(url), 256), 1, 16))
    kind = F.when(v.url_path(url).endswith("5") | (F.col("page_id") < 5), "report_pdf").otherwise("web_page")
    return t.pages.select("page_id", key.alias("source_instance_key"), kind.alias("artifact_kind"))
