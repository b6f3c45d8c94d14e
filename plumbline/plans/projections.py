"""P: projections, filters and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.contracts import TableContract
from plumbline.functions import values as v
from plumbline.operators import normalise as n
from plumbline.plans.registry import query

CUSTOMER = TableContract(
    name="pl_dim_customer",
    columns=("cust_key", "cust_name", "balance", "segment", "note"),
    key=("cust_key",),
    numeric=("cust_key", "balance"),
    aliases={"cust_name": ("full name", "name"), "balance": ("account balance",), "segment": ("market",)},
)


@query(
    "p01_schema_normalise",
    """SELECT CAST(c_custkey AS DOUBLE) AS cust_key, trim(c_name) AS cust_name, c_acctbal AS balance,
              c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS note FROM customer""",
)
def p01(t):
    raw = t.customer.select(
        F.col("c_custkey").cast("string").alias("Cust Key"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("Full_Name"),
        F.format_string("%.2f", "c_acctbal").alias("ACCOUNT BALANCE"),
        F.col("c_mktsegment").alias("market"),
        F.col("c_nationkey").alias("unknown column"),
    )
    return n.normalise(raw, CUSTOMER)


@query(
    "p02_coerce_number",
    """SELECT p_partkey, p_size / 100.0::DOUBLE AS from_percent, CAST(p_size AS DOUBLE) AS percent_points,
              p_retailprice AS from_commas, CAST(p_size AS BIGINT) AS strict_size, CAST(NULL AS BIGINT) AS strict_price,
              CAST(floor(p_retailprice) AS BIGINT) AS lenient_price, CAST(NULL AS DOUBLE) AS from_text
       FROM part""",
)
def p02(t):
    percent = F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit("%"))
    commas = F.format_number("p_retailprice", 2)
    return t.part.select(
        "p_partkey",
        v.coerce_number(percent).alias("from_percent"),
        v.percent_points(percent).alias("percent_points"),
        v.coerce_number(commas).alias("from_commas"),
        v.strict_int(F.col("p_size")).alias("strict_size"),
        v.strict_int(commas).alias("strict_price"),
        v.lenient_int(commas).alias("lenient_price"),
        v.coerce_number(F.col("p_name")).alias("from_text"),
    )


def wide_orders(t):
    """One row per customer with a count and a value column for every year that has orders; a pivot reads the years first."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    pivoted = t.orders.withColumn("year", F.year("o_orderdate")).groupBy("o_custkey").pivot("year")
    return pivoted.agg(F.count(F.lit(1)).alias("orders"), F.sum(cents).alias("cents"))


YEAR_PATTERNS = {"order_count": r"(\d{4})_orders", "value_cents": r"(\d{4})_cents"}


@query(
    "p03_unpivot_years",
    """SELECT o_custkey, year(o_orderdate) AS score_year, count(*) AS order_count,
              CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS value_cents
       FROM orders GROUP BY 1, 2""",
)
def p03(t):
    wide = wide_orders(t)
    return n.unpivot_years(wide, ["o_custkey"], n.year_columns(wide.columns, YEAR_PATTERNS))


@query(
    "p03_unpivot_skip_counts",
    """WITH c AS (SELECT DISTINCT o_custkey FROM orders), y AS (SELECT DISTINCT year(o_orderdate) AS score_year FROM orders),
       k AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS score_year FROM orders)
       SELECT y.score_year, count(k.o_custkey) AS kept, count(*) - count(k.o_custkey) AS skipped
       FROM y CROSS JOIN c LEFT JOIN k ON k.o_custkey = c.o_custkey AND k.score_year = y.score_year GROUP BY 1""",
)
def p03_skips(t):
    wide = wide_orders(t)
    return (
        n.unpivot_years(wide, ["o_custkey"], n.year_columns(wide.columns, YEAR_PATTERNS), keep_empty=True)
        .groupBy("score_year")
        .agg(F.count_if("is_filled").alias("kept"), F.count_if(~F.col("is_filled")).alias("skipped"))
    )


@query(
    "p04_plan_projection",
    """SELECT CAST(p_partkey AS VARCHAR) AS item_code, trim(p_name) AS item_name, coalesce(nullif(p_size, 0), 1) AS plan_count,
              CASE WHEN lower(p_type) IN ('promo', 'standard') THEN 1 ELSE 0 END AS is_new,
              'first' AS batch, CAST(NULL AS VARCHAR) AS city FROM part""",
)
def p04(t):
    return n.project_with_defaults(
        t.part,
        {
            "item_code": (F.col("p_partkey").cast("string"), None),
            "item_name": (v.clean_text(F.col("p_name")), None),
            "plan_count": (F.nullif(F.col("p_size"), F.lit(0)), 1),
            "is_new": (v.truthy(F.col("p_type"), ("promo", "standard")), None),
            "batch": (F.lit(None).cast("string"), "first"),
            "city": (F.lit(None).cast("string"), None),
        },
    )


@query(
    "p05_first_non_empty",
    """SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), ''),
              nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), ''), nullif(trim(url), '')) AS label FROM pages""",
)
def p05(t):
    return t.pages.select(
        "page_id",
        v.first_non_empty(
            F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.col("url")
        ).alias("label"),
    )


@query(
    "p06_unify_brackets",
    """SELECT doc_id, md5(translate(text, '()[]【】 　', '（）（）（）')) AS text_md5 FROM documents""",
)
def p06(t):
    return t.documents.select("doc_id", F.md5(v.unify_brackets(F.col("text"))).alias("text_md5"))


@query(
    "p07_unify_separators",
    r"""SELECT doc_id, md5(regexp_replace(translate(trim(text), '（）【】，、；;', '()[],,,,'), '\s+', '', 'g')) AS text_md5 FROM documents""",
)
def p07(t):
    return t.documents.select("doc_id", F.md5(v.unify_separators(F.col("text"))).alias("text_md5"))


@query(
    "p08_alias_and_slug",
    """SELECT p_partkey, lower(replace(p_brand || ' ' || p_name, ' ', '')) AS alias_key,
              trim(regexp_replace(p_brand || ' ' || p_name, '[^0-9A-Za-z_]+', '_', 'g'), '_') AS slug FROM part""",
)
def p08(t):
    name = F.concat_ws(" ", "p_brand", "p_name")
    return t.part.select("p_partkey", v.alias_form(name).alias("alias_key"), v.slug(name).alias("slug"))


PAGE_URL_SQL = r"""lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' ||
  regexp_replace(lower(regexp_extract(url, '^[^:/]+://([^/?#]*)', 1)), '^www\.', '') ||
  regexp_replace(regexp_extract(url, '^[^:/]+://[^/?#]*([^?#]*)', 1), '/+$', '') || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1)"""


@query(
    "p09_canonical_url",
    f"""SELECT page_id, {PAGE_URL_SQL} AS source_url, lower(regexp_extract(url, '^[^:/]+://([^/?#]*)', 1)) AS host FROM pages""",
)
def p09(t):
    return t.pages.select("page_id", v.canonical_url(F.col("url")).alias("source_url"), v.url_host(F.col("url")).alias("host"))


@query(
    "p10_title_key",
    r"""SELECT page_id, CASE WHEN title = '' THEN NULL ELSE 'page|' || page_id || '|' || length(url) || '|' ||
          lower(translate(regexp_replace(title, '\s+', '', 'g'), '（）', '()')) END AS title_key
        FROM (SELECT page_id, url, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pages)""",
)
def p10(t):
    title = v.title_form(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    return t.pages.select("page_id", v.joined_key(F.lit("page"), F.col("page_id"), F.length("url"), title).alias("title_key"))


# fixed values: endings of region names, in the order they are tried
REGION_SUFFIXES = ("壮族自治区", "回族自治区", "维吾尔自治区", "自治区", "特别行政区", "省", "市", "地区", "盟")
CITY_SUFFIXES = ("市", "地区", "盟", "自治州", "州")


@query(
    "p11_region_names",
    """WITH p AS (SELECT c_custkey, r_name, n_name || CASE n_regionkey WHEN 0 THEN '市' WHEN 1 THEN '市省' WHEN 2 THEN '州'
                  WHEN 3 THEN '自治区' ELSE '' END AS place
                  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
       SELECT c_custkey, place, regexp_replace(place, '(自治区|市省|市)$', '') AS base_name,
              regexp_replace(place, '(市|州)$', '') AS city_name,
              CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN r_name END AS province,
              CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN place ELSE r_name || place END AS city,
              CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN place ELSE r_name || place END AS preferred_city FROM p""",
)
def p11(t):
    suffix = F.when(F.col("n_regionkey") == 0, "市").when(F.col("n_regionkey") == 1, "市省").when(F.col("n_regionkey") == 2, "州").when(F.col("n_regionkey") == 3, "自治区").otherwise("")
    places = (
        t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("c_custkey", F.concat("n_name", suffix).alias("place"), F.concat("r_name", "n_name", suffix).alias("full"))
    )
    prefix = F.regexp_extract("full", "^(ASIA|EUROPE)", 1)
    province = F.nullif(prefix, F.lit(""))
    city = F.when(province.isNotNull(), F.substring(F.col("full"), F.length(prefix) + 1, F.lit(1000))).otherwise(F.col("full"))
    region_city, profile_city = city, F.col("place")
    preferred = F.when(profile_city.contains(region_city), profile_city).otherwise(F.coalesce(F.nullif(region_city, F.lit("")), profile_city))
    return places.select(
        "c_custkey",
        "place",
        v.strip_suffixes(F.col("place"), ("自治区", "省", "市"), repeat=True).alias("base_name"),
        v.strip_suffixes(F.col("place"), CITY_SUFFIXES, repeat=False).alias("city_name"),
        province.alias("province"),
        city.alias("city"),
        preferred.alias("preferred_city"),
    )


@query(
    "p12_in_list_filters",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'P')""",
)
def p12(t):
    return n.in_filters(t.orders, {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": ["F", "P"], "o_custkey": []}).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus"
    )


@query(
    "p13_stable_ids",
    """WITH k AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS y, o_custkey || '-' || year(o_orderdate) AS order_group FROM orders),
       d AS (SELECT o_custkey, y FROM k GROUP BY 1, 2 HAVING count(*) > 1)
       SELECT k.o_orderkey, substr(sha1(k.o_orderkey || '|' || k.o_custkey), 1, 20) AS task_id,
              substr(sha256(CAST(k.o_orderkey AS VARCHAR)), 1, 16) AS artifact_hash,
              CASE WHEN d.y IS NULL THEN order_group ELSE order_group || '_' || substr(md5(k.o_custkey || '|' || k.o_orderkey), 1, 8) END AS order_group
       FROM k LEFT JOIN d ON d.o_custkey = k.o_custkey AND d.y = k.y""",
)
def p13(t):
    keyed = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("y"),
        F.concat_ws("-", "o_custkey", F.year("o_orderdate")).alias("order_group"),
    )
    return n.suffix_duplicate_keys(keyed, ["o_custkey", "y"], "order_group", ["o_custkey", "o_orderkey"]).select(
        "o_orderkey",
        v.stable_id(F.col("o_orderkey"), F.col("o_custkey")).alias("task_id"),
        F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 16).alias("artifact_hash"),
        "order_group",
    )


GRID_RULES = [
    {"metric_key": "order_value", "metric_label": "order value", "metric_unit": "cents"},
    {"metric_key": "order_count", "metric_label": "number of orders", "metric_unit": "count"},
    {"metric_key": "urgent_share", "metric_label": "share of urgent orders", "metric_unit": "ratio"},
]


@query(
    "p14_task_grid",
    """SELECT c_custkey AS entity_code, c_name AS entity_name, metric_key, metric_label, metric_unit, 'todo' AS status,
              c_name || ' 1998 ' || metric_label AS search_query, 'site:example.org ' || c_name || ' ' || metric_label AS site_query
       FROM customer CROSS JOIN (VALUES ('order_value', 'order value', 'cents'), ('order_count', 'number of orders', 'count'),
            ('urgent_share', 'share of urgent orders', 'ratio')) AS r(metric_key, metric_label, metric_unit)""",
)
def p14(t):
    entities = t.customer.select(F.col("c_custkey").alias("entity_code"), F.col("c_name").alias("entity_name"))
    grid = n.task_grid(entities, GRID_RULES)
    parts = {"entity": F.col("entity_name"), "label": F.col("metric_label")}
    return grid.select(
        "*",
        F.lit("todo").alias("status"),
        n.fill_template("{entity} 1998 {label}", **parts).alias("search_query"),
        n.fill_template("site:example.org {entity} {label}", **parts).alias("site_query"),
    )


@query(
    "p15_year_coverage",
    """SELECT DISTINCT y AS year FROM (SELECT year(l_shipdate) AS y FROM lineitem UNION ALL
       SELECT year(l_shipdate + INTERVAL 90 DAY) FROM lineitem)""",
)
def p15(t):
    years = t.lineitem.select(
        F.year("l_shipdate").alias("ship_year"),
        F.year(F.date_add(F.to_date("l_shipdate"), 90)).alias("due_year"),
        F.col("l_returnflag").alias("not_a_year"),
    )
    return n.year_coverage(years, ["ship_year", "due_year", "not_a_year"])


@query(
    "p16_append_note",
    """SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%' || note || '%' THEN o_orderpriority ELSE o_orderpriority || '; ' || note END AS notes
       FROM (SELECT o_orderkey, o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'URGENT' ELSE 'status=' || o_orderstatus END AS note FROM orders)""",
)
def p16(t):
    note = F.when(F.col("o_orderstatus") == "F", "URGENT").otherwise(F.concat(F.lit("status="), "o_orderstatus"))
    once = v.append_note(F.col("o_orderpriority"), note)
    return t.orders.select("o_orderkey", v.append_note(once, note).alias("notes"))


DOC_RULES = [("license", ["license", "Copyright"]), ("contact", ["@"]), ("article", [" the ", " le ", " der "])]


@query(
    "p17_classify",
    """SELECT doc_id, CASE WHEN contains(text, 'license') OR contains(text, 'Copyright') THEN 'license' WHEN contains(text, '@') THEN 'contact'
       WHEN contains(text, ' the ') OR contains(text, ' le ') OR contains(text, ' der ') THEN 'article' ELSE 'other' END AS doc_class FROM documents""",
)
def p17(t):
    return t.documents.select("doc_id", n.classify_by_keyword(F.col("text"), DOC_RULES, "other").alias("doc_class"))


@query(
    "p18_status_routing",
    """SELECT event_type, CASE event_type WHEN 'error' THEN 'blocked' WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'passed' ELSE 'unknown' END AS status,
       CASE event_type WHEN 'error' THEN 'unavailable' WHEN 'signup' THEN 'degraded' WHEN 'view' THEN 'manual_review_pending' ELSE 'healthy' END AS health,
       count(*) AS events FROM events GROUP BY ALL""",
)
def p18(t):
    kind = F.col("event_type")
    raw = F.when(kind == "error", "blocked_by_error").when(kind == "signup", "awaiting_user").when(kind == "view", "research_required").otherwise("fine")
    return t.events.groupBy(
        "event_type",
        n.route_status(kind, passed=("purchase",), blocked=("error",), pending=("signup",)).alias("status"),
        n.health_status(raw, kind).alias("health"),
    ).agg(F.count(F.lit(1)).alias("events"))
