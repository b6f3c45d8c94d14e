"""J: lookups, two-sided joins, candidates, cascades and containment."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from plumbline.functions.values import fixed6
from plumbline.functions.vocabulary import MAJOR_CODE
from plumbline.operators import joins as j
from plumbline.plans import base
from plumbline.plans.registry import fx, query
from plumbline.rules import broadcast_rules, first_match, rule_frame, values_sql


def distribution(t, flag: str):
    """Count and descending running count per (supplier, year, quantity); at most 50 quantities per group."""
    counts = (
        t.lineitem.filter(F.col("l_returnflag") == flag)
        .groupBy(F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").alias("ship_year"), F.col("l_quantity").cast("int").alias("min_quantity"))
        .agg(F.count(F.lit(1)).alias("score_count"))
    )
    w = Window.partitionBy("supplier", "ship_year").orderBy(F.desc("min_quantity"))
    return counts.withColumn("min_rank", F.sum("score_count").over(w.rowsBetween(Window.unboundedPreceding, 0)))


DISTRIBUTION = """distribution AS (SELECT supplier, ship_year, min_quantity, score_count,
  CAST(sum(score_count) OVER (PARTITION BY supplier, ship_year ORDER BY min_quantity DESC) AS BIGINT) AS min_rank FROM
  (SELECT l_suppkey AS supplier, year(l_shipdate) AS ship_year, CAST(l_quantity AS INTEGER) AS min_quantity, count(*) AS score_count
   FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2, 3))"""


@query(
    "j01_rank_lookup",
    f"""WITH {base.CORE}, {DISTRIBUTION} SELECT ship_year, batch, supplier, slot, min_quantity, min_rank, min_rank IS NOT NULL AS is_matched
        FROM core LEFT JOIN distribution USING (supplier, ship_year, min_quantity)""",
)
def j01(t):
    ranks = j.last_by_key(distribution(t, "A"), ["supplier", "ship_year", "min_quantity"], ["min_rank"])
    return j.rank_lookup(base.core(t), ranks, ["supplier", "ship_year", "min_quantity"], "min_rank").select(
        *base.KEY, "min_quantity", "min_rank", "is_matched"
    )


@query(
    "j02_two_sided_join",
    f"""WITH {base.PACKAGE}, {base.CORE} SELECT ship_year, batch, supplier, slot, p.min_quantity AS package_quantity, c.min_quantity AS core_quantity,
        CASE WHEN c.line_count IS NULL THEN 'package_only' WHEN p.line_count IS NULL THEN 'core_only' ELSE 'matched' END AS side
        FROM package p FULL JOIN core c USING (ship_year, batch, supplier, slot)""",
)
def j02(t):
    return j.two_sided(base.package(t), base.core(t), base.KEY).select(
        *base.KEY, F.col("package.min_quantity").alias("package_quantity"), F.col("core.min_quantity").alias("core_quantity"), "side"
    )


@query(
    "j03_scope_restriction",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def j03(t):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return j.in_scope(t.orders, returned, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query(
    "j04_missing_or_exempt",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2000) OR c_acctbal < 0""",
)
def j04(t):
    covered = t.orders.filter(F.year("o_orderdate") == 2000).select(F.col("o_custkey").alias("c_custkey"))
    exempt = t.customer.filter("c_acctbal < 0")
    return j.missing_or_exempt(t.customer, covered, exempt, "c_custkey").select("c_custkey", "c_name")


@query(
    "j05_rekey_candidates",
    f"""WITH {base.SIDES} SELECT p.ship_year, p.batch, p.supplier, p.slot, count(*) AS candidate_count, min(c.slot) AS first_slot
        FROM package_only p JOIN core_only c USING (ship_year, batch, supplier) WHERE c.slot <> p.slot GROUP BY ALL""",
)
def j05(t):
    sides = j.two_sided(base.package(t), base.core(t), base.KEY)
    package_only = sides.filter("side = 'package_only'").select(*base.KEY)
    core_only = j.in_scope(sides.filter("side = 'core_only'").select(*base.KEY), base.package(t), base.MATCH)
    return j.rekey_candidates(package_only, core_only, base.MATCH, base.VARIANT).select(
        *base.KEY, "candidate_count", F.col("first_candidate.slot").alias("first_slot")
    )


@query(
    "j05_candidates",
    f"""WITH {base.SIDES} SELECT ship_year, batch, supplier, slot, CAST(row_number() OVER (PARTITION BY ship_year, batch, supplier ORDER BY slot) AS INTEGER) AS candidate_no
        FROM core_only c WHERE EXISTS (SELECT 1 FROM package_only p WHERE p.ship_year = c.ship_year AND p.batch = c.batch AND p.supplier = c.supplier)""",
)
def j05_candidates(t):
    sides = j.two_sided(base.package(t), base.core(t), base.KEY)
    package_only = sides.filter("side = 'package_only'").select(*base.KEY)
    core_only = j.in_scope(sides.filter("side = 'core_only'").select(*base.KEY), base.package(t), base.MATCH)
    return j.candidate_rows(package_only, core_only, base.MATCH, base.VARIANT)


@query(
    "j06_union_of_keys",
    """SELECT k AS entity, CAST(sum(a) AS BIGINT) AS order_count, CAST(sum(b) AS BIGINT) AS event_count, CAST(sum(c) AS BIGINT) AS turn_count FROM (
         SELECT o_custkey AS k, 1 AS a, NULL AS b, NULL AS c FROM orders UNION ALL SELECT user_id, NULL, 1, NULL FROM events
         UNION ALL SELECT conv_id, NULL, NULL, 1 FROM conversations) GROUP BY 1""",
)
def j06(t):
    return j.union_of_keys(
        [
            t.orders.groupBy(F.col("o_custkey").alias("entity")).agg(F.count(F.lit(1)).alias("order_count")),
            t.events.groupBy(F.col("user_id").alias("entity")).agg(F.count(F.lit(1)).alias("event_count")),
            t.conversations.groupBy(F.col("conv_id").alias("entity")).agg(F.count(F.lit(1)).alias("turn_count")),
        ],
        ["entity"],
    )


def places(df, key: str, nation: str, balance: str):
    """Points for the distance join; the tables hold no coordinates, so key and balance stand in."""
    return df.select(
        F.col(nation).alias("nation"),
        F.col(key).alias("place_id"),
        (F.col(balance) / 200.0).alias("latitude"),
        ((F.col(key) * 7) % 360 - 180).cast("double").alias("longitude"),
    )


@query(
    "j07_nearest_in_group",
    f"""WITH a AS (SELECT c_nationkey AS nation, c_custkey AS place_id, c_acctbal / 200.0 AS lat1, CAST((c_custkey * 7) % 360 - 180 AS DOUBLE) AS lon1 FROM customer),
        b AS (SELECT s_nationkey AS nation, s_acctbal / 200.0 AS lat2, CAST((s_suppkey * 7) % 360 - 180 AS DOUBLE) AS lon2 FROM supplier),
        d AS (SELECT nation, place_id, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat2 - lat1) / 2), 2)
              + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))) AS km FROM a JOIN b USING (nation))
        SELECT nation, place_id, {fx('min(km)')} AS nearest_km FROM d GROUP BY 1, 2""",
)
def j07(t):
    left = places(t.customer, "c_custkey", "c_nationkey", "c_acctbal")
    right = places(t.supplier, "s_suppkey", "s_nationkey", "s_acctbal")
    near = j.nearest_in_group(left, right, ["nation"], "place_id")
    return near.select("nation", "place_id", fixed6(F.col("nearest_km")).alias("nearest_km"))


@query(
    "j08_fallback_key_join",
    """WITH s AS (SELECT s_nationkey AS nation, n_regionkey AS region, CAST(round(s_acctbal * 100) AS BIGINT) AS cents FROM supplier JOIN nation ON n_nationkey = s_nationkey),
       a AS (SELECT nation, max(cents) AS cost FROM s GROUP BY 1), b AS (SELECT region, max(cents) AS cost FROM s GROUP BY 1),
       c AS (SELECT c_custkey, c_nationkey AS nation, n_regionkey AS region FROM customer JOIN nation ON n_nationkey = c_nationkey)
       SELECT c_custkey, nation, region, CASE WHEN a.nation IS NOT NULL THEN a.cost ELSE b.cost END AS cost,
              CASE WHEN a.nation IS NOT NULL THEN 'code' WHEN b.region IS NOT NULL THEN 'city' ELSE 'none' END AS matched_by
       FROM c LEFT JOIN a USING (nation) LEFT JOIN b USING (region)""",
)
def j08(t):
    nations = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    costs = (
        t.supplier.select(F.col("s_nationkey").alias("nation"), F.round(F.col("s_acctbal") * 100).cast("bigint").alias("cents"))
        .join(nations, "nation")
    )
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation")).join(nations, "nation").select("c_custkey", "nation", "region")
    return j.with_fallback(
        rows, costs.groupBy("nation").agg(F.max("cents").alias("cost")), costs.groupBy("region").agg(F.max("cents").alias("cost")), "nation", "region", "cost"
    )


def benchmark_keywords(t):
    """Letters-only words of the benchmark items, of two letters or more."""
    words = t.benchmark.select("item_id", F.explode(F.expr("regexp_extract_all(text, '[A-Za-z]{2,}', 0)")).alias("keyword"))
    return words.select("item_id", F.lower("keyword").alias("keyword")).distinct()


KEYWORDS_SQL = """kw AS (SELECT DISTINCT item_id, lower(unnest(regexp_extract_all(text, '[A-Za-z]{2,}'))) AS keyword FROM benchmark),
  lowered AS (SELECT doc_id, lower(text) AS body FROM documents),
  hits AS (SELECT doc_id, keyword FROM (SELECT DISTINCT keyword FROM kw) JOIN lowered ON contains(body, keyword))"""


def document_texts(t):
    return t.documents.select("doc_id", F.lower("text").alias("body"))


@query(
    "j09_keyword_containment",
    f"""WITH {KEYWORDS_SQL} SELECT DISTINCT item_id, doc_id FROM hits JOIN kw USING (keyword)""",
)
def j09(t):
    texts, keywords = document_texts(t), benchmark_keywords(t)
    held = j.held_keywords(texts, "doc_id", keywords, "item_id", "[a-z]+")
    if held:
        return j.item_hits_in_tasks(texts, "doc_id", "body", held, "item_id", "bigint", "[a-z]+")
    return j.item_hits(texts, "doc_id", "body", keywords, "item_id", token="[a-z]+")


def padded_code(number):
    """At least four digits; longer numbers stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(4), F.length(text)), F.lit("0"))


@query(
    "j10_code_prefix_name_match",
    """WITH m AS (SELECT p_name AS major_name, lpad(CAST(min(p_partkey) AS VARCHAR), CAST(greatest(4, length(CAST(min(p_partkey) AS VARCHAR))) AS INTEGER), '0') AS major_code FROM part GROUP BY 1),
       p AS (SELECT p_partkey, p_name, lpad(CAST(p_partkey % 97 AS VARCHAR), 4, '0') AS code FROM part),
       hit AS (SELECT p_partkey, major_code, 'code_exact' AS match_type FROM p JOIN m ON m.major_code = p.code UNION
               SELECT p_partkey, major_code, 'code_prefix_3' FROM p JOIN m ON substr(m.major_code, 1, 3) = substr(p.code, 1, 3) UNION
               SELECT p_partkey, major_code, 'name' FROM p JOIN m ON contains('needs ' || p.p_name || ' or ' || p.code, m.major_name))
       SELECT major_code, match_type, count(*) AS position_count FROM hit GROUP BY 1, 2""",
)
def j10(t):
    majors = t.part.groupBy(F.col("p_name").alias("major_name")).agg(padded_code(F.min("p_partkey")).alias("major_code"))
    code = padded_code(F.col("p_partkey") % 97)
    positions = t.part.select("p_partkey", F.concat(F.lit("needs "), "p_name", F.lit(" or "), code).alias("body"))
    found = F.regexp_extract_all("body", F.lit(MAJOR_CODE), F.lit(1))
    wanted = j.code_keys(positions, ["p_partkey"], found, [3])
    offered = j.code_keys(majors, ["major_code"], F.array("major_code"), [3])
    by_code = j.counts_by_key(wanted, offered, "major_code").withColumnRenamed("rows", "position_count")
    names = majors.select(F.col("major_name").alias("keyword"), "major_code")
    by_name = j.keyword_hits(positions, "p_partkey", "body", names).groupBy("keyword").agg(F.count(F.lit(1)).alias("position_count")).join(names, "keyword")
    return by_code.unionByName(by_name.select("major_code", F.lit("name").alias("match_type"), "position_count"))


def words_of(df, col: str = "text"):
    """Distinct lower-case words."""
    return df.select(F.explode(F.expr(f"regexp_extract_all(lower({col}), '[a-z]+', 0)")).alias("name")).distinct()


@query(
    "j11_prefix_suggestions",
    """WITH l AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS name FROM benchmark),
       p AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS profile FROM documents),
       ll AS (SELECT name FROM l WHERE length(name) >= 6), pp AS (SELECT profile FROM p WHERE length(profile) >= 6),
       m AS (SELECT name, profile FROM ll JOIN pp ON starts_with(name, profile) OR starts_with(profile, name)),
       g AS (SELECT name, count(*) AS n, string_agg(profile, '|' ORDER BY profile) AS c, min(profile) AS one FROM m GROUP BY 1)
       SELECT ll.name, coalesce(n, 0) AS prefix_matches, CASE WHEN n <= 3 THEN c ELSE '' END AS candidates, CASE WHEN n = 1 THEN one END AS suggestion
       FROM ll LEFT JOIN g USING (name)""",
)
def j11(t):
    return j.prefix_suggestions(words_of(t.benchmark), words_of(t.documents), 6, 3)


@query(
    "j12_unique_match",
    """WITH l AS (SELECT p_partkey AS local_id, p_brand, p_size FROM part WHERE p_partkey % 2 = 0),
       n AS (SELECT p_brand, p_size, count(*) AS n, min('N' || p_partkey) AS code FROM part WHERE p_partkey % 2 = 1 GROUP BY 1, 2)
       SELECT local_id, p_brand, p_size, CASE WHEN p_size = 1 THEN 'R' || local_id WHEN n = 1 THEN code END AS national_code,
              CASE WHEN p_size = 1 THEN 'reviewed' WHEN n IS NULL THEN 'no_name_match' WHEN n > 1 THEN 'ambiguous_name' ELSE 'unique_name' END AS match_reason
       FROM l LEFT JOIN n USING (p_brand, p_size)""",
)
def j12(t):
    local = t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("local_id"), "p_brand", "p_size")
    profiles = t.part.filter("p_partkey % 2 = 1").select("p_brand", "p_size", F.concat(F.lit("N"), "p_partkey").alias("national_code"))
    reviewed = local.filter("p_size = 1").select("local_id", F.concat(F.lit("R"), "local_id").alias("national_code"))
    return j.unique_match(local, reviewed, profiles, "local_id", ["p_brand", "p_size"], "national_code")


@query(
    "j13_code_or_name_coverage",
    """WITH r AS (SELECT p_partkey, p_brand AS code, p_name AS name, p_size AS city FROM part),
       f AS (SELECT DISTINCT p_brand AS code, p_name AS name, CASE WHEN p_retailprice > 999.9 THEN 0 ELSE p_size END AS city FROM part WHERE p_partkey % 2 = 1)
       SELECT DISTINCT p_partkey FROM r JOIN f ON (r.code = f.code OR r.name = f.name) AND (r.city = f.city OR f.city = 0)""",
)
def j13(t):
    rows = t.part.select("p_partkey", F.col("p_brand").alias("code"), F.col("p_name").alias("name"), F.col("p_size").alias("city"))
    facts = t.part.filter("p_partkey % 2 = 1").select(
        F.col("p_brand").alias("code"), F.col("p_name").alias("name"), F.when(F.col("p_retailprice") > 999.9, 0).otherwise(F.col("p_size")).alias("city")
    )
    return j.covered_by_either(rows, facts, "p_partkey", "code", "name", "city", 0)


@query(
    "j14_bridge_join",
    """SELECT DISTINCT o_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 1)""",
)
def j14(t):
    facts = t.supplier.filter("s_suppkey % 2 = 1").select(F.col("s_nationkey").alias("c_nationkey")).distinct()
    bridge = t.customer.join(facts, "c_nationkey", "left_semi").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_custkey").distinct().join(bridge, "o_custkey", "left_semi")


@query(
    "j15_name_cascade",
    """WITH p AS (SELECT p_partkey, p_size AS scope, p_brand || ' ' || p_name AS name FROM part WHERE p_partkey % 2 = 1),
       c AS (SELECT p_partkey AS code, p_size AS scope, p_brand || ' ' || p_name AS name FROM part WHERE p_partkey % 2 = 0),
       tok AS (SELECT p.p_partkey, c.code, CASE WHEN p.name = c.name THEN 1 WHEN contains(p.name, c.name) OR contains(c.name, p.name) THEN 2
                 WHEN len(list_intersect(list_distinct(string_split(p.name, ' ')), list_distinct(string_split(c.name, ' ')))) >= 2 THEN 3 END AS kind
               FROM p JOIN c USING (scope)),
       g AS (SELECT p_partkey, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2, count(*) FILTER (WHERE kind = 3) AS n3,
                    min(code) FILTER (WHERE kind = 1) AS c1, min(code) FILTER (WHERE kind = 2) AS c2, min(code) FILTER (WHERE kind = 3) AS c3 FROM tok GROUP BY 1)
       SELECT p.p_partkey, CASE WHEN n1 = 1 THEN 'single_exact' WHEN n1 > 1 THEN 'ambiguous_exact' WHEN n2 = 1 THEN 'single_contains' WHEN n2 > 1 THEN 'ambiguous_contains'
                 WHEN n3 = 1 THEN 'single_token_overlap' WHEN n3 > 1 THEN 'ambiguous_token_overlap' ELSE 'no_match' END AS match_hint,
              CASE WHEN n1 = 1 THEN c1 WHEN n1 > 1 THEN NULL WHEN n2 = 1 THEN c2 WHEN n2 > 1 THEN NULL WHEN n3 = 1 THEN c3 END AS matched_code
       FROM p LEFT JOIN g USING (p_partkey)""",
)
def j15(t):
    name = F.concat_ws(" ", "p_brand", "p_name").alias("name")
    package = t.part.filter("p_partkey % 2 = 1").select("p_partkey", F.col("p_size").alias("scope"), name)
    core = t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("code"), F.col("p_size").alias("scope"), name)
    matched = j.name_cascade(package, core, ["scope"], lambda c: F.array_distinct(F.split(c, " ")), 2, 0.5)
    return matched.select("p_partkey", "match_hint", "matched_code")


@query(
    "j16_role_fan_out",
    """WITH d AS (SELECT p_type AS role, s_nationkey AS city, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q
                  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2)
       SELECT p_brand AS major, city, count(*) AS role_count, CAST(sum(n) AS BIGINT) AS demand_rows, CAST(sum(q) AS BIGINT) AS quantity
       FROM (SELECT DISTINCT p_brand, p_type AS role FROM part) JOIN d USING (role) GROUP BY 1, 2""",
)
def j16(t):
    demand = (
        t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .select(F.col("p_type").alias("role"), F.col("s_nationkey").alias("city"), F.col("l_quantity").cast("bigint").alias("quantity"))
    )
    roles = t.part.select(F.col("p_brand").alias("major"), F.col("p_type").alias("role"))
    return j.role_demand(roles, demand, "major", "role", "city", ["quantity"])


LINE_RULES = [("A", "value", 2.0, 1.0, 50.0), ("R", "risk", 1.0, 10.0, 40.0)]
LINE_RULE_COLUMNS = ["l_returnflag", "component", "weight", "low", "high"]


@query(
    "j17_rule_join",
    f"""SELECT component, l_linestatus, count(*) AS scored_rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem JOIN {values_sql(LINE_RULE_COLUMNS, LINE_RULES)} r USING (l_returnflag) GROUP BY 1, 2""",
)
def j17(t):
    rules = broadcast_rules(rule_frame(t.spark, LINE_RULE_COLUMNS, LINE_RULES), len(LINE_RULES))
    return (
        t.lineitem.join(rules, "l_returnflag")
        .groupBy("component", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("scored_rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )


@query(
    "j18_reference_corroboration",
    f"""WITH {base.CORE}, {base.REFERENCE} SELECT c.ship_year, c.batch, c.supplier, c.slot,
        coalesce(c.min_quantity = r.min_quantity AND c.fee = r.fee, false) AS is_corroborated
        FROM core c LEFT JOIN reference r USING (ship_year, batch, supplier, slot)""",
)
def j18(t):
    ref = base.reference(t).select(*base.KEY, F.struct(*base.COMPARE).alias("ref"))
    same = F.struct(*base.COMPARE) == F.col("ref")
    return base.core(t).join(ref, base.KEY, "left").select(*base.KEY, F.coalesce(same, F.lit(False)).alias("is_corroborated"))


@query(
    "j19_enrichment_cascade",
    """WITH b AS (SELECT o_custkey AS k, 'buyer' AS family FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 HAVING count(*) >= 5)
       SELECT c_custkey, c_name, coalesce(CASE WHEN s_suppkey IS NOT NULL THEN 'supplier' END, b.family, CASE WHEN c_name LIKE '%7' THEN 'art' ELSE '' END) AS family
       FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN b ON b.k = c_custkey""",
)
def j19(t):
    by_code = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.lit("supplier").alias("family"))
    buyers = t.orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").count().filter("count >= 5")
    by_name = buyers.select(F.format_string("Customer#%09d", "o_custkey").alias("c_name"), F.lit("buyer").alias("family"))
    rows = t.customer.select("c_custkey", "c_name")
    return j.enrich_cascade(rows, by_code, by_name, "c_custkey", "c_name", "family", F.when(F.col("c_name").endswith("7"), "art").otherwise(""))


@query(
    "j20_route_evidence",
    """SELECT d.doc_id, coalesce(m.n, 0) AS same_metric_rows, CASE WHEN m.n > 0 THEN 'same_metric_candidate_exists'
         WHEN l.doc_id IS NOT NULL OR p.page_id IS NOT NULL THEN 'official_artifact_but_metric_missing'
         WHEN d.lang = 'en' THEN 'official_route_pending_artifact_intake' WHEN d.lang = 'de' THEN 'official_route_missing'
         WHEN d.lang = 'fr' THEN 'official_route_rejected' ELSE 'no_candidate_artifact_indexed' END AS route_evidence
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id
       LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY 1) m ON m.conv_id = d.doc_id""",
)
def j20(t):
    raw = t.labels.groupBy("doc_id").agg(F.count(F.lit(1)).alias("raw_artifacts"))
    candidates = t.pages.groupBy(F.col("page_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("candidate_artifacts"))
    metric = t.conversations.filter("role = 'assistant'").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("same_metric_rows"))
    rows = t.documents.select("doc_id", "lang").join(raw, "doc_id", "left").join(candidates, "doc_id", "left").join(metric, "doc_id", "left")
    status = first_match(
        [
            (F.col("same_metric_rows") > 0, "same_metric_candidate_exists"),
            (F.col("raw_artifacts").isNotNull() | F.col("candidate_artifacts").isNotNull(), "official_artifact_but_metric_missing"),
            (F.col("lang") == "en", "official_route_pending_artifact_intake"),
            (F.col("lang") == "de", "official_route_missing"),
            (F.col("lang") == "fr", "official_route_rejected"),
        ],
        "no_candidate_artifact_indexed",
    )
    return rows.select("doc_id", F.coalesce("same_metric_rows", F.lit(0)).alias("same_metric_rows"), status.alias("route_evidence"))
