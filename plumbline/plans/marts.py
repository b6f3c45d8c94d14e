"""M: the marts users query."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import scoring as sc
from plumbline.functions.values import fixed6
from plumbline.operators import aggregate as a
from plumbline.operators import joins as j
from plumbline.operators import marts as m
from plumbline.operators import review as r
from plumbline.operators import sets as u
from plumbline.operators.normalise import project_with_defaults, suffix_duplicate_keys, unpivot_years, year_columns
from plumbline.operators.sequence import dedupe, global_row_number, place_verdict
from plumbline.plans import base
from plumbline.plans.aggregates import COMPONENTS_SQL, POI_RULES, POI_SQL, SIGNAL_SQL, company_signals, line_pois, overall
from plumbline.plans.joins import DISTRIBUTION, KEYWORDS_SQL, benchmark_keywords, distribution, document_texts, padded_code, places
from plumbline.plans.projections import YEAR_PATTERNS, wide_orders
from plumbline.plans.registry import fx, query
from plumbline.plans.scans import DISTRICTS, GEOCODED, district_tree, geocoded
from plumbline.functions.vocabulary import MAJOR_CODE
from plumbline.rules import first_match, rule_frame, values_sql
from plumbline.sources import files as f
from plumbline.session import cut_lineage

CAREER_RULES = [("A", "income", 2.0, 1.0, 50.0, "positive"), ("R", "stability", 1.0, 1.0, 50.0, "negative")]
LATEST = "l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC"


@query(
    "m01_career_score",
    f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_returnflag ORDER BY {LATEST}) AS rn FROM lineitem),
        s AS (SELECT l_suppkey, l_linenumber, l_returnflag, l_shipdate, CASE l_returnflag WHEN 'A' THEN (l_quantity - 1.0) / 49.0 * 100.0 WHEN 'R' THEN 100.0 - (l_quantity - 1.0) / 49.0 * 100.0 END AS score, CASE l_returnflag WHEN 'A' THEN 2.0 WHEN 'R' THEN 1.0 END AS w FROM l WHERE rn = 1)
        SELECT l_suppkey AS occupation, l_linenumber AS city, {fx('sum(score * w) / sum(w)')} AS weighted_score, {fx("avg(score) FILTER (WHERE l_returnflag = 'A')")} AS income_score, {fx("avg(score) FILTER (WHERE l_returnflag = 'R')")} AS stability_score,
          count(*) AS signal_count, concat_ws('|', CASE WHEN bool_or(l_returnflag = 'N') THEN 'unused_metric:N' END, CASE WHEN count(*) < 3 THEN 'below_minimum_signal_count' END) AS reason_codes, strftime(max(l_shipdate), '%Y-%m-%d') AS source_date FROM s GROUP BY 1, 2""",
)
def m01(t):
    signals = t.lineitem.select(
        F.col("l_suppkey").alias("occupation"), F.col("l_linenumber").alias("city"), F.col("l_returnflag").alias("metric_key"), F.col("l_quantity").alias("metric_value"),
        F.to_date("l_shipdate").alias("source_date"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    )
    scored = m.career_scores(signals, ["occupation", "city"], ["source_date", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], CAREER_RULES, 3)
    for c in ("weighted_score", "income_score", "stability_score"):
        scored = scored.withColumn(c, fixed6(F.col(c)))
    return scored.withColumn("source_date", F.date_format("source_date", "yyyy-MM-dd"))


@query(
    "m02_city_development_score",
    f"""WITH {COMPONENTS_SQL} SELECT nation, n_name AS city, {fx('economic')} AS economic_score, {fx('industry')} AS industry_score, {fx('service')} AS service_score, component_count, {fx('overall_score')} AS overall_score, reason_codes FROM overall JOIN nation ON n_nationkey = nation""",
)
def m02(t):
    names = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("city"))
    scores = [fixed6(F.col(c)).alias(f"{c}_score") for c in ("economic", "industry", "service")]
    return overall(t).join(names, "nation").select("nation", "city", *scores, "component_count", fixed6(F.col("overall_score")).alias("overall_score"), "reason_codes")


# metric_key, component, weight, low, high, polarity
HOUSING_RULES = [("rent", "housing", 2.0, 1.0, 50.0, "negative"), ("fee", "housing", 1.0, 0.0, 8.0, "negative")]
REGION_RULES = [("living_cost", "housing", 1.0, 0.0, 10000.0, "negative")]
CAMPUS_WEIGHTS = {"commerce": 0.3, "housing": 0.4, "transit": 0.3}
CAMPUS = f"""{POI_SQL}, pc AS (SELECT supplier, component, sum(metric_score * weight) / sum(weight) AS component_score FROM poi GROUP BY 1, 2),
  hm AS (SELECT l_suppkey AS supplier, avg(CAST(l_quantity AS BIGINT)) AS rent, avg(CAST(round(l_tax * 100) AS BIGINT)) AS fee FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
  hc AS (SELECT supplier, 'housing' AS component, ((100.0 - greatest(0.0, least(100.0, (rent - 1.0) / 49.0 * 100.0))) * 2.0 + (100.0 - greatest(0.0, least(100.0, fee / 8.0 * 100.0)))) / 3.0 AS component_score FROM hm),
  nc AS (SELECT c_nationkey AS nation, max(CAST(round(c_acctbal * 100) AS BIGINT)) / 100.0::DOUBLE AS cost FROM customer GROUP BY 1),
  rc AS (SELECT n_regionkey AS region, max(cost) AS cost FROM nc JOIN nation ON n_nationkey = nation GROUP BY 1),
  rg AS (SELECT s_suppkey AS supplier, 'housing' AS component, 100.0 - greatest(0.0, least(100.0, coalesce(nc.cost, rc.cost) / 10000.0 * 100.0)) AS component_score FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN nc ON nc.nation = s_nationkey LEFT JOIN rc ON rc.region = n_regionkey WHERE nc.cost IS NOT NULL OR rc.cost IS NOT NULL),
  mc AS (SELECT supplier, component, avg(component_score) AS component_score FROM (SELECT * FROM pc UNION ALL SELECT * FROM hc UNION ALL SELECT * FROM rg) GROUP BY 1, 2),
  mw AS (SELECT supplier, max(component_score) FILTER (WHERE component = 'commerce') AS commerce, max(component_score) FILTER (WHERE component = 'housing') AS housing, max(component_score) FILTER (WHERE component = 'transit') AS transit FROM mc GROUP BY 1)"""


@query(
    "m03_campus_living_score",
    f"""WITH {CAMPUS} SELECT supplier, {fx('commerce')} AS commerce, {fx('housing')} AS housing, {fx('transit')} AS transit,
        {fx('(coalesce(commerce * 0.3, 0.0) + coalesce(housing * 0.4, 0.0) + coalesce(transit * 0.3, 0.0)) / ((CASE WHEN commerce IS NULL THEN 0 ELSE 0.3 END) + (CASE WHEN housing IS NULL THEN 0 ELSE 0.4 END) + (CASE WHEN transit IS NULL THEN 0 ELSE 0.3 END))')} AS overall_score FROM mw""",
)
def m03(t):
    pois = a.counts_within_radius(line_pois(t), POI_RULES, ["supplier"])
    listings = t.lineitem.filter("l_returnflag = 'N'").groupBy(F.col("l_suppkey").alias("supplier"))
    housing = listings.agg(F.avg(F.col("l_quantity").cast("bigint")).alias("rent"), F.avg(F.round(F.col("l_tax") * 100).cast("bigint")).alias("fee"))
    housing = a.score_metrics(housing.unpivot(["supplier"], ["rent", "fee"], "metric_key", "metric_value"), HOUSING_RULES)
    nations = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    cost = F.max(F.round(F.col("c_acctbal") * 100).cast("bigint")) / F.lit(100.0)
    by_nation = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(cost.alias("metric_value"))
    by_region = by_nation.join(nations, "nation").groupBy("region").agg(F.max("metric_value").alias("metric_value"))
    located = t.supplier.select(F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("nation")).join(nations, "nation")
    region = j.with_fallback(located, by_nation, by_region, "nation", "region", "metric_value").filter("matched_by <> 'none'")
    region = a.score_metrics(region.select("supplier", F.lit("living_cost").alias("metric_key"), "metric_value"), REGION_RULES)
    merged = a.merge_components([a.component_scores(s, ["supplier"]) for s in (pois, housing, region)], ["supplier"])
    scored = a.overall_scores(merged, ["supplier"], CAMPUS_WEIGHTS)
    return scored.select("supplier", *[fixed6(F.col(c)).alias(c) for c in ("commerce", "housing", "transit", "overall_score")])


FIT_WEIGHTS = {"recruitment": 0.3, "research": 0.2, "employment": 0.2, "internship": 0.1, "zone_proximity": 0.1, "resilience": 0.1}
FIT = f"""rec AS (SELECT user_id AS entity, count(*) AS n, sum(CASE event_type WHEN 'signup' THEN 1.0 WHEN 'purchase' THEN 3.0 ELSE 0.5 END::DOUBLE) AS w, count(*) FILTER (WHERE event_type = 'signup') AS interns, count(DISTINCT event_type) AS employers, count(DISTINCT CAST(ts AS DATE)) AS roles FROM events GROUP BY 1),
  res AS (SELECT o_custkey AS entity, sum(CASE o_orderstatus WHEN 'F' THEN 2.0 ELSE 1.0 END::DOUBLE) AS w FROM orders GROUP BY 1), emp AS (SELECT conv_id AS entity, avg(length(text)) AS v FROM conversations GROUP BY 1),
  near AS (SELECT place_id AS entity, min(km) AS km FROM (SELECT place_id, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))) AS km
    FROM (SELECT c_nationkey AS nation, c_custkey AS place_id, c_acctbal / 200.0 AS lat1, CAST((c_custkey * 7) % 360 - 180 AS DOUBLE) AS lon1 FROM customer) JOIN (SELECT s_nationkey AS nation, s_acctbal / 200.0 AS lat2, CAST((s_suppkey * 7) % 360 - 180 AS DOUBLE) AS lon2 FROM supplier) USING (nation)) GROUP BY 1),
  k AS (SELECT entity FROM rec UNION SELECT entity FROM res UNION SELECT entity FROM emp),
  c AS (SELECT k.entity, CASE WHEN rec.w IS NOT NULL THEN least(100.0, rec.w / 100.0 * 100.0) END AS recruitment, CASE WHEN res.w IS NOT NULL THEN least(100.0, res.w / 30.0 * 100.0) END AS research, CASE WHEN emp.v IS NOT NULL THEN greatest(0.0, least(100.0, emp.v / 1000.0 * 100.0)) END AS employment,
    CASE WHEN rec.interns > 0 THEN least(100.0, rec.interns / 20.0 * 100.0) END AS internship, CASE WHEN near.entity IS NOT NULL THEN greatest(0.0, (1500.0 - near.km) / 1500.0 * 100.0) END AS zone_proximity,
    CASE WHEN rec.entity IS NOT NULL THEN least(100.0, rec.employers / 5.0 * 100.0) * 0.6 + least(100.0, rec.roles / 30.0 * 100.0) * 0.4 END AS resilience
    FROM k LEFT JOIN rec USING (entity) LEFT JOIN res USING (entity) LEFT JOIN emp USING (entity) LEFT JOIN near USING (entity))"""


def term(c, w):
    return f"coalesce({c} * {w}, 0.0)"


FIT_OVERALL = f"({' + '.join(term(c, w) for c, w in FIT_WEIGHTS.items())}) / ({' + '.join(f'(CASE WHEN {c} IS NULL THEN 0.0 ELSE {w} END)' for c, w in FIT_WEIGHTS.items())})"


@query(
    "m04_city_industry_fit",
    f"""WITH {FIT} SELECT entity, {', '.join(f'{fx(c)} AS {c}' for c in FIT_WEIGHTS)}, {fx(FIT_OVERALL)} AS overall_score, concat_ws('|', CASE WHEN recruitment >= 70 THEN 'recruitment_strong' WHEN recruitment < 35 THEN 'recruitment_weak' END, CASE WHEN internship IS NOT NULL THEN 'internship_signal_visible' END) AS reason_codes FROM c""",
)
def m04(t):
    kind = F.col("event_type")
    weight = first_match([(kind == "signup", 1.0), (kind == "purchase", 3.0)], 0.5)
    recruiting = t.events.groupBy(F.col("user_id").alias("entity")).agg(
        F.sum(weight).alias("rec_w"),
        F.count_if(kind == "signup").cast("double").alias("interns"),
        F.count_distinct("event_type").cast("double").alias("employers"),
        F.count_distinct(F.to_date("ts")).cast("double").alias("role_days"),
    )
    research = t.orders.groupBy(F.col("o_custkey").alias("entity")).agg(F.sum(F.when(F.col("o_orderstatus") == "F", 2.0).otherwise(1.0)).alias("res_w"))
    employment = t.conversations.groupBy(F.col("conv_id").alias("entity")).agg(F.avg(F.length("text")).alias("emp_v"))
    facts = j.union_of_keys([recruiting, research, employment], ["entity"])
    near = j.nearest_in_group(places(t.customer, "c_custkey", "c_nationkey", "c_acctbal"), places(t.supplier, "s_suppkey", "s_nationkey", "s_acctbal"), ["nation"], "place_id")
    zones = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("zones"))
    located = t.customer.select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("nation")).join(zones, "nation", "left")
    located = located.join(near.select(F.col("place_id").alias("entity"), "nearest_km"), "entity", "left")
    rows = facts.join(located, "entity", "left")
    has_rec = F.col("rec_w").isNotNull()
    scored = rows.select(
        "entity",
        sc.capped_share(F.col("rec_w"), 100.0).alias("recruitment"),
        sc.capped_share(F.col("res_w"), 30.0).alias("research"),
        sc.clip(F.col("emp_v") / 1000.0 * 100.0).alias("employment"),
        F.when(F.col("interns") > 0, sc.capped_share(F.col("interns"), 20.0)).alias("internship"),
        m.proximity_score(F.col("nearest_km"), 1500.0, F.col("zones"), 50.0).alias("zone_proximity"),
        F.when(has_rec, sc.capped_share(F.col("employers"), 5.0) * 0.6 + sc.capped_share(F.col("role_days"), 30.0) * 0.4).alias("resilience"),
    )
    strength = F.when(F.col("recruitment") >= 70, "recruitment_strong").when(F.col("recruitment") < 35, "recruitment_weak")
    reasons = F.concat_ws("|", strength, F.when(F.col("internship").isNotNull(), "internship_signal_visible"))
    return scored.select("entity", *[fixed6(F.col(c)).alias(c) for c in FIT_WEIGHTS], fixed6(m.weighted_overall(FIT_WEIGHTS)).alias("overall_score"), reasons.alias("reason_codes"))


FITS = {"private_fit": ["ECONOMY", "STANDARD", "LARGE"], "public_fit": ["PROMO", "SMALL", "MEDIUM"]}
MAJOR_WEIGHTS = {"private_fit": 0.4, "public_fit": 0.2, "demand": 0.2, "flexibility": 0.2}


@query(
    "m05_major_city_fit",
    f"""WITH p AS (SELECT p_brand AS major, p_type AS role, CAST(p_size AS DOUBLE) * 2 AS fit, CASE WHEN p_retailprice > 1000 THEN 1.0 WHEN p_retailprice > 950 THEN 0.5 ELSE 0.25 END::DOUBLE AS w FROM part),
        rs AS (SELECT major, sum(fit * w) FILTER (WHERE role IN ('ECONOMY', 'STANDARD', 'LARGE')) / sum(w) FILTER (WHERE role IN ('ECONOMY', 'STANDARD', 'LARGE')) AS private_fit, sum(fit * w) FILTER (WHERE role IN ('PROMO', 'SMALL', 'MEDIUM')) / sum(w) FILTER (WHERE role IN ('PROMO', 'SMALL', 'MEDIUM')) AS public_fit, count(DISTINCT role) AS roles FROM p GROUP BY 1),
        d AS (SELECT p_type AS role, s_nationkey AS city, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2),
        f AS (SELECT major, city, count(*) AS role_count, CAST(sum(n) AS BIGINT) AS demand_rows FROM (SELECT DISTINCT major, role FROM p) JOIN d USING (role) GROUP BY 1, 2),
        b AS (SELECT major, city, role AS primary_role FROM (SELECT m.major, d.city, m.role, row_number() OVER (PARTITION BY m.major, d.city ORDER BY (m.best + least(100.0::DOUBLE, d.n * 20.0::DOUBLE) * 0.2::DOUBLE) * m.w DESC, m.role) AS rn FROM (SELECT major, role, w, max(fit * CASE WHEN role IN ('ECONOMY', 'STANDARD', 'LARGE') THEN 0.4 ELSE 0.2 END::DOUBLE) AS best FROM p GROUP BY 1, 2, 3) m JOIN d USING (role)) WHERE rn = 1),
        c AS (SELECT f.*, private_fit, public_fit, least(100.0, demand_rows / 3000.0::DOUBLE * 100.0) AS demand, least(100.0, least(100.0, roles / 6.0::DOUBLE * 100.0) + least(10.0, greatest(0, roles - 1) * 5.0)) AS flexibility, primary_role FROM f JOIN rs USING (major) JOIN b USING (major, city))
        SELECT major, city, role_count, demand_rows, primary_role, {fx('(coalesce(private_fit * 0.4, 0.0) + coalesce(public_fit * 0.2, 0.0) + coalesce(demand * 0.2, 0.0) + coalesce(flexibility * 0.2, 0.0)) / ((CASE WHEN private_fit IS NULL THEN 0.0 ELSE 0.4 END) + (CASE WHEN public_fit IS NULL THEN 0.0 ELSE 0.2 END) + 0.4)')} AS overall_score FROM c""",
)
def m05(t):
    roles = t.part.select(
        F.col("p_brand").alias("major"), F.col("p_type").alias("role_key"), F.col("p_type").alias("role_type"), (F.col("p_size").cast("double") * 2).alias("fit"),
        first_match([(F.col("p_retailprice") > 1000, 1.0), (F.col("p_retailprice") > 950, 0.5)], 0.25).alias("confidence"),
    )
    demand = (
        t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .groupBy(F.col("p_type").alias("role_key"), F.col("s_nationkey").alias("city"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_role = roles.groupBy("major", "role_key").agg(F.count(F.lit(1)).alias("parts")).join(demand, "role_key")
    cities = per_role.groupBy("major", "city").agg(F.count(F.lit(1)).alias("role_count"), F.sum("n").alias("demand_rows"))
    # a role's score: its fit by weight and its demand, 20 for each row up to 100, times the confidence; reduced to one row per
    # role and confidence before it meets the cities
    weight = F.when(F.col("role_type").isin(*FITS["private_fit"]), MAJOR_WEIGHTS["private_fit"]).otherwise(MAJOR_WEIGHTS["public_fit"])
    best = roles.groupBy("major", "role_key", "confidence").agg(F.max(F.col("fit") * weight).alias("best")).join(demand, "role_key")
    signal = (F.col("best") + F.least(F.lit(100.0), F.col("n") * F.lit(20.0)) * F.lit(MAJOR_WEIGHTS["demand"])) * F.col("confidence")
    primary = best.groupBy("major", "city").agg(F.min_by("role_key", F.struct(-signal, F.col("role_key"))).alias("primary_role"))
    cities = cities.join(primary, ["major", "city"])
    summary = m.role_summary(roles, "major", F.col("confidence"), FITS)
    scored = cities.join(summary, "major").select(
        "*",
        sc.capped_share(F.col("demand_rows"), 3000.0).alias("demand"),
        m.flexibility_score(F.col("roles"), F.col("role_types"), 6, 10.0).alias("flexibility"),
    )
    return scored.select("major", "city", "role_count", "demand_rows", "primary_role", fixed6(m.weighted_overall(MAJOR_WEIGHTS)).alias("overall_score"))


@query("m06_listed_company_signals", f"WITH {SIGNAL_SQL} SELECT n_name AS city, metric_key, metric_value, 1998 AS metric_year, CASE metric_key WHEN 'large_balance_sum' THEN 'usd' ELSE 'count' END AS metric_unit FROM signals JOIN nation ON n_nationkey = nation")
def m06(t):
    names = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("city"))
    unit = F.when(F.col("metric_key") == "large_balance_sum", "usd").otherwise("count")
    return company_signals(t).join(names, "nation").select("city", "metric_key", "metric_value", F.lit(1998).alias("metric_year"), unit.alias("metric_unit"))


@query(
    "m07_civil_service_fit",
    f"""WITH m AS (SELECT p_name AS major_name, lpad(CAST(min(p_partkey) AS VARCHAR), CAST(greatest(4, length(CAST(min(p_partkey) AS VARCHAR))) AS INTEGER), '0') AS major_code FROM part GROUP BY 1), p AS (SELECT p_partkey, p_name, p_size, lpad(CAST(p_partkey % 97 AS VARCHAR), 4, '0') AS code FROM part),
        hit AS (SELECT DISTINCT p_partkey, p_size, major_code FROM p JOIN m ON substr(m.major_code, 1, 3) = substr(p.code, 1, 3) OR contains('needs ' || p.p_name || ' or ' || p.code, m.major_name))
        SELECT major_code, major_name, count(*) AS position_count, CAST(sum(p_size) AS BIGINT) AS recruit_count, {fx('greatest(40.0, least(100.0, 40.0 + 60.0 * (ln(1.0 + CAST(sum(p_size) AS DOUBLE)) / ln(5001.0))))')} AS metric_value FROM hit JOIN m USING (major_code) GROUP BY 1, 2""",
)
def m07(t):
    majors = t.part.groupBy(F.col("p_name").alias("major_name")).agg(padded_code(F.min("p_partkey")).alias("major_code"))
    code = padded_code(F.col("p_partkey") % 97)
    positions = t.part.select("p_partkey", "p_size", F.concat(F.lit("needs "), "p_name", F.lit(" or "), code).alias("body"))
    found = F.regexp_extract_all("body", F.lit(MAJOR_CODE), F.lit(1))
    # whoever shares a code shares its prefix
    prefix = lambda df, *cols: df.filter("match_type = 'code_prefix_3'").select(*cols, "match_key")
    wanted = prefix(j.code_keys(positions, ["p_partkey", "p_size"], found, [3]), "p_partkey", "p_size")
    offered = prefix(j.code_keys(majors, ["major_code"], F.array("major_code"), [3]), "major_code")
    names = majors.select(F.col("major_name").alias("keyword"), "major_code")
    listed = j.keyword_hits(positions, "p_partkey", "body", names).join(names, "keyword").join(positions.select("p_partkey", "p_size"), "p_partkey").select("p_partkey", "p_size", "major_code")
    totals = j.counts_either_way(wanted, offered, cut_lineage(listed.distinct(), "name-matches"), "major_code", "p_partkey", ["p_size"])
    totals = totals.select("major_code", F.col("rows").alias("position_count"), F.col("p_size").alias("recruit_count"))
    scored = totals.withColumn("metric_value", fixed6(sc.log_score(F.col("recruit_count").cast("double"), 40.0, 100.0, 5000.0)))
    return scored.join(majors, "major_code")


@query(
    "m08_signal_candidates",
    f"""WITH {KEYWORDS_SQL}, s AS (SELECT item_id, doc_id, CAST(sum(length(keyword)) AS BIGINT) AS strength FROM hits JOIN kw USING (keyword) GROUP BY 1, 2),
        r AS (SELECT s.*, n_chars, row_number() OVER (PARTITION BY item_id ORDER BY strength DESC, n_chars DESC, doc_id) AS rn FROM s JOIN documents USING (doc_id))
        SELECT item_id, count(*) AS position_count, CAST(sum(n_chars) AS BIGINT) AS metric_value, string_agg(doc_id, '|' ORDER BY rn) FILTER (WHERE rn <= 3) AS evidence, max(strength) AS best_strength FROM r GROUP BY 1""",
)
def m08(t):
    texts, keywords = t.documents.select("doc_id", F.lower("text").alias("body"), "n_chars"), benchmark_keywords(t)
    held = j.held_keywords(texts, "doc_id", keywords, "item_id", "[a-z]+")
    if held:
        return m08_in_tasks(texts, held)
    found = j.item_strengths(document_texts(t), "doc_id", "body", benchmark_keywords(t), "item_id", token="[a-z]+")
    strength = cut_lineage(found.join(t.documents.select("doc_id", "n_chars"), "doc_id"), "strengths")
    totals = strength.groupBy("item_id").agg(F.count(F.lit(1)).alias("position_count"), F.sum("n_chars").alias("metric_value"), F.max("strength").alias("best_strength"))
    top = r.top_per_group(strength, ["item_id"], [F.desc("strength"), F.desc("n_chars"), F.asc("doc_id")], 3)
    order = F.array_sort(F.collect_list(F.struct((-F.col("strength")).alias("s"), (-F.col("n_chars")).alias("n"), "doc_id")))
    evidence = top.groupBy("item_id").agg(F.array_join(F.transform(order, lambda e: e["doc_id"].cast("string")), "|").alias("evidence"))
    return totals.join(evidence, "item_id")


def m08_in_tasks(texts, held):
    """The same where tasks can hold the keywords: an item's texts are summed, and its best ones picked, in one pass."""
    parts = cut_lineage(j.item_totals_in_tasks(texts, "doc_id", "body", "n_chars", held, "item_id", "bigint", "[a-z]+", 3), "item-totals")
    totals = parts.groupBy("item_id").agg(F.sum("texts").alias("position_count"), F.sum("measure").alias("metric_value"))
    top = r.top_per_group(parts.select("item_id", F.inline("top")), ["item_id"], [F.desc("strength"), F.desc("measure"), F.asc("id")], 3)
    order = F.array_sort(F.collect_list(F.struct((-F.col("strength")).alias("s"), F.col("measure").isNull().alias("none"), (-F.col("measure")).alias("n"), "id")))
    evidence = top.groupBy("item_id").agg(F.array_join(F.transform(order, lambda e: e["id"].cast("string")), "|").alias("evidence"), F.max("strength").alias("best_strength"))
    return totals.join(evidence, "item_id")


HISTORY = f"""{base.CORE}, {DISTRIBUTION}, history AS (SELECT ship_year, batch, supplier, slot, min_quantity AS min_score, min_rank FROM core LEFT JOIN distribution USING (supplier, ship_year, min_quantity))"""


def history(t):
    ranks = j.last_by_key(distribution(t, "A"), ["supplier", "ship_year", "min_quantity"], ["min_rank"])
    return j.rank_lookup(base.core(t), ranks, ["supplier", "ship_year", "min_quantity"], "min_rank")


@query("m09_derived_history", f"WITH {HISTORY} SELECT * FROM history WHERE min_rank IS NOT NULL")
def m09(t):
    return history(t).filter("is_matched").select(*base.KEY, F.col("min_quantity").alias("min_score"), "min_rank")


@query("m09_history_report", f"WITH {HISTORY} SELECT ship_year, count(*) AS row_count, count(min_rank) AS matched_rows, count(*) - count(min_rank) AS unmatched_rows, min(min_score) AS lowest_score, max(min_rank) AS largest_rank FROM history GROUP BY 1")
def m09_report(t):
    return history(t).groupBy("ship_year").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("min_rank").alias("matched_rows"),
        F.count_if(F.col("min_rank").isNull()).alias("unmatched_rows"),
        F.min("min_quantity").alias("lowest_score"),
        F.max("min_rank").alias("largest_rank"),
    )


ENTITIES = """entities AS (SELECT 'region:' || r_regionkey AS entity_id, 'region' AS entity_type, r_name AS canonical_name, lower(r_name) AS short_name, NULL AS parent_id FROM region
  UNION ALL SELECT 'region:N' || n_nationkey, 'region', n_name, lower(n_name), 'region:' || n_regionkey FROM nation UNION ALL SELECT 'school:' || s_suppkey, 'school', s_name, substr(s_name, 10), 'region:N' || s_nationkey FROM supplier
  UNION ALL SELECT 'person:' || c_custkey, 'person', c_name, substr(c_name, 10), 'region:N' || c_nationkey FROM customer UNION ALL SELECT DISTINCT 'industry:' || p_type, 'industry', p_type, NULL, NULL FROM part
  UNION ALL SELECT 'major:' || p_partkey, 'major', p_name, p_brand || ' ' || p_name, 'industry:' || p_type FROM part)"""


def entities(t):
    """Six inputs in one entity table; a repeated id keeps its last row."""
    none = F.lit(None).cast("string")

    def rows(df, kind, key, name, short, parent):
        return df.select(F.concat(F.lit(f"{kind}:"), key).alias("entity_id"), F.lit(kind).alias("entity_type"), name.alias("canonical_name"), short.alias("short_name"), parent.alias("parent_id"))

    c = F.col
    parts = [
        rows(t.region, "region", c("r_regionkey").cast("string"), c("r_name"), F.lower("r_name"), none),
        rows(t.nation, "region", F.concat(F.lit("N"), c("n_nationkey")), c("n_name"), F.lower("n_name"), F.concat(F.lit("region:"), c("n_regionkey"))),
        rows(t.supplier, "school", c("s_suppkey").cast("string"), c("s_name"), F.substring("s_name", 10, 100), F.concat(F.lit("region:N"), c("s_nationkey"))),
        rows(t.customer, "person", c("c_custkey").cast("string"), c("c_name"), F.substring("c_name", 10, 100), F.concat(F.lit("region:N"), c("c_nationkey"))),
        rows(t.part, "industry", c("p_type"), c("p_type"), none, none),
        rows(t.part, "major", c("p_partkey").cast("string"), c("p_name"), F.concat_ws(" ", "p_brand", "p_name"), F.concat(F.lit("industry:"), c("p_type"))),
    ]
    return dedupe(u.bag_union(parts), ["entity_id"], ["canonical_name", "short_name"], "replace")


@query("m10_entity_registry", f"WITH {ENTITIES} SELECT * FROM entities")
def m10(t):
    return entities(t)


@query(
    "m10_alias_registry",
    f"""WITH {ENTITIES}, x AS (SELECT entity_id, entity_type, unnest([canonical_name, short_name]) AS alias FROM entities) SELECT entity_type, lower(replace(alias, ' ', '')) AS alias_key, max(entity_id) AS entity_id, count(DISTINCT entity_id) AS claims FROM x WHERE coalesce(alias, '') <> '' GROUP BY 1, 2""",
)
def m10_alias(t):
    return m.aliases_of(entities(t), "entity_id", ["canonical_name", "short_name"])


METRIC_RULES = [("career", "A", "income", "score"), ("career", "R", "stability", "score"), ("event", "click", "clicks", "count"), ("event", "view", "views", "count"), ("event", "gone", "gone", "count")]


@query(
    "m11_metric_registry",
    f"""WITH r AS {values_sql(['domain', 'metric_key', 'metric_name', 'unit'], METRIC_RULES)}, n AS (SELECT 'event' AS domain, event_type AS metric_key, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'career', l_returnflag, count(*) FROM lineitem GROUP BY 2)
        SELECT domain, metric_key, metric_name, unit, lower(domain || ':' || metric_name) AS alias_key, coalesce(n, 0) AS observed_rows FROM r LEFT JOIN n USING (domain, metric_key)""",
)
def m11(t):
    rules = rule_frame(t.spark, ["domain", "metric_key", "metric_name", "unit"], METRIC_RULES)
    seen = t.events.groupBy(F.lit("event").alias("domain"), F.col("event_type").alias("metric_key")).agg(F.count(F.lit(1)).alias("n"))
    seen = seen.unionByName(t.lineitem.groupBy(F.lit("career").alias("domain"), F.col("l_returnflag").alias("metric_key")).agg(F.count(F.lit(1)).alias("n")))
    alias = F.lower(F.concat_ws(":", "domain", "metric_name"))
    return rules.join(seen, ["domain", "metric_key"], "left").select("domain", "metric_key", "metric_name", "unit", alias.alias("alias_key"), F.coalesce("n", F.lit(0)).alias("observed_rows"))


@query(
    "m12_identity_bridge",
    """WITH l AS (SELECT p_brand || '-' || p_size AS local_code, p_name, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY length(p_name) DESC, p_name) AS rn FROM part WHERE p_partkey % 2 = 0),
       f AS (SELECT p_name, count(*) AS n, min(p_partkey) AS code FROM part WHERE p_partkey % 2 = 1 GROUP BY 1)
       SELECT local_code, p_name, CASE WHEN local_code LIKE '%-1' THEN -1 WHEN n = 1 THEN code END AS national_code, CASE WHEN local_code LIKE '%-1' THEN 'reviewed' WHEN n IS NULL THEN 'no_name_match' WHEN n > 1 THEN 'ambiguous_name' ELSE 'unique_name' END AS match_reason FROM l LEFT JOIN f USING (p_name) WHERE rn = 1""",
)
def m12(t):
    local = m.canonical_names(t.part.filter("p_partkey % 2 = 0").select(F.concat_ws("-", "p_brand", "p_size").alias("local_code"), "p_name"), "local_code", "p_name")
    profiles = t.part.filter("p_partkey % 2 = 1").select("p_name", F.col("p_partkey").alias("national_code"))
    reviewed = local.filter(F.col("local_code").endswith("-1")).select("local_code", F.lit(-1).cast("bigint").alias("national_code"))
    return j.unique_match(local, reviewed, profiles, "local_code", ["p_name"], "national_code")


@query(
    "m13_merged_profile",
    """WITH b AS (SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation FROM customer WHERE c_mktsegment <> 'BUILDING'), s AS (SELECT o_custkey AS k, 'from orders' AS name, CAST(NULL AS INTEGER) AS nation FROM orders GROUP BY 1)
       SELECT k, coalesce(b.name, s.name) AS name, CASE WHEN b.name IS NOT NULL THEN b.nation ELSE s.nation END AS nation, CASE WHEN b.name IS NOT NULL AND s.name IS NOT NULL THEN 'kept' WHEN b.name IS NOT NULL THEN 'base' ELSE 'added' END AS merge_action, (b.name IS NOT NULL AND b.nation IS NOT NULL) AS is_complete FROM b FULL JOIN s USING (k)""",
)
def m13(t):
    known = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    more = t.orders.select(F.col("o_custkey").alias("k")).distinct().select("k", F.lit("from orders").alias("name"), F.lit(None).cast("int").alias("nation"))
    return u.merge_with_precedence(known, more, ["k"], allow_override=False).withColumn("is_complete", F.col("nation").isNotNull())


@query(
    "m14_bridge_promotion",
    """WITH a AS (SELECT p_name, p_type, p_size, p_partkey, row_number() OVER (PARTITION BY p_name, p_type ORDER BY p_partkey DESC) AS rn FROM part WHERE p_retailprice > 990 AND p_size > 45)
       SELECT p_name, p_type, p_size, p_partkey FROM part WHERE NOT (p_retailprice > 990 AND p_size > 45) AND p_name NOT IN (SELECT p_name FROM a) UNION ALL SELECT p_name, p_type, p_size, p_partkey FROM a WHERE rn = 1""",
)
def m14(t):
    columns = ["p_name", "p_type", "p_size", "p_partkey"]
    approved = t.part.filter("p_retailprice > 990 AND p_size > 45").select(*columns)
    return u.promote(t.part.filter("NOT (p_retailprice > 990 AND p_size > 45)").select(*columns), approved, "p_name", ["p_name", "p_type"], ["p_partkey"])


@query("m15_region_profile", f"WITH {DISTRICTS} SELECT code, name, level, parent_code, province, city, count(c_custkey) AS people FROM districts LEFT JOIN customer ON code = 'S' || c_nationkey || '-' || c_mktsegment GROUP BY ALL")
def m15(t):
    people = t.customer.groupBy(F.concat(F.lit("S"), "c_nationkey", F.lit("-"), "c_mktsegment").alias("code")).agg(F.count(F.lit(1)).alias("people"))
    rows = f.flatten_districts(district_tree(t)).join(people, "code", "left")
    return rows.select("code", "name", "level", "parent_code", "province", "city", F.coalesce("people", F.lit(0)).alias("people"))


@query(
    "m16_school_location",
    f"""WITH {GEOCODED} SELECT place_id, longitude, latitude, geocode_confidence, concat_ws('|', CASE WHEN geocode_confidence < 0.5 THEN 'low_confidence' END, CASE WHEN city <> geocode_city THEN 'other_city' END) AS problems FROM geocoded""",
)
def m16(t):
    checks = {
        "coordinates_missing": F.col("longitude").isNull() | F.col("latitude").isNull(),
        "low_confidence": F.col("geocode_confidence") < 0.5,
        "other_city": F.col("city") != F.col("geocode_city"),
    }
    return geocoded(t).select("place_id", "longitude", "latitude", "geocode_confidence", F.array_join(r.column_checks(checks), "|").alias("problems"))


POI = """cand AS (SELECT l_suppkey, 'Brand#' || (s_nationkey + 1) AS owner, p_brand || CASE WHEN p_size < 2 THEN '' WHEN p_size < 5 THEN 'X' ELSE ' ' || p_name END AS place, p_partkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS source_rank
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey),
  kept AS (SELECT l_suppkey, owner, p_partkey, arg_max(place, source_rank) AS place FROM cand GROUP BY 1, 2, 3),
  tails AS (SELECT *, substr(place, length(owner) + 1) AS tail FROM kept WHERE starts_with(place, owner)),
  verdicts AS (SELECT *, CASE WHEN tail = '' THEN 100 WHEN contains(tail, 'ring') THEN CASE WHEN contains(regexp_replace(tail, '^.*?(ring)', ''), 'bolt') THEN 0 ELSE 90 END WHEN contains(tail, 'bolt') OR contains(tail, 'widget') OR contains(tail, 'gear') THEN 0 WHEN length(tail) <= 2 THEN 70 ELSE 0 END AS score FROM tails),
  best AS (SELECT l_suppkey, p_partkey, score FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, length(tail), p_partkey) AS rn FROM verdicts WHERE score > 0) WHERE rn = 1),
  located AS (SELECT s_suppkey, s_nationkey, CASE WHEN b.p_partkey IS NOT NULL THEN 'poi' WHEN s_acctbal > 0 THEN 'geocode' ELSE 'manual_review' END AS source, b.p_partkey FROM supplier LEFT JOIN best b ON b.l_suppkey = s_suppkey)"""


def poi_locations(t):
    """Best place per supplier from base and retry records, a geocode where none fits, else the manual queue."""
    place = F.concat("p_brand", F.when(F.col("p_size") < 2, "").when(F.col("p_size") < 5, "X").otherwise(F.concat(F.lit(" "), "p_name")))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), place.alias("place"))
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_returnflag").join(parts, "l_partkey")
    records = lines.select("l_suppkey", "l_partkey", "place", F.col("l_returnflag").alias("flag"))
    merged = f.latest_wins(records.filter("flag <> 'R'"), records.filter("flag = 'R'"), ["l_suppkey", "l_partkey"], ["place"])
    owners = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("Brand#"), F.col("s_nationkey") + 1).alias("owner"))
    verdict = place_verdict(F.col("place"), F.col("owner"), ("ring",), ("bolt", "widget", "gear"))
    fitting = merged.join(owners, "l_suppkey").withColumn("v", verdict).filter("v.score > 0")
    order = F.struct(-F.col("v.score"), F.col("v.tail_length"), F.col("l_partkey"))
    best = fitting.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.min_by("l_partkey", order).alias("p_partkey"))
    joined = t.supplier.join(best, "s_suppkey", "left")
    source = F.when(F.col("p_partkey").isNotNull(), "poi").when(F.col("s_acctbal") > 0, "geocode").otherwise("manual_review")
    return joined.select("s_suppkey", "s_nationkey", source.alias("source"), "p_partkey")


@query(
    "m17_poi_location",
    f"""WITH {POI}, r AS (SELECT CAST(s_suppkey AS VARCHAR) AS campus_key, source, p_partkey, false AS is_sibling FROM located WHERE source <> 'manual_review')
        SELECT * FROM r UNION ALL SELECT campus_key || 'b', source, p_partkey, true FROM r WHERE source = 'poi'""",
)
def m17(t):
    rows = poi_locations(t).filter("source <> 'manual_review'")
    rows = rows.select(F.col("s_suppkey").cast("string").alias("campus_key"), "source", "p_partkey")
    listed = F.when(F.col("source") == "poi", F.concat_ws(",", "campus_key", F.concat("campus_key", F.lit("b")))).otherwise("")
    return u.expand_siblings(rows, "campus_key", listed)


@query(
    "m18_policy_tables",
    """SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_type END, 'general') AS policy_label, p_size AS policy_intensity, concat_ws('|', CASE WHEN p_size > 25 AND p_type NOT IN ('ECONOMY', 'PROMO') THEN 'label_not_allowed' END, CASE WHEN p_size NOT BETWEEN 1 AND 40 THEN 'intensity_out_of_bounds' END) AS problems FROM part""",
)
def m18(t):
    files = t.part.select(
        F.struct(F.lit("general").alias("policy_label"), F.lit("2026").alias("policy_period")).alias("defaults"),
        F.array(F.struct("p_partkey", F.when(F.col("p_size") > 25, F.col("p_type")).alias("policy_label"), F.col("p_size").alias("policy_intensity"))).alias("rows"),
    )
    rows = f.seed_rows(files, ["p_partkey", "policy_label", "policy_intensity"])
    checks = {
        "label_not_allowed": ~F.col("policy_label").isin("ECONOMY", "PROMO", "general"),
        "intensity_out_of_bounds": ~F.col("policy_intensity").between(1, 40),
    }
    return rows.withColumn("problems", F.array_join(r.column_checks(checks), "|"))


@query(
    "m18_wage_benchmark",
    """SELECT c_nationkey AS category, c_mktsegment AS ownership_type, count(*) AS sample_count, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) // count(*) AS BIGINT) AS avg_wage, sum(CAST(round(c_acctbal * 100) AS BIGINT)) // count(*) NOT BETWEEN 300000 AND 600000 AS is_out_of_bounds FROM customer GROUP BY 1, 2""",
)
def m18_wages(t):
    cents = F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint"))
    rows = t.customer.groupBy(F.col("c_nationkey").alias("category"), F.col("c_mktsegment").alias("ownership_type")).agg(F.count(F.lit(1)).alias("sample_count"), F.floor(cents / F.count(F.lit(1))).alias("avg_wage"))
    return rows.withColumn("is_out_of_bounds", ~F.col("avg_wage").between(300000, 600000))


@query("m19_career_signals", f"WITH {base.CPLAN} SELECT entity_code, metric_key, metric_value, metric_unit, metric_year FROM cplan WHERE status = 'complete' AND metric_key <> 'urgent_share'")
def m19(t):
    done = m.importable(base.collection_plan(t), ["complete"], allow_partial=False).filter("metric_key <> 'urgent_share'")
    return done.select("entity_code", "metric_key", "metric_value", "metric_unit", "metric_year")


@query(
    "m20_outcome_tables",
    f"""WITH {base.CPLAN}, d AS (SELECT o_custkey AS entity_code, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
        SELECT CASE WHEN metric_key = 'urgent_share' THEN 'ratio_outcome' ELSE 'amount_outcome' END AS domain_table, entity_code, metric_key, {fx('metric_value')} AS metric_value, coalesce(last_date, '1998-01-01') AS source_date, status = 'complete' AS is_importable FROM cplan LEFT JOIN d USING (entity_code) WHERE status IN ('complete', 'partial')""",
)
def m20(t):
    dates = t.orders.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("entity_code")).agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_date"))
    rows = m.importable(base.collection_plan(t), ["complete"], allow_partial=True).join(dates, "entity_code", "left")
    table = F.when(F.col("metric_key") == "urgent_share", "ratio_outcome").otherwise("amount_outcome")
    return rows.select(table.alias("domain_table"), "entity_code", "metric_key", fixed6(F.col("metric_value")).alias("metric_value"), F.coalesce("last_date", F.lit("1998-01-01")).alias("source_date"), "is_importable")


@query(
    "m21_city_context_tables",
    f"""WITH {base.CPLAN} SELECT nation AS adcode, n_name AS city, metric_key, CASE metric_key WHEN 'order_value' THEN 'economic' WHEN 'order_count' THEN 'public' ELSE 'ranking' END AS domain, count(*) AS entity_count, {fx('max(metric_value)')} AS metric_value FROM cplan JOIN nation ON n_nationkey = nation WHERE status = 'complete' GROUP BY 1, 2, 3""",
)
def m21(t):
    done = m.importable(base.collection_plan(t), ["complete"], allow_partial=False)
    rows = done.groupBy(F.col("nation").alias("adcode"), "metric_key").agg(F.count(F.lit(1)).alias("entity_count"), fixed6(F.max("metric_value")).alias("metric_value"))
    domain = first_match([(F.col("metric_key") == "order_value", "economic"), (F.col("metric_key") == "order_count", "public")], "ranking")
    names = t.nation.select(F.col("n_nationkey").alias("adcode"), F.col("n_name").alias("city"))
    return rows.join(names, "adcode").withColumn("domain", domain)


@query(
    "m22_target_cities",
    """WITH s AS (SELECT n_name AS city, n_regionkey AS region, count(*) AS plan_rows FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2), p AS (SELECT 'NATION_' || s_nationkey AS city, max(s_suppkey) AS code FROM supplier GROUP BY 1),
       g AS (SELECT n_regionkey AS region, max(s_suppkey) AS code FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)
       SELECT row_number() OVER (ORDER BY plan_rows DESC, city) AS priority_rank, city, plan_rows, CASE WHEN p.code IS NOT NULL THEN p.code ELSE g.code END AS profile_code, CASE WHEN p.code IS NOT NULL THEN 'code' WHEN g.code IS NOT NULL THEN 'city' ELSE 'none' END AS matched_by FROM s LEFT JOIN p USING (city) LEFT JOIN g USING (region)""",
)
def m22(t):
    nations = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("city"), F.col("n_regionkey").alias("region"))
    people = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    source = people.groupBy(F.col("c_nationkey").alias("nation")).agg(F.sum("n").alias("plan_rows")).join(nations, "nation").drop("nation")
    profiles = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("profile_code")).join(nations, "nation")
    by_city = profiles.groupBy("city").agg(F.max("profile_code").alias("profile_code"))
    by_region = profiles.groupBy("region").agg(F.max("profile_code").alias("profile_code"))
    matched = j.with_fallback(source, by_city, by_region, "city", "region", "profile_code")
    ranked = global_row_number(matched, [F.desc("plan_rows"), F.asc("city")], "priority_rank")
    return ranked.select("priority_rank", "city", "plan_rows", "profile_code", "matched_by")


@query(
    "m23_geocode_plan",
    """WITH l AS (SELECT p_partkey AS local_id, p_brand, p_size FROM part WHERE p_partkey % 2 = 0), n AS (SELECT p_brand, p_size, count(*) AS n, min('N' || p_partkey) AS code FROM part WHERE p_partkey % 2 = 1 GROUP BY 1, 2),
       m AS (SELECT local_id, p_brand, p_size, CASE WHEN n = 1 THEN code END AS code, CASE WHEN n IS NULL THEN 'no_name_match' WHEN n > 1 THEN 'ambiguous_name' ELSE 'unique_name' END AS reason FROM l LEFT JOIN n USING (p_brand, p_size)),
       d AS (SELECT code FROM m WHERE code IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
       SELECT local_id, code AS national_code, CASE WHEN code IS NULL THEN 'blocked' ELSE 'ready' END AS status, CASE WHEN code IS NULL THEN reason ELSE '' END AS blocking_reason, p_brand || ' ' || p_size AS geocode_query, 'main' || CASE WHEN d.code IS NULL THEN '' ELSE '_' || substr(md5(local_id || '|' || p_brand), 1, 8) END AS campus_key FROM m LEFT JOIN d USING (code)""",
)
def m23(t):
    local = t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("local_id"), "p_brand", "p_size")
    profiles = t.part.filter("p_partkey % 2 = 1").select("p_brand", "p_size", F.concat(F.lit("N"), "p_partkey").alias("national_code"))
    nothing = local.filter(F.lit(False)).select("local_id", F.lit("").alias("national_code"))
    matched = j.unique_match(local, nothing, profiles, "local_id", ["p_brand", "p_size"], "national_code").withColumn("campus_key", F.lit("main"))
    keyed = suffix_duplicate_keys(matched, ["national_code", "campus_key"], "campus_key", ["local_id", "p_brand"])
    ready = F.col("national_code").isNotNull()
    return keyed.select(
        "local_id",
        "national_code",
        F.when(ready, "ready").otherwise("blocked").alias("status"),
        F.when(ready, "").otherwise(F.col("match_reason")).alias("blocking_reason"),
        F.concat_ws(" ", "p_brand", "p_size").alias("geocode_query"),
        "campus_key",
    )


@query(
    "q13_geocode_readiness",
    """WITH l AS (SELECT p_partkey AS local_id, p_brand, p_size FROM part WHERE p_partkey % 2 = 0), n AS (SELECT p_brand, p_size, count(*) AS n FROM part WHERE p_partkey % 2 = 1 GROUP BY 1, 2)
       SELECT p_brand, count(*) AS total_rows, count(*) FILTER (WHERE n = 1) AS done_rows, count(*) - count(*) FILTER (WHERE n = 1) AS blocked_rows, CAST(0 AS BIGINT) AS failed_checks, true AS is_ready FROM l LEFT JOIN n USING (p_brand, p_size) GROUP BY 1""",
)
def q13_geocode(t):
    plan = m23(t).withColumn("p_brand", F.regexp_extract("geocode_query", "^([^ ]+) ", 1))
    ready, blocked = F.col("status") == "ready", F.col("status") == "blocked"
    checks = {
        "query_missing": F.col("geocode_query") == "",
        "reason_missing": blocked & (F.col("blocking_reason") == ""),
        "code_missing": ready & F.col("national_code").isNull(),
    }
    return r.plan_readiness(plan, ["p_brand"], checks, ready, blocked)


@query("m24_poi_retry_list", f"WITH {POI} SELECT s_suppkey, s_nationkey FROM located WHERE source <> 'poi'")
def m24(t):
    located = poi_locations(t).filter("source = 'poi'")
    return t.supplier.join(located, "s_suppkey", "left_anti").select("s_suppkey", "s_nationkey")


@query(
    "m25_source_coverage_by_year",
    """WITH p AS (SELECT year(l_shipdate) AS y, count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity > 49) AS projection, count(*) FILTER (WHERE l_returnflag = 'A' AND year(l_shipdate) > 1996) AS distribution FROM lineitem GROUP BY 1), y AS (SELECT unnest(range(1994, 2003)) AS y)
       SELECT CAST(y AS INTEGER) AS score_year, coalesce(projection, 0) AS projection_rows, coalesce(distribution, 0) AS distribution_rows, CASE WHEN projection > 0 AND distribution > 0 THEN 'derivable' WHEN projection > 0 THEN 'distribution_missing' WHEN distribution > 0 THEN 'projection_missing' ELSE 'no_source' END AS status FROM y LEFT JOIN p USING (y)""",
)
def m25(t):
    year = F.year("l_shipdate")
    found = t.lineitem.groupBy(year.alias("score_year")).agg(
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 49)).alias("p"), F.count_if((F.col("l_returnflag") == "A") & (year > 1996)).alias("d")
    )
    wanted = rule_frame(t.spark, ["score_year"], [(y,) for y in range(1994, 2003)])
    p, d = F.coalesce("p", F.lit(0)), F.coalesce("d", F.lit(0))
    return wanted.join(found, "score_year", "left").select("score_year", p.alias("projection_rows"), d.alias("distribution_rows"), m.year_status(p, d).alias("status"))


@query(
    "m26_application_plan",
    """SELECT o_custkey AS school, CASE WHEN bool_or(o_orderpriority = '1-URGENT') THEN 'first' ELSE 'second' END AS batch, count(*) AS plan_count, coalesce(max(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END), 'none') AS subject_requirement FROM orders GROUP BY 1""",
)
def m26(t):
    wide = t.orders.groupBy(F.col("o_custkey").alias("school")).agg(
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", "first")).alias("batch"), F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("req")
    )
    return project_with_defaults(wide, {"school": (F.col("school"), None), "batch": (F.col("batch"), "second"), "plan_count": (F.col("n"), 1), "subject_requirement": (F.col("req"), "none")})


@query(
    "m26_application_history",
    """SELECT o_custkey, year(o_orderdate) AS score_year, count(*) AS order_count, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS value_cents FROM orders GROUP BY 1, 2""",
)
def m26_history(t):
    wide = f.route_sheets(wide_orders(t).withColumn("sheet", F.lit("history by year")), "sheet", [("contains", "history", "first", "all")])
    long = unpivot_years(wide.filter(F.col("batch").isNotNull()), ["o_custkey"], year_columns(wide.columns, YEAR_PATTERNS))
    return dedupe(long, ["o_custkey", "score_year"], ["order_count"], "keep_first")
