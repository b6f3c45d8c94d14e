"""Q: quality gates, audits and readiness."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.contracts import TableContract
from plumbline.functions.values import fixed6, url_host
from plumbline.operators import coverage as cv
from plumbline.operators import quality as q
from plumbline.operators import review as r
from plumbline.operators.aggregate import counters, gap_summary
from plumbline.operators.joins import two_sided
from plumbline.operators.normalise import health_status
from plumbline.operators.reconcile import compare_tables
from plumbline.operators.sequence import cumulative_check
from plumbline.plans import base
from plumbline.plans.aggregates import COMPONENTS_SQL, overall
from plumbline.plans.registry import fx, query
from plumbline.plans.review import REVIEWED, reviewed
from plumbline.plans.windows import CELL, OBS, observations
from plumbline.rules import first_match, rule_frame

LINES = TableContract(
    name="pl_fact_lines",
    columns=("l_orderkey", "l_linenumber", "l_quantity"),
    key=("l_orderkey", "l_linenumber"),
    required=("l_quantity", "l_returnflag"),
    year_columns=("ship_year", "due_year"),
)


@query(
    "q01_quality_report",
    """SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_key_count,
       'l_quantity:' || count(*) FILTER (WHERE l_quantity IS NULL) || '|l_returnflag:' || count(*) FILTER (WHERE coalesce(l_returnflag, '') = '') AS null_counts,
       min(year(l_shipdate)) AS first_year, max(year(l_shipdate + INTERVAL 90 DAY)) AS last_year, 'duplicate_keys' AS error_codes FROM lineitem""",
)
def q01(t):
    rows = t.lineitem.withColumn("ship_year", F.year("l_shipdate")).withColumn("due_year", F.year(F.date_add(F.to_date("l_shipdate"), 90)))
    return q.quality_report(rows, LINES)


EVENT_REGISTRY = [("click", "usd", 0.0, 40.0, False), ("view", "usd", 0.0, 60.0, False), ("purchase", "eur", 1.0, 100.0, False), ("signup", "usd", 0.0, 100.0, True)]


@query(
    "q02_metric_registry_check",
    """SELECT event_id, event_type AS metric_key, v AS violation FROM (SELECT event_id, event_type, unnest(list_filter([
         CASE WHEN event_type = 'error' THEN 'unregistered_metric' END, CASE WHEN event_type = 'purchase' THEN 'unit_mismatch' END,
         CASE WHEN event_type = 'purchase' AND value < 1.0 THEN 'below_minimum' END,
         CASE WHEN (event_type = 'click' AND value > 40) OR (event_type = 'view' AND value > 60) OR (event_type IN ('purchase', 'signup') AND value > 100) THEN 'above_maximum' END,
         CASE WHEN event_type = 'signup' THEN 'scope_missing' END, CASE WHEN NOT contains(props, '"k": 1') THEN 'evidence_missing' END], lambda x: x IS NOT NULL)) AS v FROM events)""",
)
def q02(t):
    rows = t.events.select("event_id", F.col("event_type").alias("metric_key"), F.lit("usd").alias("metric_unit"), F.col("value").alias("metric_value"), F.lit("").alias("metric_scope"), "props")
    return q.metric_registry_check(rows, EVENT_REGISTRY, ["event_id"], evidence=F.col("props").contains('"k": 1'))


PLAN_REGISTRY = [("order_value", "cents", 0.0, 300000000.0, False), ("order_count", "count", 0.0, 15.0, True), ("urgent_share", "percent", 0.0, 0.4, False)]


@query(
    "q03_outcome_registry_check",
    f"""WITH {base.CPLAN} SELECT entity_code, metric_key, v AS violation FROM (SELECT entity_code, metric_key, unnest(list_filter([CASE WHEN metric_key = 'urgent_share' THEN 'unit_mismatch' END,
          CASE WHEN (metric_key = 'order_value' AND metric_value > 300000000) OR (metric_key = 'order_count' AND metric_value > 15) OR (metric_key = 'urgent_share' AND metric_value > 0.4) THEN 'above_maximum' END,
          CASE WHEN metric_key = 'order_count' AND segment <> 'BUILDING' THEN 'scope_missing' END], lambda x: x IS NOT NULL)) AS v FROM cplan WHERE status IN ('complete', 'partial'))""",
)
def q03(t):
    rows = base.collection_plan(t).filter(F.col("status").isin("complete", "partial"))
    rows = rows.withColumn("metric_scope", F.when(F.col("segment") == "BUILDING", "overall").otherwise(""))
    return q.metric_registry_check(rows, PLAN_REGISTRY, ["entity_code"])


@query(
    "q04_distribution_check",
    f"""WITH {OBS}, x AS (SELECT *, cum + CASE WHEN mark = 4 THEN 1 ELSE 0 END AS c FROM placed), y AS (SELECT *, c <> coalesce(lag(c) OVER (PARTITION BY subject, score_year, image, block ORDER BY true_score DESC), 0) + n AS bad FROM x),
        g AS (SELECT subject, score_year, image, block, count(*) FILTER (WHERE bad) AS bad_rows, count(*) AS score_rows FROM y GROUP BY 1, 2, 3, 4)
        SELECT subject, score_year, count(*) AS block_count, count(*) FILTER (WHERE bad_rows > 0) AS cumulative_errors, count(*) FILTER (WHERE score_rows < 50) AS row_warnings, CAST(sum(bad_rows) AS BIGINT) AS bad_rows FROM g GROUP BY 1, 2""",
)
def q04(t):
    shifted = F.col("cum") + F.when(F.col("mark") == 4, 1).otherwise(0)
    rows = observations(t).select(*CELL, F.col("true_score").alias("score"), F.col("n").alias("score_count"), shifted.alias("cumulative_rank"))
    checked = cumulative_check(rows, CELL, 50)
    return checked.groupBy("subject", "score_year").agg(
        F.count(F.lit(1)).alias("block_count"),
        F.count_if(F.col("mismatches") > 0).alias("cumulative_errors"),
        F.count_if("too_few_rows").alias("row_warnings"),
        F.sum("mismatches").alias("bad_rows"),
    )


@query(
    "q05_mart_input_checks",
    """WITH c AS (SELECT count(*) AS checked_rows, count(*) FILTER (WHERE l_quantity < 5) AS quantity_below_minimum, count(*) FILTER (WHERE l_discount > 0.085) AS discount_out_of_range,
         count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'R')) AS unregistered_key, count(*) FILTER (WHERE year(l_shipdate) NOT BETWEEN 1996 AND 2000) AS year_out_of_range FROM lineitem)
       SELECT checked_rows, violation, row_count FROM c UNPIVOT (row_count FOR violation IN (quantity_below_minimum, discount_out_of_range, unregistered_key, year_out_of_range)) WHERE row_count > 0
       UNION ALL SELECT count(*), 'bad_json', count(*) FILTER (WHERE NOT json_valid(CASE WHEN value > 30 THEN '}' ELSE '' END || props)) FROM events""",
)
def q05(t):
    lines = {
        "quantity_below_minimum": F.col("l_quantity") < 5,
        "discount_out_of_range": ~F.col("l_discount").between(0.0, 0.085),
        "unregistered_key": ~F.col("l_returnflag").isin("A", "R"),
        "year_out_of_range": ~F.year("l_shipdate").between(1996, 2000),
        "quantity_not_numeric": F.col("l_quantity").cast("string").try_cast("double").isNull(),
    }
    # a stray brace at the front makes some of the texts invalid
    text = F.concat(F.when(F.col("value") > 30, "}").otherwise(""), "props")
    events = q.count_violations(t.events.withColumn("text", text), {"bad_json": ~q.json_is_valid(F.col("text"))})
    return q.count_violations(t.lineitem, lines).unionByName(events)


@query(
    "q06_domain_value_checks",
    """SELECT p_partkey, v AS violation FROM (SELECT p_partkey, unnest(list_filter([CASE WHEN p_type NOT IN ('ECONOMY', 'PROMO', 'STANDARD', 'SMALL') THEN 'label_not_allowed' END,
       CASE WHEN p_size NOT BETWEEN 3 AND 45 THEN 'size_out_of_bounds' END, CASE WHEN p_retailprice >= 1000 THEN 'not_a_list' END], lambda x: x IS NOT NULL)) AS v FROM part)""",
)
def q06(t):
    themes = F.when(F.col("p_retailprice") >= 1000, F.concat(F.lit('{"a": "'), "p_type", F.lit('"}'))).otherwise(F.concat(F.lit('["'), "p_type", F.lit('"]')))
    checks = {
        "label_not_allowed": ~F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD", "SMALL"),
        "size_out_of_bounds": ~F.col("p_size").between(3, 45),
        "not_a_list": F.json_array_length(themes).isNull(),
    }
    return r.violations(t.part, ["p_partkey"], checks)


@query(
    "q07_source_metadata",
    """WITH u AS (SELECT count(*) AS checked_rows, count(*) FILTER (WHERE NOT regexp_matches(url, '^https?://[^/]+')) AS bad_source_url FROM pages),
       d AS (SELECT count(*) AS checked_rows, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS bad_source_date, count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND CAST(o_orderdate AS DATE) > CAST(l_shipdate AS DATE)) AS available_before_source
             FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
       SELECT checked_rows, 'bad_source_url' AS violation, bad_source_url AS row_count FROM u WHERE bad_source_url > 0 UNION ALL SELECT checked_rows, 'bad_source_date', bad_source_date FROM d UNION ALL SELECT checked_rows, 'available_before_source', available_before_source FROM d""",
)
def q07(t):
    good_date, good_url = F.lit("2020-01-01"), F.lit("http://example.org/")
    pages = q.count_violations(t.pages, q.metadata_checks(F.col("url"), good_date, good_date))
    source = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    dates = q.count_violations(lines, q.metadata_checks(good_url, source, F.date_format("l_shipdate", "yyyy-MM-dd")))
    return pages.unionByName(dates)


@query(
    "q08_score_range_check",
    f"""WITH {COMPONENTS_SQL} SELECT count(*) AS mart_rows, count(*) FILTER (WHERE overall_score NOT BETWEEN 0 AND 100) AS out_of_range, count(*) FILTER (WHERE overall_score IS NULL) AS null_scores FROM overall""",
)
def q08(t):
    return q.range_report(overall(t), F.col("overall_score"))


@query(
    "q08_raw_range_check",
    """SELECT count(*) AS mart_rows, count(*) FILTER (WHERE c_acctbal / 50.0 NOT BETWEEN 0 AND 100) AS out_of_range, count(*) FILTER (WHERE c_acctbal IS NULL) AS null_scores FROM customer""",
)
def q08_raw(t):
    return q.range_report(t.customer, F.col("c_acctbal") / 50.0)


@query(
    "q09_geocode_acceptance",
    """SELECT c_custkey, v AS violation FROM (SELECT c_custkey, unnest(list_filter([CASE WHEN c_acctbal < 0 THEN 'coordinates_missing' END,
       CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'low_confidence' END, CASE WHEN s_nationkey IS NOT NULL AND s_nationkey <> c_nationkey THEN 'other_city' END], lambda x: x IS NOT NULL)) AS v
       FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey)""",
)
def q09(t):
    confidence = first_match([(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), 0.4)], 0.9)
    rows = t.customer.join(t.supplier, F.col("s_suppkey") == F.col("c_custkey"), "left").withColumn("confidence", confidence)
    checks = {
        "coordinates_missing": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).isNull(),
        "low_confidence": F.col("confidence") < 0.6,
        "other_city": F.col("s_nationkey") != F.col("c_nationkey"),
    }
    return r.violations(rows, ["c_custkey"], checks)


@query(
    "q10_package_audit",
    f"""WITH {base.PLAN} SELECT 'matched' AS measure, count(*) AS row_count FROM sides WHERE pl IS NOT NULL AND cl IS NOT NULL UNION ALL SELECT 'package_only', count(*) FROM po
        UNION ALL SELECT 'core_only', count(*) FROM sides WHERE pl IS NULL UNION ALL SELECT 'differs_min_quantity', count(*) FROM sides WHERE pq <> cq UNION ALL SELECT 'differs_fee', count(*) FROM sides WHERE pf <> cf
        UNION ALL SELECT 'drifted', count(*) FROM sides WHERE pq <> cq OR pf <> cf""",
)
def q10(t):
    return q.difference_counts(compare_tables(base.package(t), base.core(t), base.spec()), base.COMPARE)


@query(
    "q10_scope_decision",
    f"""WITH {base.PLAN}, s AS (SELECT ship_year, count(*) FILTER (WHERE cl IS NULL) AS package_only, count(*) FILTER (WHERE pl IS NULL) AS core_only, count(*) FILTER (WHERE pq <> cq OR pf <> cf) AS drifted, count(*) AS key_count FROM sides GROUP BY 1)
        SELECT *, CASE WHEN package_only + core_only + drifted = 0 THEN 'replace' WHEN package_only + core_only > key_count * 0.25 THEN 'review_keys_first' ELSE 'review_values' END AS advice FROM s""",
)
def q10_scope(t):
    rows = compare_tables(base.package(t), base.core(t), base.spec())
    counted = rows.groupBy("ship_year").agg(
        F.count_if(F.col("side") == "package_only").alias("package_only"),
        F.count_if(F.col("side") == "core_only").alias("core_only"),
        F.count_if(F.size("differences") > 0).alias("drifted"),
        F.count(F.lit(1)).alias("key_count"),
    )
    one_sided = F.col("package_only") + F.col("core_only")
    advice = first_match([(one_sided + F.col("drifted") == 0, "replace"), (one_sided > F.col("key_count") * 0.25, "review_keys_first")], "review_values")
    return counted.withColumn("advice", advice)


TABLE_DIFF = """d AS (SELECT l_returnflag, year(l_shipdate) AS ship_year, l_suppkey AS supplier, CAST(l_quantity AS INTEGER) AS score, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2, 3, 4)"""


@query(
    "q11_candidate_diff",
    f"""WITH {TABLE_DIFF}, s AS (SELECT ship_year, supplier, score, a.n AS an, r.n AS rn FROM (SELECT * FROM d WHERE l_returnflag = 'A') a FULL JOIN (SELECT * FROM d WHERE l_returnflag = 'R') r USING (ship_year, supplier, score)),
        g AS (SELECT ship_year, supplier, max(score) - min(score) + 1 - count(*) AS missing FROM d WHERE l_returnflag = 'A' GROUP BY 1, 2)
        SELECT ship_year, count(*) FILTER (WHERE an IS NOT NULL AND rn IS NOT NULL) AS matched, count(*) FILTER (WHERE an <> rn) AS differing, count(*) FILTER (WHERE rn IS NULL) AS candidate_only, count(*) FILTER (WHERE an IS NULL) AS baseline_only,
          (SELECT CAST(sum(missing) AS BIGINT) FROM g WHERE g.ship_year = s.ship_year) AS candidate_gaps FROM s GROUP BY 1""",
)
def q11(t):
    rows = t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("ship_year"), F.col("l_suppkey").alias("supplier"), F.col("l_quantity").cast("int").alias("score")).agg(F.count(F.lit(1)).alias("n"))
    candidate, baseline = (rows.filter(F.col("l_returnflag") == f).drop("l_returnflag") for f in ("A", "R"))
    sides = two_sided(candidate, baseline, ["ship_year", "supplier", "score"], ("candidate", "baseline"))
    diff = sides.groupBy("ship_year").agg(
        F.count_if(F.col("side") == "matched").alias("matched"),
        F.count_if((F.col("side") == "matched") & (F.col("candidate.n") != F.col("baseline.n"))).alias("differing"),
        F.count_if(F.col("side") == "candidate_only").alias("candidate_only"),
        F.count_if(F.col("side") == "baseline_only").alias("baseline_only"),
    )
    gaps = gap_summary(candidate, ["ship_year", "supplier"], "score", 20).groupBy("ship_year").agg(F.sum("missing_count").alias("candidate_gaps"))
    return diff.join(gaps, "ship_year")


@query(
    "q12_reconciliation_readiness",
    f"""WITH {REVIEWED} SELECT issue_type, count(*) AS total_rows, count(*) FILTER (WHERE status = 'decided') AS done_rows, 0::BIGINT AS blocked_rows,
        count(*) FILTER (WHERE status = 'decided' AND review_decision = 'skip') AS failed_checks, count(*) FILTER (WHERE status <> 'decided') = 0 AND count(*) FILTER (WHERE status = 'decided' AND review_decision = 'skip') = 0 AS is_ready FROM reviewed GROUP BY 1""",
)
def q12(t):
    decided = F.col("status") == "decided"
    checks = {
        "bad_status": ~F.col("status").isin("todo", "decided"),
        "decision_missing": decided & (F.col("review_decision") == ""),
        "decision_not_final": decided & (F.col("review_decision") == "skip"),
        "reviewer_missing": decided & (F.col("reviewer") == ""),
        "core_side_missing": decided & (F.col("review_decision") == "keep_core") & F.col("core_slot").isNull(),
    }
    return r.plan_readiness(reviewed(t), ["issue_type"], checks, decided, F.col("status") == "blocked")


@query(
    "q12_plan_counters",
    f"""WITH {REVIEWED} SELECT issue_type, ship_year, status, count(*) AS row_count FROM reviewed GROUP BY GROUPING SETS ((issue_type), (status), (issue_type, status), (issue_type, ship_year, status))""",
)
def q12_counters(t):
    sets = [["issue_type"], ["status"], ["issue_type", "status"], ["issue_type", "ship_year", "status"]]
    return counters(reviewed(t), sets, ["issue_type", "ship_year", "status"])


@query(
    "q13_collection_readiness",
    f"""WITH {base.CPLAN} SELECT segment, metric_key, count(*) AS total_rows, count(*) FILTER (WHERE status = 'complete') AS done_rows, count(*) FILTER (WHERE status IN ('blocked', 'not_applicable')) AS blocked_rows,
        CAST(0 AS BIGINT) AS failed_checks, count(*) FILTER (WHERE status IN ('complete', 'blocked', 'not_applicable')) = count(*) AS is_ready FROM cplan GROUP BY 1, 2""",
)
def q13(t):
    done, blocked = F.col("status") == "complete", F.col("status").isin("blocked", "not_applicable")
    checks = {
        "value_missing": done & F.col("metric_value").isNull(),
        "reason_missing": blocked & (F.col("blocking_reason") == ""),
        "bad_status": ~F.col("status").isin("todo", "partial", "complete", "blocked", "not_applicable"),
    }
    return r.plan_readiness(base.collection_plan(t), ["segment", "metric_key"], checks, done, blocked)


MARKERS = {"en": ["license", "haha"], "fr": ["@", "eau"], "de": ["http"]}


@query(
    "q14_semantic_hints",
    """WITH m(lang, evidence) AS (VALUES ('en', 'license'), ('en', 'haha'), ('fr', '@'), ('fr', 'eau'), ('de', 'http'))
       SELECT doc_id, lang, lang || '_semantic_proxy' AS hint_code, evidence FROM documents JOIN m USING (lang) WHERE contains(text, evidence)""",
)
def q14(t):
    return q.semantic_hints(t.documents, "text", "lang", MARKERS, ["doc_id", "lang"])


@query(
    "q14_third_party_hosts",
    """SELECT host, count(*) AS page_count FROM (SELECT lower(regexp_extract(url, '^[^:/]+://([^/?#]*)', 1)) AS host FROM pages) WHERE regexp_matches(host, '^(www|m)[.]') GROUP BY 1""",
)
def q14_hosts(t):
    host = url_host(F.col("url"))
    return t.pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("page_count")).filter(F.col("host").rlike("^(www|m)[.]"))


@query(
    "q15_hint_collapse",
    """WITH m(lang, evidence) AS (VALUES ('en', 'license'), ('en', 'haha'), ('fr', '@'), ('fr', 'eau'), ('de', 'http'))
       SELECT source, lang || '_semantic_proxy' AS hint_code, evidence, min(doc_id) AS first_ordinal, count(*) AS hint_rows FROM documents JOIN m USING (lang) WHERE contains(text, evidence) GROUP BY 1, 2, 3""",
)
def q15(t):
    return q.collapse_hints(q.semantic_hints(t.documents, "text", "lang", MARKERS, ["source", "doc_id"]), ["source"], "doc_id")


AREAS = {"orders": 0.9, "urgent": 0.8, "recent": 0.5, "supplier": 0.5, "profile": 0.9}
COVERAGE = f"""u AS (SELECT DISTINCT c_custkey AS k FROM customer), pairs AS (SELECT DISTINCT 'orders' AS area, o_custkey AS k FROM orders UNION ALL SELECT DISTINCT 'urgent', o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT DISTINCT 'recent', o_custkey FROM orders WHERE year(o_orderdate) = 2001 UNION ALL SELECT DISTINCT 'supplier', s_suppkey FROM supplier),
  areas(area, threshold) AS (VALUES ('orders', 0.9), ('urgent', 0.8), ('recent', 0.5), ('supplier', 0.5), ('profile', 0.9)),
  cov AS (SELECT area, threshold, count(u.k) AS covered_count, (SELECT count(*) FROM u) AS total FROM areas LEFT JOIN pairs USING (area) LEFT JOIN u ON u.k = pairs.k GROUP BY 1, 2),
  coverage AS (SELECT area, covered_count, total - covered_count AS missing_count, covered_count / total::DOUBLE AS coverage_rate, CASE WHEN area = 'profile' THEN 'missing_table' WHEN covered_count / total::DOUBLE < threshold THEN 'below_threshold' ELSE 'passed' END AS area_status FROM cov),
  blocked AS (SELECT *, CASE WHEN area_status = 'passed' THEN '' ELSE upper(area) || '_COVERAGE_' || upper(area_status) END AS blocker_code FROM coverage)"""


def customer_coverage(t):
    key = F.col("o_custkey").alias("c_custkey")
    areas = {
        "orders": t.orders.select(key),
        "urgent": t.orders.filter("o_orderpriority = '1-URGENT'").select(key),
        "recent": t.orders.filter(F.year("o_orderdate") == 2001).select(key),
        "supplier": t.supplier.select(F.col("s_suppkey").alias("c_custkey")),
        "profile": None,
    }
    return cv.area_coverage(t.customer, "c_custkey", areas, AREAS)


@query("q16_operational_coverage", f"WITH {COVERAGE} SELECT area, covered_count, missing_count, {fx('coverage_rate')} AS coverage_rate, area_status, blocker_code FROM blocked")
def q16(t):
    return customer_coverage(t).withColumn("coverage_rate", fixed6(F.col("coverage_rate")))


@query(
    "q17_universe_grid",
    f"""WITH {base.CPLAN}, p AS (SELECT entity_code, count(DISTINCT metric_key) AS metric_count FROM cplan WHERE status = 'complete' GROUP BY 1), u AS (SELECT DISTINCT o_custkey AS entity_code FROM orders WHERE o_orderstatus = 'F')
        SELECT * FROM (SELECT entity_code, coalesce(metric_count, 0) AS metric_count, CASE WHEN u.entity_code IS NULL THEN 'extra' WHEN metric_count IS NULL THEN 'missing' WHEN metric_count <> 3 THEN 'incomplete' END AS gap FROM u FULL JOIN p USING (entity_code)) WHERE gap IS NOT NULL""",
)
def q17(t):
    universe = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("entity_code"))
    return cv.grid_gaps(universe, base.collection_plan(t).filter("status = 'complete'"), "entity_code", "metric_key", 3)


DOMAINS = [
    ("d1", "orders", "easy_but_underused", "required", "deep"),
    ("d2", "urgent", "easy_but_underused", "optional", "shallow"),
    ("d3", "recent", "optional_enhancement", "required", "deep"),
    ("d4", "supplier", "not_for_formal_recommendation", "optional", "deep"),
    ("d5", "unknown", "required_unavailable", "required", "deep"),
    ("d6", "unknown", "planned", "required", "deep"),
]


@query(
    "q18_portfolio",
    f"""WITH {COVERAGE}, d(domain, area, declared, importance, use_depth) AS (VALUES {', '.join(str(x) for x in DOMAINS)})
        SELECT domain, area, {fx('coverage_rate')} AS coverage_rate, bucket, CASE WHEN importance = 'required' AND bucket = 'required_unavailable' THEN upper(domain) || '_NOT_OPERATIONAL' ELSE '' END AS blocker_code
        FROM (SELECT *, CASE WHEN importance = 'required' AND area_status = 'passed' THEN 'required_available' WHEN importance = 'required' AND area_status IS NOT NULL THEN 'required_unavailable'
          WHEN declared IN ('required_available', 'required_unavailable', 'easy_but_underused', 'optional_enhancement', 'not_for_formal_recommendation') THEN declared ELSE 'optional_enhancement' END AS bucket FROM d LEFT JOIN blocked USING (area))""",
)
def q18(t):
    domains = rule_frame(t.spark, ["domain", "area", "declared", "importance", "use_depth"], DOMAINS)
    return q.classify_portfolio(domains, customer_coverage(t), "area").select("domain", "area", fixed6(F.col("coverage_rate")).alias("coverage_rate"), "bucket", "blocker_code")


@query(
    "q19_gap_rollup",
    f"""WITH {COVERAGE}, {base.CPLAN}, rows AS (SELECT blocker_code AS code, area AS domain FROM blocked WHERE blocker_code <> '' UNION ALL SELECT upper(blocking_reason), segment FROM cplan WHERE status = 'blocked' OR status = 'not_applicable')
        SELECT code, count(*) AS blocker_rows, count(DISTINCT domain) AS domain_count FROM rows GROUP BY 1""",
)
def q19(t):
    areas = customer_coverage(t).filter("blocker_code <> ''").select(F.col("blocker_code").alias("code"), F.col("area").alias("domain"))
    blocked = base.collection_plan(t).filter(F.col("status").isin("blocked", "not_applicable"))
    return cv.gap_rollup([areas, blocked.select(F.upper("blocking_reason").alias("code"), F.col("segment").alias("domain"))])


RELEASE = """pk AS (SELECT l_returnflag || '-' || year(l_shipdate) AS package_id, count(*) AS row_count, count(*) FILTER (WHERE l_discount > 0.095 AND l_tax > 0.075 AND l_quantity > 45) AS error_count, max(year(l_shipdate)) AS y, max(l_returnflag) AS f FROM lineitem GROUP BY 1),
  pe AS (SELECT *, CASE f WHEN 'A' THEN 'replace' WHEN 'R' THEN 'append' ELSE CASE WHEN y >= 2000 THEN 'append' ELSE 'unspecified' END END AS load_mode, CASE WHEN y < 2001 THEN 'passed' ELSE 'pending' END AS readiness, CASE f WHEN 'A' THEN 'not_required' WHEN 'R' THEN 'passed' ELSE 'blocked' END AS review FROM pk),
  gate AS (SELECT package_id, row_count, error_count, load_mode, concat_ws('|', CASE WHEN error_count > 0 THEN 'quality_report_errors' END, CASE WHEN load_mode = 'unspecified' THEN 'load_mode_missing' END,
    CASE WHEN readiness <> 'passed' THEN 'readiness_not_passed' END, CASE WHEN review NOT IN ('passed', 'not_required') THEN 'review_reconciliation_not_passed' END) AS blockers FROM pe)"""


@query("q20_release_gate", f"WITH {RELEASE} SELECT *, blockers = '' AS is_ready FROM gate")
def q20(t):
    bad = (F.col("l_discount") > 0.095) & (F.col("l_tax") > 0.075) & (F.col("l_quantity") > 45)
    packages = t.lineitem.groupBy(F.col("l_returnflag").alias("flag"), F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(bad).alias("error_count"))
    # a mode given for the package wins over the one given for its kind
    by_kind = first_match([(F.col("flag") == "A", "replace"), (F.col("flag") == "R", "append")])
    by_package = F.when((F.col("flag") == "N") & (F.col("year") >= 2000), "append")
    evidence = packages.select(
        F.concat_ws("-", "flag", "year").alias("package_id"),
        "row_count",
        "error_count",
        F.coalesce(by_package, by_kind, F.lit("unspecified")).alias("load_mode"),
        F.when(F.col("year") < 2001, "passed").otherwise("pending").alias("readiness"),
        first_match([(F.col("flag") == "A", "not_required"), (F.col("flag") == "R", "passed")], "blocked").alias("review"),
    )
    blockers = q.release_blockers(evidence)
    return evidence.select("package_id", "row_count", "error_count", "load_mode", F.array_join(blockers, "|").alias("blockers"), (F.size(blockers) == 0).alias("is_ready"))


@query(
    "q21_source_health",
    """WITH e AS (SELECT user_id, event_type, CASE WHEN value > 40 AND event_type = 'error' THEN 'blocked_by_error' WHEN value > 60 AND event_type = 'click' THEN 'blocked_by_quota' WHEN event_type = 'signup' THEN 'awaiting_user' ELSE 'passed' END AS s FROM events)
       SELECT user_id, count(*) AS check_count, count(*) FILTER (WHERE s LIKE 'blocked%') AS blocked_count, CASE WHEN bool_or(s LIKE 'blocked%') THEN 'blocked' ELSE 'healthy' END AS health_status,
         coalesce(string_agg(DISTINCT s, '; ' ORDER BY s) FILTER (WHERE s LIKE 'blocked%'), '') AS blocked_reason, coalesce(string_agg(DISTINCT 'fix ' || event_type, '; ' ORDER BY 'fix ' || event_type) FILTER (WHERE s LIKE 'blocked%'), '') AS recovery_reason,
         bool_or(s LIKE 'blocked%' AND event_type = 'error') AS hash_changed, bool_or(s LIKE 'blocked%' AND event_type = 'click') AS schema_changed FROM e GROUP BY 1""",
)
def q21(t):
    kind = F.col("event_type")
    check = first_match([(kind == "error", "content_hash"), (kind == "click", "response_schema")], kind)
    return q.source_health(t.events.withColumn("check_key", check), "user_id", "check_key", event_status(), F.concat(F.lit("fix "), "event_type"))


def event_status():
    kind, value = F.col("event_type"), F.col("value")
    return first_match(
        [((value > 40) & (kind == "error"), "blocked_by_error"), ((value > 60) & (kind == "click"), "blocked_by_quota"), (kind == "signup", "awaiting_user")], "passed"
    )


@query(
    "q21_check_health",
    """SELECT event_id, user_id, 'readiness:' || event_type AS check_type, CASE WHEN (value > 40 AND event_type = 'error') OR (value > 60 AND event_type = 'click') THEN 'unavailable' WHEN event_type = 'signup' THEN 'degraded' ELSE 'healthy' END AS health_status FROM events""",
)
def q21_checks(t):
    health = health_status(event_status(), F.col("event_type"))
    return t.events.select("event_id", "user_id", F.concat(F.lit("readiness:"), "event_type").alias("check_type"), health.alias("health_status"))


@query(
    "q22_ocr_readiness",
    f"""WITH {OBS}, g AS (SELECT subject, score_year, count(*) AS row_count, count(*) FILTER (WHERE mark < 2) AS unresolved_rows, (SELECT count(*) FROM (SELECT image, score FROM obs x WHERE x.subject = o.subject AND x.score_year = o.score_year AND score IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)) AS duplicate_scores FROM obs o GROUP BY 1, 2)
        SELECT *, unresolved_rows = 0 AND duplicate_scores = 0 AS is_ready FROM g""",
)
def q22(t):
    rows = observations(t)
    group = ["subject", "score_year"]
    counted = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("parse_status") == "unreadable").alias("unresolved_rows"))
    per_score = rows.filter(F.col("score").isNotNull()).groupBy(*group, "image", "score").agg(F.count(F.lit(1)).alias("n"))
    repeated = per_score.groupBy(*group).agg(F.count_if(F.col("n") > 1).alias("duplicate_scores"))
    ready = (F.col("unresolved_rows") == 0) & (F.col("duplicate_scores") == 0)
    return counted.join(repeated, group).withColumn("is_ready", ready)


EXEMPT = """ex AS (SELECT c_custkey AS entity_code, CASE WHEN c_acctbal > 9500 THEN 'closed' ELSE 'no_count' END AS reason, c_acctbal > 9500 AS every FROM customer WHERE c_acctbal > 9000)"""


def exemptions(t):
    closed = F.col("c_acctbal") > 9500
    metrics = F.when(closed, F.array().cast("array<string>")).otherwise(F.array(F.lit("order_count")))
    reason = F.when(closed, "closed").otherwise("no_count")
    return t.customer.filter("c_acctbal > 9000").select(F.col("c_custkey").alias("entity_code"), metrics.alias("metric_keys"), reason.alias("exempt_reason"))


@query(
    "q23_plan_exemptions",
    f"""WITH {base.CPLAN}, {EXEMPT} SELECT entity_code, metric_key, CASE WHEN hit THEN 'blocked' ELSE status END AS status, CASE WHEN hit THEN reason ELSE blocking_reason END AS blocking_reason, hit AS is_exempt
        FROM (SELECT c.*, reason, reason IS NOT NULL AND (every OR metric_key = 'order_count') AS hit FROM cplan c LEFT JOIN ex USING (entity_code))""",
)
def q23(t):
    return cv.apply_exemptions(base.collection_plan(t), exemptions(t), "entity_code", "metric_key").select("entity_code", "metric_key", "status", "blocking_reason", "is_exempt")


@query(
    "q23_exemption_problems",
    f"""WITH {EXEMPT}, s AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 2000) SELECT entity_code, 'unknown_entity' AS violation FROM ex WHERE entity_code NOT IN (SELECT o_custkey FROM s)""",
)
def q23_problems(t):
    known = t.orders.filter(F.year("o_orderdate") == 2000).select(F.col("o_custkey").alias("entity_code"), F.lit(True).alias("known")).distinct()
    rows = exemptions(t).join(known, "entity_code", "left")
    checks = {
        "unknown_entity": F.col("known").isNull(),
        "reason_missing": F.col("exempt_reason") == "",
        "unknown_metric": F.size(F.array_except("metric_keys", F.array(*[F.lit(m["metric_key"]) for m in base.METRICS]))) > 0,
    }
    return r.violations(rows, ["entity_code"], checks)
