"""A: grouped summaries and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import scoring as sc
from plumbline.functions.values import fixed6
from plumbline.operators import aggregate as a
from plumbline.operators.joins import two_sided
from plumbline.plans import base
from plumbline.plans.registry import fx, query
from plumbline.rules import first_match, rule_frame, values_sql


@query(
    "a01_duplicate_keys",
    """SELECT count(*) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_keys,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_keys FROM lineitem""",
)
def a01(t):
    return a.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "a02_null_counts",
    """SELECT 'quality' AS column_name, count(*) - count(quality) AS null_count FROM documents LEFT JOIN labels USING (doc_id) UNION ALL
       SELECT 'toxic', count(*) - count(toxic) FROM documents LEFT JOIN labels USING (doc_id) UNION ALL
       SELECT 'text', count(*) FILTER (WHERE coalesce(text, '') = '') FROM documents""",
)
def a02(t):
    return a.null_counts(t.documents.join(t.labels, "doc_id", "left"), ["quality", "toxic", "text"])


@query(
    "a03_range_score",
    f"""SELECT c_custkey, {fx('greatest(0.0, least(100.0, (c_acctbal - 0.0) / 9000.0 * 100.0))')} AS balance_score,
               {fx('100.0 - greatest(0.0, least(100.0, (c_acctbal - 1000.0) / 4000.0 * 100.0))')} AS risk_score, 0.0::DOUBLE AS empty_range FROM customer""",
)
def a03(t):
    def score(low, high, polarity):
        return fixed6(sc.range_score(F.col("c_acctbal"), F.lit(low), F.lit(high), F.lit(polarity)))

    return t.customer.select(
        "c_custkey",
        score(0.0, 9000.0, "positive").alias("balance_score"),
        score(1000.0, 5000.0, "negative").alias("risk_score"),
        score(5.0, 5.0, "positive").alias("empty_range"),
    )


SEGMENT_WEIGHT = {"BUILDING": 2.0, "MACHINERY": 1.0, "FURNITURE": 0.5}


@query(
    "a04_weighted_average",
    f"""WITH w AS (SELECT c_nationkey, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
          CASE c_mktsegment WHEN 'BUILDING' THEN 2.0 WHEN 'MACHINERY' THEN 1.0 WHEN 'FURNITURE' THEN 0.5 ELSE 0.0 END::DOUBLE AS w FROM customer)
        SELECT c_nationkey, c_mktsegment, {fx('sum(cents * w) FILTER (WHERE w > 0) / sum(w) FILTER (WHERE w > 0)')} AS mean_or_null,
          coalesce({fx('sum(cents * w) FILTER (WHERE w > 0) / sum(w) FILTER (WHERE w > 0)')}, 0.0) AS mean_or_zero FROM w GROUP BY 1, 2""",
)
def a04(t):
    weight = first_match([(F.col("c_mktsegment") == k, w) for k, w in SEGMENT_WEIGHT.items()], 0.0)
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    return t.customer.groupBy("c_nationkey", "c_mktsegment").agg(
        fixed6(sc.weighted_mean(cents, weight)).alias("mean_or_null"), fixed6(sc.weighted_mean(cents, weight, 0.0)).alias("mean_or_zero")
    )


# metric_key, component, weight, low, high, polarity
NATION_RULES = [
    ("customer_balance", "economic", 2.0, 3000.0, 6000.0, "positive"),
    ("customer_count", "economic", 1.0, 20.0, 100.0, "positive"),
    ("supplier_balance", "economic", 1.0, 2000.0, 8000.0, "positive"),
    ("supplier_count", "industry", 1.0, 0.0, 10.0, "positive"),
    ("urgent_orders", "service", 1.0, 50.0, 200.0, "negative"),
    ("order_count", "service", 1.0, 100.0, 1000.0, "positive"),
    ("unscored", "service", 0.0, 0.0, 1.0, "positive"),
]
NATION_RULE_COLUMNS = a.RULE_COLUMNS
COMPONENT_WEIGHTS = {"economic": 0.5, "industry": 0.2, "service": 0.3}


def metric_rows(df, key, **metrics):
    """Aggregated columns as (key, metric_key, metric_value) rows."""
    wide = df.groupBy(F.col(key).alias("nation")).agg(*[e.cast("double").alias(m) for m, e in metrics.items()])
    return wide.unpivot(["nation"], list(metrics), "metric_key", "metric_value")


def mean_of(column):
    """Mean through exact cents, so that the order of summation cannot show."""
    return F.sum(F.round(F.col(column) * 100).cast("bigint")) / F.lit(100.0) / F.count(F.lit(1))


def customer_metrics(t):
    return metric_rows(t.customer, "c_nationkey", customer_balance=mean_of("c_acctbal"), customer_count=F.count(F.lit(1)))


def supplier_metrics(t):
    return metric_rows(t.supplier, "s_nationkey", supplier_balance=mean_of("s_acctbal"), supplier_count=F.count(F.lit(1)))


def order_metrics(t):
    orders = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return metric_rows(orders, "c_nationkey", urgent_orders=urgent, order_count=F.count(F.lit(1)), unscored=F.count(F.lit(1)))


def source_components(t):
    return [a.component_scores(a.score_metrics(m, NATION_RULES), ["nation"]) for m in (customer_metrics(t), supplier_metrics(t), order_metrics(t))]


COMPONENTS_SQL = f"""rules AS {values_sql(NATION_RULE_COLUMNS, NATION_RULES)},
  metrics AS (
    SELECT 'c' AS source, c_nationkey AS nation, 'customer_balance' AS metric_key, sum(CAST(round(c_acctbal * 100) AS BIGINT)) / 100.0::DOUBLE / count(*) AS metric_value FROM customer GROUP BY 2
    UNION ALL SELECT 'c', c_nationkey, 'customer_count', count(*) FROM customer GROUP BY 2
    UNION ALL SELECT 's', s_nationkey, 'supplier_balance', sum(CAST(round(s_acctbal * 100) AS BIGINT)) / 100.0::DOUBLE / count(*) FROM supplier GROUP BY 2
    UNION ALL SELECT 's', s_nationkey, 'supplier_count', count(*) FROM supplier GROUP BY 2
    UNION ALL SELECT 'o', c_nationkey, 'urgent_orders', count(*) FILTER (WHERE o_orderpriority = '1-URGENT') FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 2
    UNION ALL SELECT 'o', c_nationkey, 'order_count', count(*) FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 2
    UNION ALL SELECT 'o', c_nationkey, 'unscored', count(*) FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 2),
  scored AS (SELECT *, CASE WHEN polarity = 'negative' THEN 100.0 - greatest(0.0, least(100.0, (metric_value - low) / (high - low) * 100.0))
    ELSE greatest(0.0, least(100.0, (metric_value - low) / (high - low) * 100.0)) END AS metric_score FROM metrics JOIN rules USING (metric_key)),
  by_source AS (SELECT source, nation, component, sum(metric_score * weight) / sum(weight) AS component_score FROM scored WHERE weight > 0 GROUP BY 1, 2, 3),
  merged AS (SELECT nation, component, avg(component_score) AS component_score FROM by_source GROUP BY 1, 2),
  wide AS (SELECT nation, max(component_score) FILTER (WHERE component = 'economic') AS economic, max(component_score) FILTER (WHERE component = 'industry') AS industry,
    max(component_score) FILTER (WHERE component = 'service') AS service, count(*) AS component_count FROM merged GROUP BY 1),
  overall AS (SELECT *, (coalesce(economic * 0.5, 0.0) + coalesce(industry * 0.2, 0.0) + coalesce(service * 0.3, 0.0))
    / ((CASE WHEN economic IS NULL THEN 0 ELSE 0.5 END) + (CASE WHEN industry IS NULL THEN 0 ELSE 0.2 END) + (CASE WHEN service IS NULL THEN 0 ELSE 0.3 END)) AS overall_score,
    concat_ws('|', CASE WHEN component_count < 2 THEN 'below_minimum_component_count' END,
      CASE WHEN economic >= 70 THEN 'economic_strong' WHEN economic < 35 THEN 'economic_weak' END, CASE WHEN industry >= 70 THEN 'industry_strong' WHEN industry < 35 THEN 'industry_weak' END,
      CASE WHEN service >= 70 THEN 'service_strong' WHEN service < 35 THEN 'service_weak' END) AS reason_codes FROM wide)"""


@query("a05_component_merge", f"WITH {COMPONENTS_SQL} SELECT nation, component, {fx('component_score')} AS component_score FROM merged")
def a05(t):
    merged = a.merge_components(source_components(t), ["nation"])
    return merged.select("nation", "component", fixed6(F.col("component_score")).alias("component_score"))


def overall(t):
    return a.overall_scores(a.merge_components(source_components(t), ["nation"]), ["nation"], COMPONENT_WEIGHTS)


@query("a06_weighted_overall", f"WITH {COMPONENTS_SQL} SELECT nation, {fx('overall_score')} AS overall_score FROM overall")
def a06(t):
    return overall(t).select("nation", fixed6(F.col("overall_score")).alias("overall_score"))


@query(
    "a07_component_mean",
    f"""WITH {COMPONENTS_SQL} SELECT nation, component, count(*) AS metric_count, {fx('avg(metric_score)')} AS mean_score FROM scored GROUP BY 1, 2""",
)
def a07(t):
    rows = customer_metrics(t).unionByName(supplier_metrics(t)).unionByName(order_metrics(t))
    return (
        a.score_metrics(rows, NATION_RULES)
        .groupBy("nation", "component")
        .agg(F.count(F.lit(1)).alias("metric_count"), fixed6(F.avg("metric_score")).alias("mean_score"))
    )


POI_RULES = [("A", "transit", 2.0, 20.0, 40.0), ("R", "commerce", 1.0, 30.0, 80.0)]
POI_RULE_COLUMNS = ["category", "component", "weight", "radius", "max_count"]


def line_pois(t):
    return t.lineitem.select(
        F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("category"), F.col("l_quantity").alias("distance"), F.col("l_partkey").alias("poi")
    )


POI_SQL = f"""poi AS (SELECT l_suppkey AS supplier, category, component, weight, count(DISTINCT l_partkey) AS poi_count, least(100.0, count(DISTINCT l_partkey) / max_count * 100.0) AS metric_score
  FROM lineitem JOIN {values_sql(POI_RULE_COLUMNS, POI_RULES)} r ON category = l_returnflag WHERE l_quantity <= radius GROUP BY 1, 2, 3, 4, max_count)"""


@query("a08_count_within_radius", f"WITH {POI_SQL} SELECT supplier, category, poi_count, {fx('metric_score')} AS metric_score FROM poi")
def a08(t):
    return a.counts_within_radius(line_pois(t), POI_RULES, ["supplier"]).select("supplier", "category", "poi_count", fixed6(F.col("metric_score")).alias("metric_score"))


EVENT_WEIGHTS = {"signup": 1.0, "purchase": 3.0, "click": 0.5}


@query(
    "a09_weighted_events",
    f"""SELECT user_id, count(*) AS event_count, sum(CASE event_type WHEN 'signup' THEN 1.0 WHEN 'purchase' THEN 3.0 WHEN 'click' THEN 0.5 ELSE 0.0 END::DOUBLE) AS weighted_count,
        {fx("least(100.0, sum(CASE event_type WHEN 'signup' THEN 1.0 WHEN 'purchase' THEN 3.0 WHEN 'click' THEN 0.5 ELSE 0.0 END::DOUBLE) / 90.0 * 100.0)")} AS event_score,
        count(*) FILTER (WHERE event_type = 'signup') AS subset_count,
        CASE WHEN count(*) FILTER (WHERE event_type = 'signup') > 0 THEN {fx("least(100.0, count(*) FILTER (WHERE event_type = 'signup') / 20.0::DOUBLE * 100.0)")} END AS subset_score
        FROM events GROUP BY 1""",
)
def a09(t):
    scored = a.weighted_events(t.events, ["user_id"], "event_type", EVENT_WEIGHTS, 90.0, ["signup"], 20.0)
    return scored.withColumn("event_score", fixed6(F.col("event_score"))).withColumn("subset_score", fixed6(F.col("subset_score")))


@query(
    "a10_diversity_score",
    f"""SELECT user_id, count(DISTINCT event_type) AS employer_count, count(DISTINCT json_extract_string(props, '$.k')) AS role_count, count(DISTINCT CAST(ts AS DATE)) AS metric_count,
        {fx("0.0 + least(100.0, count(DISTINCT event_type) / 5.0::DOUBLE * 100.0) * 0.5 + least(100.0, count(DISTINCT json_extract_string(props, '$.k')) / 60.0::DOUBLE * 100.0) * 0.3 + least(100.0, count(DISTINCT CAST(ts AS DATE)) / 30.0::DOUBLE * 100.0) * 0.2")} AS diversity_score
        FROM events GROUP BY 1""",
)
def a10(t):
    role = F.from_json("props", "k int")["k"]
    counted = t.events.groupBy("user_id").agg(
        F.count_distinct("event_type").alias("employer_count"), F.count_distinct(role).alias("role_count"), F.count_distinct(F.to_date("ts")).alias("metric_count")
    )
    score = a.diversity_score({"employer_count": (5.0, 0.5), "role_count": (60.0, 0.3), "metric_count": (30.0, 0.2)})
    return counted.withColumn("diversity_score", fixed6(score))


SIGNAL_SQL = """signals AS (SELECT nation, metric_key, metric_value FROM (SELECT c_nationkey AS nation, CAST(count(DISTINCT c_custkey) AS DOUBLE) AS distinct_company_count,
  CAST(count(DISTINCT c_mktsegment) AS DOUBLE) AS distinct_industry_count, sum(CASE WHEN c_acctbal > 9900 THEN CAST(round(c_acctbal * 100) AS BIGINT) END) / 100.0::DOUBLE AS large_balance_sum FROM customer GROUP BY 1)
  UNPIVOT (metric_value FOR metric_key IN (distinct_company_count, distinct_industry_count, large_balance_sum)))"""


def company_signals(t):
    """One pass over the companies, one output row per configured aggregate that has a value."""
    large = F.when(F.col("c_acctbal") > 9900, F.round(F.col("c_acctbal") * 100).cast("bigint"))
    aggs = {
        "distinct_company_count": F.count_distinct("c_custkey").cast("double"),
        "distinct_industry_count": F.count_distinct("c_mktsegment").cast("double"),
        "large_balance_sum": F.sum(large) / F.lit(100.0),
    }
    wide = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(*[e.alias(m) for m, e in aggs.items()])
    return wide.unpivot(["nation"], list(aggs), "metric_key", "metric_value").filter(F.col("metric_value").isNotNull())


@query("a11_configured_aggregates", f"WITH {SIGNAL_SQL} SELECT * FROM signals")
def a11(t):
    return company_signals(t)


LATEST_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


@query(
    "a12_latest_per_metric",
    """SELECT l_suppkey, l_returnflag, CAST(l_quantity AS INTEGER) AS quantity, strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def a12(t):
    latest = a.latest_by(t.lineitem, ["l_suppkey", "l_returnflag"], ["l_quantity", "l_shipdate"], LATEST_ORDER)
    return latest.select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("int").alias("quantity"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"))


@query(
    "a13_argmax_first_wins",
    """SELECT p_brand, p_type, n FROM (SELECT p_brand, p_type, count(*) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rn FROM part GROUP BY 1, 2) WHERE rn = 1""",
)
def a13(t):
    counts = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n")).withColumn("ordinal", F.col("p_type"))
    return a.best_first(counts, ["p_brand"], "p_type", "n", "ordinal")


@query(
    "a14_log_score",
    f"""SELECT l_partkey, count(*) AS n, {fx('greatest(40.0, least(100.0, 40.0 + 60.0 * (ln(1.0 + count(*)) / ln(101.0))))')} AS score FROM lineitem GROUP BY 1""",
)
def a14(t):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("score", fixed6(sc.log_score(F.col("n").cast("double"), 40.0, 100.0, 100.0)))


@query(
    "a15_deduped_evidence",
    """WITH d AS (SELECT l_suppkey, l_orderkey, max(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1, 2),
       s AS (SELECT l_suppkey, 'order-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS sample, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS rn FROM d)
       SELECT l_suppkey, g.recruit_count, g.position_count, string_agg(sample, '; ' ORDER BY sample) AS samples
       FROM s JOIN (SELECT l_suppkey, CAST(sum(q) AS BIGINT) AS recruit_count, count(*) AS position_count FROM d GROUP BY 1) g USING (l_suppkey) WHERE rn <= 3 GROUP BY 1, 2, 3""",
)
def a15(t):
    deduped = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(F.max(F.col("l_quantity").cast("bigint")).alias("q"))
    totals = deduped.groupBy("l_suppkey").agg(F.sum("q").alias("recruit_count"), F.count(F.lit(1)).alias("position_count"))
    named = deduped.withColumn("sample", F.concat(F.lit("order-"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")))
    return totals.join(a.evidence_samples(named, ["l_suppkey"], "sample", 3), "l_suppkey")


@query(
    "a16_counters",
    """SELECT o_orderstatus, o_orderpriority, y AS order_year, count(*) AS row_count FROM (SELECT *, year(o_orderdate) AS y FROM orders)
       GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority, y), ())""",
)
def a16(t):
    rows = t.orders.withColumn("order_year", F.year("o_orderdate"))
    dims = ["o_orderstatus", "o_orderpriority", "order_year"]
    return a.counters(rows, [["o_orderstatus"], ["o_orderpriority"], dims, []], dims)


@query("a17_top_counts", "SELECT l_partkey, count(*) AS row_count FROM lineitem GROUP BY 1 ORDER BY row_count DESC, l_partkey LIMIT 20")
def a17(t):
    return a.top_n(t.lineitem, ["l_partkey"], 20)


@query(
    "a18_progress",
    """SELECT o_orderpriority, count(*) AS total_rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed_rows, count(*) FILTER (WHERE o_orderstatus = 'P') AS blocked_rows,
       floor(count(*) FILTER (WHERE o_orderstatus = 'F') * 10000.0 / count(*) + 0.5) / 10000.0 AS completion_rate FROM orders GROUP BY 1""",
)
def a18(t):
    return a.progress(t.orders, ["o_orderpriority"], F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P")


@query(
    "a19_coverage_pivot",
    """SELECT lang, source, count(quality) FILTER (WHERE quality = 1) AS verified_rows, count(*) AS total_rows FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2""",
)
def a19(t):
    rows = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return rows.groupBy("lang", "source").agg(F.count_if(F.col("quality") == 1).alias("verified_rows"), F.count(F.lit(1)).alias("total_rows"))


@query(
    "a20_missing_by_category",
    """WITH g AS (SELECT c_custkey, c_mktsegment, y FROM customer CROSS JOIN (VALUES (1999), (2000), (2001)) v(y)),
       m AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = y)),
       n AS (SELECT c_mktsegment, y, count(*) AS n FROM m GROUP BY 1, 2)
       SELECT c_mktsegment, CAST(sum(n) AS BIGINT) AS missing_rows, string_agg(y || ':' || n, '|' ORDER BY y || ':' || n) AS metric_counts,
              (SELECT count(DISTINCT c_custkey) FROM m WHERE m.c_mktsegment = n.c_mktsegment) AS entity_count FROM n GROUP BY 1""",
)
def a20(t):
    years = F.array(*[F.lit(y) for y in (1999, 2000, 2001)])
    grid = t.customer.select("c_custkey", "c_mktsegment", F.explode(years).alias("y"))
    have = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"))
    return a.nested_counts(grid.join(have, ["c_custkey", "y"], "left_anti"), ["c_mktsegment"], "c_custkey", "y")


@query(
    "a21_composition",
    """WITH n AS (SELECT l_suppkey, p_type, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
       r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_type) AS rn FROM n)
       SELECT l_suppkey, CAST(count(*) AS INTEGER) AS family_count, max(p_type) FILTER (WHERE rn = 1) AS top_family, max(n) AS top_count, CAST(sum(n) AS BIGINT) AS total_count,
              string_agg(p_type || ' ' || n, ' / ' ORDER BY rn) FILTER (WHERE rn <= 3) AS summary FROM r GROUP BY 1""",
)
def a21(t):
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select("l_suppkey", "p_type")
    return a.composition(rows, ["l_suppkey"], "p_type")


BUCKET_SQL = """CASE WHEN {a} IS NULL AND {b} IS NULL THEN 'both_missing' WHEN {a} IS NULL THEN 'package_missing' WHEN {b} IS NULL THEN 'core_missing'
  WHEN abs({a} - {b}) = 0 THEN '0' WHEN abs({a} - {b}) <= {small} THEN '<= {small}' WHEN abs({a} - {b}) <= {medium} THEN '<= {medium}' ELSE '> {medium}' END"""


@query(
    "a22_delta_buckets",
    f"""WITH {base.PACKAGE}, {base.CORE} SELECT ship_year, {BUCKET_SQL.format(a='p.min_quantity', b='c.min_quantity', small=1, medium=5)} AS quantity_bucket,
        {BUCKET_SQL.format(a='p.fee', b='c.fee', small=1, medium=3)} AS fee_bucket, count(*) AS row_count
        FROM package p FULL JOIN core c USING (ship_year, batch, supplier, slot) GROUP BY 1, 2, 3""",
)
def a22(t):
    rows = two_sided(base.package(t), base.core(t), base.KEY)
    return rows.groupBy(
        "ship_year",
        a.delta_bucket(F.col("package.min_quantity"), F.col("core.min_quantity"), 1, 5).alias("quantity_bucket"),
        a.delta_bucket(F.col("package.fee"), F.col("core.fee"), 1, 3).alias("fee_bucket"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "a23_distinct_text",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities, count(*) AS order_count FROM orders GROUP BY 1""",
)
def a23(t):
    return t.orders.groupBy("o_custkey").agg(a.distinct_text("o_orderpriority").alias("priorities"), F.count(F.lit(1)).alias("order_count"))


@query(
    "a24_canonical_group_key",
    """SELECT CASE WHEN regexp_matches(p_name, '^(small|large) ') THEN 'sized ' || regexp_extract(p_name, '([a-z]+)$', 1) ELSE p_name END AS role_name, min(p_size) AS min_size, max(p_size) AS max_size,
       CAST(sum(p_size) AS BIGINT) AS total_size, count(*) AS part_count FROM part GROUP BY 1""",
)
def a24(t):
    name = F.when(F.col("p_name").rlike("^(small|large) "), F.concat(F.lit("sized "), F.regexp_extract("p_name", "([a-z]+)$", 1))).otherwise(F.col("p_name"))
    return (
        t.part.groupBy(name.alias("role_name"))
        .agg(F.min("p_size").alias("min_size"), F.max("p_size").alias("max_size"), F.sum("p_size").alias("total_size"), F.count(F.lit(1)).alias("part_count"))
        .orderBy(F.desc_nulls_last("part_count"), "role_name")
    )


@query(
    "a25_nested_grouping",
    """WITH d AS (SELECT DISTINCT p_brand, p_type, p_name FROM part), g AS (SELECT p_brand, p_type, string_agg(p_name, ',' ORDER BY p_name) AS names FROM d GROUP BY 1, 2)
       SELECT p_brand, string_agg(p_type || '=' || names, ';' ORDER BY p_type) AS role_mix FROM g GROUP BY 1""",
)
def a25(t):
    per_type = t.part.select("p_brand", "p_type", "p_name").distinct().groupBy("p_brand", "p_type").agg(F.sort_array(F.collect_list("p_name")).alias("names"))
    mix = per_type.groupBy("p_brand").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("p_type", "names")))).alias("mix"))
    entry = F.transform(F.map_entries("mix"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ",")))
    return mix.select("p_brand", F.array_join(entry, ";").alias("role_mix"))


@query(
    "a26_lineage",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       SELECT o_custkey, max(o_orderpriority) FILTER (WHERE rn = 1) AS first_priority, strftime(max(o_orderdate), '%Y-%m-%d') AS latest_date, count(DISTINCT o_orderpriority) AS source_count FROM r GROUP BY 1""",
)
def a26(t):
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("latest_date"),
        F.count_distinct("o_orderpriority").alias("source_count"),
    )


@query("a26_lineage_rows", "SELECT DISTINCT l_suppkey, l_orderkey AS source_key FROM lineitem")
def a26_rows(t):
    return t.lineitem.select("l_suppkey", F.col("l_orderkey").alias("source_key")).distinct()


@query(
    "a27_sequence_gaps",
    """WITH s AS (SELECT DISTINCT l_suppkey AS supplier, year(l_shipdate) AS ship_year, CAST(l_quantity AS INTEGER) AS q FROM lineitem),
       g AS (SELECT supplier, ship_year, count(*) AS score_rows, max(q) AS max_score, min(q) AS min_score FROM s GROUP BY 1, 2),
       f AS (SELECT supplier, ship_year, unnest(range(min_score, max_score + 1)) AS q FROM g),
       m AS (SELECT *, row_number() OVER (PARTITION BY supplier, ship_year ORDER BY q DESC) AS rn FROM f ANTI JOIN s USING (supplier, ship_year, q))
       SELECT g.*, count(m.q) AS missing_count, coalesce(string_agg(m.q, ',' ORDER BY m.q DESC) FILTER (WHERE rn <= 20), '') AS missing_sample
       FROM g LEFT JOIN m USING (supplier, ship_year) GROUP BY ALL""",
)
def a27(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").alias("ship_year"), F.col("l_quantity").cast("int").alias("q"))
    return a.gap_summary(rows, ["supplier", "ship_year"], "q", 20)


REGISTRY = [("en",), ("fr",), ("de",), ("es",), ("it",), ("pt",)]


@query(
    "a28_source_coverage",
    f"""SELECT lang, count(DISTINCT source) AS source_count, coalesce(string_agg(DISTINCT source, '|' ORDER BY source), '') AS sources, count(source) = 0 AS is_uncovered
        FROM {values_sql(['lang'], REGISTRY)} r LEFT JOIN documents USING (lang) GROUP BY 1""",
)
def a28(t):
    return a.inverted_sources(t.documents, rule_frame(t.spark, ["lang"], REGISTRY), "lang", "source")


@query("a29_reason_codes", f"WITH {COMPONENTS_SQL} SELECT nation, reason_codes FROM overall")
def a29(t):
    return overall(t).select("nation", "reason_codes")


@query(
    "a30_confidence_weighted_fit",
    f"""WITH p AS (SELECT p_brand, p_size, CASE WHEN p_retailprice > 1000 THEN 1.0 WHEN p_retailprice > 950 THEN 0.5 ELSE 0.25 END::DOUBLE AS w FROM part)
        SELECT p_brand, {fx('sum(p_size * w) / sum(w)')} AS fit_score FROM p GROUP BY 1""",
)
def a30(t):
    confidence = first_match([(F.col("p_retailprice") > 1000, 1.0), (F.col("p_retailprice") > 950, 0.5)], 0.25)
    return t.part.groupBy("p_brand").agg(fixed6(sc.weighted_mean(F.col("p_size"), confidence)).alias("fit_score"))
