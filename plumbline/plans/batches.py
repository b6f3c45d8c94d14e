"""L: sorts, top-k batches and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import review as r
from plumbline.operators.sequence import dedupe
from plumbline.plans import base
from plumbline.plans.registry import query
from plumbline.rules import first_match

L1_ORDER = ["ship_year", "batch", "supplier", "package_slot", "core_slot", "task_id"]


@query(
    "l01_issue_batch",
    f"""WITH {base.PLAN} SELECT task_id, issue_type, ship_year, supplier FROM (SELECT *, row_number() OVER (PARTITION BY issue_type ORDER BY ship_year NULLS LAST, batch NULLS LAST, supplier NULLS LAST, package_slot NULLS LAST, core_slot NULLS LAST, task_id) AS rn FROM plan WHERE status = 'todo') WHERE rn <= 25""",
)
def l01(t):
    pending = base.plan(t).filter(F.col("status").isin("todo", "pending"))
    return r.top_per_group(pending, ["issue_type"], [F.asc_nulls_last(c) for c in L1_ORDER], 25).select("task_id", "issue_type", "ship_year", "supplier")


@query(
    "l02_domain_batch_by_priority",
    f"""WITH {base.CPLAN} SELECT segment, entity_code, metric_key FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY plan_rows DESC, entity_name, metric_key, metric_year) AS rn FROM cplan WHERE status IN ('todo', 'partial')) WHERE rn <= 20""",
)
def l02(t):
    pending = base.collection_plan(t).filter(F.col("status").isin("todo", "partial"))
    order = [F.desc("plan_rows"), F.asc("entity_name"), F.asc("metric_key"), F.asc("metric_year")]
    return r.top_per_group(pending, ["segment"], order, 20).select("segment", "entity_code", "metric_key")


@query(
    "l02_domain_batch_in_plan_order",
    f"""WITH {base.CPLAN} SELECT nation, entity_code, metric_key FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY entity_code, metric_key) AS rn FROM cplan WHERE status = 'todo') WHERE rn <= 10""",
)
def l02_plan_order(t):
    pending = base.collection_plan(t).filter("status = 'todo'")
    return r.top_per_group(pending, ["nation"], [F.asc("entity_code"), F.asc("metric_key")], 10).select("nation", "entity_code", "metric_key")


@query(
    "l02_domain_batch_by_city",
    f"""WITH {base.CPLAN} SELECT domain, nation, entity_code, metric_key FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY nation, entity_name, metric_key, metric_year) AS rn FROM cplan WHERE status = 'partial') WHERE rn <= 50""",
)
def l02_city(t):
    pending = base.collection_plan(t).filter("status = 'partial'")
    order = [F.asc(c) for c in ("nation", "entity_name", "metric_key", "metric_year")]
    return r.top_per_group(pending, ["domain"], order, 50).select("domain", "nation", "entity_code", "metric_key")


TYPED = [("p_size", "number", "desc"), ("p_retailprice", "number", "asc"), ("p_type", "text", "asc"), ("p_partkey", "number", "asc")]


@query(
    "l03_typed_sort",
    """SELECT p_partkey, p_size, p_type FROM part ORDER BY p_size DESC NULLS LAST, p_retailprice, p_type, p_partkey LIMIT 100""",
)
def l03(t):
    return t.part.orderBy(*r.typed_order(TYPED)).limit(100).select("p_partkey", "p_size", "p_type")


@query("l04_paging", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_custkey, o_orderkey LIMIT 50 OFFSET 100")
def l04(t):
    return t.orders.filter("o_orderstatus = 'P'").orderBy("o_custkey", "o_orderkey").offset(100).limit(50).select("o_orderkey", "o_custkey")


@query(
    "l05_stock_batch",
    """WITH d AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, props ORDER BY ts, event_id) AS dup FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)),
       r AS (SELECT *, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS class_rank FROM d WHERE dup = 1)
       SELECT event_id, class_rank FROM r ORDER BY class_rank, value DESC, event_id LIMIT 200""",
)
def l05(t):
    rank = first_match([(F.col("event_type") == "error", 0), (F.col("event_type") == "purchase", 1)], 2)
    excluded = t.supplier.filter("s_acctbal < 0").select(F.col("s_suppkey").alias("user_id"))
    rows = t.events.join(excluded, "user_id", "left_anti")
    unique = dedupe(rows, ["user_id", "event_type", "props"], ["ts", "event_id"], "keep_first").withColumn("class_rank", rank)
    return unique.orderBy("class_rank", F.desc("value"), "event_id").limit(200).select("event_id", "class_rank")


@query(
    "l06_capped_or_seeded",
    """SELECT c_custkey, c_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 5 OR c_mktsegment = 'MACHINERY'""",
)
def l06(t):
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    return r.capped_or_seeded(t.customer, ["c_nationkey"], order, 5, F.col("c_mktsegment") == "MACHINERY").select("c_custkey", "c_nationkey")


@query(
    "l07_identity_batch",
    """SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0 ORDER BY CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END, CAST(c_acctbal AS BIGINT) // 100 DESC, c_name LIMIT 60""",
)
def l07(t):
    first = F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(1)
    hundreds = F.floor(F.round("c_acctbal") / 100)
    return t.customer.filter("c_acctbal >= 0").orderBy(first, F.desc(hundreds), "c_name").limit(60).select("c_custkey", "c_name")


@query(
    "l08_hint_batch",
    """SELECT doc_id, lang, source FROM documents LEFT JOIN labels USING (doc_id) WHERE lang IN ('en', 'fr') AND source IN ('src1', 'src2', 'src3', 'src4')
       ORDER BY lang, source, coalesce(quality, -1), coalesce(toxic, -1), n_chars DESC, doc_id LIMIT 40""",
)
def l08(t):
    rows = t.documents.filter(F.col("lang").isin("en", "fr") & F.col("source").isin("src1", "src2", "src3", "src4")).join(t.labels, "doc_id", "left")
    order = ["lang", "source", F.coalesce("quality", F.lit(-1)), F.coalesce("toxic", F.lit(-1)), F.desc("n_chars"), "doc_id"]
    return rows.orderBy(*order).limit(40).select("doc_id", "lang", "source")
