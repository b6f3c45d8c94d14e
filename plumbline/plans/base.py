"""Inputs shared by several queries: two snapshots of one fact, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.normalise import task_grid
from plumbline.operators.reconcile import Reconcile, reconciliation_plan
from plumbline.rules import first_match
from plumbline.session import cut_lineage

KEY = ["ship_year", "batch", "supplier", "slot"]
MATCH = ["ship_year", "batch", "supplier"]
VARIANT = ["slot"]
COMPARE = ["min_quantity", "fee"]


def snapshots(t) -> DataFrame:
    """Lines at the grain return flag, year, status, supplier, line slot, with the highest part."""
    held = vars(t).get("_snapshots")
    if held is not None:
        return held
    return t.lineitem.groupBy(
        "l_returnflag",
        F.year("l_shipdate").alias("ship_year"),
        F.col("l_linestatus").alias("batch"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_linenumber").alias("slot"),
    ).agg(
        F.min("l_quantity").cast("int").alias("min_quantity"),
        F.max(F.round(F.col("l_tax") * 100)).cast("int").alias("fee"),
        F.count(F.lit(1)).alias("line_count"),
        F.max("l_partkey").alias("p_partkey"),
    )


def share_snapshots(t) -> None:
    """Lines are read once for all snapshots and names of this query."""
    vars(t)["_snapshots"] = cut_lineage(snapshots(t), "snapshots")


def snapshot(t, flag: str) -> DataFrame:
    """Lines of one return flag at the grain year, status, supplier, line slot."""
    return snapshots(t).filter(F.col("l_returnflag") == flag).drop("l_returnflag", "p_partkey")


def package(t) -> DataFrame:
    return snapshot(t, "A")


def core(t) -> DataFrame:
    return snapshot(t, "R")


def reference(t) -> DataFrame:
    return snapshot(t, "N")


def snapshot_sql(name: str, flag: str) -> str:
    return f"""{name} AS (SELECT year(l_shipdate) AS ship_year, l_linestatus AS batch, l_suppkey AS supplier, l_linenumber AS slot,
      CAST(min(l_quantity) AS INTEGER) AS min_quantity, CAST(max(round(l_tax * 100)) AS INTEGER) AS fee, count(*) AS line_count
      FROM lineitem WHERE l_returnflag = '{flag}' GROUP BY 1, 2, 3, 4)"""


PACKAGE = snapshot_sql("package", "A")
CORE = snapshot_sql("core", "R")
REFERENCE = snapshot_sql("reference", "N")
SIDES = f"""{PACKAGE}, {CORE}, package_only AS (SELECT * FROM package ANTI JOIN core USING (ship_year, batch, supplier, slot)),
  core_only AS (SELECT * FROM core ANTI JOIN package USING (ship_year, batch, supplier, slot)
                WHERE (ship_year, batch, supplier) IN (SELECT (ship_year, batch, supplier) FROM package))"""


def spec() -> Reconcile:
    return Reconcile(
        match=tuple(MATCH),
        variant=tuple(VARIANT),
        compare=tuple(COMPARE),
        scope=tuple(MATCH),
        issues={
            "value_drift": (1, "high", "compare_values"),
            "rekey_candidate": (2, "medium", "confirm_rekey"),
            "package_only_unmatched": (3, "low", "review_package_row"),
            "core_only_unmatched": (4, "low", "review_core_row"),
            "zero_placeholder": (5, "high", "exclude_placeholder"),
        },
        placeholder={"fee": [0]},
    )


def plan(t) -> DataFrame:
    """Review tasks from the two snapshots."""
    return reconciliation_plan(package(t), core(t), spec())


PLAN = f"""{PACKAGE}, {CORE},
  sides AS (SELECT ship_year, batch, supplier, slot, p.min_quantity AS pq, p.fee AS pf, p.line_count AS pl, c.min_quantity AS cq, c.fee AS cf, c.line_count AS cl
    FROM package p FULL JOIN core c USING (ship_year, batch, supplier, slot)),
  po AS (SELECT * FROM sides WHERE cl IS NULL), co AS (SELECT * FROM sides WHERE pl IS NULL AND (ship_year, batch, supplier) IN (SELECT (ship_year, batch, supplier) FROM package)),
  pg AS (SELECT ship_year, batch, supplier, count(*) AS n FROM po GROUP BY 1, 2, 3), cg AS (SELECT ship_year, batch, supplier, count(*) AS n, min(slot) AS first_slot FROM co GROUP BY 1, 2, 3),
  tasks AS (
    SELECT 'value_drift' AS issue_type, ship_year, batch, supplier, slot AS package_slot, slot AS core_slot, pq, cq, pf, cf, 0 AS candidate_count,
      concat_ws('|', CASE WHEN pq <> cq THEN 'min_quantity' END, CASE WHEN pf <> cf THEN 'fee' END) AS differences FROM sides WHERE pl IS NOT NULL AND cl IS NOT NULL AND (pq <> cq OR pf <> cf)
    UNION ALL SELECT CASE WHEN cg.n IS NULL THEN 'package_only_unmatched' ELSE 'rekey_candidate' END, ship_year, batch, supplier, slot, first_slot, pq, cq, pf, cf, coalesce(cg.n, 0), '' FROM po LEFT JOIN cg USING (ship_year, batch, supplier)
    UNION ALL SELECT CASE WHEN cf = 0 THEN 'zero_placeholder' ELSE 'core_only_unmatched' END, ship_year, batch, supplier, NULL, slot, pq, cq, pf, cf, 0, '' FROM co ANTI JOIN pg USING (ship_year, batch, supplier)),
  plan AS (SELECT substr(sha1(concat_ws('|', issue_type, ship_year, batch, supplier, coalesce(CAST(package_slot AS VARCHAR), ''), coalesce(CAST(core_slot AS VARCHAR), ''))), 1, 20) AS task_id, issue_type,
      CASE issue_type WHEN 'value_drift' THEN 1 WHEN 'rekey_candidate' THEN 2 WHEN 'package_only_unmatched' THEN 3 WHEN 'core_only_unmatched' THEN 4 ELSE 5 END AS priority,
      CASE issue_type WHEN 'value_drift' THEN 'high' WHEN 'rekey_candidate' THEN 'medium' WHEN 'zero_placeholder' THEN 'high' ELSE 'low' END AS match_confidence,
      CASE issue_type WHEN 'value_drift' THEN 'compare_values' WHEN 'rekey_candidate' THEN 'confirm_rekey' WHEN 'package_only_unmatched' THEN 'review_package_row' WHEN 'core_only_unmatched' THEN 'review_core_row' ELSE 'exclude_placeholder' END AS suggested_action,
      'todo' AS status, ship_year, batch, supplier, package_slot, core_slot, pq AS package_min_quantity, cq AS core_min_quantity, pf AS package_fee, cf AS core_fee, candidate_count, differences,
      '' AS review_decision, '' AS reviewer, '' AS notes FROM tasks)"""


METRICS = [
    {"metric_key": "order_value", "metric_unit": "cents"},
    {"metric_key": "order_count", "metric_unit": "count"},
    {"metric_key": "urgent_share", "metric_unit": "ratio"},
]


def collection_plan(t) -> DataFrame:
    """Entity by metric tasks; the orders of a customer decide how far each one is."""
    stats = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    grid = task_grid(t.customer.join(stats, "c_custkey", "left"), METRICS)
    n, urgent = F.coalesce("n", F.lit(0)), F.coalesce("urgent", F.lit(0))
    key = F.col("metric_key")
    value = F.when(key == "order_value", F.col("cents").cast("double")).when(key == "order_count", F.col("n").cast("double")).otherwise(urgent / F.nullif(n, F.lit(0)))
    status = first_match(
        [
            (F.col("c_acctbal") < 0, "blocked"),
            ((key == "urgent_share") & (urgent == 0), "not_applicable"),
            (n >= 12, "complete"),
            (n >= 8, "partial"),
        ],
        "todo",
    )
    done = status.isin("complete", "partial")
    return grid.select(
        F.lit("customer").alias("domain"),
        F.col("c_custkey").alias("entity_code"),
        F.col("c_name").alias("entity_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        "metric_key",
        "metric_unit",
        F.lit(1998).alias("metric_year"),
        n.cast("bigint").alias("plan_rows"),
        status.alias("status"),
        F.when(done, value).alias("metric_value"),
        F.when(status == "blocked", "no_public_report").when(status == "not_applicable", "no_urgent_orders").otherwise("").alias("blocking_reason"),
        F.lit("").alias("reviewer"),
        F.lit("").alias("notes"),
    )


CPLAN = """stats AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1),
  grid AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal, metric_key, metric_unit, coalesce(n, 0) AS n, cents, coalesce(urgent, 0) AS urgent
    FROM customer LEFT JOIN stats ON o_custkey = c_custkey CROSS JOIN (VALUES ('order_value', 'cents'), ('order_count', 'count'), ('urgent_share', 'ratio')) AS m(metric_key, metric_unit)),
  staged AS (SELECT *, CASE WHEN c_acctbal < 0 THEN 'blocked' WHEN metric_key = 'urgent_share' AND urgent = 0 THEN 'not_applicable' WHEN n >= 12 THEN 'complete' WHEN n >= 8 THEN 'partial' ELSE 'todo' END AS status FROM grid),
  cplan AS (SELECT 'customer' AS domain, c_custkey AS entity_code, c_name AS entity_name, c_mktsegment AS segment, c_nationkey AS nation, metric_key, metric_unit, 1998 AS metric_year, n AS plan_rows, status,
    CASE WHEN status IN ('complete', 'partial') THEN CASE metric_key WHEN 'order_value' THEN CAST(cents AS DOUBLE) WHEN 'order_count' THEN CAST(n AS DOUBLE) ELSE CAST(urgent AS DOUBLE) / n END END AS metric_value,
    CASE status WHEN 'blocked' THEN 'no_public_report' WHEN 'not_applicable' THEN 'no_urgent_orders' ELSE '' END AS blocking_reason, '' AS reviewer, '' AS notes FROM staged)"""
