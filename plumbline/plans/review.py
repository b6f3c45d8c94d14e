"""R: review workflow from plan to published rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.values import append_note, slug, stable_id
from plumbline.operators import aggregate as a
from plumbline.operators import joins as j
from plumbline.operators import reconcile as rc
from plumbline.operators import review as r
from plumbline.operators import sequence as s
from plumbline.operators.normalise import classify_by_keyword, fill_template
from plumbline.plans import base
from plumbline.plans.aggregates import BUCKET_SQL
from plumbline.plans.registry import query
from plumbline.plans.windows import ANCHORS, CELL, OBS, fill_sql, observations
from plumbline.rules import broadcast_rules, first_match, rule_frame
from plumbline.session import cut_lineage

PLAN_COLUMNS = [
    "task_id", "issue_type", "priority", "match_confidence", "suggested_action", "status", "ship_year", "batch", "supplier",
    "package_slot", "core_slot", "package_min_quantity", "core_min_quantity", "package_fee", "core_fee", "candidate_count", "differences",
]


@query("r01_reconciliation_plan", f"WITH {base.PLAN} SELECT {', '.join(PLAN_COLUMNS)} FROM plan")
def r01(t):
    return base.plan(t).select(*PLAN_COLUMNS)


@query(
    "r02_two_sided_plan",
    f"""WITH {base.PLAN} SELECT 'value_drift' AS issue_type, ship_year, batch, supplier, slot AS package_slot, slot AS core_slot FROM sides WHERE pl IS NOT NULL AND cl IS NOT NULL AND (pq <> cq OR pf <> cf)
        UNION ALL SELECT 'package_only_unmatched', ship_year, batch, supplier, slot, NULL FROM po UNION ALL SELECT 'core_only_unmatched', ship_year, batch, supplier, NULL, slot FROM co""",
)
def r02(t):
    full = base.spec()
    simple = rc.Reconcile(full.match, full.variant, full.compare, full.scope, full.issues, rekey=False)
    plan = rc.reconciliation_plan(base.package(t), base.core(t), simple)
    return plan.select("issue_type", "ship_year", "batch", "supplier", "package_slot", "core_slot")


AUTO_RULES = [
    rc.AutoRule("placeholder", "zero_placeholder", "exclude_core", match_confidence="high", note="placeholder row"),
    rc.AutoRule("single_candidate", "rekey_candidate", "map_to_core_key", candidate_count=1, note="one candidate"),
    rc.AutoRule("reference_core", "value_drift", "keep_core", reference_side="core", note="reference agrees with core"),
    rc.AutoRule("reference_package", "value_drift", "use_package", reference_side="package", note="reference agrees with package"),
    rc.AutoRule("final_package", "package_only_unmatched", "use_package", required={"batch": "F"}, note="final batch"),
]
DECIDED = f"""{base.PLAN}, {base.REFERENCE},
  flagged AS (SELECT p.*, coalesce(rc.min_quantity = core_min_quantity AND rc.fee = core_fee, false) AS core_ok, coalesce(rp.min_quantity = package_min_quantity AND rp.fee = package_fee, false) AS package_ok
    FROM plan p LEFT JOIN reference rc ON rc.ship_year = p.ship_year AND rc.batch = p.batch AND rc.supplier = p.supplier AND rc.slot = p.core_slot
    LEFT JOIN reference rp ON rp.ship_year = p.ship_year AND rp.batch = p.batch AND rp.supplier = p.supplier AND rp.slot = p.package_slot),
  ruled AS (SELECT *, CASE WHEN issue_type = 'zero_placeholder' THEN 'placeholder' WHEN issue_type = 'rekey_candidate' AND candidate_count = 1 THEN 'single_candidate'
    WHEN issue_type = 'value_drift' AND core_ok THEN 'reference_core' WHEN issue_type = 'value_drift' AND package_ok THEN 'reference_package'
    WHEN issue_type = 'package_only_unmatched' AND batch = 'F' THEN 'final_package' END AS auto_rule FROM flagged),
  decided AS (SELECT * EXCLUDE (status, review_decision, notes), CASE WHEN auto_rule IS NULL THEN 'todo' ELSE 'decided' END AS status,
    CASE auto_rule WHEN 'placeholder' THEN 'exclude_core' WHEN 'single_candidate' THEN 'map_to_core_key' WHEN 'reference_core' THEN 'keep_core' WHEN 'reference_package' THEN 'use_package' WHEN 'final_package' THEN 'use_package' ELSE '' END AS review_decision,
    CASE auto_rule WHEN 'placeholder' THEN 'auto_rule=placeholder; placeholder row' WHEN 'single_candidate' THEN 'auto_rule=single_candidate; one candidate' WHEN 'reference_core' THEN 'auto_rule=reference_core; reference agrees with core'
      WHEN 'reference_package' THEN 'auto_rule=reference_package; reference agrees with package' WHEN 'final_package' THEN 'auto_rule=final_package; final batch' ELSE '' END AS notes FROM ruled)"""


def flagged(t):
    plan = base.plan(t)
    for side in ("core", "package"):
        plan = rc.corroborated(plan, base.reference(t), base.spec(), side)
    return plan


def decided(t):
    return rc.auto_decide(flagged(t), AUTO_RULES)


@query("r03_auto_decisions", f"WITH {DECIDED} SELECT task_id, auto_rule, status, review_decision, notes FROM decided")
def r03(t):
    return decided(t).select("task_id", "auto_rule", "status", "review_decision", "notes")


@query(
    "r03_auto_decisions_limited",
    f"""WITH {DECIDED} SELECT task_id, review_decision FROM decided WHERE auto_rule IS NOT NULL ORDER BY priority, issue_type, task_id LIMIT 100""",
)
def r03_limited(t):
    done = rc.auto_decide(cut_lineage(flagged(t), "plan"), AUTO_RULES, limit=100, order=["priority", "issue_type", "task_id"])
    return done.filter("status = 'decided'").select("task_id", "review_decision")


def names_of(t, flag):
    """Name of every snapshot key: the type of its highest part."""
    last = base.snapshots(t).filter(F.col("l_returnflag") == flag).select(*base.KEY, "p_partkey")
    return last.join(t.part.select("p_partkey", F.col("p_type").alias("name")), "p_partkey").drop("p_partkey")


def names_sql(label, flag):
    return f"""{label} AS (SELECT ship_year, batch, supplier, slot, p_type AS name FROM (SELECT year(l_shipdate) AS ship_year, l_linestatus AS batch, l_suppkey AS supplier, l_linenumber AS slot, max(l_partkey) AS p_partkey
      FROM lineitem WHERE l_returnflag = '{flag}' GROUP BY 1, 2, 3, 4) JOIN part USING (p_partkey))"""


NAMES = f"{names_sql('package_names', 'A')}, {names_sql('core_names', 'R')}"


def task_names(tasks, names, side):
    key = [*base.MATCH, f"{side}_slot"]
    return tasks.join(names.withColumnRenamed("slot", f"{side}_slot"), key).select("task_id", "name")


def core_candidates(t):
    core_only = base.core(t).join(base.package(t), base.KEY, "left_anti").select(*base.KEY)
    return core_only.join(names_of(t, "R"), base.KEY)


@query(
    "r04_name_reference_decisions",
    f"""WITH {base.PLAN}, {NAMES}, c AS (SELECT ship_year, batch, supplier, name, count(*) AS n, min(slot) AS slot FROM co JOIN core_names USING (ship_year, batch, supplier, slot) GROUP BY 1, 2, 3, 4)
        SELECT task_id, n.name, CASE WHEN c.n = 1 THEN c.slot END AS matched_slot, CASE WHEN c.n = 1 THEN 'map_to_core_key' ELSE '' END AS review_decision
        FROM plan p JOIN package_names n ON n.ship_year = p.ship_year AND n.batch = p.batch AND n.supplier = p.supplier AND n.slot = p.package_slot
        LEFT JOIN c ON c.ship_year = p.ship_year AND c.batch = p.batch AND c.supplier = p.supplier AND c.name = n.name WHERE issue_type = 'rekey_candidate'""",
)
def r04(t):
    tasks = cut_lineage(base.plan(t).filter("issue_type = 'rekey_candidate'"), "tasks")
    matched = rc.decide_by_name(tasks, task_names(tasks, names_of(t, "A"), "package"), core_candidates(t), base.MATCH, "slot")
    hit = F.col("matched_key").isNotNull()
    return matched.select("task_id", "name", F.col("matched_key").alias("matched_slot"), F.when(hit, "map_to_core_key").otherwise("").alias("review_decision"))


CLAIMS = f"""{DECIDED}, {NAMES},
  one AS (SELECT ship_year, supplier, name, count(*) AS n, min({{'batch': batch, 'slot': slot}}) AS claimed FROM package_names GROUP BY 1, 2, 3),
  package_sides AS (SELECT ship_year, batch, supplier, package_slot AS slot, task_id AS package_task, issue_type AS issue, status, review_decision AS said FROM decided WHERE package_slot IS NOT NULL),
  met AS (SELECT d.task_id AS core_task, c.name, one.n, s.package_task, s.issue, s.status, s.said, row_number() OVER (PARTITION BY s.package_task ORDER BY d.task_id) AS claim,
      row_number() OVER (PARTITION BY s.package_task ORDER BY d.task_id DESC) AS claim_from_last
    FROM decided d LEFT JOIN core_names c ON c.ship_year = d.ship_year AND c.batch = d.batch AND c.supplier = d.supplier AND c.slot = d.core_slot
    LEFT JOIN one ON one.ship_year = d.ship_year AND one.supplier = d.supplier AND one.name = c.name
    LEFT JOIN package_sides s ON one.n = 1 AND s.ship_year = d.ship_year AND s.supplier = d.supplier AND s.batch = one.claimed.batch AND s.slot = one.claimed.slot
    WHERE d.issue_type = 'core_only_unmatched' AND d.status = 'todo'),
  claims AS (SELECT *, CASE WHEN name IS NULL THEN 'missing_core_name' WHEN n IS NULL THEN 'no_match' WHEN n > 1 THEN 'ambiguous_match' WHEN package_task IS NULL THEN 'no_plan_task'
      WHEN issue = 'package_only_unmatched' THEN CASE WHEN said IN ('', 'use_package', 'map_to_core_key') THEN 'exact_pair' ELSE 'blocked_decision' END
      WHEN issue = 'value_drift' AND status = 'decided' AND said = 'use_package' THEN CASE WHEN claim = 1 THEN 'exact_drift_pair' ELSE 'has_other_task:value_drift:decided:remap_core' END
      ELSE 'has_other_task:' || issue || ':' || status || ':' || said END AS reason FROM met),
  pairs AS (SELECT core_task, package_task, reason, reason = 'exact_drift_pair' OR claim_from_last = 1 AS last FROM claims WHERE reason IN ('exact_pair', 'exact_drift_pair')),
  answers AS (SELECT core_task AS task_id, package_task AS paired_task, 'pair_covered' AS decision FROM pairs
    UNION ALL SELECT package_task, core_task, CASE reason WHEN 'exact_pair' THEN 'pair_replace' ELSE 'remap_core' END FROM pairs WHERE last)"""


def claims_of(t, plan):
    """Claims of open core-only tasks on the package rows of their name, whatever batch these are in."""
    cores = plan.filter("issue_type = 'core_only_unmatched'")
    return rc.pair_claims(plan, task_names(cores, names_of(t, "R"), "core"), names_of(t, "A"), ["ship_year", "supplier"], base.spec())


def paired(t, plan):
    """The plan with core-only rows paired with package rows by name."""
    return rc.apply_pairs(plan, cut_lineage(claims_of(t, plan), "claims"), base.spec())


@query(
    "r05_pair_decisions",
    f"""WITH {CLAIMS} SELECT d.task_id, paired_task, CASE WHEN paired_task IS NULL THEN d.status ELSE 'decided' END AS status, coalesce(decision, d.review_decision) AS review_decision
        FROM decided d LEFT JOIN answers USING (task_id)""",
)
def r05(t):
    base.share_snapshots(t)
    return paired(t, cut_lineage(decided(t), "decided")).select("task_id", "paired_task", "status", "review_decision")


@query("r05_pair_claims", f"WITH {CLAIMS} SELECT core_task, CASE WHEN reason IN ('exact_pair', 'exact_drift_pair') THEN package_task END AS package_task, reason FROM claims")
def r05_claims(t):
    base.share_snapshots(t)
    return claims_of(t, cut_lineage(decided(t), "decided")).drop("place")


EDITABLE = ["status", "review_decision", "reviewer", "notes"]


def reviewed_batch(plan):
    """The first 40 tasks of every issue type with a reviewer's answer."""
    batch = r.top_per_group(plan, ["issue_type"], [F.asc("task_id")], 40)
    answer = F.when(F.col("issue_type") == "value_drift", F.when(F.col("core_fee") > F.col("package_fee"), "keep_core").otherwise("use_package")).otherwise("skip")
    return batch.select("task_id", F.lit("decided").alias("status"), answer.alias("review_decision"), F.lit("ann").alias("reviewer"), F.lit("").alias("notes"))


REVIEWED = f"""{base.PLAN}, reviewed AS (SELECT task_id, issue_type, ship_year, CASE WHEN rn <= 40 THEN 'decided' ELSE 'todo' END AS status, CASE WHEN rn > 40 THEN '' WHEN issue_type <> 'value_drift' THEN 'skip' WHEN core_fee > package_fee THEN 'keep_core' ELSE 'use_package' END AS review_decision,
  CASE WHEN rn <= 40 THEN 'ann' ELSE '' END AS reviewer, rn <= 40 AS is_changed FROM (SELECT *, row_number() OVER (PARTITION BY issue_type ORDER BY task_id) AS rn FROM plan))"""


def reviewed(t):
    plan = cut_lineage(base.plan(t), "plan")
    return r.merge_batch(plan, reviewed_batch(plan), ["task_id"], EDITABLE)


CELLS = """cellplan AS (SELECT CAST(o_orderkey AS VARCHAR) AS task_id, o_orderpriority AS note, o_orderstatus AS status FROM orders),
  cellbatch AS (SELECT '  ' || o_orderkey || ' ' AS task_id, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN o_orderpriority ELSE 'seen' END AS note, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'F' END AS status FROM orders WHERE o_orderkey % 2 = 0)"""


@query(
    "r06_batch_cells",
    f"""WITH {CELLS} SELECT p.task_id, CASE WHEN b.task_id IS NULL THEN p.note ELSE b.note END AS note, CASE WHEN b.task_id IS NULL THEN p.status ELSE b.status END AS status,
          CASE WHEN b.task_id IS NULL THEN 0 ELSE CAST(coalesce(b.note, '') <> p.note AS INTEGER) + CAST(coalesce(b.status, '') <> p.status AS INTEGER) END AS changed_cells
        FROM cellplan p LEFT JOIN cellbatch b ON trim(b.task_id) = p.task_id""",
)
def r06_cells(t):
    """Every second order is edited: blank and missing values clear cells, keys come with blanks around them."""
    key = F.col("o_orderkey").cast("string")
    plan = t.orders.select(key.alias("task_id"), F.col("o_orderpriority").alias("note"), F.col("o_orderstatus").alias("status"))
    note = F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, F.col("o_orderpriority")).otherwise("seen")
    batch = t.orders.filter("o_orderkey % 2 = 0").select(F.concat(F.lit("  "), key, F.lit(" ")).alias("task_id"), note.alias("note"), F.when(F.col("o_orderkey") % 5 != 0, "F").alias("status"))
    return r.merge_batch(plan, batch, ["task_id"], ["note", "status"]).select("task_id", "note", "status", "changed_cells")


@query("r06_batch_merge", f"WITH {REVIEWED} SELECT task_id, status, review_decision, reviewer, is_changed FROM reviewed")
def r06(t):
    return reviewed(t).select("task_id", "status", "review_decision", "reviewer", "is_changed")


@query(
    "r06_batch_problems",
    """WITH b AS (SELECT nullif(user_id, 0) AS k, count(*) AS row_count FROM events GROUP BY 1)
       SELECT k AS s_suppkey, row_count, problem FROM (SELECT k, row_count, unnest(list_filter([CASE WHEN k IS NULL THEN 'blank_key' END, CASE WHEN row_count > 1 THEN 'duplicate_key' END,
         CASE WHEN k IS NOT NULL AND k NOT IN (SELECT s_suppkey FROM supplier) THEN 'unknown_key' END], lambda x: x IS NOT NULL)) AS problem FROM b)""",
)
def r06_problems(t):
    batch = t.events.select(F.nullif(F.col("user_id"), F.lit(0)).alias("s_suppkey"))
    return r.batch_problems(t.supplier, batch, ["s_suppkey"])


def seeds(t):
    """Values found elsewhere: the count of urgent orders per customer, under the order_count metric."""
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return urgent.select(
        F.col("o_custkey").alias("entity_code"),
        F.lit("order_count").alias("metric_key"),
        F.col("n").cast("double").alias("metric_value"),
        F.lit("complete").alias("status"),
        F.lit("seed").alias("reviewer"),
    )


SEEDED = f"""{base.CPLAN}, seeds AS (SELECT o_custkey AS entity_code, 'order_count' AS metric_key, CAST(count(*) AS DOUBLE) AS seed_value FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)"""


@query(
    "r07_seed_replay",
    f"""WITH {SEEDED} SELECT entity_code, metric_key, CASE WHEN hit THEN 'complete' ELSE status END AS status, CASE WHEN hit THEN seed_value ELSE metric_value END AS metric_value, CASE WHEN hit THEN 'seed' ELSE '' END AS reviewer, hit AS is_changed
        FROM (SELECT c.*, seed_value, seed_value IS NOT NULL AND status NOT IN ('complete', 'partial') AS hit FROM cplan c LEFT JOIN seeds USING (entity_code, metric_key))""",
)
def r07(t):
    open_rows = ~F.col("status").isin("complete", "partial")
    merged = r.merge_batch(base.collection_plan(t), seeds(t), ["entity_code", "metric_key"], ["status", "metric_value", "reviewer"], only_if=open_rows, blank_keeps=True, unknown_keys="ignore")
    return merged.select("entity_code", "metric_key", "status", "metric_value", "reviewer", "is_changed")


@query(
    "r07_seed_overwrite",
    f"""WITH {SEEDED} SELECT entity_code, metric_key, CASE WHEN seed_value IS NOT NULL THEN seed_value ELSE metric_value END AS metric_value FROM cplan LEFT JOIN seeds USING (entity_code, metric_key)""",
)
def r07_overwrite(t):
    merged = r.merge_batch(base.collection_plan(t), seeds(t), ["entity_code", "metric_key"], ["status", "metric_value", "reviewer"], blank_keeps=True, unknown_keys="ignore")
    return merged.select("entity_code", "metric_key", "metric_value")


@query(
    "r07_unmatched_seeds",
    """SELECT DISTINCT user_id AS c_custkey FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
       AND 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') NOT IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def r07_unmatched(t):
    found = t.events.select(F.col("user_id").alias("c_custkey")).distinct().withColumn("c_name", F.format_string("Customer#%09d", "c_custkey"))
    by_code = r.unmatched_rows(found, t.customer.filter("c_acctbal > 0"), ["c_custkey"])
    return r.unmatched_rows(by_code, t.customer.filter("c_mktsegment = 'BUILDING'"), ["c_name"]).select("c_custkey")


CANDIDATES = """cand AS (SELECT o_custkey AS entity_code, CASE o_orderstatus WHEN 'F' THEN 'order_value' WHEN 'O' THEN 'order_count' ELSE 'urgent_share' END AS metric_key, o_totalprice AS candidate_value, 'class of ' || year(o_orderdate) || '届' AS quote, o_orderkey FROM orders),
  checked AS (SELECT *, count(*) OVER (PARTITION BY entity_code, metric_key) AS n, regexp_extract(quote, '(\\d{4})\\s*届', 1) <> '1998' AS wrong_year FROM cand)"""


def approved_candidates(t):
    """Every order is a candidate for one of its customer's metrics, by its status."""
    status = F.col("o_orderstatus")
    rows = t.orders.select(
        F.col("o_custkey").alias("entity_code"),
        F.when(status == "F", "order_value").when(status == "O", "order_count").otherwise("urgent_share").alias("metric_key"),
        F.col("o_totalprice").alias("candidate_value"),
        F.concat(F.lit("class of "), F.year("o_orderdate"), F.lit("届")).alias("quote"),
        "o_orderkey",
    )
    years = F.regexp_extract_all("quote", F.lit(r"(\d{4})\s*届"), F.lit(1))
    repeated = rows.groupBy("entity_code", "metric_key").agg((F.count(F.lit(1)) > 1).alias("is_repeated"))
    checks = {
        "cohort_year_mismatch": (F.size(years) > 0) & ~F.array_contains(years, "1998"),
        "duplicate_candidate": F.col("is_repeated"),
        "missing_value": F.col("candidate_value").isNull(),
    }
    return rows.join(repeated, ["entity_code", "metric_key"]).withColumn("problems", r.column_checks(checks))


@query(
    "r08_candidate_problems",
    f"""WITH {CANDIDATES} SELECT o_orderkey, 'cohort_year_mismatch' AS problem FROM checked WHERE wrong_year UNION ALL SELECT o_orderkey, 'duplicate_candidate' FROM checked WHERE n > 1""",
)
def r08_problems(t):
    return approved_candidates(t).select("o_orderkey", F.explode("problems").alias("problem"))


@query(
    "r08_candidate_merge",
    f"""WITH {base.CPLAN}, {CANDIDATES}, ok AS (SELECT entity_code, metric_key, candidate_value FROM checked WHERE NOT wrong_year AND n = 1)
        SELECT entity_code, metric_key, CASE WHEN ok.candidate_value IS NULL THEN status ELSE 'complete' END AS status, coalesce(ok.candidate_value, metric_value) AS metric_value FROM cplan LEFT JOIN ok USING (entity_code, metric_key)""",
)
def r08(t):
    clean = approved_candidates(t).filter(F.size("problems") == 0)
    batch = clean.select("entity_code", "metric_key", F.col("candidate_value").alias("metric_value"), F.lit("complete").alias("status"))
    return r.merge_batch(base.collection_plan(t), batch, ["entity_code", "metric_key"], ["status", "metric_value"], unknown_keys="ignore").select("entity_code", "metric_key", "status", "metric_value")


@query(
    "r09_inherit_verified",
    f"""WITH {base.CPLAN}, old AS (SELECT entity_code, metric_key, metric_value FROM cplan WHERE status = 'complete')
        SELECT c.entity_code, c.metric_key, CASE WHEN old.metric_value IS NULL THEN 'todo' ELSE 'complete' END AS status, old.metric_value FROM cplan c LEFT JOIN old USING (entity_code, metric_key)""",
)
def r09(t):
    plan = base.collection_plan(t)
    rebuilt = plan.select("entity_code", "metric_key", F.lit("todo").alias("status"), F.lit(None).cast("double").alias("metric_value"))
    verified = plan.filter("status = 'complete'").select("entity_code", "metric_key", "status", "metric_value")
    return r.merge_batch(rebuilt, verified, ["entity_code", "metric_key"], ["status", "metric_value"]).drop("is_changed", "changed_cells")


PUBLISHED = f"""{CLAIMS}, published AS (SELECT task_id, ship_year, batch, supplier, CASE WHEN review_decision IN ('keep_core', 'map_to_core_key') THEN core_slot ELSE package_slot END AS slot,
  CASE WHEN review_decision = 'keep_core' THEN core_min_quantity ELSE package_min_quantity END AS min_quantity, CASE WHEN review_decision = 'keep_core' THEN core_fee ELSE package_fee END AS fee
  FROM decided WHERE review_decision IN ('use_package', 'keep_core', 'map_to_core_key') AND task_id NOT IN (SELECT task_id FROM answers)
  UNION ALL SELECT q.task_id, c.ship_year, c.batch, c.supplier, c.core_slot, q.package_min_quantity, q.package_fee
  FROM answers a JOIN decided c ON c.task_id = a.paired_task JOIN decided q ON q.task_id = a.task_id WHERE a.decision <> 'pair_covered')"""


@query("r10_publish", f"WITH {PUBLISHED} SELECT * FROM published")
def r10(t):
    base.share_snapshots(t)
    return rc.publish(paired(t, cut_lineage(decided(t), "decided")), base.spec())


@query("r10_ambiguous_publications", f"WITH {PUBLISHED} SELECT ship_year, batch, supplier, slot, count(*) AS task_count FROM published GROUP BY 1, 2, 3, 4 HAVING count(*) > 1")
def r10_ambiguous(t):
    base.share_snapshots(t)
    return rc.ambiguous_publications(rc.publish(paired(t, cut_lineage(decided(t), "decided")), base.spec()), base.KEY)


@query(
    "r11_delete_plan",
    f"""WITH {CLAIMS} SELECT ship_year, batch, supplier, core_slot AS slot, CASE decision WHEN 'remap_core' THEN 'rekeyed' ELSE 'excluded' END AS reason, count(*) AS task_count
        FROM decided LEFT JOIN answers USING (task_id) WHERE coalesce(decision, review_decision) IN ('exclude_core', 'remap_core') GROUP BY ALL""",
)
def r11(t):
    """All tasks decided: by rule, by pair, and the rest skipped by a reviewer. Core rows that pairs cover are not deleted."""
    base.share_snapshots(t)
    plan = paired(t, cut_lineage(decided(t), "decided"))
    closed = plan.withColumn("review_decision", F.when(F.col("status") == "todo", "skip").otherwise(F.col("review_decision")))
    return rc.delete_plan(closed.withColumn("status", F.lit("decided")), base.spec())


@query(
    "r12_review_context",
    f"""WITH {base.PLAN}, {NAMES}, c AS (SELECT ship_year, batch, supplier, name, count(*) AS n FROM co JOIN core_names USING (ship_year, batch, supplier, slot) GROUP BY 1, 2, 3, 4)
        SELECT issue_type, CASE WHEN issue_type <> 'rekey_candidate' THEN '' WHEN c.n = 1 THEN 'single_exact' WHEN c.n > 1 THEN 'ambiguous_exact' ELSE 'no_match' END AS name_hint,
          {BUCKET_SQL.format(a='package_min_quantity', b='core_min_quantity', small=1, medium=5)} AS quantity_bucket, count(*) AS task_count
        FROM plan p LEFT JOIN package_names n ON n.ship_year = p.ship_year AND n.batch = p.batch AND n.supplier = p.supplier AND n.slot = p.package_slot
        LEFT JOIN c ON c.ship_year = p.ship_year AND c.batch = p.batch AND c.supplier = p.supplier AND c.name = n.name GROUP BY 1, 2, 3""",
)
def r12(t):
    names = names_of(t, "A").withColumnRenamed("slot", "package_slot")
    per_name = core_candidates(t).groupBy(*base.MATCH, "name").agg(F.count(F.lit(1)).alias("n"))
    tasks = base.plan(t).join(names, [*base.MATCH, "package_slot"], "left").join(per_name, [*base.MATCH, "name"], "left")
    hint = first_match([(F.col("issue_type") != "rekey_candidate", ""), (F.col("n") == 1, "single_exact"), (F.col("n") > 1, "ambiguous_exact")], "no_match")
    bucket = a.delta_bucket(F.col("package_min_quantity"), F.col("core_min_quantity"), 1, 5)
    return tasks.groupBy("issue_type", hint.alias("name_hint"), bucket.alias("quantity_bucket")).agg(F.count(F.lit(1)).alias("task_count"))


@query(
    "r13_drift_filters",
    f"""WITH {base.PLAN} SELECT task_id FROM plan WHERE issue_type = 'value_drift' AND core_fee > 0 AND abs(package_min_quantity - core_min_quantity) BETWEEN 2 AND 5""",
)
def r13(t):
    bucket = a.delta_bucket(F.col("package_min_quantity"), F.col("core_min_quantity"), 1, 5)
    core_state = F.when(F.coalesce("core_fee", F.lit(0)) == 0, "blank_or_zero").otherwise("present")
    return base.plan(t).filter((F.col("issue_type") == "value_drift") & (core_state == "present") & (bucket == "<= 5")).select("task_id")


def ocr_review(t):
    """Unreadable rows as tasks, prefilled with the filled-in counts where the block allows them."""
    rows = observations(t)
    found = s.anchors(rows, CELL, F.col("parse_status") == "parsed", 5)
    filled = s.fill_counts(s.expected_scores(rows, CELL, found), CELL, allow_single_number=True)
    hints = filled.select(*CELL, "position", *[F.col(c).alias(f"suggested_{c}") for c in ("score", "score_count", "cumulative_rank")])
    return rows.join(hints, [*CELL, "position"], "left")


@query(
    "r14_review_tasks",
    f"""WITH RECURSIVE {OBS}, {ANCHORS}, {fill_sql('anchors', "SELECT o.subject, o.score_year, o.image, o.block, o.position, o.raw_text, w.score AS suggested_score, w.score_count AS suggested_score_count FROM obs o LEFT JOIN walk w ON w.subject = o.subject AND w.score_year = o.score_year AND w.image = o.image AND w.block = o.block AND w.position = o.position AND w.score IS NOT NULL WHERE o.mark < 2")}""",
)
def r14_tasks(t):
    tasks = ocr_review(t).filter("parse_status = 'unreadable'")
    return tasks.select(*CELL, "position", "raw_text", "suggested_score", "suggested_score_count")


@query(
    "r14_apply_review",
    f"""WITH RECURSIVE {OBS}, {ANCHORS}, {fill_sql('anchors', "SELECT o.subject, o.score_year, CASE WHEN o.mark > 1 THEN 'kept' WHEN w.score IS NOT NULL THEN 'approved' WHEN o.mark = 1 THEN 'dropped' ELSE 'unresolved' END AS outcome, count(*) AS row_count, CAST(sum(CASE WHEN o.mark > 1 THEN o.n ELSE w.score_count END) AS BIGINT) AS counted FROM obs o LEFT JOIN walk w ON w.subject = o.subject AND w.score_year = o.score_year AND w.image = o.image AND w.block = o.block AND w.position = o.position AND w.score IS NOT NULL GROUP BY 1, 2, 3")}""",
)
def r14_apply(t):
    rows = ocr_review(t)
    outcome = first_match(
        [
            (F.col("parse_status") == "parsed", "kept"),
            (F.col("suggested_score").isNotNull(), "approved"),
            (F.size("numbers") == 1, "dropped"),
        ],
        "unresolved",
    )
    counted = F.when(F.col("parse_status") == "parsed", F.col("score_count")).otherwise(F.col("suggested_score_count"))
    return rows.groupBy("subject", "score_year", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"), F.sum(counted).alias("counted"))


STOCK_CLASS_SQL = """CASE WHEN contains(text, 'hahaha') THEN 'still_rejected' WHEN source IN ('src1', 'src2', 'src3') OR contains(lower(text), '.gov') THEN
  CASE WHEN regexp_matches(text, '(license|Copyright)') THEN 'overall_approved_candidate' ELSE 'scoped_official_candidate' END ELSE 'needs_manual_context' END"""
ACTIONS = {
    "scoped_official_candidate": "verify_scope_then_approve",
    "overall_approved_candidate": "verify_context_then_approve",
    "still_rejected": "keep_rejected",
    "needs_manual_context": "open_source_context",
}


def stock_review(t):
    official = F.col("source").isin("src1", "src2", "src3") | F.lower("text").contains(".gov")
    kind = first_match(
        [
            (F.col("text").contains("hahaha"), "still_rejected"),
            (official & F.col("text").rlike("(license|Copyright)"), "overall_approved_candidate"),
            (official, "scoped_official_candidate"),
        ],
        "needs_manual_context",
    )
    rows = t.documents.select("doc_id", "lang", kind.alias("review_class"))
    return rows.withColumn("recommended_action", first_match([(F.col("review_class") == k, v) for k, v in ACTIONS.items()]))


STOCK = f"""stock AS (SELECT doc_id, lang, review_class, CASE review_class WHEN 'scoped_official_candidate' THEN 'verify_scope_then_approve' WHEN 'overall_approved_candidate' THEN 'verify_context_then_approve'
  WHEN 'still_rejected' THEN 'keep_rejected' ELSE 'open_source_context' END AS recommended_action FROM (SELECT doc_id, lang, {STOCK_CLASS_SQL} AS review_class FROM documents))"""


@query("r15_stock_review", f"WITH {STOCK} SELECT * FROM stock")
def r15(t):
    return stock_review(t)


@query("r15_stock_audit", f"WITH {STOCK} SELECT review_class, lang, count(*) AS row_count FROM stock GROUP BY GROUPING SETS ((review_class), (review_class, lang))")
def r15_audit(t):
    return a.counters(stock_review(t), [["review_class"], ["review_class", "lang"]], ["review_class", "lang"])


@query("r15_stock_export", f"WITH {STOCK} SELECT doc_id, review_class FROM stock JOIN labels USING (doc_id) WHERE quality = 1 AND review_class IN ('scoped_official_candidate', 'overall_approved_candidate')")
def r15_export(t):
    approved = t.labels.filter("quality = 1").select("doc_id")
    rows = stock_review(t).filter(F.col("review_class").isin("scoped_official_candidate", "overall_approved_candidate"))
    return rows.join(approved, "doc_id", "left_semi").select("doc_id", "review_class")


def report_sources(t):
    """Metric tasks collapsed to one row per entity, year and scope; capped per segment, seeded nations pass."""
    pending = base.collection_plan(t).filter(F.col("status").isin("todo", "partial"))
    entities = pending.groupBy("segment", "nation", "entity_code", "entity_name", "metric_year").agg(
        F.max("plan_rows").alias("plan_rows"),
        F.array_join(F.array_sort(F.collect_set("metric_key")), "|").alias("planned_metric_keys"),
    )
    scoped = entities.withColumn("report_scope", F.explode(F.array(F.lit("annual"), F.lit("quality"))))
    order = [F.desc("plan_rows"), F.asc("entity_code"), F.asc("report_scope")]
    return r.capped_or_seeded(scoped, ["segment"], order, 30, F.col("nation") == 3)


SOURCES = f"""{base.CPLAN}, ent AS (SELECT segment, nation, entity_code, entity_name, metric_year, max(plan_rows) AS plan_rows, string_agg(metric_key, '|' ORDER BY metric_key) AS planned_metric_keys FROM cplan WHERE status IN ('todo', 'partial') GROUP BY 1, 2, 3, 4, 5),
  sources AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY plan_rows DESC, entity_code, report_scope) AS rn FROM ent CROSS JOIN (VALUES ('annual'), ('quality')) AS v(report_scope)) WHERE rn <= 30 OR nation = 3)"""


@query("r16_report_source_plan", f"WITH {SOURCES} SELECT * FROM sources")
def r16(t):
    return report_sources(t)


@query(
    "r17_intake_plan",
    f"""WITH {SOURCES} SELECT entity_code, report_scope, 'reports/' || metric_year || '/' || trim(regexp_replace(entity_name || ' ' || report_scope, '[^0-9A-Za-z_]+', '_', 'g'), '_') || '.pdf' AS local_report_path, 'awaiting_file' AS status FROM sources""",
)
def r17(t):
    name = slug(F.concat_ws(" ", "entity_name", "report_scope"))
    path = fill_template("reports/{year}/{name}.pdf", year=F.col("metric_year"), name=name)
    return report_sources(t).select("entity_code", "report_scope", path.alias("local_report_path"), F.lit("awaiting_file").alias("status"))


@query(
    "r17_intake_merge",
    f"""WITH {SOURCES} SELECT entity_code, report_scope, CASE WHEN report_scope = 'annual' AND entity_code IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001) THEN 'downloaded' ELSE 'todo' END AS status FROM sources""",
)
def r17_merge(t):
    results = t.orders.filter(F.year("o_orderdate") == 2001).select(F.col("o_custkey").alias("entity_code")).distinct()
    results = results.select("entity_code", F.lit("annual").alias("report_scope"), F.lit("downloaded").alias("status"))
    plan = report_sources(t).select("entity_code", "report_scope", F.lit("todo").alias("status"))
    return r.merge_batch(plan, results, ["entity_code", "report_scope"], ["status"], unknown_keys="ignore").drop("is_changed", "changed_cells")


@query(
    "r18_official_routes",
    """SELECT source, 'https://' || r.host || '/' || source AS route_url, string_agg(DISTINCT d.lang, '|' ORDER BY d.lang) AS metric_keys, count(*) AS hint_count
       FROM documents d JOIN (VALUES ('en', 'news.example.org'), ('fr', 'news.example.org'), ('de', 'blatt.example.net'), ('en', 'blatt.example.net')) AS r(lang, host) ON r.lang = d.lang GROUP BY 1, 2""",
)
def r18(t):
    routes = [("en", "news.example.org"), ("fr", "news.example.org"), ("de", "blatt.example.net"), ("en", "blatt.example.net")]
    table = broadcast_rules(rule_frame(t.spark, ["lang", "host"], routes), len(routes))
    joined = t.documents.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).join(table, "lang")
    url = fill_template("https://{host}/{source}", host=F.col("host"), source=F.col("source"))
    return joined.groupBy("source", url.alias("route_url")).agg(a.distinct_text("lang").alias("metric_keys"), F.sum("n").alias("hint_count"))


@query(
    "r19_identity_review_plan",
    """WITH b AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS name FROM benchmark), l AS (SELECT name, count(DISTINCT item_id) AS priority FROM b GROUP BY 1),
       p AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS profile FROM documents),
       ll AS (SELECT name, priority FROM l WHERE length(name) >= 6 AND name NOT IN (SELECT profile FROM p)), pp AS (SELECT profile FROM p WHERE length(profile) >= 6),
       m AS (SELECT name, count(*) AS n, min(profile) AS one FROM ll JOIN pp ON starts_with(name, profile) OR starts_with(profile, name) GROUP BY 1)
       SELECT ll.name, priority, coalesce(n, 0) AS prefix_matches, CASE WHEN n = 1 THEN one END AS suggestion, CASE WHEN n = 1 THEN 'suggested' ELSE 'needs_review' END AS status FROM ll LEFT JOIN m USING (name)""",
)
def r19(t):
    words = t.benchmark.select("item_id", F.explode(F.expr("regexp_extract_all(lower(text), '[a-z]+', 0)")).alias("name"))
    local = words.groupBy("name").agg(F.count_distinct("item_id").alias("priority"))
    profiles = t.documents.select(F.explode(F.expr("regexp_extract_all(lower(text), '[a-z]+', 0)")).alias("name")).distinct()
    unmatched = local.join(profiles, "name", "left_anti")
    found = j.prefix_suggestions(unmatched, profiles, 6, 3).join(unmatched, "name")
    status = F.when(F.col("prefix_matches") == 1, "suggested").otherwise("needs_review")
    return found.select("name", "priority", "prefix_matches", "suggestion", status.alias("status"))


FAMILY = [("industry", ["MACHINERY", "AUTOMOBILE"]), ("home", ["FURNITURE", "HOUSEHOLD", "BUILDING"])]
PROGRESS = f"""{base.CPLAN}, p AS (SELECT *, CASE WHEN segment IN ('MACHINERY', 'AUTOMOBILE') THEN 'industry' WHEN segment IN ('FURNITURE', 'HOUSEHOLD', 'BUILDING') THEN 'home' ELSE 'other' END AS family FROM cplan),
  h AS (SELECT *, CASE WHEN family = 'industry' AND metric_key = 'order_value' THEN 'high' WHEN metric_key = 'urgent_share' THEN 'low' ELSE 'medium' END AS priority_hint FROM p)"""


def progress_rows(t):
    family = classify_by_keyword(F.col("segment"), FAMILY, "other")
    hint = first_match([((F.col("family") == "industry") & (F.col("metric_key") == "order_value"), "high"), (F.col("metric_key") == "urgent_share", "low")], "medium")
    return base.collection_plan(t).withColumn("family", family).withColumn("priority_hint", hint)


@query(
    "r20_top_missing",
    f"""WITH {PROGRESS} SELECT entity_code, metric_key, family, priority_hint, plan_rows FROM h WHERE status IN ('todo', 'partial')
        ORDER BY CASE priority_hint WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, plan_rows DESC, entity_code, metric_key LIMIT 50""",
)
def r20_top(t):
    rank = first_match([(F.col("priority_hint") == "high", 0), (F.col("priority_hint") == "medium", 1)], 2)
    pending = progress_rows(t).filter(F.col("status").isin("todo", "partial"))
    return pending.orderBy(rank, F.desc("plan_rows"), "entity_code", "metric_key").limit(50).select("entity_code", "metric_key", "family", "priority_hint", "plan_rows")


@query(
    "r20_blocked_by_reason",
    f"""WITH {PROGRESS} SELECT blocking_reason, family, count(*) AS blocked_rows, count(DISTINCT entity_code) AS entity_count FROM h WHERE status IN ('blocked', 'not_applicable') GROUP BY 1, 2""",
)
def r20_blocked(t):
    blocked = progress_rows(t).filter(F.col("status").isin("blocked", "not_applicable"))
    return blocked.groupBy("blocking_reason", "family").agg(F.count(F.lit(1)).alias("blocked_rows"), F.count_distinct("entity_code").alias("entity_count"))


@query(
    "r20_missing_by_family",
    f"""WITH {PROGRESS}, m AS (SELECT family, metric_key, count(*) AS n FROM h WHERE status IN ('todo', 'partial') GROUP BY 1, 2)
        SELECT family, CAST(sum(n) AS BIGINT) AS missing_rows, string_agg(metric_key || ':' || n, '|' ORDER BY metric_key || ':' || n) AS metric_counts,
          (SELECT count(DISTINCT entity_code) FROM h WHERE h.family = m.family AND status IN ('todo', 'partial')) AS entity_count FROM m GROUP BY 1""",
)
def r20_family(t):
    pending = progress_rows(t).filter(F.col("status").isin("todo", "partial"))
    return a.nested_counts(pending, ["family"], "entity_code", "metric_key")


@query(
    "r21_role_template",
    """SELECT substr(sha1(p_type || '|' || role_name), 1, 20) AS task_id, p_type AS major_class, role_name, count(*) AS plan_rows, 'todo' AS status, '' AS role_key, 'source=part' AS notes
       FROM (SELECT p_type, CASE WHEN regexp_matches(p_name, '^(small|large) ') THEN regexp_extract(p_name, '([a-z]+)$', 1) ELSE p_name END AS role_name FROM part) GROUP BY 2, 3""",
)
def r21(t):
    name = F.when(F.col("p_name").rlike("^(small|large) "), F.regexp_extract("p_name", "([a-z]+)$", 1)).otherwise(F.col("p_name"))
    rows = t.part.groupBy(F.col("p_type").alias("major_class"), name.alias("role_name")).agg(F.count(F.lit(1)).alias("plan_rows"))
    return rows.select(
        stable_id(F.col("major_class"), F.col("role_name")).alias("task_id"),
        "major_class",
        "role_name",
        "plan_rows",
        F.lit("todo").alias("status"),
        F.lit("").alias("role_key"),
        append_note(F.lit(""), F.lit("source=part")).alias("notes"),
    )
