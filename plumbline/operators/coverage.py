"""How much of a universe of entities has data, area by area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.rules import broadcast_rules, rule_frame


TOTAL = "*"


def area_coverage(universe: DataFrame, key: str, areas: Mapping[str, DataFrame | None], thresholds: Mapping[str, float]) -> DataFrame:
    """Covered and missing entities per area, the rate, a status and a blocker code.

    The areas, and the universe itself as one more, are stacked as (area, key) pairs and joined
    to the universe once. An area without a table is reported as ``missing_table``.
    """
    present = {a: df for a, df in areas.items() if df is not None}
    everyone = universe.select(F.lit(TOTAL).alias("area"), F.col(key))
    pairs = reduce(lambda a, b: a.unionByName(b), [everyone, *[df.select(F.lit(a).alias("area"), F.col(key)) for a, df in present.items()]]).distinct()
    covered = pairs.join(universe.select(key).distinct(), key, "left_semi").groupBy("area").agg(F.count(F.lit(1)).alias("covered"))
    rules = [(TOTAL, 0.0, True), *[(a, float(t), areas[a] is not None) for a, t in thresholds.items()]]
    table = rule_frame(universe.sparkSession, ("area", "threshold", "has_table"), rules)
    joined = broadcast_rules(table, len(rules)).join(covered, "area", "left")
    total = F.max(F.when(F.col("area") == TOTAL, F.col("covered"))).over(Window.partitionBy(F.lit(0)))  # one row per area
    joined = joined.withColumn("total", total).filter(F.col("area") != TOTAL)
    covered_n = F.coalesce("covered", F.lit(0))
    rate = covered_n / F.nullif(F.col("total"), F.lit(0))
    status = F.when(~F.col("has_table"), "missing_table").when(rate < F.col("threshold"), "below_threshold").otherwise("passed")
    out = joined.select("area", covered_n.alias("covered_count"), (F.col("total") - covered_n).alias("missing_count"), rate.alias("coverage_rate"), status.alias("area_status"))
    code = F.when(F.col("area_status") == "passed", "").otherwise(F.concat(F.upper("area"), F.lit("_COVERAGE_"), F.upper("area_status")))
    return out.withColumn("blocker_code", code)


def grid_gaps(universe: DataFrame, plan: DataFrame, key: str, metric: str, expected: int) -> DataFrame:
    """Entities missing from the plan, unknown to the universe, or with an incomplete set of metrics."""
    planned = plan.groupBy(key).agg(F.count_distinct(metric).alias("metric_count"))
    known = universe.select(key).distinct().withColumn("_known", F.lit(True))
    joined = known.join(planned, key, "full_outer")
    gap = F.when(F.col("_known").isNull(), "extra").when(F.col("metric_count").isNull(), "missing").when(F.col("metric_count") != expected, "incomplete")
    return joined.select(key, F.coalesce("metric_count", F.lit(0)).alias("metric_count"), gap.alias("gap")).filter(F.col("gap").isNotNull())


def gap_rollup(sources: Sequence[DataFrame]) -> DataFrame:
    """Blocker rows of several audits, counted per code with the number of domains."""
    stacked = reduce(lambda a, b: a.unionByName(b), sources)
    return stacked.groupBy("code").agg(F.count(F.lit(1)).alias("blocker_rows"), F.count_distinct("domain").alias("domain_count"))


def apply_exemptions(plan: DataFrame, exemptions: DataFrame, key: str, metric: str) -> DataFrame:
    """Exempt tasks become blocked with the exemption's reason; an empty metric list means every metric."""
    joined = plan.join(exemptions.select(key, "metric_keys", "exempt_reason"), key, "left")
    hit = F.col("exempt_reason").isNotNull() & ((F.size("metric_keys") == 0) | F.array_contains("metric_keys", F.col(metric)))
    hit = F.coalesce(hit, F.lit(False))
    kept = [F.col(c) for c in plan.columns if c not in ("status", "blocking_reason")]
    return joined.select(
        *kept,
        F.when(hit, "blocked").otherwise(F.col("status")).alias("status"),
        F.when(hit, F.col("exempt_reason")).otherwise(F.col("blocking_reason")).alias("blocking_reason"),
        hit.alias("is_exempt"),
    )
