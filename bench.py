"""Time the headline queries; prints one JSON line with the median of several runs of each.

BENCH_SF_DIR names the input folder, BENCH_CPUS the local cores, BENCH_RUNS the runs of a query (3); once BENCH_SECONDS (420) are
spent, the remaining queries run once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from plumbline.plans import QUERIES
from plumbline.session import build_session

HEADLINE = (
    "s03_latest_wins",
    "s07_package_sink",
    "p03_unpivot_years",
    "j01_rank_lookup",
    "j05_rekey_candidates",
    "j09_keyword_containment",
    "j11_prefix_suggestions",
    "j15_name_cascade",
    "j16_role_fan_out",
    "a01_duplicate_keys",
    "a12_latest_per_metric",
    "a15_deduped_evidence",
    "a16_counters",
    "a27_sequence_gaps",
    "w01_global_priority_rank",
    "w06_carry_forward_fill",
    "w09_cumulative_repair",
    "w12_context_lines",
    "l01_issue_batch",
    "u01_key_sets",
    "m01_career_score",
    "m02_city_development_score",
    "m03_campus_living_score",
    "m04_city_industry_fit",
    "m05_major_city_fit",
    "m08_signal_candidates",
    "q01_quality_report",
    "q05_mart_input_checks",
    "q10_package_audit",
    "q16_operational_coverage",
    "q20_release_gate",
    "r01_reconciliation_plan",
    "r03_auto_decisions",
    "r06_batch_merge",
    "r10_publish",
    "t01_metric_candidates",
    "t03_html_tables",
    "t06_catalog_lines",
)


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a16_counters"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM's code paths
    runs, limit, start = int(os.environ.get("BENCH_RUNS", "3")), float(os.environ.get("BENCH_SECONDS", "420")), time.perf_counter()
    times = {}
    for name in HEADLINE:
        taken = [run(spark, folder, name)]
        while len(taken) < runs and time.perf_counter() - start < limit:
            taken.append(run(spark, folder, name))
        times[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
