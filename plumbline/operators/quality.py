"""Quality gates: violations come back as rows, so they can be counted, joined and stored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import TableContract
from plumbline.operators.review import column_checks
from plumbline.rules import broadcast_rules, first_match, rule_frame


def quality_report(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row: rows, duplicate keys, null counts of required columns, years, error codes.

    Rows are counted per key first, so the whole report is one shuffle and a small final merge.
    """
    empty = [F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(f"_null_{c}") for c in contract.required]
    years = [F.col(c) for c in contract.year_columns]
    low, high = (F.least(*years), F.greatest(*years)) if len(years) > 1 else (years[0], years[0])
    year_bounds = [F.min(low).alias("_first_year"), F.max(high).alias("_last_year")]
    per_key = df.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("_n"), *empty, *year_bounds)
    total = per_key.agg(
        F.sum("_n").alias("row_count"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicate_key_count"),
        *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in contract.required],
        F.min("_first_year").alias("first_year"),
        F.max("_last_year").alias("last_year"),
    )
    nulls = F.concat_ws("|", *[F.concat(F.lit(f"{c}:"), F.col(f"_null_{c}")) for c in contract.required])
    errors = F.array_compact(
        F.array(
            F.when(F.col("row_count") == 0, "no_rows"),
            F.when(F.col("duplicate_key_count") > 0, "duplicate_keys"),
            *[F.when(F.col(f"_null_{c}") > 0, f"null_{c}") for c in contract.required],
            F.when(F.lit(not contract.valid_name()), "bad_table_name"),
        )
    )
    return total.select(
        "row_count", "duplicate_key_count", nulls.alias("null_counts"), "first_year", "last_year", F.array_join(errors, "|").alias("error_codes")
    )


REGISTRY_COLUMNS = ("metric_key", "reg_unit", "min_value", "max_value", "needs_scope")


def metric_registry_check(rows: DataFrame, registry: Sequence[Sequence], key: Sequence[str], evidence: Column | None = None) -> DataFrame:
    """Metric rows against their registry entry: one row per violation, errors and warnings alike.

    Rows carry metric_key, metric_unit, metric_value (text or number) and metric_scope.
    """
    table = broadcast_rules(rule_frame(rows.sparkSession, REGISTRY_COLUMNS, registry), len(registry))
    joined = rows.join(table, "metric_key", "left")
    registered = F.col("reg_unit").isNotNull()
    number = F.col("metric_value").try_cast("double")
    given = F.col("metric_value").isNotNull()
    checks = {
        "unregistered_metric": ~registered,
        "unit_mismatch": registered & ~F.col("metric_unit").eqNullSafe(F.col("reg_unit")),
        "not_numeric": registered & given & number.isNull(),
        "below_minimum": number < F.col("min_value"),
        "above_maximum": number > F.col("max_value"),
        "scope_missing": F.col("needs_scope") & (F.coalesce(F.col("metric_scope"), F.lit("")) == ""),
    }
    if evidence is not None:
        checks["evidence_missing"] = ~evidence
    return joined.select(*key, "metric_key", F.explode(column_checks(checks)).alias("violation"))


def metadata_checks(url: Column, source_date: Column, availability_date: Column) -> dict[str, Column]:
    """Source columns: http(s) address, ISO dates, and no availability before the source date."""
    first, second = F.try_to_date(source_date, "yyyy-MM-dd"), F.try_to_date(availability_date, "yyyy-MM-dd")
    return {
        "bad_source_url": ~F.coalesce(url.rlike("^https?://[^/]+"), F.lit(False)),
        "bad_source_date": first.isNull(),
        "bad_availability_date": second.isNull(),
        "available_before_source": first > second,
    }


def count_violations(df: DataFrame, checks: Mapping[str, Column], group: Sequence[str] = ()) -> DataFrame:
    """How often each check fails; counted in one pass and turned to rows at the end."""
    counted = df.groupBy(*group).agg(*[F.count_if(c).alias(name) for name, c in checks.items()], F.count(F.lit(1)).alias("checked_rows"))
    return counted.unpivot([*group, "checked_rows"], list(checks), "violation", "row_count").filter(F.col("row_count") > 0)


def difference_counts(compared: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long summary of a two-sided comparison: rows per side and differing rows per column."""
    wide = compared.agg(
        F.count_if(F.col("side") == "matched").alias("matched"),
        F.count_if(F.col("side") == "package_only").alias("package_only"),
        F.count_if(F.col("side") == "core_only").alias("core_only"),
        *[F.count_if(F.array_contains("differences", c)).alias(f"differs_{c}") for c in columns],
        F.count_if(F.size("differences") > 0).alias("drifted"),
    )
    names = ["matched", "package_only", "core_only", *[f"differs_{c}" for c in columns], "drifted"]
    return wide.unpivot([], names, "measure", "row_count")


def range_report(df: DataFrame, score: Column) -> DataFrame:
    """Rows, scores outside 0-100 and missing scores."""
    return df.agg(
        F.count(F.lit(1)).alias("mart_rows"), F.count_if(~score.between(0, 100)).alias("out_of_range"), F.count_if(score.isNull()).alias("null_scores")
    )


def json_is_valid(c: Column) -> Column:
    """Whether the text is a JSON object."""
    return F.coalesce(F.json_object_keys(c).isNotNull(), F.lit(False))


def source_health(df: DataFrame, source: str, check: str, status: Column, remedy: Column) -> DataFrame:
    """Per source: blocked checks, distinct reasons and remedies, and the flags raised by any check.

    Reasons come from a status vocabulary, so the distinct lists are short.
    """
    blocked = status.startswith("blocked")
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("check_count"),
        F.count_if(blocked).alias("blocked_count"),
        F.when(F.bool_or(blocked), "blocked").otherwise("healthy").alias("health_status"),
        F.array_join(F.array_sort(F.collect_set(F.when(blocked, status))), "; ").alias("blocked_reason"),
        F.array_join(F.array_sort(F.collect_set(F.when(blocked, remedy))), "; ").alias("recovery_reason"),
        F.bool_or(blocked & (F.col(check) == "content_hash")).alias("hash_changed"),
        F.bool_or(blocked & (F.col(check) == "response_schema")).alias("schema_changed"),
    )


def release_blockers(df: DataFrame) -> Column:
    """Codes that keep a package from release, from its evidence columns."""
    return F.array_compact(
        F.array(
            F.when(F.col("row_count").isNull() | (F.col("row_count") == 0), "target_tables_missing"),
            F.when(F.coalesce("error_count", F.lit(0)) > 0, "quality_report_errors"),
            F.when(F.col("load_mode") == "unspecified", "load_mode_missing"),
            F.when(F.col("readiness") != "passed", "readiness_not_passed"),
            F.when(~F.col("review").isin("passed", "not_required"), "review_reconciliation_not_passed"),
        )
    )


def semantic_hints(df: DataFrame, text: str, metric: str, markers: Mapping[str, Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """A row per marker of the row's metric that occurs in its text."""
    found = []
    for key, words in markers.items():
        for word in words:
            found.append(F.when((F.col(metric) == key) & F.col(text).contains(word), F.struct(F.lit(f"{key}_semantic_proxy").alias("hint_code"), F.lit(word).alias("evidence"))))
    return df.select(*keep, F.explode(F.array_compact(F.array(*found))).alias("h")).select(*keep, "h.*")


def collapse_hints(hints: DataFrame, key: Sequence[str], ordinal: str) -> DataFrame:
    """Distinct evidence per key in order of first appearance, one row each; no list per key is built."""
    return hints.groupBy(*key, "hint_code", "evidence").agg(F.min(ordinal).alias("first_ordinal"), F.count(F.lit(1)).alias("hint_rows"))


# The buckets of a portfolio.
PORTFOLIO_BUCKETS = ("required_available", "required_unavailable", "easy_but_underused", "optional_enhancement", "not_for_formal_recommendation")


def classify_portfolio(domains: DataFrame, coverage: DataFrame, area: str) -> DataFrame:
    """Bucket of every domain, and the blocker of a required one that cannot be had.

    A required domain follows the coverage of its area: passed makes it available, anything else unavailable. Without coverage of
    its area, and where it is not required, a domain keeps its declared class; a class that is no bucket counts as optional.
    """
    joined = domains.join(coverage.select(area, "coverage_rate", "area_status"), area, "left")
    required, measured = F.col("importance") == "required", F.col("area_status").isNotNull()
    declared = F.when(F.col("declared").isin(*PORTFOLIO_BUCKETS), F.col("declared")).otherwise("optional_enhancement")
    passed = F.col("area_status") == "passed"
    bucket = first_match([(required & measured & passed, "required_available"), (required & measured, "required_unavailable")], declared)
    unavailable = required & (F.col("bucket") == "required_unavailable")
    blocker = F.when(unavailable, F.concat(F.upper("domain"), F.lit("_NOT_OPERATIONAL"))).otherwise("")
    return joined.withColumn("bucket", bucket).withColumn("blocker_code", blocker)
