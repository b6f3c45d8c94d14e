"""Marts: scores per entity composed from the scoring, matching and sequence operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scoring import capped_share, clip, range_score, weighted_mean
from plumbline.functions.values import alias_form
from plumbline.operators import aggregate as a
from plumbline.rules import broadcast_rules, first_match, rule_frame


def career_scores(signals: DataFrame, group: Sequence[str], order: Sequence[str], rules: Sequence[Sequence], minimum_signals: int) -> DataFrame:
    """Score per entity from the latest row of each metric: component means, the weighted score, reasons, lineage.

    Signals carry metric_key, metric_value and source_date. Metrics without a rule are named as
    unused; a metric without weight still counts for its component.
    """
    key = [*group, "metric_key"]
    latest = a.latest_by(signals, key, ["metric_value", "source_date"], order)
    table = broadcast_rules(rule_frame(signals.sparkSession, a.RULE_COLUMNS, rules), len(rules))
    joined = latest.join(table, "metric_key", "left")
    has_rule = F.col("component").isNotNull()
    score = F.when(has_rule, range_score(F.col("metric_value"), F.col("low"), F.col("high"), F.col("polarity")))
    scored = joined.withColumn("metric_score", score)
    components = sorted({r[1] for r in rules})
    unused = F.array_join(F.array_sort(F.collect_set(F.when(~has_rule, F.concat(F.lit("unused_metric:"), "metric_key")))), "|")
    out = scored.groupBy(*group).agg(
        weighted_mean(F.col("metric_score"), F.col("weight")).alias("weighted_score"),
        *[F.avg(F.when(F.col("component") == c, F.col("metric_score"))).alias(f"{c}_score") for c in components],
        F.count(F.lit(1)).alias("signal_count"),
        unused.alias("_unused"),
        F.max("source_date").alias("source_date"),
    )
    few = F.when(F.col("signal_count") < minimum_signals, "below_minimum_signal_count")
    return out.withColumn("reason_codes", F.concat_ws("|", F.nullif(F.col("_unused"), F.lit("")), few)).drop("_unused")


def proximity_score(nearest_km: Column, max_km: float, zone_count: Column, fallback: float) -> Column:
    """Closer is better, 0 from max_km on; no zone gives null, zones without usable coordinates the fallback."""
    near = clip((F.lit(max_km) - nearest_km) / F.lit(max_km) * 100.0)
    return F.when(F.coalesce(zone_count, F.lit(0)) > 0, F.coalesce(near, F.lit(fallback)))


def weighted_overall(components: Mapping[str, float]) -> Column:
    """Weighted mean over the component columns that are not null; 0 when all are."""
    value = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in components.items()), F.lit(0.0))
    total = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0) for c, w in components.items()), F.lit(0.0))
    return F.coalesce(value / F.nullif(total, F.lit(0.0)), F.lit(0.0))


def flexibility_score(role_count: Column, type_count: Column, max_roles: int, bonus: float) -> Column:
    coverage = capped_share(role_count, float(max_roles))
    extra = F.least(F.lit(bonus), F.greatest(F.lit(0), type_count - 1) * F.lit(bonus / 2))
    return F.least(F.lit(100.0), coverage + extra)


def role_summary(roles: DataFrame, major: str, confidence: Column, fits: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per major: confidence-weighted fit of the allowed role types, role and type counts, and flags."""
    aggs = [
        weighted_mean(F.when(F.col("role_type").isin(*types), F.col("fit")), confidence).alias(name) for name, types in fits.items()
    ]
    return roles.groupBy(major).agg(
        *aggs,
        F.count_distinct("role_key").alias("roles"),
        F.count_distinct("role_type").alias("role_types"),
        F.bool_or(F.col("role_type") == "generalist").alias("has_generalist"),
    )


def aliases_of(entities: DataFrame, id_col: str, names: Sequence[str]) -> DataFrame:
    """One row per distinct alias and entity type; the last entity id keeps a contested alias."""
    long = entities.select(id_col, "entity_type", F.explode(F.array(*[F.col(n) for n in names])).alias("alias")).filter(F.coalesce("alias", F.lit("")) != "")
    keyed = long.withColumn("alias_key", alias_form(F.col("alias")))
    return keyed.groupBy("entity_type", "alias_key").agg(F.max(id_col).alias(id_col), F.count_distinct(id_col).alias("claims"))


def canonical_names(df: DataFrame, key: str, name: str) -> DataFrame:
    """The longest name per key, the first in order among equals."""
    return df.groupBy(key).agg(F.min_by(name, F.struct(-F.length(name), F.col(name))).alias(name))


def importable(plan: DataFrame, statuses: Sequence[str], allow_partial: bool) -> DataFrame:
    """Completed plan rows with a value; partial ones only when allowed, and marked."""
    wanted = [*statuses, "partial"] if allow_partial else list(statuses)
    rows = plan.filter(F.col("status").isin(*wanted) & F.col("metric_value").isNotNull())
    return rows.withColumn("is_importable", F.col("status").isin(*statuses))


def year_status(projection: Column, distribution: Column) -> Column:
    """Whether a year's history can be derived from its two sources."""
    return first_match(
        [
            ((projection > 0) & (distribution > 0), "derivable"),
            (projection > 0, "distribution_missing"),
            (distribution > 0, "projection_missing"),
        ],
        "no_source",
    )
