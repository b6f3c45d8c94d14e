"""Grouped summaries. Every group-by pre-aggregates on the map side, so hot keys stay small;
lists are only collected where their length is bounded by a rule table or by a top-N."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scoring import capped_share, range_score, weighted_mean
from plumbline.operators.sequence import carried, in_stretches
from plumbline.rules import all_of, broadcast_rules, first_match, rule_frame
from plumbline.session import cut_lineage


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Row count, distinct keys and the surplus; null is an ordinary key value."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_keys"), (F.sum("n") - F.count(F.lit(1))).alias("duplicate_keys")
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column with the number of null or empty values, in one pass."""
    counted = df.agg(*[F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_count")


RULE_COLUMNS = ("metric_key", "component", "weight", "low", "high", "polarity")


def score_metrics(metrics: DataFrame, rules: Sequence[Sequence]) -> DataFrame:
    """Metric rows with score, weight and component; metrics without a rule drop out. Two rules for one metric are an error."""
    keys = [r[0] for r in rules]
    if len(set(keys)) < len(keys):
        raise ValueError(f"metrics with several rules: {sorted({k for k in keys if keys.count(k) > 1})}")
    joined = metrics.join(broadcast_rules(rule_frame(metrics.sparkSession, RULE_COLUMNS, rules), len(rules)), "metric_key")
    score = range_score(F.col("metric_value"), F.col("low"), F.col("high"), F.col("polarity"))
    return joined.withColumn("metric_score", score).drop("low", "high", "polarity")


def component_scores(scored: DataFrame, group: Sequence[str]) -> DataFrame:
    """Weighted mean per component; components without weight do not appear."""
    usable = scored.filter((F.col("weight") > 0) & (F.col("component") != ""))
    return usable.groupBy(*group, "component").agg(weighted_mean(F.col("metric_score"), F.col("weight")).alias("component_score"))


def merge_components(sources: Sequence[DataFrame], group: Sequence[str]) -> DataFrame:
    """Plain mean of the component over the sources that have it."""
    stacked = sources[0]
    for s in sources[1:]:
        stacked = stacked.unionByName(s)
    return stacked.groupBy(*group, "component").agg(F.avg("component_score").alias("component_score"))


def overall_scores(
    components: DataFrame,
    group: Sequence[str],
    weights: Mapping[str, float],
    strong: float = 70.0,
    weak: float = 35.0,
    minimum_components: int = 2,
) -> DataFrame:
    """One row per entity: each component, the overall score and the reason codes.

    Weights are few and known, so the pivot is an aggregate with one column per component.
    """
    wide = components.groupBy(*group).agg(
        *[F.max(F.when(F.col("component") == c, F.col("component_score"))).alias(c) for c in weights],
        F.count_if(F.col("component_score").isNotNull()).alias("component_count"),
    )
    total = sum((F.when(F.col(c).isNotNull(), F.lit(float(w))).otherwise(0.0) for c, w in weights.items() if w > 0), F.lit(0.0))
    value = sum((F.coalesce(F.col(c) * float(w), F.lit(0.0)) for c, w in weights.items() if w > 0), F.lit(0.0))
    overall = F.coalesce(value / F.nullif(total, F.lit(0.0)), F.lit(0.0))
    return wide.withColumn("overall_score", overall).withColumn(
        "reason_codes", reason_codes({c: F.col(c) for c in weights}, F.col("component_count") < minimum_components, strong, weak)
    )


def reason_codes(components: Mapping[str, Column], below_minimum: Column, strong: float, weak: float, *extra: tuple[Column, str]) -> Column:
    """Codes joined by ``|``: too few signals first, then each component's strength in name order."""
    parts = [F.when(below_minimum, "below_minimum_component_count")]
    for name in sorted(components):
        c = components[name]
        parts.append(F.when(c >= strong, f"{name}_strong").when(c < weak, f"{name}_weak"))
    parts += [F.when(p, code) for p, code in extra]
    return F.array_join(F.array_compact(F.array(*parts)), "|")


def counts_within_radius(pois: DataFrame, rules: Sequence[Sequence], group: Sequence[str]) -> DataFrame:
    """Distinct points per category inside the category's radius, as a share of its cap."""
    table = rule_frame(pois.sparkSession, ("category", "component", "weight", "radius", "max_count"), rules)
    near = pois.join(broadcast_rules(table, len(rules)), "category").filter(F.col("distance") <= F.col("radius"))
    counted = near.groupBy(*group, "category", "component", "weight", "max_count").agg(F.count_distinct("poi").alias("poi_count"))
    share = F.least(F.lit(100.0), F.col("poi_count") / F.greatest(F.lit(1.0), F.col("max_count")) * 100.0)
    return counted.withColumn("metric_score", share).drop("max_count")


def weighted_events(df: DataFrame, group: Sequence[str], kind: str, weights: Mapping[str, float], cap: float, subset: Sequence[str], subset_cap: float) -> DataFrame:
    """Weighted event count as a share of a cap, and the same for a subset of the types (null if none)."""
    weight = first_match([(F.col(kind) == k, w) for k, w in weights.items()], 0.0)
    counted = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(weight).alias("weighted_count"), F.count_if(F.col(kind).isin(*subset)).alias("subset_count")
    )
    return counted.withColumn("event_score", capped_share(F.col("weighted_count"), cap)).withColumn(
        "subset_score", F.when(F.col("subset_count") > 0, capped_share(F.col("subset_count"), subset_cap))
    )


def diversity_score(counts: Mapping[str, tuple[float, float]]) -> Column:
    """Sum of capped shares of distinct counts; ``column -> (cap, weight)``."""
    return sum((capped_share(F.col(c), cap) * weight for c, (cap, weight) in counts.items()), F.lit(0.0))


def latest_by(df: DataFrame, key: Sequence[str], value: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Values of the last row per key; ties are settled by the later order columns."""
    best = F.max_by(F.struct(*[F.col(c) for c in value]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*key).agg(best.alias("v")).select(*key, "v.*")


def best_first(df: DataFrame, key: Sequence[str], value: str, score: str, ordinal: str) -> DataFrame:
    """Value with the highest score per key; the lowest ordinal wins a tie."""
    return df.groupBy(*key).agg(
        F.min_by(value, F.struct(-F.col(score), F.col(ordinal))).alias(value), F.max(score).alias(score)
    )


def evidence_samples(df: DataFrame, key: Sequence[str], sample: str, limit: int) -> DataFrame:
    """First ``limit`` distinct samples per key, joined; the window keeps top rows per map task first."""
    distinct = df.select(*key, sample).distinct()
    ranked = distinct.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy(sample))).filter(F.col("rn") <= limit)
    return ranked.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list(sample)), "; ").alias("samples"))


def counters(df: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str]) -> DataFrame:
    """Counts over several key sets: the finest grain is counted once, then rolled up."""
    fine = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    return fine.groupingSets([[F.col(c) for c in s] for s in sets], *dims).agg(F.sum("n").alias("row_count"))


def top_n(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """Most frequent keys; ties in key order."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), *key).limit(n)


def progress(df: DataFrame, group: Sequence[str], done: Column, blocked: Column) -> DataFrame:
    """Totals, completed and blocked rows and the completion rate to four digits."""
    counted = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(done).alias("completed_rows"), F.count_if(blocked).alias("blocked_rows")
    )
    rate = F.floor(F.col("completed_rows") * 10000.0 / F.col("total_rows") + 0.5).cast("double") / 10000.0
    return counted.withColumn("completion_rate", rate)


def nested_counts(df: DataFrame, group: Sequence[str], entity: str, metric: str) -> DataFrame:
    """Rows, distinct entities and a ``metric:count`` list per group; the list is as long as the metric registry."""
    per_metric = df.groupBy(*group, metric).agg(F.count(F.lit(1)).alias("n"))
    nested = per_metric.groupBy(*group).agg(
        F.sum("n").alias("missing_rows"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col(metric), F.col("n")))), "|").alias("metric_counts"),
    )
    entities = df.groupBy(*group).agg(F.count_distinct(entity).alias("entity_count"))
    return nested.join(entities, list(group))


def composition(df: DataFrame, group: Sequence[str], family: str) -> DataFrame:
    """Largest family per group, its share, the number of families and the top three as text.

    Families come from a classification rule, so there are few per group.
    """
    counts = df.groupBy(*group, family).agg(F.count(F.lit(1)).alias("n"))
    listed = counts.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(family).alias("family")))).alias("f"), F.sum("n").alias("total")
    )
    top = F.element_at("f", 1)
    text = F.array_join(F.transform(F.slice("f", 1, 3), lambda e: F.concat_ws(" ", e["family"], -e["m"])), " / ")
    return listed.select(
        *group,
        F.size("f").alias("family_count"),
        top["family"].alias("top_family"),
        (-top["m"]).alias("top_count"),
        F.col("total").alias("total_count"),
        text.alias("summary"),
    )


def delta_bucket(a: Column, b: Column, small: int, medium: int) -> Column:
    """Size class of the difference of two numbers that may be missing."""
    delta = F.abs(a - b)
    return first_match(
        [
            (a.isNull() & b.isNull(), "both_missing"),
            (a.isNull(), "package_missing"),
            (b.isNull(), "core_missing"),
            (delta == 0, "0"),
            (delta <= small, f"<= {small}"),
            (delta <= medium, f"<= {medium}"),
        ],
        f"> {medium}",
    )


def distinct_text(c: str) -> Column:
    """Aggregate: distinct values of a small category, sorted, joined by ``|``."""
    return F.array_join(F.sort_array(F.collect_set(c)), "|")


def gap_summary(df: DataFrame, group: Sequence[str], score: str, sample: int) -> DataFrame:
    """Missing integers between the smallest and largest score of a group: how many, and the largest ones.

    Each score is set beside the one below it, whatever their distance; what is missing is the sum of distances, and the sample
    comes from the highest gaps, of which no more than the sample's size are needed. Null scores are a score row without a gap.
    """
    distinct = in_stretches(df.select(*group, F.col(score).cast("bigint").alias("_score")).distinct(), group, "_score")
    told = carried(distinct, group, "_score", F.col("_score"), "_below").withColumn("_gap", F.greatest(F.col("_score") - F.col("_below") - 1, F.lit(0)))
    told = cut_lineage(told.select(*group, "_score", "_below", "_gap"), "gaps")
    found = told.groupBy(*group).agg(
        F.count(F.lit(1)).alias("score_rows"), F.max("_score").alias("max_score"), F.min("_score").alias("min_score"), F.coalesce(F.sum("_gap"), F.lit(0)).alias("missing_count")
    )
    highest = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_score")))
    gaps = told.filter("_gap > 0").withColumn("_place", highest).filter(F.col("_place") <= sample)
    listed = F.sequence(F.col("_score") - 1, F.greatest(F.col("_below") + 1, F.col("_score") - sample), F.lit(-1).cast("bigint"))
    numbers = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_place", listed.alias("n")))), lambda x: x["n"]))
    text = F.array_join(F.slice(numbers, 1, sample), ",")
    samples = gaps.groupBy(*[F.col(c).alias(f"_{c}") for c in group]).agg(text.alias("missing_sample"))
    same = all_of(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group)
    kind = df.schema[score].dataType
    return found.join(samples, same, "left").select(
        *group,
        "score_rows",
        *[F.col(c).cast(kind).alias(c) for c in ("max_score", "min_score")],
        "missing_count",
        F.coalesce("missing_sample", F.lit("")).alias("missing_sample"),
    )


def inverted_sources(df: DataFrame, registry: DataFrame, metric: str, source: str) -> DataFrame:
    """Sources of every registered metric, with a flag for metrics nobody serves."""
    pairs = df.select(metric, source).distinct()
    found = pairs.groupBy(metric).agg(F.count(F.lit(1)).alias("source_count"), distinct_text(source).alias("sources"))
    out = registry.join(found, metric, "left")
    return out.select(
        metric,
        F.coalesce("source_count", F.lit(0)).alias("source_count"),
        F.coalesce("sources", F.lit("")).alias("sources"),
        F.col("source_count").isNull().alias("is_uncovered"),
    )

