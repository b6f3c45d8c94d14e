"""Review queues: batches out, edits in, readiness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.rules import any_of


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per group; Spark cuts each map task to ``k`` rows per group before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= k).drop("_rn")


def capped_or_seeded(df: DataFrame, group: Sequence[str], order: Sequence[Column], cap: int, seeded: Column) -> DataFrame:
    """Rows up to the cap per group in order, and every seeded row.

    Emitted seeded rows use up the cap, so an unseeded row passes exactly when its place in the
    whole order is within it.
    """
    rn = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rn", rn).filter((F.col("_rn") <= cap) | F.coalesce(seeded, F.lit(False))).drop("_rn")


def typed_order(rules: Sequence[tuple[str, str, str]]) -> list[Column]:
    """Sort columns from (column, number or text, asc or desc); missing values come last."""
    out = []
    for name, kind, direction in rules:
        c = F.col(name).try_cast("double") if kind == "number" else F.nullif(F.col(name).cast("string"), F.lit(""))
        out.append(F.desc_nulls_last(c) if direction == "desc" else F.asc_nulls_last(c))
    return out


def batch_problems(plan: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """What keeps a batch from being merged: blank, duplicate and unknown keys, one row per key."""
    counts = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
    blank = any_of(F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in key)
    known = plan.select(*key, F.lit(True).alias("_known")).distinct()
    checked = counts.join(known, list(key), "left")
    problems = F.array_compact(
        F.array(
            F.when(blank, "blank_key"),
            F.when(F.col("row_count") > 1, "duplicate_key"),
            F.when(~blank & F.col("_known").isNull(), "unknown_key"),
        )
    )
    return checked.select(*key, "row_count", F.explode(problems).alias("problem"))


def merge_batch(
    plan: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    editable: Sequence[str],
    only_if: Column | None = None,
    blank_keeps: bool = False,
    unknown_keys: str = "fail",
) -> DataFrame:
    """Plan with the editable columns taken from the batch row of the same key, ``is_changed`` and ``changed_cells``.

    A row that the batch holds is taken over in full: a blank or missing batch value clears the cell, unless ``blank_keeps``.
    Text keys of both sides are compared without surrounding blanks. ``only_if`` restricts which plan rows may change. Blank and
    repeated batch keys fail the job, and so do keys that the plan lacks, unless ``unknown_keys`` is ``ignore``.
    """
    trimmed = {c: F.trim(c) if plan.schema[c].dataType.typeName() == "string" else F.col(c) for c in key}
    edits = batch.select(*[trimmed[c].alias(c) for c in key], *editable).groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(f"_new_{c}") for c in editable]
    )
    blank = any_of(F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in key)
    problem = F.when(blank, "blank key in batch").when(F.col("_rows") > 1, F.concat(F.lit("duplicate key in batch: "), F.concat_ws("|", *[F.col(c).cast("string") for c in key])))
    # the check is the hit flag itself, so no plan that uses the edits can leave it out
    edits = edits.withColumn("_hit", F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(True)).drop("_rows")
    keyed = plan.select("*", *[trimmed[c].alias(f"_key_{c}") for c in key])
    edits = edits.select(*[F.col(c).alias(f"_key_{c}") for c in key], *[c for c in edits.columns if c not in key])
    on = [f"_key_{c}" for c in key]
    if unknown_keys == "ignore":
        joined = keyed.join(edits, on, "left")
    else:
        joined = keyed.withColumn("_known", F.lit(True)).join(edits, on, "full")
        unknown = F.raise_error(F.concat(F.lit("unknown key in batch: "), F.concat_ws("|", *[F.col(c).cast("string") for c in on])))
        joined = joined.filter(F.when(F.col("_known").isNull(), unknown.cast("boolean")).otherwise(True))
    may = F.coalesce(F.col("_hit"), F.lit(False))
    if only_if is not None:
        may = may & only_if
    joined = joined.withColumn("_may", may)
    filled = {c: F.col(f"_new_{c}").isNotNull() & (F.col(f"_new_{c}").cast("string") != "") for c in editable}
    new = {c: F.when(F.col("_may") & (filled[c] if blank_keeps else F.lit(True)), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in editable}
    differs = [F.coalesce(new[c].cast("string"), F.lit("")) != F.coalesce(F.col(c).cast("string"), F.lit("")) for c in editable]
    cells = sum((d.cast("int") for d in differs), F.lit(0))
    kept = [F.col(c) for c in plan.columns if c not in editable]
    return joined.select(*kept, *[new[c].alias(c) for c in editable], (cells > 0).alias("is_changed"), cells.alias("changed_cells"))


def unmatched_rows(batch: DataFrame, plan: DataFrame, key: Sequence[str]) -> DataFrame:
    return batch.join(plan.select(*key), list(key), "left_anti")


def column_checks(checks: Mapping[str, Column]) -> Column:
    """Array of the names of the checks that fail on a row; a null check does not fail."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))


def violations(df: DataFrame, key: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """One row per failed check."""
    return df.select(*key, F.explode(column_checks(checks)).alias("violation"))


def plan_readiness(
    df: DataFrame, group: Sequence[str], checks: Mapping[str, Column], done: Column, blocked: Column
) -> DataFrame:
    """Progress and failed checks per group, and whether the group may move on."""
    marked = df.withColumn("_failed", F.size(column_checks(checks)))
    out = marked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(done).alias("done_rows"),
        F.count_if(blocked).alias("blocked_rows"),
        F.sum("_failed").alias("failed_checks"),
    )
    return out.withColumn("is_ready", (F.col("done_rows") + F.col("blocked_rows") == F.col("total_rows")) & (F.col("failed_checks") == 0))
