"""Two tables of one fact: plan the differences, decide them, publish or delete the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.values import append_note, stable_id
from plumbline.operators.joins import two_sided
from plumbline.rules import all_of, first_match

PLAN_STATUS = "todo"
PENDING = ("todo", "pending", "needs_review")


@dataclass(frozen=True)
class Reconcile:
    """What is compared: key = match + variant; ``issues`` is issue -> (priority, confidence, action)."""

    match: tuple[str, ...]
    variant: tuple[str, ...]
    compare: tuple[str, ...]
    scope: tuple[str, ...]
    issues: Mapping[str, tuple[int, str, str]]
    placeholder: Mapping[str, Sequence] = field(default_factory=dict)
    rekey: bool = True

    @property
    def key(self) -> list[str]:
        return [*self.match, *self.variant]


def differing(spec: Reconcile) -> Column:
    """Names of the compared columns whose two values differ; null equals null."""
    return F.array_compact(
        F.array(*[F.when(~F.col(f"package.{c}").eqNullSafe(F.col(f"core.{c}")), F.lit(c)) for c in spec.compare])
    )


def compare_tables(package: DataFrame, core: DataFrame, spec: Reconcile) -> DataFrame:
    """Every key of either side with the side, both rows and the differing columns of matched keys."""
    sides = two_sided(package, core, spec.key)
    return sides.withColumn("differences", F.when(F.col("side") == "matched", differing(spec)).otherwise(F.array().cast("array<string>")))


def reconciliation_plan(package: DataFrame, core: DataFrame, spec: Reconcile) -> DataFrame:
    """One review task per difference.

    Matched keys with other values drift. A package-only key whose match columns occur among the
    core-only keys is a re-key candidate, and those core keys are not listed again. Candidates
    are described per match group by count and first variant, so no pairs are written.
    """
    rows = compare_tables(package, core, spec)
    in_package, in_core = F.col("side") == "package_only", F.col("side") == "core_only"
    scope_is_match = set(spec.scope) == set(spec.match)
    if not scope_is_match:
        scopes = package.select(*spec.scope, F.lit(True).alias("_in_scope")).distinct()
        rows = rows.join(scopes, list(spec.scope), "left").filter(~in_core | F.col("_in_scope"))
    groups = rows.groupBy(*spec.match).agg(
        F.count_if(~in_core).alias("_package_rows"),
        F.count_if(in_package).alias("_package_only"),
        F.count_if(in_core).alias("_core_only"),
        F.min(F.when(in_core, F.struct(*spec.variant))).alias("_first"),
    )
    tasks = rows.filter(~((F.col("side") == "matched") & (F.size("differences") == 0))).join(groups, list(spec.match))
    if scope_is_match:
        tasks = tasks.filter(~in_core | (F.col("_package_rows") > 0))
    has_core, has_package = (F.col("_core_only") > 0) & spec.rekey, (F.col("_package_only") > 0) & spec.rekey
    is_placeholder = all_of(F.col(f"core.{c}").isin(*values) for c, values in spec.placeholder.items()) if spec.placeholder else F.lit(False)
    issue = first_match(
        [
            (F.col("side") == "matched", "value_drift"),
            (in_package & has_core, "rekey_candidate"),
            (in_package, "package_only_unmatched"),
            (in_core & has_package, None),
            (in_core & is_placeholder, "zero_placeholder"),
            (in_core, "core_only_unmatched"),
        ]
    )
    tasks = tasks.withColumn("issue_type", issue).filter(F.col("issue_type").isNotNull())
    rekeyed = F.col("issue_type") == "rekey_candidate"
    own = F.struct(*spec.variant)
    package_variant = F.when(~in_core, own)
    core_variant = F.when(rekeyed, F.col("_first")).when(in_package, None).otherwise(own)
    chosen = {k: first_match([(F.col("issue_type") == i, v[n]) for i, v in spec.issues.items()]) for n, k in enumerate(("priority", "match_confidence", "suggested_action"))}
    values = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in spec.compare for side in ("package", "core")]
    variants = [v for c in spec.variant for v in (package_variant[c].alias(f"package_{c}"), core_variant[c].alias(f"core_{c}"))]
    key = [F.col(c) for c in spec.match]
    ids = stable_id(F.col("issue_type"), *key, *[package_variant[c] for c in spec.variant], *[core_variant[c] for c in spec.variant])
    return tasks.select(
        ids.alias("task_id"),
        "issue_type",
        *[c.alias(k) for k, c in chosen.items()],
        F.lit(PLAN_STATUS).alias("status"),
        *spec.match,
        *variants,
        *values,
        F.when(rekeyed, F.col("_core_only")).otherwise(0).alias("candidate_count"),
        F.array_join("differences", "|").alias("differences"),
        F.lit("").alias("review_decision"),
        F.lit("").alias("reviewer"),
        F.lit("").alias("notes"),
    )


@dataclass(frozen=True)
class AutoRule:
    rule_id: str
    issue_type: str
    review_decision: str
    match_confidence: str | None = None
    required: Mapping[str, object] = field(default_factory=dict)
    candidate_count: int | None = None
    reference_side: str | None = None
    status: str = "decided"
    note: str = ""


def corroborated(plan: DataFrame, reference: DataFrame, spec: Reconcile, side: str) -> DataFrame:
    """Flag ``<side>_corroborated``: the reference has the side's key with the same values."""
    ref = reference.select(
        *spec.match, *[F.col(c).alias(f"{side}_{c}") for c in spec.variant], F.struct(*spec.compare).alias("_ref")
    )
    joined = plan.join(ref, [*spec.match, *[f"{side}_{c}" for c in spec.variant]], "left")
    same = all_of(F.col(f"_ref.{c}") == F.col(f"{side}_{c}") for c in spec.compare)
    return joined.withColumn(f"{side}_corroborated", F.coalesce(same, F.lit(False))).drop("_ref")


def auto_decide(plan: DataFrame, rules: Sequence[AutoRule], limit: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """First matching rule decides a pending task; with a limit, only the first tasks in plan order."""

    def matches(rule: AutoRule) -> Column:
        tests = [F.col("issue_type") == rule.issue_type]
        if rule.match_confidence:
            tests.append(F.col("match_confidence") == rule.match_confidence)
        tests += [F.col(c) == v for c, v in rule.required.items()]
        if rule.candidate_count is not None:
            tests.append(F.col("candidate_count") == rule.candidate_count)
        if rule.reference_side:
            tests.append(F.col(f"{rule.reference_side}_corroborated"))
        return all_of(tests)

    pending = F.col("status").isin(*PENDING)
    fired = first_match([(pending & matches(r), r.rule_id) for r in rules])
    marked = plan.withColumn("auto_rule", fired)
    if limit is not None:
        first = marked.filter(F.col("auto_rule").isNotNull()).orderBy(*order).limit(limit).select("task_id", F.lit(True).alias("_taken"))
        marked = marked.join(F.broadcast(first) if limit <= 10_000 else first, "task_id", "left")
        marked = marked.withColumn("auto_rule", F.when(F.col("_taken"), F.col("auto_rule"))).drop("_taken")

    def pick(value):
        return first_match([(F.col("auto_rule") == r.rule_id, value(r)) for r in rules])

    note = F.concat(F.lit("auto_rule="), F.col("auto_rule"), F.lit("; "), pick(lambda r: r.note))
    hit = F.col("auto_rule").isNotNull()
    return (
        marked.withColumn("status", F.when(hit, pick(lambda r: r.status)).otherwise(F.col("status")))
        .withColumn("review_decision", F.when(hit, pick(lambda r: r.review_decision)).otherwise(F.col("review_decision")))
        .withColumn("reviewer", F.when(hit, F.lit("auto")).otherwise(F.col("reviewer")))
        .withColumn("notes", F.when(hit, append_note(F.col("notes"), note)).otherwise(F.col("notes")))
    )


def decide_by_name(tasks: DataFrame, names: DataFrame, candidates: DataFrame, scope: Sequence[str], key: str) -> DataFrame:
    """Re-key tasks whose name occurs exactly once among the candidates of their scope.

    ``names`` gives the task's own name, ``candidates`` holds scope, name and candidate key; the
    candidates are counted per scope and name, so a large scope is not paired out.
    """
    per_name = candidates.groupBy(*scope, "name").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("matched_key"))
    joined = tasks.join(names, "task_id", "left").join(per_name, [*scope, "name"], "left")
    return joined.withColumn("matched_key", F.when(F.col("_n") == 1, F.col("matched_key"))).drop("_n")


CLAIMABLE = ("", "use_package", "map_to_core_key")


def pair_claims(
    plan: DataFrame, core_names: DataFrame, candidates: DataFrame, scope: Sequence[str], spec: Reconcile, order: Sequence[str] = ("task_id",), limit: int | None = None
) -> DataFrame:
    """One row per pending core-only task: core_task, package_task (of the package row that it claims, if it counts) and reason.

    core_names: task_id and name of core-only tasks; candidates: all package rows, scope, name and key. A task claims the one
    package row of its name in its scope. Whether the claim counts is up to the row's own task: an open or mapped package-only
    row takes any number of claims; a drifted row that was decided for the package takes the first claim in plan order, since
    it is re-mapped from then on; others take none. With a limit, the first claims in plan order count.
    """
    key = [F.col(c) for c in spec.key]
    one = candidates.filter(F.col("name") != "").groupBy(*scope, "name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*key)).alias("claimed"))
    opened = (F.col("issue_type") == "core_only_unmatched") & F.col("status").isin(*PENDING)
    core = plan.filter(opened).select(F.col("task_id").alias("core_task"), F.struct(*[F.col(c) for c in order]).alias("place"), *scope)
    named = core.join(core_names.select(F.col("task_id").alias("core_task"), "name"), "core_task", "left").join(one, [*scope, "name"], "left")
    of_key = F.struct(*spec.match, *[F.col(f"package_{c}").alias(c) for c in spec.variant]).alias("claimed")
    sides = plan.filter(F.col(f"package_{spec.variant[0]}").isNotNull())
    sides = sides.select(of_key, F.struct(F.col("task_id").alias("task"), F.col("issue_type").alias("issue"), "status", "review_decision").alias("side"))
    met = named.withColumn("claimed", F.when(F.col("n") == 1, F.col("claimed"))).join(sides, "claimed", "left")
    said = F.coalesce("side.review_decision", F.lit(""))
    other = lambda *parts: F.concat_ws(":", F.lit("has_other_task"), *parts)
    drifted = F.col("side.issue") == "value_drift"
    reason = first_match(
        [
            (F.coalesce("name", F.lit("")) == "", "missing_core_name"),
            (F.col("n").isNull(), "no_match"),
            (F.col("n") > 1, "ambiguous_match"),
            (F.col("side").isNull(), "no_plan_task"),
            ((F.col("side.issue") == "package_only_unmatched") & said.isin(*CLAIMABLE), "exact_pair"),
            (F.col("side.issue") == "package_only_unmatched", "blocked_decision"),
            (drifted & (F.col("side.status") == "decided") & (said == "use_package"), "exact_drift_pair"),
        ],
        other(F.col("side.issue"), F.col("side.status"), said),
    )
    told = met.select("core_task", "place", F.col("side.task").alias("package_task"), reason.alias("reason"))
    # the first claim alone re-maps a drifted row
    first = told.filter("reason = 'exact_drift_pair'").groupBy("package_task").agg(F.min(F.struct("place", "core_task")).alias("first"))
    late = (F.col("reason") == "exact_drift_pair") & (F.col("first.core_task") != F.col("core_task"))
    told = told.join(first, "package_task", "left").withColumn("reason", F.when(late, other(F.lit("value_drift"), F.lit("decided"), F.lit("remap_core"))).otherwise(F.col("reason")))
    counts = F.col("reason").isin("exact_pair", "exact_drift_pair")
    if limit is not None:
        taken = told.filter(counts).orderBy("place").limit(limit).select("core_task", F.lit(True).alias("taken"))
        told = told.join(taken, "core_task", "left")
        counts = F.coalesce("taken", F.lit(False))
        told = told.withColumn("reason", F.when(F.col("reason").isin("exact_pair", "exact_drift_pair") & ~counts, "over_limit").otherwise(F.col("reason")))
    return told.select("core_task", F.when(counts, F.col("package_task")).alias("package_task"), "place", "reason")


def apply_pairs(plan: DataFrame, pairs: DataFrame, spec: Reconcile) -> DataFrame:
    """Both rows of every pair (core_task, package_task; place and reason as from pair_claims) are decided and carry the id of the
    other row.

    The package row is to replace the core row: it carries the core row's key as ``paired_key``, that of the last claim in plan
    order. A drifted package row leaves its own core row behind, which is to be deleted (remap_core). Every core row with a claim
    is covered and calls for nothing of its own.
    """
    place = F.col("place") if "place" in pairs.columns else F.struct("core_task")
    drift = F.col("reason") == "exact_drift_pair" if "reason" in pairs.columns else F.lit(False)
    own = plan.select(F.col("task_id").alias("core_task"), F.struct(*spec.match, *[F.col(f"core_{c}").alias(c) for c in spec.variant]).alias("key"))
    keyed = pairs.filter(F.col("package_task").isNotNull()).select("core_task", "package_task", place.alias("place"), drift.alias("drift")).join(own, "core_task")
    last = keyed.groupBy("package_task").agg(F.max_by(F.struct("core_task", "key", "drift"), F.struct("place", "core_task")).alias("last"))
    package = last.select(F.col("package_task").alias("task_id"), F.col("last.core_task").alias("paired_task"), F.col("last.key").alias("paired_key"), F.col("last.drift").alias("drift"))
    core = keyed.select(F.col("core_task").alias("task_id"), F.col("package_task").alias("paired_task"), F.when(F.lit(False), F.col("key")).alias("paired_key"), "drift")
    joined = plan.join(package.unionByName(core), "task_id", "left")
    hit = F.col("paired_task").isNotNull()
    decision = F.when(F.col("paired_key").isNull(), "pair_covered").when(F.col("drift"), "remap_core").otherwise("pair_replace")
    return joined.withColumn("status", F.when(hit, "decided").otherwise(F.col("status"))).withColumn(
        "review_decision", F.when(hit, decision).otherwise(F.col("review_decision"))
    ).drop("drift")


def publish(plan: DataFrame, spec: Reconcile) -> DataFrame:
    """Rows to publish from decided tasks: the package row, the core row, or the package row under a core key, its own or its pair's."""
    decision = F.col("review_decision")
    paired = decision.isin("pair_replace", "remap_core") & F.col("paired_key").isNotNull() if "paired_key" in plan.columns else F.lit(False)
    rows = plan.filter(paired | decision.isin("use_package", "keep_core", "map_to_core_key"))
    from_core = decision == "keep_core"
    core_key = from_core | (decision == "map_to_core_key")
    variant = {c: F.when(core_key, F.col(f"core_{c}")).otherwise(F.col(f"package_{c}")) for c in spec.variant}
    key = {**{c: F.col(c) for c in spec.match}, **variant}
    if "paired_key" in plan.columns:
        key = {c: F.when(paired, F.col(f"paired_key.{c}")).otherwise(v) for c, v in key.items()}
    return rows.select(
        "task_id",
        *[v.alias(c) for c, v in key.items()],
        *[F.when(from_core, F.col(f"core_{c}")).otherwise(F.col(f"package_{c}")).alias(c) for c in spec.compare],
    )


def ambiguous_publications(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that more than one decided task would publish."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("task_count")).filter("task_count > 1")


def delete_plan(plan: DataFrame, spec: Reconcile) -> DataFrame:
    """Core keys to remove: excluded placeholders, and originals whose value was moved to another core key.

    A core row that a pair covers is kept. Tasks that are open or blocked fail the job, and so does a key that two tasks would
    delete.
    """
    opened = F.coalesce(F.col("status").isin("todo", "blocked"), F.lit(True))
    ready = F.when(opened, F.raise_error(F.concat(F.lit("task is not decided: "), F.col("task_id").cast("string"))).cast("boolean")).otherwise(True)
    decision = F.col("review_decision")
    rows = plan.filter(ready).filter(decision.isin("exclude_core", "remap_core")).filter(F.col(f"core_{spec.variant[0]}").isNotNull())
    key = [*spec.match, *[F.col(f"core_{c}").alias(c) for c in spec.variant]]
    found = rows.select(*key, F.when(decision == "exclude_core", "excluded").otherwise("rekeyed").alias("reason")).groupBy(*spec.key)
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("a core key is deleted twice"))).otherwise(F.min("reason"))
    return found.agg(once.alias("reason"), F.count(F.lit(1)).alias("task_count"))
