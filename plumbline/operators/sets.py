"""Set operations and merges with precedence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_sets(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every distinct key with ``both``, ``left_only`` or ``right_only``; one aggregation over the stacked keys."""
    stacked = left.select(*key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(right.select(*key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    seen = stacked.groupBy(*key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    part = F.when(F.col("_l") + F.col("_r") == 2, "both").when(F.col("_l") == 1, "left_only").otherwise("right_only")
    return seen.select(*key, part.alias("part"))


def bag_union(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; a column a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def merge_with_precedence(base: DataFrame, supplement: DataFrame, key: Sequence[str], allow_override: bool) -> DataFrame:
    """Base rows plus supplement rows of new keys; on a clash the supplement wins only if allowed.

    ``merge_action`` says what happened: base, added, overridden, or kept (clash ignored).
    """
    columns = [c for c in base.columns if c not in key]
    stacked = base.select(*key, F.struct(*columns).alias("_b")).join(
        supplement.select(*key, F.struct(*columns).alias("_s")), list(key), "full_outer"
    )
    in_base, in_supplement = F.col("_b").isNotNull(), F.col("_s").isNotNull()
    clash = in_base & in_supplement
    action = F.when(clash, "overridden" if allow_override else "kept").when(in_base, "base").otherwise("added")
    row = F.coalesce("_s", "_b") if allow_override else F.coalesce("_b", "_s")
    return stacked.select(*key, row.alias("_row"), action.alias("merge_action")).select(*key, "_row.*", "merge_action")


def promote(existing: DataFrame, approved: DataFrame, name: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Approved rows replace every existing row of their name; the last approved row per key stays."""
    rest = [c for c in approved.columns if c not in key]
    last = approved.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, "_r.*")
    kept = existing.join(approved.select(name).distinct(), name, "left_anti")
    return kept.select(*existing.columns).unionByName(last.select(*existing.columns))


def merge_catalogs(tables: Sequence[DataFrame], code: str, pattern: str) -> DataFrame:
    """Stacked catalogs with a problem per row: bad code, or a code that occurs more than once."""
    rows = bag_union(tables)
    repeated = rows.groupBy(code).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    joined = rows.join(repeated, code, "left")
    problem = F.when(~F.col(code).rlike(pattern), "bad_code").when(F.col("_n").isNotNull(), "duplicate_code").otherwise("")
    return joined.withColumn("problem", problem).drop("_n")


def expand_siblings(rows: DataFrame, key: str, listed: Column) -> DataFrame:
    """Each row again under every key it lists, unless that key has a row of its own."""
    more = rows.withColumn("_sibling", F.explode(F.split(listed, ","))).filter(F.trim("_sibling") != "")
    more = more.withColumn(key, F.trim("_sibling")).drop("_sibling")
    fresh = more.join(rows.select(key), key, "left_anti")
    return rows.withColumn("is_sibling", F.lit(False)).unionByName(fresh.select(*rows.columns).withColumn("is_sibling", F.lit(True)))
