"""U: set operations and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import sets as u
from plumbline.plans import base
from plumbline.plans.registry import query


@query(
    "u01_key_sets",
    f"""WITH {base.PACKAGE}, {base.CORE} SELECT ship_year, batch, supplier, slot, 'both' AS part FROM package SEMI JOIN core USING (ship_year, batch, supplier, slot)
        UNION ALL SELECT ship_year, batch, supplier, slot, 'left_only' FROM package ANTI JOIN core USING (ship_year, batch, supplier, slot)
        UNION ALL SELECT ship_year, batch, supplier, slot, 'right_only' FROM core ANTI JOIN package USING (ship_year, batch, supplier, slot)""",
)
def u01(t):
    return u.key_sets(base.package(t), base.core(t), base.KEY)


@query(
    "u02_bag_union",
    """SELECT c_custkey AS party_key, c_name AS party_name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def u02(t):
    return u.bag_union(
        [
            t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"), F.col("c_mktsegment").alias("segment")),
            t.supplier.select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name")),
        ]
    )


def merge_sql(override: bool) -> str:
    first, action = ("s", "overridden") if override else ("b", "kept")
    second = "b" if override else "s"
    return f"""WITH b AS (SELECT c_custkey AS k, c_name AS name, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer WHERE c_acctbal > 0),
      s AS (SELECT s_suppkey AS k, s_name AS name, CAST(round(s_acctbal * 100) AS BIGINT) AS cents FROM supplier)
      SELECT k, coalesce({first}.name, {second}.name) AS name, coalesce({first}.cents, {second}.cents) AS cents,
        CASE WHEN b.name IS NOT NULL AND s.name IS NOT NULL THEN '{action}' WHEN b.name IS NOT NULL THEN 'base' ELSE 'added' END AS merge_action FROM b FULL JOIN s USING (k)"""


def parties(t):
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").alias("cents")
    return (
        t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), cents("c_acctbal")),
        t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), cents("s_acctbal")),
    )


@query("u03_merge_keep_base", merge_sql(False))
def u03(t):
    return u.merge_with_precedence(*parties(t), ["k"], allow_override=False)


@query("u03_merge_override", merge_sql(True))
def u03_override(t):
    return u.merge_with_precedence(*parties(t), ["k"], allow_override=True)


@query(
    "u04_promote_by_name",
    """WITH a AS (SELECT p_name, p_brand, p_size, p_partkey, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey DESC) AS rn FROM part WHERE p_partkey % 2 = 1)
       SELECT p_name, p_brand, p_size, p_partkey FROM part WHERE p_partkey % 2 = 0 AND p_name NOT IN (SELECT p_name FROM a) UNION ALL SELECT p_name, p_brand, p_size, p_partkey FROM a WHERE rn = 1""",
)
def u04(t):
    columns = ["p_name", "p_brand", "p_size", "p_partkey"]
    existing = t.part.filter("p_partkey % 2 = 0").select(*columns)
    approved = t.part.filter("p_partkey % 2 = 1").select(*columns)
    return u.promote(existing, approved, "p_name", ["p_name", "p_brand"], ["p_partkey"])


@query(
    "u05_catalog_merge",
    """WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier)
       SELECT code, name, CASE WHEN NOT regexp_matches(code, '^[0-9]{2,}$') THEN 'bad_code' WHEN count(*) OVER (PARTITION BY code) > 1 THEN 'duplicate_code' ELSE '' END AS problem FROM r""",
)
def u05(t):
    return u.merge_catalogs(
        [
            t.customer.select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name")),
            t.supplier.select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name")),
        ],
        "code",
        "^[0-9]{2,}$",
    )


@query(
    "u06_sibling_expansion",
    """WITH r AS (SELECT CAST(s_suppkey AS VARCHAR) AS campus_key, s_name, s_suppkey || ', N' || s_nationkey || ',R' || s_suppkey AS siblings FROM supplier),
       x AS (SELECT trim(unnest(string_split(siblings, ','))) AS campus_key, s_name, siblings FROM r)
       SELECT *, false AS is_sibling FROM r UNION ALL SELECT *, true FROM x WHERE campus_key NOT IN (SELECT campus_key FROM r)""",
)
def u06(t):
    key = F.col("s_suppkey")
    rows = t.supplier.select(
        key.cast("string").alias("campus_key"), "s_name", F.concat(key, F.lit(", N"), "s_nationkey", F.lit(",R"), key).alias("siblings")
    )
    return u.expand_siblings(rows, "campus_key", F.col("siblings"))
