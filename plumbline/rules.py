"""Rule tables: small, written by people, and therefore bounded.

A rule table is built from a Python list, so its size is known before the plan runs.
Only such tables get a broadcast hint; everything else is left to AQE's measured sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULE_ROWS = 10_000


def literal(value: Any) -> str:
    """SQL text of one rule value."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_frame(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[Any]]) -> DataFrame:
    """Rules as an inline relation whose size Catalyst knows exactly."""
    if not rows:
        raise ValueError("a rule table needs at least one row")
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS rules({', '.join(columns)})")


def broadcast_rules(rules: DataFrame, row_count: int) -> DataFrame:
    """Broadcast a rule table whose row count has been checked; larger ones join by shuffle."""
    return F.broadcast(rules) if row_count <= MAX_RULE_ROWS else rules


def values_sql(columns: Sequence[str], rows: Sequence[Sequence[Any]]) -> str:
    """The same rules as a derived table for an ANSI engine."""

    def text(value: Any) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, float):
            return f"CAST({value!r} AS DOUBLE)"
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        return str(value)

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS rules({', '.join(columns)}))"


def first_match(rules: Iterable[tuple[Column, Any]], otherwise: Any = None) -> Column:
    """The value of the first rule whose predicate holds; a null predicate does not hold."""
    chain = None
    for predicate, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(predicate, value) if chain is None else chain.when(predicate, value)
    fallback = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return fallback if chain is None else chain.otherwise(fallback)


def codes(*flags: tuple[Column, str]) -> Column:
    """Sorted array of the codes whose predicate holds."""
    return F.array_sort(F.array_compact(F.array(*[F.when(p, F.lit(code)) for p, code in flags])))


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))
