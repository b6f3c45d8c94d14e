"""Shaping of incoming tables: contracts, unpivot, task grids, keys, classification."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import TableContract
from plumbline.functions.values import clean_text, coerce_number, stable_id
from plumbline.rules import all_of, any_of, first_match


def header_form(name: str) -> str:
    return re.sub(r"[\s_﻿]+", "", name).lower()


def resolve_headers(actual: Sequence[str], contract: TableContract) -> dict[str, str | None]:
    """Contract column -> the header that carries it: the first alias present wins."""
    by_form: dict[str, str] = {}
    for header in actual:
        by_form.setdefault(header_form(header), header)
    found = {}
    for column in contract.columns:
        names = (column, *contract.aliases.get(column, ()))
        found[column] = next((by_form[header_form(n)] for n in names if header_form(n) in by_form), None)
    return found


def normalise(df: DataFrame, contract: TableContract) -> DataFrame:
    """Contract columns only: aliases resolved, text cleaned, numbers coerced, absent columns null."""
    source = resolve_headers(df.columns, contract)
    out = []
    for column in contract.columns:
        header = source[column]
        numeric = column in contract.numeric
        if header is None:
            value = F.lit(None).cast("double" if numeric else "string")
        else:
            value = df[f"`{header}`"]
            value = coerce_number(value) if numeric else clean_text(value)
        out.append(value.alias(column))
    return df.select(*out)


def year_columns(columns: Sequence[str], patterns: Mapping[str, str]) -> dict[int, dict[str, str]]:
    """For every year in a header, the column of each metric; a pattern's first group is the year.

    A year needs all metrics.
    """
    found: dict[int, dict[str, str]] = {}
    for metric, pattern in patterns.items():
        for column in columns:
            match = re.fullmatch(pattern, column)
            if match:
                found.setdefault(int(match[1]), {})[metric] = column
    return {year: cols for year, cols in sorted(found.items()) if len(cols) == len(patterns)}


def unpivot_years(
    df: DataFrame, ids: Sequence[str], years: Mapping[int, Mapping[str, str]], keep_empty: bool = False
) -> DataFrame:
    """One row per id and year from columns that each hold one metric of one year.

    A year whose metrics are all null or zero is dropped unless ``keep_empty``.
    """
    if not years:
        raise ValueError("the header names no year")
    metrics = list(next(iter(years.values())))
    entries = F.array(
        *[
            F.struct(F.lit(year).alias("score_year"), *[F.col(cols[m]).alias(m) for m in metrics])
            for year, cols in years.items()
        ]
    )
    long = df.select(*ids, F.explode(entries).alias("e")).select(*ids, "e.*")
    filled = any_of(F.coalesce(F.col(m), F.lit(0)) != 0 for m in metrics)
    return long.withColumn("is_filled", filled) if keep_empty else long.filter(filled)


def project_with_defaults(df: DataFrame, spec: Mapping[str, tuple[Column, object]]) -> DataFrame:
    """Typed projection; each output is (expression, default for null)."""
    return df.select(
        *[(e if default is None else F.coalesce(e, F.lit(default))).alias(name) for name, (e, default) in spec.items()]
    )


def in_filters(df: DataFrame, filters: Mapping[str, Sequence]) -> DataFrame:
    """Rows whose columns are in the configured lists; an empty list means no restriction."""
    return df.filter(all_of(F.col(c).isin(*values) for c, values in filters.items() if values))


def suffix_duplicate_keys(df: DataFrame, key: Sequence[str], target: str, suffix_from: Sequence[str]) -> DataFrame:
    """``target`` gets a short hash where its key occurs more than once.

    Repeated keys are found by a partial-aggregated count, so a hot key costs one row per
    map task; the flag comes back by a join that AQE may broadcast or split.
    """
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key, F.lit(True).alias("repeated"))
    suffix = F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in suffix_from])), 1, 8)
    joined = df.join(repeated, list(key), "left")
    return joined.withColumn(
        target, F.when(F.col("repeated"), F.concat_ws("_", F.col(target), suffix)).otherwise(F.col(target))
    ).drop("repeated")


def task_grid(entities: DataFrame, rules: Sequence[Mapping[str, object]]) -> DataFrame:
    """Every entity with every rule, by exploding the rules inside each row: no join, no shuffle."""
    entry = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in rule.items()]) for rule in rules])
    return entities.select("*", F.explode(entry).alias("rule")).select(*entities.columns, "rule.*")


def fill_template(template: str, **parts: Column) -> Column:
    """Text with ``{name}`` marks replaced by columns."""
    pieces = re.split(r"\{(\w+)\}", template)
    cols = [F.lit(p) if i % 2 == 0 else parts[p].cast("string") for i, p in enumerate(pieces) if i % 2 or p]
    return F.concat(*cols)


def year_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct years named in any of the columns."""
    return (
        df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("y"))
        .filter(F.col("y").rlike("^[0-9]+$"))
        .select(F.col("y").cast("int").alias("year"))
        .distinct()
    )


def classify_by_keyword(text: Column, rules: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> Column:
    """Label of the first rule one of whose words occurs in the text."""
    return first_match([(any_of(text.contains(w) for w in words), label) for label, words in rules], otherwise)


# fixed values: how raw statuses are read by the release gate
PASS_STATUSES = ("passed", "pass", "ok", "ready", "success")
BLOCKED_STATUSES = ("blocked", "failed", "fail", "error")
PENDING_STATUSES = ("pending", "todo", "in_progress", "needs_review")


def route_status(
    status: Column,
    passed: Sequence[str] = PASS_STATUSES,
    blocked: Sequence[str] = BLOCKED_STATUSES,
    pending: Sequence[str] = PENDING_STATUSES,
) -> Column:
    s = F.lower(F.trim(status))
    return first_match(
        [
            (s.isin(*passed), "passed"),
            (s.isin(*blocked), "blocked"),
            (s.isin(*pending), "pending"),
            (s.isin("not_required", "not_provided"), s),
        ],
        "unknown",
    )


def health_status(status: Column, check: Column) -> Column:
    waiting = status.startswith("awaiting")
    return first_match(
        [
            (status.startswith("blocked"), "unavailable"),
            (waiting & (check == "manual_file"), "manual_review_pending"),
            (waiting, "degraded"),
            (status == "research_required", "manual_review_pending"),
        ],
        "healthy",
    )


def task_id(*parts: Column) -> Column:
    return stable_id(*parts)
