"""Scans: delimited text, JSON lines, globs, nested responses, trees and seed files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.rules import first_match

BYTE_ORDER_MARK = "﻿"


def scan_delimited(spark: SparkSession, path: str, sep: str = ",", line_breaks: bool = False) -> DataFrame:
    """CSV or TSV with a header row, all columns text; a byte-order mark before the first header is dropped.

    Quotes inside a quoted cell are doubled. ``line_breaks`` is for files whose quoted cells hold line breaks: a file is then one
    task, since no place inside it can be told for the start of a row.
    """
    df = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", line_breaks).csv(path)
    return df.toDF(*[c.replace(BYTE_ORDER_MARK, "").strip('"') for c in df.columns])


def scan_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines under a declared nested schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def scan_candidates(spark: SparkSession, glob: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame:
    """All files of a glob with the file each row came from."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(glob)
    return df.select("*", F.col("_metadata.file_path").alias("candidate_file"))


def latest_wins(base: DataFrame, retry: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One record per key: a retry record before a base record, then the last by ``order``."""
    stacked = base.withColumn("_rank", F.lit(0)).unionByName(retry.withColumn("_rank", F.lit(1)))
    rest = [c for c in base.columns if c not in key]
    at = F.struct(F.col("_rank"), *[F.col(c) for c in order])
    return stacked.groupBy(*key).agg(F.max_by(F.struct(*rest, F.col("_rank").alias("source_rank")), at).alias("r")).select(*key, "r.*")


def core_snapshot(df: DataFrame, columns: Mapping[str, str], required: Sequence[str]) -> DataFrame:
    """Contract columns (absent ones null) with a flag for rows whose required columns are filled."""
    out = [(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]
    filled = F.lit(True)
    for c in required:
        filled = filled & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return df.select(*out).withColumn("is_exportable", filled)


def split_location(c: Column) -> tuple[Column, Column]:
    """``"lon,lat"`` as two numbers; null when there is no comma."""
    two = F.instr(c, ",") > 0
    parts = F.split(c, ",", 2)
    return tuple(F.when(two, F.trim(F.get(parts, i)).try_cast("double")) for i in (0, 1))


def flatten_geocodes(records: DataFrame, confidence: Mapping[str, float], otherwise: float) -> DataFrame:
    """First geocode of each response as a location row; responses without one drop out."""
    first = records.withColumn("g", F.get("response.geocodes", 0)).filter(F.col("g").isNotNull())
    lon, lat = split_location(F.col("g.location"))
    level = first_match([(F.col("g.level") == k, v) for k, v in confidence.items()], otherwise)
    return first.select(
        "source_row.*",
        lon.alias("longitude"),
        lat.alias("latitude"),
        F.col("g.level").alias("geocode_level"),
        level.alias("geocode_confidence"),
        F.col("g.city").alias("geocode_city"),
    )


def tree_depth(node) -> int:
    """Levels that a nested district type has."""
    depth = 1
    while "districts" in node.fieldNames():
        node, depth = node["districts"].dataType.elementType, depth + 1
    return depth


def flatten_districts(tree: DataFrame) -> DataFrame:
    """Rows of a nested district column ``node`` (code, name, level, districts), parents before children.

    The depth is that of the column's type, so no level is left out. Each level is one explode. A row's province and city are
    the names of the nearest row above, itself included, whose level says so. A code that occurs twice keeps its first place
    in the tree.
    """
    none = F.lit(None).cast("string")
    named = lambda node, level, above: F.when(F.col(f"{node}.level") == level, F.col(f"{node}.name")).otherwise(above)
    level = tree.select(
        F.col("node"), none.alias("parent_code"), named("node", "province", none).alias("province"), named("node", "city", none).alias("city"),
        F.lit(0).alias("depth"), F.array().cast("array<int>").alias("path"),
    )
    tables = []
    for depth in range(tree_depth(tree.schema["node"].dataType)):
        if depth:
            child = level.select(F.col("node.code").alias("parent_code"), "province", "city", "path", F.posexplode("node.districts").alias("at", "child"))
            level = child.select(
                F.col("child").alias("node"), "parent_code", named("child", "province", F.col("province")).alias("province"), named("child", "city", F.col("city")).alias("city"),
                F.lit(depth).alias("depth"), F.concat("path", F.array("at")).alias("path"),
            )
        tables.append(level.select("node.code", "node.name", "node.level", "parent_code", "province", "city", "depth", "path"))
    stacked = tables[0]
    for t in tables[1:]:
        stacked = stacked.unionByName(t)
    rest = [c for c in stacked.columns if c not in ("code", "path")]
    return stacked.groupBy("code").agg(F.min_by(F.struct(*rest), F.struct("path", "parent_code")).alias("r")).select("code", "r.*")


def seed_rows(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of seed files; a value the row leaves out comes from the file's defaults."""
    rows = files.select("defaults", F.explode("rows").alias("row"))
    have_row = files.schema["rows"].dataType.elementType.fieldNames()
    have_default = files.schema["defaults"].dataType.fieldNames()

    def value(c: str) -> Column:
        found = [F.col(f"row.{c}")] if c in have_row else []
        found += [F.col(f"defaults.{c}")] if c in have_default else []
        return F.coalesce(*found).alias(c)

    return rows.select(*[value(c) for c in columns])


def route_sheets(df: DataFrame, sheet: str, rules: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Batch and subject of each row by its sheet title: (exact or contains, text, batch, subject), in order."""
    title = F.trim(F.col(sheet))

    def hit(kind: str, text: str) -> Column:
        return title == text if kind == "exact" else title.contains(text)

    tag = first_match([(hit(k, x), F.struct(F.lit(b).alias("batch"), F.lit(s).alias("subject"))) for k, x, b, s in rules])
    return df.withColumn("_tag", tag).select(*df.columns, F.col("_tag.batch").alias("batch"), F.col("_tag.subject").alias("subject"))
