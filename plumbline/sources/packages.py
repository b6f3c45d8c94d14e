"""Data packages: a table in partitioned Parquet, a manifest with content hashes, and their checks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contracts import TABLE_NAME, TableContract
from plumbline.operators.review import violations
from plumbline.rules import any_of


def quality_report(df: DataFrame, contract: TableContract, partition: str) -> DataFrame:
    """Per package: rows, rows without a required value, keys that occur more than once, and the sum of both faults.

    Rows are counted per key first, so that a package with most of the rows is spread over its keys.
    """
    missing = any_of(F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in contract.required)
    per_key = df.groupBy(F.col(partition).alias("package_id"), *contract.key).agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing"))
    counts = per_key.groupBy("package_id").agg(F.sum("n").alias("row_count"), F.sum("missing").alias("missing_required"), F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    return counts.withColumn("error_count", F.col("missing_required") + F.col("duplicate_keys"))


def write_packages(df: DataFrame, contract: TableContract, root: str, partition: str, version: str = "v1", rows_per_file: int = 2_000_000) -> None:
    """Contract columns as one Parquet folder per package, with the quality report and the manifest beside them.

    A table with faulty packages is refused before anything is written. Rows are not gathered by package first: a package of any
    size is written by all its tasks. ``rows_per_file`` bounds the rows of a file.
    """
    spark = df.sparkSession
    report_path = f"{root}/_quality/{contract.name}"
    report = quality_report(df, contract, partition)
    faulty = report.filter("error_count > 0").select("package_id").limit(10).collect()
    if faulty:
        raise ValueError(f"packages with quality errors: {sorted(row['package_id'] for row in faulty)}")
    report.write.json(report_path)
    columns = [c for c in contract.columns if c in df.columns]
    df.select(*columns, partition).write.option("maxRecordsPerFile", rows_per_file).partitionBy(partition).mode("errorifexists").parquet(f"{root}/{contract.name}")
    manifest(spark, root, contract, version).write.json(f"{root}/_manifest/{contract.name}")


def read_manifest(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The manifest as it was written with the packages."""
    return spark.read.schema("package_id string, table_name string, source_version string, file_path string, file_sha256 string").json(f"{root}/_manifest/{table}")


def read_quality(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The quality report as it was written with the packages."""
    return spark.read.schema("package_id string, row_count bigint, missing_required bigint, duplicate_keys bigint, error_count bigint").json(f"{root}/_quality/{table}")


#: Files of up to so many bytes are rows, whose hash Spark takes; and bytes of a larger file that a task holds at once.
ROW_BYTES, PIECE_BYTES = 64 << 20, 4 << 20
#: Stores that tasks can read by themselves; in others a file has to fit a row.
STREAMED = ("file", "hdfs", "s3", "gs")


def file_hashes(spark: SparkSession, root: str, table: str, row_bytes: int = ROW_BYTES) -> DataFrame:
    """SHA-256 of every file of a table, with its package and its path below the root.

    Files are listed without their contents. Those of a modest size are read as rows; a larger one is read by its task in pieces
    that update the hash, so that a file of any size takes a piece of memory. Both give the same hash.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(f"{root}/{table}")
    large = files.filter(F.col("length") > row_bytes).select("path")
    first = large.first()
    if first is None or urlsplit(first["path"]).scheme not in STREAMED:
        hashed = files.select("path", F.sha2("content", 256).alias("file_sha256"))
    else:
        small = files.filter(F.col("length") <= row_bytes).select("path", F.sha2("content", 256).alias("file_sha256"))
        hashed = small.unionByName(large.mapInArrow(_hashed, "path string, file_sha256 string"))
    relative = F.regexp_extract("path", f"({table}/.*)$", 1)
    return hashed.select(F.regexp_extract("path", r"package_id=([^/]*)/", 1).alias("package_id"), relative.alias("file_path"), "file_sha256")


def _hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        paths = batch.column(0).to_pylist()
        digests = []
        for path in paths:
            # one slash, as Spark writes local files, is none of an address
            store, inside = fs.FileSystem.from_uri(quote(re.sub("^file:/(?!/)", "file:///", path), safe=":/"))
            digest = hashlib.sha256()
            with store.open_input_stream(inside) as stream:
                while piece := stream.read(PIECE_BYTES):
                    digest.update(piece)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(digests, pa.string())], ["path", "file_sha256"])


def manifest(spark: SparkSession, root: str, contract: TableContract, version: str) -> DataFrame:
    """One row per file: package, table, version, relative path and hash."""
    return file_hashes(spark, root, contract.name).select(
        "package_id", F.lit(contract.name).alias("table_name"), F.lit(version).alias("source_version"), "file_path", "file_sha256"
    )


def manifest_violations(entries: DataFrame, actual: DataFrame, quality: DataFrame) -> DataFrame:
    """Broken rules per manifest entry: fields, relative path, existing file, matching hash, table name, quality report; and files
    that no entry declares."""
    found = actual.select("file_path", F.col("file_sha256").alias("actual_sha256"))
    joined = entries.join(found, "file_path", "left").join(quality.select("package_id", "error_count"), "package_id", "left")
    exists = F.col("actual_sha256").isNotNull()
    checks = {
        "field_missing": F.coalesce("source_version", F.lit("")) == "",
        "path_not_relative": F.col("file_path").startswith("/") | F.col("file_path").contains(".."),
        "file_missing": ~exists & ~F.col("file_path").startswith("/"),
        "hash_mismatch": exists & (F.col("actual_sha256") != F.col("file_sha256")),
        "bad_table_name": ~F.col("table_name").rlike(TABLE_NAME.pattern),
        "quality_report_missing": F.col("error_count").isNull(),
        "quality_errors": F.col("error_count") > 0,
    }
    undeclared = actual.join(entries.select("file_path"), "file_path", "left_anti").select("package_id", F.lit("file_not_declared").alias("violation"))
    return violations(joined, ["package_id"], checks).unionByName(undeclared).distinct()


def read_packages(spark: SparkSession, root: str, table: str, registry: DataFrame) -> DataFrame:
    """Rows of the valid packages of a registry; the package column prunes folders at run time."""
    valid = registry.filter(F.col("manifest_ok") & (F.col("error_count") == 0)).select("package_id")
    return spark.read.parquet(f"{root}/{table}").join(valid, "package_id", "left_semi")


def package_errors(registry: DataFrame) -> DataFrame:
    """Why packages of the registry contribute no rows."""
    checks = {"manifest_invalid": ~F.col("manifest_ok"), "quality_errors": F.col("error_count") > 0}
    return violations(registry, ["package_id"], checks)

