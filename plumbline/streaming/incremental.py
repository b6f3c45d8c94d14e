"""Latest-wins records and source health kept up to date from a stream.

Each micro-batch is reduced on its own and written under its batch number, so a batch that is
retried after a failure overwrites its own folder only. Readers merge the small reduced tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from plumbline.operators.aggregate import latest_by
from plumbline.session import remove_folders

BATCH = "batch_number"


def keep_latest(stream: DataFrame, key: Sequence[str], order: Sequence[str], table: str, checkpoint: str) -> DataStreamWriter:
    """Writer that stores the last record per key of every micro-batch."""
    value = [c for c in stream.columns if c not in key]

    def store(batch: DataFrame, number: int) -> None:
        latest_by(batch, key, value, order).write.mode("overwrite").parquet(f"{table}/{BATCH}={number}")

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def read_latest(spark: SparkSession, table: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last record per key over all batches; among equal order values the later batch wins."""
    rows = spark.read.parquet(table)
    value = [c for c in rows.columns if c not in (*key, BATCH)]
    return latest_by(rows, key, value, [*order, BATCH])


def compact_latest(spark: SparkSession, table: str, key: Sequence[str], order: Sequence[str], upto: int) -> None:
    """Merges the batches up to a number into that batch's folder and removes the earlier ones.

    The merged rows are added before anything goes, and a record that is there twice is read once, so that a compaction that
    stops halfway leaves the table as it reads. Batches up to the number must be committed: none of them may be written again.
    """
    rows = spark.read.parquet(table).filter(F.col(BATCH) <= upto)
    folders = [row["folder"] for row in rows.select(F.col(BATCH).alias("folder")).distinct().collect()]  # one row a batch
    value = [c for c in rows.columns if c not in (*key, BATCH)]
    latest_by(rows, key, value, [*order, BATCH]).write.mode("append").parquet(f"{table}/{BATCH}={upto}")
    remove_folders(spark, [f"{table}/{BATCH}={n}" for n in folders if n < upto])


def keep_health(stream: DataFrame, source: str, blocked, table: str, checkpoint: str) -> DataStreamWriter:
    """Writer that stores checks and blocked checks per source of every micro-batch."""

    def store(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy(source).agg(F.count(F.lit(1)).alias("check_count"), F.count_if(blocked).alias("blocked_count"))
        counted.write.mode("overwrite").parquet(f"{table}/{BATCH}={number}")

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def read_health(spark: SparkSession, table: str, source: str) -> DataFrame:
    """Health per source over all batches."""
    summed = spark.read.parquet(table).groupBy(source).agg(F.sum("check_count").alias("check_count"), F.sum("blocked_count").alias("blocked_count"))
    return summed.withColumn("health_status", F.when(F.col("blocked_count") > 0, "blocked").otherwise("healthy"))
