"""Lazy access to the input tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, folder).lineitem`` reads ``folder/lineitem.parquet``; nothing is cached or collected."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
