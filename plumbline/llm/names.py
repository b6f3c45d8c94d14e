"""Columns that an operator adds to a table of the caller's, and rows told by id and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, lengthened until no column of df has them in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_number_of() -> Column:
    """A number of a row's doc_id and text."""
    return F.xxhash64("doc_id", "text")


def keep_rows(docs: DataFrame, kept: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows of docs with a kept number, one of each; kept, repeated: row, numbers to keep and numbers of several rows.

    Only rows that repeat a number are compared with one another, in the order of all columns.
    """
    (name,) = free_names(docs, "__row")
    numbers = lambda df: df.select(F.col("row").alias(name)).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = docs.withColumn(name, row_number_of()).join(numbers(kept), name, "left_semi")
    several = numbers(repeated.join(kept, "row", "left_semi"))
    least = found.join(several, name, "left_semi").groupBy(name).agg(F.min(F.struct(*columns)).alias("least")).select("least.*")
    return found.join(several, name, "left_anti").select(*columns).unionByName(least)
