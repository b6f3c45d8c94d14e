"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut_lineage


#: Links up to this number are handled in one task, since a shuffle costs more than the work; the result is the same.
FEW_LINKS = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each node's larger neighbours to the smallest among itself and its neighbours. edges: src > dst."""
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = edges.select(F.explode(ends).alias("e")).select("e.src", "e.dst")
    least = both.groupBy("src").agg(F.least("src", F.min("dst")).alias("least"))
    return both.join(least, "src").filter("dst > src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the smallest of them. edges: src > dst."""
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    both = F.array(F.struct("src", F.col("least").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("least").alias("dst")))
    return edges.join(least, "src").select(F.explode(both).alias("e")).select("e.src", "e.dst").filter("src <> dst")


def connected_components(links: DataFrame) -> DataFrame:
    """src and root: the smallest node of its component, for each node that a link touches, roots included.

    links: src, dst (same ordered type; direction, loops and repeats do not matter, nulls are left out). Each round is written
    to the shared folder, so that no round is computed twice and lost executors cost one round at most.
    """
    a, b = F.col("src"), F.col("dst")
    edges = links.filter(a != b).select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).distinct()
    edges = cut_lineage(edges, "links")
    before = None
    while True:
        # a number for the whole set of links: equal to the last one only when a round changed nothing
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("sum")).first()
        if now == before or not now["n"]:
            break
        before = now
        if now["n"] <= FEW_LINKS:
            edges = edges.coalesce(1)  # one partition meets the needs of every join and grouping below
        edges = cut_lineage(_small_star(_large_star(edges).distinct()).distinct(), "links")
    roots = edges.select(F.col("dst").alias("src")).distinct()
    return edges.select("src", F.col("dst").alias("root")).unionByName(roots.select("src", F.col("src").alias("root")))
