"""Near copies by SimHash, held against the Jaccard similarity of word shingles: five words and a similarity of 0.8 or more.

Fingerprints of the same shingles propose the groups: those that SimHash links, by its deletion variants, are groups of sets, in
which the metric join compares sets exactly. A similarity of 0.8 leaves about ten bits of two fingerprints apart, so that groups of
a few bits do not hold all links: the metric join goes on with the shingles of sets that are not in one component yet. So no link
is lost, and no text goes for its fingerprint alone. Here one row of each component stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import metric_join, simhash
from plumbline.llm.names import keep_rows
from plumbline.llm.shingle_sets import shingle_sets
from plumbline.session import cut_lineage

#: Words in a shingle.
SHINGLE_WORDS = 5
#: Least similarity of linked texts, as a fraction.
SIMILARITY = (4, 5)


def fingerprint_groups(sets: DataFrame, distance: int = simhash.DISTANCE) -> DataFrame:
    """region (the group's smallest node) and node of the groups of several nodes that links of fingerprints tie together.

    sets: node, n, fp; sets without shingles are in no group. A node of several texts may have several fingerprints, and groups.
    """
    nodes = cut_lineage(sets.filter("n > 0").select("fp", "node").distinct(), "fingerprints")
    linked = simhash.components(nodes.select("fp").distinct(), distance)
    rooted = cut_lineage(nodes.join(linked, "fp", "left").select(F.coalesce("root", "fp").alias("root"), "node").distinct(), "fingerprint-roots")
    groups = rooted.groupBy("root").agg(F.min("node").alias("region"), F.max("node").alias("other")).filter("region <> other")
    return rooted.join(groups, "root").select("region", "node").distinct()


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, link: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row of each component: that with its smallest doc_id. Columns as in docs.

    docs: doc_id, text, and others. Texts without words are copies of each other. Where one id has several texts, each text is a
    document of its own, and of a component's texts with the smallest id one stays; of rows that repeat its id and text, that with
    the smallest remaining columns. Rows without doc_id cannot be told apart and all stay.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    sets = cut_lineage(shingle_sets(named, words, link, fingerprints=True), "shingle-sets")
    nodes = sets.groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    rooted = nodes.join(metric_join.components(named, sets, words, link, fingerprint_groups(sets)), "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    repeated = sets.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1").select("row")
    return keep_rows(named, kept, repeated).unionByName(docs.filter(F.col("doc_id").isNull()))
