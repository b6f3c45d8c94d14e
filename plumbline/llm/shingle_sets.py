"""Texts as sets of word shingles, and the shingles of a set that suffice to meet every similar set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.batches import portions
from plumbline.llm.names import row_number_of
from plumbline.llm.simhash import fingerprint_of

SEED = 42
#: Expected documents in the sample that tells frequent shingles, from how many of them on one is frequent, and how many are told.
SAMPLE_DOCS, FREQUENT, MOST_FREQUENT = 4000, 3, 100_000


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Hashes of a text's shingles as they come, repeats included; A-Z are lower-cased, words are runs without ASCII white
    space; fewer words than a shingle has are one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - size + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64).view(np.int64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Hashes of a text's different shingles, in order."""
    return np.unique(shingle_hashes(text, size))


def name_of(found: np.ndarray) -> int:
    """Number that stands for a set of shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def enough(n: int, link: tuple[int, int]) -> int:
    """How many shingles of a set of n, in any order of all shingles, have one in common with as many of every linked set."""
    least, whole = link
    return n - -(-least * n // whole) + 1 if n else 0


def told(n: int, link: tuple[int, int]) -> int:
    """How many first shingles of a set are told: twice as many as are enough, so that linked sets have several in common."""
    return min(n, 2 * enough(n, link))


def least_shared(n: Column, link: tuple[int, int]) -> Column:
    """How many of the told shingles of a set of n are told of another set, if any links.

    Of two linked sets, the one whose told shingles end first shares all of them but those that the other lacks, and has no
    fewer shingles than fit n.
    """
    least, whole = link
    fits = F.ceil(n * least / whole)
    some = F.floor(fits * (whole - least) / whole) + 1
    return F.least(fits, 2 * some) - some + 1


def frequent_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and counts of shingles that are frequent in a sample of documents. They decide about an order only."""

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, 0):
            for x in part.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(x.as_py(), words))], ["h"])

    drawn = docs.filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(max(docs.count(), 1))) < SAMPLE_DOCS)
    counted = drawn.select("text").mapInArrow(hashed, "h bigint").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT)
    found = sorted((r["h"], r["n"]) for r in counted.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).collect())
    return np.array([h for h, _ in found], np.int64), np.array([n for _, n in found], np.int64)


def shingle_sets(docs: DataFrame, words: int, link: tuple[int, int], fingerprints: bool = False) -> DataFrame:
    """doc_id, row (a number of id and text), node (a number of the set), n (its size), first (its told shingles, rare ones
    first) and, if asked for, fp (the SimHash fingerprint of the text's shingles) of every row of docs."""
    frequent, counts = frequent_shingles(docs, words)

    def first(found: np.ndarray) -> np.ndarray:
        rank = np.zeros(len(found), np.int64)
        if len(frequent) and len(found):
            at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
            rank = np.where(frequent[at] == found, counts[at], 0)
        return found[np.lexsort((found, rank))[: told(len(found), link)]]

    def named(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, 2):
            hashed = [shingle_hashes(x.as_py(), words) for x in part.column(2)]
            found = [np.unique(x) for x in hashed]
            columns = [pa.array([name_of(x) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int64())]
            columns.append(pa.array([first(x) for x in found], pa.list_(pa.int64())))
            if fingerprints:
                columns.append(pa.array([fingerprint_of(x) for x in hashed], pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["doc_id", "row", "node", "n", "first", "fp"][: 2 + len(columns)])

    own = docs.select(F.col("doc_id").cast("bigint"), row_number_of().alias("row"), "text")
    return own.mapInArrow(named, "doc_id bigint, row bigint, node bigint, n bigint, first array<bigint>" + ", fp bigint" * fingerprints)


def members(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node and hashes (all shingles, in order) of each wanted node; wanted: node and the row number of a row that has it."""

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, 1):
            found = [(node, x) for node, text in zip(part.column(0).to_pylist(), part.column(1), strict=True) if name_of(x := shingles(text.as_py(), words)) == node]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.list_(pa.int64()))], ["node", "hashes"])

    texts = docs.select(row_number_of().alias("row"), "text").join(wanted, "row").select("node", "text")
    return texts.mapInArrow(hashed, "node bigint, hashes array<bigint>").dropDuplicates(["node"])
