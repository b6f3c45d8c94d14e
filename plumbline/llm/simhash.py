"""Near-duplicates by SimHash, found through deletion-variant signatures.

Fingerprints link when they differ in at most `distance` bits. Cut into distance // 2 + 1 segments, two linked fingerprints
agree in one segment up to a single bit, since two bits in each segment would be more than the distance. Each segment is
indexed with each of its bits deleted, one at a time: segments at most one bit apart share such a variant, so an equality join
on variants sees every linked pair, and the whole fingerprints are compared behind it.

Only components are asked for, so pairs inside a group are never listed. First every fingerprint of a variant is compared with
the variant's smallest one, which ties a group of near copies together with one row each. Then, in variants whose members still
lie in several components, those outside the variant's largest component are compared with all others, by a semi-join that tells
which of them have a link. One of these in each variant is tied to all that it links to, components are merged, and the variants
concerned are looked at again, until no link leads from one component to another. A pair that is never compared lies in one
component already.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.graph import connected_components
from plumbline.llm.names import keep_rows, row_number_of
from plumbline.session import cut_lineage

SEED = 42
BITS = 64
#: Largest number of differing bits of linked fingerprints.
DISTANCE = 4
#: Words in a shingle.
SHINGLE_WORDS = 4
#: Shingles whose bits are counted together.
BLOCK = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a whole text as a signed 64-bit number; 0 without words.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are `size` words joined by spaces (fewer words: all
    of them). A bit is set if more than half of the shingles' hashes, repeats included, have it.
    """
    words = (text or "").encode().lower().split()  # bytes: only ASCII letters and white space count
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])  # one past the space behind each word
    n = max(1, len(words) - size + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    blocks = ([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=True)] for at in range(0, n, BLOCK))
    return _over_half(map(np.uint64, blocks), n)


def fingerprint_of(hashes: np.ndarray) -> int:
    """fingerprint of a text whose shingles, repeats included, have these hashes (64 bits each); 0 without any."""
    return _over_half((hashes[at : at + BLOCK] for at in range(0, len(hashes), BLOCK)), len(hashes))


def _over_half(blocks: Iterable[np.ndarray], n: int) -> int:
    """Bits that more than half of n hashes have, as a signed number; the hashes come in blocks."""
    ones = np.zeros(BITS, np.int64)
    for hashes in blocks:
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row (a number of id and text) and fp (signed long) of every row of docs. Null text: 0."""

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [fingerprint(x.as_py(), size) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "row", "fp"])

    own = docs.select(F.col("doc_id").cast("bigint"), row_number_of().alias("row"), "text")
    return own.mapInArrow(hashed, "doc_id bigint, row bigint, fp bigint")


def segment_bounds(distance: int) -> list[tuple[int, int]]:
    """First bit and length of each segment: as few as ensure that one differs in at most one bit."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return list(zip(cuts, (b - a for a, b in zip(cuts, cuts[1:])), strict=False))


def variants(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Rows of nodes, once per deleted bit, with `variant`: the bit's number and its segment's other bits."""
    lows, masks = [], []
    for low, length in segment_bounds(distance):
        for bit in range(low, low + length):
            lows.append(low)
            masks.append(((1 << length) - 1) & ~(1 << (bit - low)))
    bit = F.col("bit")
    # a segment of up to 58 bits leaves room for the bit's number; one of 64 bits (distance 0 or 1) is hashed with it
    kept = F.element_at(F.array(*map(F.lit, lows)), bit + 1)
    mask = F.element_at(F.array(*(F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("bigint") for m in masks)), bit + 1)
    value = F.call_function("shiftrightunsigned", F.col("fp"), kept).bitwiseAND(mask)
    wide = max(length for _, length in segment_bounds(distance)) > 57
    key = F.xxhash64(value, bit) if wide else F.shiftleft(value, 6).bitwiseOR(bit.cast("bigint"))
    return nodes.select("*", F.explode(F.array(*map(F.lit, range(BITS)))).alias("bit")).withColumn("variant", key).drop("bit")


def _close(a: str, b: str, distance: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def components(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fp and root (one member of its component, the same for all) of each fingerprint that has a link; nodes: distinct fp."""
    per = Window.partitionBy("variant")
    hubs = variants(nodes.select("fp"), distance).withColumn("hub", F.min("fp").over(per)).filter(F.col("fp") != F.col("hub"))
    star = hubs.filter(_close("fp", "hub", distance)).select(F.col("fp").alias("src"), F.col("hub").alias("dst"))
    first = cut_lineage(connected_components(star).select(F.col("src").alias("fp"), F.col("root").alias("comp")), "hub-components")

    marked = nodes.select("fp").join(first, "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp"))
    mixed = cut_lineage(_mixed(variants(marked, distance)), "mixed-variants")
    links = None
    while True:
        outside = mixed.filter("comp <> largest").select("variant", F.col("fp").alias("src"), F.col("comp").alias("src_comp"))
        inside = mixed.select("variant", F.col("fp").alias("dst"), F.col("comp").alias("dst_comp"))
        other = (outside["variant"] == inside["variant"]) & (F.col("src_comp") != F.col("dst_comp")) & _close("src", "dst", distance)
        # those outside with any link across components: at most one row each, however many links there are
        linked = cut_lineage(outside.join(inside, other, "left_semi"), "linked")
        if linked.isEmpty():
            break
        # one of them in each variant is tied to all it links to; a variant without one has been compared in full
        pivots = linked.groupBy("variant").agg(F.min_by(F.struct("src", "src_comp"), F.xxhash64("variant", "src")).alias("pivot"))
        outside = pivots.select("variant", "pivot.src", "pivot.src_comp")
        found = outside.join(inside, (outside["variant"] == inside["variant"]) & (F.col("src_comp") != F.col("dst_comp")) & _close("src", "dst", distance))
        found = found.select(F.col("src_comp").alias("src"), F.col("dst_comp").alias("dst")).distinct()
        links = cut_lineage(found if links is None else links.unionByName(found), "component-links")
        merged = connected_components(found).select(F.col("src").alias("comp"), F.col("root").alias("into"))
        left = mixed.join(pivots.select("variant"), "variant", "left_semi").join(merged, "comp", "left")
        mixed = cut_lineage(_mixed(left.select("variant", "fp", F.coalesce("into", "comp").alias("comp"))), "mixed-variants")
    if links is None:
        return first.withColumnRenamed("comp", "root")
    joined = connected_components(links).select(F.col("src").alias("comp"), "root")
    alone = joined.join(first.select(F.col("comp")).distinct(), "comp", "left_anti").select(F.col("comp").alias("fp"), "root")
    return first.join(joined, "comp", "left").select("fp", F.coalesce("root", "comp").alias("root")).unionByName(alone)


def _mixed(members: DataFrame) -> DataFrame:
    """variant, fp, comp and the variant's largest component, for variants with members of several; members: variant, fp, comp."""
    per = Window.partitionBy("variant")
    several = members.withColumn("one", F.min("comp").over(per)).withColumn("other", F.max("comp").over(per)).filter("one <> other")
    counted = several.withColumn("n", F.count("*").over(Window.partitionBy("variant", "comp")))
    return counted.withColumn("largest", F.max(F.struct("n", "comp")).over(per)).select("variant", "fp", "comp", F.col("largest.comp").alias("largest"))


def _rooted(rows: DataFrame, distance: int) -> DataFrame:
    """fp, its smallest doc_id and row, and root; rows: as from fingerprints."""
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "row")).alias("first")), "distinct-fingerprints")
    linked = components(nodes, distance)
    return nodes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id that links reach, its own included), one row per row of docs.

    docs: doc_id, text; other columns are left aside. Null, empty and wordless texts have fingerprint 0 and link like others.
    A null doc_id counts as none: a component without any other id has component_id null. Repeated rows come back repeated.
    """
    rows = cut_lineage(fingerprints(docs, size), "fingerprints")
    rooted = _rooted(rows, distance)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # a table of its own: both sides of the last join are then plain shuffles, which Spark splits where one fingerprint is frequent
    named = cut_lineage(rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp) -> F.Column:
    """16 lower-case hexadecimal digits of the unsigned fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, distance: int = DISTANCE, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component: that with its smallest doc_id. Columns as in docs.

    Where one id has several texts, each text is a document of its own, and of a component's texts with the smallest id one
    stays; of rows that repeat its id and text, that with the smallest remaining columns. Rows without doc_id cannot be told
    apart and all stay.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    rows = cut_lineage(fingerprints(named, size), "fingerprints")
    kept = _rooted(rows, distance).groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    repeated = rows.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1").select("row")
    return keep_rows(named, kept, repeated).unionByName(docs.filter(F.col("doc_id").isNull()))
