"""Ranked lexical search, term-at-a-time over short posting lists and document-at-a-time over long ones.

Texts are read once; of each document its length and its postings of the queries' terms are written. Stretches of that table
are the blocks of the index. In a first pass every block sums the contributions of short lists into accumulators, one sum for
each document and query, and writes them beside its long lists. The k-th best sum of a query over all blocks bounds its k-th
best score from below. In the second pass a block's accumulators are one more list of the query, with their largest sum as
bound. Lists are put in order of their bounds; those whose bounds together stay below the query's bar name no candidates. The
others do, and the rest is looked up for candidates only, list after list, as long as a candidate can still reach the bar.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.batches import portions
from plumbline.session import cut_lineage

#: Results of a query.
K = 50
#: A list is short if it holds at most one document in so many.
SHORT_PART = 200
#: Documents in a block at most.
BLOCK_DOCS = 2048
#: Terms of all queries that are searched together, at most or those of one query; the only data that every task holds.
PORTION_TERMS = 1 << 19
#: Weight of a document's length against the mean length, in hundredths, and the scale of term weights, saturation and impacts.
LENGTH_PART, WEIGHT_SCALE, SATURATION, IMPACT = 50, 1000, 20, 1_000_000_000

#: Bytes outside terms become spaces, capitals small letters; bytes over 127 belong to letters.
TERM_BYTES = bytes((b | 32 if 65 <= b <= 90 else b) if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8: runs of letters and digits of ASCII and of all other characters, A-Z lower-cased."""
    return text.translate(TERM_BYTES).split()


def weight(documents: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one unit of a term's weight is worth in a document; both in 64-bit integers."""
    return (IMPACT * tf) // (1000 * tf + SATURATION * m)


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Normalised lengths of documents with n of all total terms."""
    return 100 - LENGTH_PART + (LENGTH_PART * n * documents) // max(1, total)


def query_portions(items: DataFrame, size: int = PORTION_TERMS) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """item_id and different terms of the queries that have any, in portions of so many terms. Rows that share an id are one query."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, 1):
            found = [(i, t) for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for t in {*terms((text or "").encode())}]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())], ["item_id", "term"])

    found = items.select(F.col("item_id").cast("bigint"), "text").mapInArrow(cut, "item_id bigint, term binary").distinct()
    found = cut_lineage(found.orderBy("item_id", "term"), "query-terms").orderBy("item_id", "term").toLocalIterator()
    portion: list[tuple[int | None, list[bytes]]] = []
    held = 0
    for row in found:
        if not portion or portion[-1][0] != row["item_id"]:
            if held >= size:
                yield portion
                portion, held = [], 0
            portion.append((row["item_id"], []))
        portion[-1][1].append(bytes(row["term"]))
        held += 1
    if portion:
        yield portion


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the text, repeats included), terms (numbers of those asked for) and tfs of every row of docs."""

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, 1):
            sizes, nums, tfs = [], [], []
            for text in part.column(1).cast(pa.binary()).to_pylist():
                own = terms(text or b"")
                found = sorted((numbers[t], c) for t, c in Counter(own).items() if t in numbers)
                sizes.append(len(own))
                nums.append([t for t, _ in found])
                tfs.append([c for _, c in found])
            columns = [pa.array(sizes, pa.int64()), pa.array(nums, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


BLOCK = pa.schema([
    *((name, pa.list_(kind)) for name, kind in (("ids", pa.int64()), ("docs", pa.int32()), ("worth", pa.int64()), ("terms", pa.int32()), ("starts", pa.int32()))),
    *((name, pa.list_(kind)) for name, kind in (("items", pa.int32()), ("ends", pa.int32()), ("at", pa.int32()), ("sums", pa.int64()), ("best", pa.int32()), ("bars", pa.int64()))),
])
BLOCK_COLUMNS = ", ".join(f"{f.name} array<{'bigint' if f.type.value_type == pa.int64() else 'int'}>" for f in BLOCK)


def accumulated(index: DataFrame, queries: list[list[int]], weights: np.ndarray, short: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """Blocks of the index, a row each: ids of their documents, long lists (places and impacts, where each term's begin), and
    accumulators: for each query with short lists in the block (items) its documents' places and sums, and the k best sums."""
    short_of = [[t for t in own if short[t]] for own in queries]

    def packed(batch: pa.RecordBatch) -> tuple:
        lists = batch.column(2)
        term, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        m = lengths(batch.column(1).to_numpy().astype(np.int64), documents, total)
        order = np.argsort(term, kind="stable")
        term, doc = term[order], doc[order]
        worth = impacts(tf[order], m[doc])
        numbers = np.arange(len(weights))
        low, high = np.searchsorted(term, numbers), np.searchsorted(term, numbers, "right")
        long = ~short[term]
        kept, starts = np.unique(term[long], return_index=True)
        items, ends, at, sums, best_of, bars = [], [0], [], [], [], []
        for q, own in enumerate(short_of):
            own = [t for t in own if high[t] > low[t]]
            if own:
                total_of = np.zeros(batch.num_rows, np.int64)
                for t in own:
                    total_of[doc[low[t] : high[t]]] += weights[t] * worth[low[t] : high[t]]
                found = np.flatnonzero(total_of)
                items.append(q)
                ends.append(ends[-1] + len(found))
                at.append(found)
                sums.append(total_of[found])
                bars.append(np.sort(total_of[found])[::-1][:k])
                best_of.append(np.full(len(bars[-1]), q))
        joined = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        return batch.column(0).to_pylist(), doc[long], worth[long], kept, [*starts, long.sum()], items, ends, joined(at), joined(sums), joined(best_of), joined(bars)

    def block(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, BLOCK_DOCS):
                row = packed(batch.slice(start, BLOCK_DOCS))
                yield pa.RecordBatch.from_arrays([pa.array([values], f.type) for values, f in zip(row, BLOCK, strict=True)], schema=BLOCK)

    return index.mapInArrow(block, BLOCK_COLUMNS)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the scores that are no less than the k-th best."""
    if len(scores) <= k:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, -k)[-k])


def evaluate(lists: list[tuple[np.ndarray, np.ndarray]], bar: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block, by place, whose scores reach the bar, and the scores; lists: places and scores, one entry a place."""
    lists = sorted(lists, key=lambda x: int(x[1].max()))
    reach = np.cumsum([int(scores.max()) for _, scores in lists])
    first = int(np.searchsorted(reach, bar))  # the lists before it cannot reach the bar together
    total = np.zeros(size, np.int64)
    for at, scores in lists[first:]:
        total[at] += scores
    found = np.flatnonzero(total)
    for i in range(first - 1, -1, -1):
        found = found[total[found] + reach[i] >= bar]
        if not len(found):
            break
        at, scores = lists[i]
        place = np.minimum(np.searchsorted(at, found), len(at) - 1)
        total[found] += np.where(at[place] == found, scores[place], 0)
    found = found[total[found] >= bar]
    return found, total[found]


def searched(blocks: DataFrame, queries: list[list[int]], weights: np.ndarray, short: np.ndarray, bars: np.ndarray, k: int) -> DataFrame:
    """item (a query's number), doc_id, score: the best k documents of every block, and more on ties, that reach the query's bar."""
    long_of = [[t for t in own if not short[t]] for own in queries]

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raised = bars.copy()  # by what this task has seen
        for batch in rows:
            for i in range(batch.num_rows):
                ids, docs, worth, kept, starts, items, ends, at, sums = (batch.column(f).slice(i, 1).flatten().to_numpy(zero_copy_only=False) for f in BLOCK.names[:9])
                ids = batch.column("ids").slice(i, 1).flatten()
                places = {t: j for j, t in enumerate(kept.tolist())}
                summed = {q: slice(ends[j], ends[j + 1]) for j, q in enumerate(items.tolist())}
                out = [(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))]
                for q, own in enumerate(long_of):
                    cuts = [(t, slice(starts[j], starts[j + 1])) for t in own if (j := places.get(t)) is not None]
                    lists = [(docs[cut], weights[t] * worth[cut]) for t, cut in cuts]
                    if q in summed:
                        lists.append((at[summed[q]], sums[summed[q]]))
                    if lists:
                        where, scores = evaluate(lists, max(1, int(raised[q])), len(ids))
                        top = best(scores, k)
                        if len(top) >= k:
                            raised[q] = max(raised[q], scores[top].min())
                        out.append((np.full(len(top), q, np.int32), where[top], scores[top]))
                item, where, scores = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids.take(pa.array(where, pa.int64())), pa.array(scores)], ["item", "doc_id", "score"])

    return blocks.mapInArrow(search, "item int, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = K, short_part: int = SHORT_PART) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: each query's k best documents with a score above 0, fewer if there are fewer.

    docs: doc_id, text; items: item_id, text; other columns are left aside. Ties go to the smaller doc_id, a null doc_id last.
    Rows of items that share an id are one query, with the terms of all of them; null is an id as well. Rows of docs that share
    an id, or repeat, are documents of their own. Null and empty texts have no terms: such queries give no rows, such documents
    are in none and do not count.
    """
    spark = docs.sparkSession
    results = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for portion in query_portions(items):
        numbers = {t: i for i, t in enumerate(sorted({t for _, own in portion for t in own}))}
        queries = [[numbers[t] for t in own] for _, own in portion]
        index = cut_lineage(postings(docs, numbers), "postings")
        counts = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
        df = np.zeros(len(numbers), np.int64)
        for row in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():  # at most the portion's terms
            df[row["t"]] = row["df"]
        weights = np.array([weight(counts["documents"], int(x)) for x in df], np.int64)
        short = df * short_part <= counts["documents"]
        blocks = cut_lineage(accumulated(index, queries, weights, short, counts["documents"], counts["total"], k), "search-blocks")
        sums = blocks.select(F.inline(F.arrays_zip("best", "bars")))
        bars = np.zeros(len(queries), np.int64)
        largest = F.row_number().over(Window.partitionBy("best").orderBy(F.desc("bars")))
        for row in sums.withColumn("rank", largest).filter(F.col("rank") == k).collect():  # one row a query
            bars[row["best"]] = row["bars"]
        found = searched(blocks, queries, weights, short, bars, k)
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(portion)], "item int, item_id bigint")
        results = results.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return results
