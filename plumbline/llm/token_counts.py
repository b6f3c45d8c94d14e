"""Token counts as a tokenizer library gives them, with huge documents encoded in overlapping chunks.

A document of more than huge_chars characters is cut into chunks. Each is encoded, with offsets, together with an overlap on
both sides. Around the cut between two chunks, both look for the place nearest to the cut where white space ends: this
tokenizer drops white space, and neither its normalizer nor its merges look across it, so a token boundary there is stable
whatever stands before. Where both encodings have a token that begins at the same such place, the two are spliced there, and a
chunk counts the tokens between its two splices. Cuts without such a place get overlaps eight times as wide, until all align
or the overlap holds the whole document.

Other documents fall apart at white space for the same reason; each worker remembers the counts of the words it met first.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.batches import portions
from plumbline.session import cut_lineage

#: Characters above which a document is cut, in a chunk, and in the first overlap.
HUGE_CHARS = 32_768
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
WIDEN = 8
#: Words that a worker remembers at most.
REMEMBERED = 300_000

# Fixed value: the white space of Unicode.
SPACE = "\t-\r \x85\xa0  -     　"
WORD = re.compile(f"[^{SPACE}]+")
#: Where white space ends.
STABLE = re.compile(f"(?<=[{SPACE}])(?=[^{SPACE}])")
#: Characters that Python's split() takes for white space and Unicode does not.
SEPARATORS = re.compile("[\x1c-\x1f]")


@functools.cache
def tokenizer(path: str):
    """One per worker and file: a vocabulary that drops white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    if [found.encode(x, add_special_tokens=False).ids for x in ("a b", "a \n b ")] != [found.encode("a", add_special_tokens=False).ids + found.encode("b", add_special_tokens=False).ids] * 2:
        raise ValueError(f"{path} does not drop white space")
    return found


class Counter:
    """Token counts of words that have been met, for one vocabulary."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [WORD.findall(t) if SEPARATORS.search(t) else t.split() for t in texts]
        wanted = {w for words in split for w in words}
        unknown = wanted.difference(self.known)
        if len(self.known) + len(unknown) > REMEMBERED and 2 * len(unknown) > len(wanted):
            self.known, unknown = {}, wanted
        words = list(unknown)
        made = dict(zip(words, map(len, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)), strict=True))
        if len(self.known) + len(made) > REMEMBERED:
            known = self.known
            counts = {w: made[w] if w in made else known[w] for w in wanted}
        else:
            self.known.update(made)
            counts = self.known
        return [sum([counts[w] for w in words]) for words in split]


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def plain_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of documents that are encoded whole; docs: doc_id, text (null: empty)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for part in portions(rows, 2):
            tokens = count(part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text")).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )


SLICE = "uid bigint, doc_id bigint, n_bytes bigint, n_chars bigint, k int, text string"


def slices(docs: DataFrame, chunk: int) -> DataFrame:
    """Documents as chunks without overlap; uid names a document's row. Written once, so that uid stays what it is."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, 3):
            for uid, doc_id, n_bytes, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                parts = [text[a : a + chunk] for a in range(0, len(text), chunk)]
                for at in range(0, len(parts), 256):
                    some = parts[at : at + 256]
                    same = [pa.array([x] * len(some), pa.int64()) for x in (uid, doc_id, n_bytes, len(text))]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(range(at, at + len(some)), pa.int32()), pa.array(some)], ["uid", "doc_id", "n_bytes", "n_chars", "k", "text"])

    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint"), F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    return cut_lineage(numbered.mapInArrow(run, SLICE), "slices")


def widened(parts: DataFrame, wanted: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """uid, k, n_chars, low (place of the first character) and the text of each wanted chunk with its overlaps.

    wanted: uid, k. Each chunk gathers the slices that its overlaps touch: a number that follows from overlap and chunk.
    """
    reach = -(-overlap // chunk)
    near = wanted.select("uid", "k", F.explode(F.array(*(F.col("k") + d for d in range(-reach, reach + 1)))).alias("of"))
    found = near.join(parts.withColumnRenamed("k", "of"), ["uid", "of"])
    before, after = F.col("of") < F.col("k"), F.col("of") > F.col("k")
    # of the slices at the far ends, only what lies within the overlap
    start = F.when(before, F.greatest(F.lit(0), (F.col("k") - F.col("of")) * chunk - overlap)).otherwise(0)
    length = F.when(after, F.least(F.lit(chunk), overlap - (F.col("of") - F.col("k") - 1) * chunk)).otherwise(chunk)
    piece = F.substring(F.col("text"), (start + 1).cast("int"), length.cast("int"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("of", piece.alias("t")))), lambda x: x["t"]), "")
    gathered = found.groupBy("uid", "k").agg(joined.alias("text"), F.first("n_chars").alias("n_chars"))
    return gathered.select("uid", "k", "n_chars", F.greatest(F.lit(0), F.col("k").cast("bigint") * chunk - overlap).alias("low"), "text")


def splices(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """uid, k, left, right (splices with the chunks before and after; null: none found) and n_tokens between them."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = tokenizer(path)
        for batch in rows:
            for row in range(batch.num_rows):
                uid, k, n_chars, low, text = (c[row].as_py() for c in batch.columns)
                starts = [a for a, _ in library.encode(text, add_special_tokens=False).offsets]
                begins = set(starts)

                def splice(cut: int) -> int | None:
                    """Nearest stable place to a cut at which a token begins, ties to the left; at the ends of the document, the end."""
                    if cut <= 0 or cut >= n_chars:
                        return min(max(cut, 0), n_chars)
                    a, b = max(0, cut - overlap), min(n_chars, cut + overlap)
                    # the first and last place may not see what lies beside them
                    places = [m.start() + low for m in STABLE.finditer(text, a - low, b - low) if m.start() in begins and (m.start() + low > a or a == 0)]
                    if places:
                        return min(places, key=lambda p: (abs(p - cut), p))
                    return n_chars if a == 0 and b == n_chars else None

                left, right = splice(k * chunk), splice((k + 1) * chunk)
                n = None if left is None or right is None else sum(left <= a + low < right for a in starts)
                yield pa.RecordBatch.from_pylist([{"uid": uid, "k": k, "left": left, "right": right, "n_tokens": n}], RESULT)

    return texts.mapInArrow(run, "uid bigint, k int, left bigint, right bigint, n_tokens bigint")


RESULT = pa.schema([("uid", pa.int64()), ("k", pa.int32()), ("left", pa.int64()), ("right", pa.int64()), ("n_tokens", pa.int64())])


def spliced_counts(docs: DataFrame, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens of documents that are encoded in chunks; docs: doc_id, text (not empty)."""
    parts = slices(docs, chunk)
    wanted = parts.select("uid", "k")
    found = None
    while True:
        now = cut_lineage(splices(widened(parts, wanted, chunk, overlap), path, chunk, overlap), "splices")
        kept = now if found is None else now.unionByName(found.join(wanted, ["uid", "k"], "left_anti"))
        # both sides of a cut must have found the same splice
        ahead = kept.select("uid", (F.col("k") + 1).alias("k"), F.col("right").alias("met"))
        meeting = kept.join(ahead, ["uid", "k"], "left")
        torn = meeting.filter("k > 0 AND NOT coalesce(left = met, false)").select("uid", "k")
        found = kept if found is None else cut_lineage(kept, "splices")
        wanted = cut_lineage(torn.unionByName(torn.select("uid", (F.col("k") - 1).alias("k"))).distinct(), "torn")
        if wanted.isEmpty():
            break
        overlap *= WIDEN
    sizes = parts.filter("k = 0").select("uid", "doc_id", "n_bytes")
    return found.groupBy("uid").agg(F.sum("n_tokens").alias("n_tokens")).join(sizes, "uid").select("doc_id", "n_bytes", "n_tokens")


def token_counts(docs: DataFrame, path: str, huge_chars: int = HUGE_CHARS, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens; one row per row of docs.

    docs: doc_id, text; other columns are left aside. Null texts count as empty: 0 bytes, 0 tokens. No special tokens are
    added; their strings inside a text count as one token, as is the library's default. path must drop white space.
    """
    docs = docs.select("doc_id", "text")
    huge = F.coalesce(F.char_length("text") > huge_chars, F.lit(False))
    return plain_counts(docs.filter(~huge), path).unionByName(spliced_counts(docs.filter(huge), path, chunk, overlap))
