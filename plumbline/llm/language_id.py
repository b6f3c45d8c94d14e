"""Language identification with rank-order profiles.

A profile is a language's n-grams (one to three letters, words padded by one blank) in descending order of
frequency, cut at a fixed length. A document's own profile is made in the same way from its whole text; its
out-of-place distance to a language is the sum, over its n-grams, of how far each stands from its place in the
language's profile, n-grams that the language's profile lacks counting the full profile length.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.batches import portions
from plumbline.llm.names import free_names

UNDETERMINED = "und"
BLANK = 32
#: Length of a profile, of a language as of a document.
PROFILE_LENGTH = 300
#: Expected number of documents per language that the profiles are learned from (all, if a language has fewer).
SAMPLE_DOCS = 4000
#: Distinct lang values that profiles are learned for; as many or more are refused, since that is no language column.
MAX_LANGUAGES = 10_000
#: Characters of one language that are counted together while learning.
BLOCK_CHARS = 1 << 18


@functools.cache
def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(text: str) -> np.ndarray:
    """Keys of all n-grams of a text, repeats included; empty if it has no letter.

    A key packs up to three code points of 21 bits. A blank stands for each run of other characters, and both ends.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = letter_table()[points]
    if not letters.any():
        return np.empty(0, np.int64)
    padded = np.full(len(points) + 2, BLANK, np.int64)
    padded[1:-1][letters] = points[letters]
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != BLANK) | (padded[:-1] != BLANK)
    one = padded[keep]
    two = (one[:-1] << 21) | one[1:]
    three = ((one[:-2] << 42) | (one[1:-1] << 21) | one[2:])[one[1:-1] != BLANK]
    return np.concatenate([one[one != BLANK], two, three])


def ranked(keys: np.ndarray, length: int) -> np.ndarray:
    """The most frequent keys, most frequent first, ties to the smaller key."""
    values, counts = np.unique(keys, return_counts=True)
    return values[np.lexsort((values, -counts))[:length]]


def held_out(doc_id) -> F.Column:
    """Whether a document stays out of learning: crc32 of its id as text leaves 2 when divided by 4. Null ids: no."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def profiles(docs: DataFrame, length: int = PROFILE_LENGTH, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per language and profile place: lang, gram (packed key), place (from 0).

    docs: doc_id, text, lang. Learns from documents with a lang, an id and a text that are not held out; of each language
    a sample drawn by a hash of the id, of sample_docs documents in expectation. Counts are summed per task, so a language
    with most of the rows is spread over all tasks. Empty input gives no rows.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # one row per language: the share of its documents that is read
    share = labelled.groupBy("lang").agg((F.lit(float(sample_docs)) / F.count("*")).alias("share"))
    drawn = (F.xxhash64("doc_id", F.lit("profile sample")).bitwiseAND(0xFFFFFF) / float(1 << 24)) < F.col("share")
    counted = (
        labelled.filter(F.col("text").isNotNull())
        .join(F.broadcast(share.limit(MAX_LANGUAGES)), "lang")
        .filter(drawn)
        .select("lang", "text")
        .mapInArrow(_count_grams, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = [F.desc("n"), F.asc("gram")]
    # cut in two steps, so that no task sorts all n-grams of a language
    part = Window.partitionBy("lang", F.pmod(F.col("gram"), F.lit(31))).orderBy(*order)
    first = counted.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= length)
    whole = Window.partitionBy("lang").orderBy(*order)
    return first.withColumn("place", F.row_number().over(whole) - 1).filter(F.col("place") < length).select("lang", "gram", "place")


def _count_grams(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, list[str]] = {}
    size: dict[str, int] = {}

    def counted(lang: str) -> pa.RecordBatch:
        values, counts = np.unique(grams(" ".join(waiting.pop(lang))), return_counts=True)
        size.pop(lang)
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(values)), pa.array(values), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])

    for part in portions(rows, 1):
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            waiting.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
            if size[lang] >= BLOCK_CHARS:
                yield counted(lang)
        if sum(size.values()) > 16 * BLOCK_CHARS:
            for lang in list(waiting):
                yield counted(lang)
    for lang in list(waiting):
        yield counted(lang)


class Model:
    """Languages in order of their names, all n-grams of their profiles, and each one's place in each language."""

    def __init__(self, rows: list[tuple[str, int, int]], length: int):
        self.length = length
        self.langs = sorted({r[0] for r in rows})
        self.keys = np.unique(np.array([r[1] for r in rows], np.int64))
        self.places = np.full((len(self.langs), len(self.keys)), -1, np.int64)
        at = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.places[at[lang], np.searchsorted(self.keys, gram)] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language of least distance (ties: the smaller name), and 1 less its share of the greatest possible distance."""
        keys = grams(text) if text else np.empty(0, np.int64)
        if not len(keys) or not self.langs:
            return UNDETERMINED, 0.0
        own = ranked(keys, self.length)
        found = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        places = np.where(self.keys[found] == own, self.places[:, found], -1)
        far = np.where(places < 0, self.length, np.abs(places - np.arange(len(own)))).sum(axis=1)
        best = int(far.argmin())
        return self.langs[best], float(1 - far[best] / (self.length * len(own)))


def learn(docs: DataFrame, length: int = PROFILE_LENGTH, sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of `profiles`. What comes to the driver is length rows per language."""
    found = profiles(docs, length, sample_docs).collect()
    if len({r["lang"] for r in found}) >= MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Model([(r["lang"], r["gram"], r["place"]) for r in found], length)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), as_names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns keep of docs, lang_pred and score (0 to 1; as_names gives other names), one row per row of docs.

    Only the text is looked at, all of it. Text null, empty or without letters: `und`, score 0; likewise if the model knows
    no language. Columns of docs other than keep and text are left aside, whatever their names.
    """
    fields = [f for f in docs.schema.fields if f.name in keep]
    made = [T.StructField(name, kind) for name, kind in zip(as_names, (T.StringType(), T.DoubleType()), strict=True)]
    schema = T.StructType([*fields, *made])
    names = [f.name for f in fields]
    own_text = [] if "text" in names else [F.col("text").alias("__text")]  # a kept text is not sent twice
    n = names.index("text") if "text" in names else len(fields)

    def predict(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, n):
            found = [model.predict(x.as_py()) for x in part.column(n)]
            own = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(fields)], *own], schema.names)

    return docs.select(*(F.col(f"`{f.name}`") for f in fields), *own_text).mapInArrow(predict, schema)


def language_filter(docs: DataFrame, min_score: float = 0.0, length: int = PROFILE_LENGTH, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Rows of docs whose text is in a learned language with a score of min_score or more; the columns of docs.

    Rejected: null texts, texts without letters, and those below min_score. Repeated rows stay as often as they come.
    """
    model = learn(docs, length, sample_docs)
    lang, score = free_names(docs, "lang_pred", "score")
    found = identify(docs, model, tuple(docs.columns), (lang, score))
    return found.filter((F.col(lang) != UNDETERMINED) & (F.col(score) >= min_score)).drop(lang, score)
