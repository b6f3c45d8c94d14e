"""A training corpus from the documents table: five stages, each on all that the one before it kept."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import bpe, language_id, mixing, near_copies, quality
from plumbline.llm.queries import vocabulary_file
from plumbline.session import cut_lineage, folders_made, remove_folders
from plumbline.tables import Tables

#: Documents whose profile is farther from every language than this share of the greatest distance are in none.
MIN_LANGUAGE_SCORE = 0.2


#: Rows in a batch that goes to Python. Spark's 10,000 whole texts are held several times over, in both processes.
BATCH_ROWS = 512
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Tables that the last stage over a folder made on its way.
_MADE: dict[str, list[str]] = {}


def stage(build):
    """A stage whose tables go once the next one over the same folder begins: by then its result has been written."""

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_folders(spark, _MADE.pop(sf_dir, []))
        told = int(spark.conf.get(BATCH_KEY, "0"))
        if told <= 0 or told > BATCH_ROWS:  # 0: no limit; it holds for what the caller runs on the result
            spark.conf.set(BATCH_KEY, str(BATCH_ROWS))
        with folders_made() as made:
            out = build(spark, docs, sf_dir)
        _MADE[sf_dir] = made
        return out

    return run_stage


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language of the corpus."""
    return language_id.language_filter(docs, MIN_LANGUAGE_SCORE)


@stage
def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass every quality rule."""
    return quality.quality_filter(docs)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five-word shingles with a similarity of 0.8 or more."""
    return near_copies.drop_near_copies(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often, and as far, as it takes them."""
    return mixing.mixed_documents(docs)


@stage
def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document of the mix."""
    return bpe.round_trip_digests(docs, vocabulary_file("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("bpe_round_trip", encode_tokens),
]

#: SQL has neither the profiles nor the merges; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each one's result is a table in the shared folder."""
    docs = Tables(spark, sf_dir).documents
    for name, build in STAGES[:-1]:
        docs = cut_lineage(build(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
