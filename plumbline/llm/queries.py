"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, conversations, html_text, language_id, lexical, licenses, metric_join, mixing, oracles, quality, simhash, token_counts, topk, warc
from plumbline.tables import Tables

#: Name of the module that says where the vocabulary files are; a query's only setting.
TOKENIZERS = "public_tokenizers"

#: Tokens above which a document is over the limit.
LENGTH_LIMIT = 2048

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_warc_round_trip": oracles.WARC,
    "op4_license_scan": oracles.LICENSE_SCAN,
    "op5_quality_rules": oracles.QUALITY,
    "op7_exact_top_k": oracles.TOP_K,
    "op12_lexical_search": oracles.LEXICAL,
}


def query(run):
    QUERIES[run.__name__] = run
    return run


def vocabulary_file(name: str) -> str:
    return importlib.import_module(TOKENIZERS).path(name)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = Tables(spark, sf_dir).documents
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(Tables(spark, sf_dir).documents)
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality rules on every document."""
    return quality.assess(Tables(spark, sf_dir).documents)


@query
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte-level BPE, and their decoded text, as digests."""
    return bpe.round_trip_digests(Tables(spark, sf_dir).documents, vocabulary_file("byte_bpe_50k.json"))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of all sources takes."""
    return mixing.with_taken(Tables(spark, sf_dir).documents, "doc_id")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the length limit."""
    found = token_counts.token_counts(Tables(spark, sf_dir).documents, vocabulary_file("word_bpe_49k.json"))
    return found.select("*", (F.col("n_tokens") > LENGTH_LIMIT).alias("over_limit"))


@query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best candidates of every hundredth vector among all vectors."""
    return topk.top_k(Tables(spark, sf_dir).embeddings)


@query
def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of an archive, written and read back."""
    return warc.round_trip(Tables(spark, sf_dir).pages)


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document as a whole, and of its lines."""
    return licenses.scan(Tables(spark, sf_dir).documents)


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, laid out."""
    found = html_text.extract(Tables(spark, sf_dir).pages)
    return found.select("page_id", F.length("text").alias("n_chars"), "text")


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    tables = Tables(spark, sf_dir)
    return lexical.search(tables.documents, tables.benchmark)


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every conversation after damage, its cheapest repair, and the digest of what that gives."""
    return conversations.repair(Tables(spark, sf_dir).conversations)


@query
def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of every document, and its component of similar documents."""
    return metric_join.similar_documents(Tables(spark, sf_dir).documents)
