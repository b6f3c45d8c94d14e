"""The registered queries on the smallest tables, and the pipeline."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check_queries import compare, duck
from plumbline.llm.queries import ORACLES, QUERIES, vocabulary_file
from plumbline.tables import Tables

from . import test_language_id, test_mixing, test_near_copies, test_quality

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    ok, message, _ = compare(spark, duck(FOLDER), FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert ok, message


def test_pipeline_stage_by_stage(spark):
    docs = Tables(spark, FOLDER).documents
    columns = docs.columns
    counts = [docs.count()]
    labels = {r["doc_id"]: r for r in Tables(spark, FOLDER).labels.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, FOLDER), "test")
        assert docs.columns == columns
        counts.append(docs.count())
        if name == "quality_rules":
            kept = {r["doc_id"] for r in docs.collect()}
    assert counts[1] <= counts[0] and counts[2] < counts[1] and counts[3] < counts[2]
    bad = [i for i, r in labels.items() if r["quality"] == 0]
    assert sum(i not in kept for i in bad) >= 0.7 * len(bad)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert final.count() == counts[-1]
    assert sorted(map(repr, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(repr, final.collect()))


def plain_languages(rows, length=300):
    """Documents that the language stage keeps, by plain profiles over all documents that are not held out."""
    texts = {}
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            texts.setdefault(r["lang"], []).append(r["text"])
    profiles = {lang: {g: i for i, g in enumerate(test_language_id.plain_profile(" ".join(t), length))} for lang, t in texts.items()}
    kept = []
    for r in rows:
        own = test_language_id.plain_profile(r["text"], length)
        far = min(sum(abs(p[g] - i) if g in p else length for i, g in enumerate(own)) for p in profiles.values())
        if own and 1 - far / (length * len(own)) >= corpus_pipeline.MIN_LANGUAGE_SCORE:
            kept.append(r)
    return kept


def plain_survivors(rows):
    """The document with the smallest id of each group of near copies."""
    kept = set(test_near_copies.plain_survivors([(r["doc_id"], r["text"]) for r in rows]))
    return [r for r in rows if r["doc_id"] in kept]


def test_pipeline_against_a_plain_version(spark):
    docs = Tables(spark, FOLDER).documents
    rows = docs.collect()
    for (name, stage), plain in zip(
        corpus_pipeline.STAGES[:3], (plain_languages, lambda rows: [r for r in rows if test_quality.plain(r["text"])[-1]], plain_survivors), strict=True
    ):
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, FOLDER), "test")
        rows = plain(rows)
        assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, rows)), name

    mixed = corpus_pipeline.cut_lineage(corpus_pipeline.STAGES[3][1](spark, docs, FOLDER), "test")
    text = {r["doc_id"]: r["text"] for r in rows}
    words = lambda t: len(test_quality.WORD.findall(t))
    sizes, taken = {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    for r in mixed.collect():
        assert text[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
        taken[r["source"]] = taken.get(r["source"], 0) + words(r["text"])
    want = test_mixing.plain_targets(sizes)
    assert all(abs(taken.get(s, 0) - want[s]) <= 0.5 for s in want)

    library = Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json"))
    digest = lambda b: hashlib.sha256(b).hexdigest()
    encoded = []
    for r in mixed.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        encoded.append((r["doc_id"], len(ids), digest(np.array(ids, "<u4").tobytes()), digest(r["text"].encode())))
    assert sorted(map(tuple, corpus_pipeline.STAGES[4][1](spark, mixed, FOLDER).collect())) == sorted(encoded)
