"""Ranked search against a plain version over all documents."""

import math
import random
import re

import numpy as np
import pytest

from plumbline.llm import lexical

SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k):
    own = [(i, plain_terms(text)) for i, text in docs]
    total, documents = sum(len(t) for _, t in own), sum(bool(t) for _, t in own)
    df, queries, out = {}, {}, []
    for _, t in own:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    for item, text in items:
        queries.setdefault(item, set()).update(plain_terms(text))
    for item, asked in queries.items():
        scored = []
        for doc_id, t in own:
            m = t and 50 + 50 * len(t) * documents // total
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 20 * m)) for x in asked if x in t)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, k=5, **options):
    docs_df = spark.createDataFrame(docs, SCHEMA).repartition(4).selectExpr("*", "1 as item_id", "2 as n", "'x' as terms", "3 as rank")
    items_df = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as doc_id", "2 as score", "'x' as term")
    found = lexical.search(docs_df, items_df, k, **options)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items, k)


def corpus(seed):
    """Frequent and rare words, copies that tie, odd texts, ids that repeat or are missing."""
    pick = random.Random(seed)
    word = lambda: pick.choice("abcdefgh") if pick.random() < 0.5 else f"w{int(pick.paretovariate(0.6)) % 900}"
    docs = [(i, " ".join(word() for _ in range(pick.randrange(1, 60)))) for i in range(500)]
    docs += [(500 + i, docs[i][1]) for i in range(40)] + [(3, docs[9][1]), (3, docs[9][1]), (None, docs[5][1]), (None, "a b"), (900, None), (901, ""), (902, " \n,")]
    items = [(i, " ".join(word() for _ in range(pick.randrange(1, 25)))) for i in range(30)]
    items += [(4, "w1 W2 w3"), (4, "w1 W2 w3"), (None, "a w5"), (50, None), (51, "!?"), (52, "nowhere"), (53, "Ä ä Straße 漢字 x1"), (54, "a a a b")]
    return docs + [(903, "Ä Straße 漢字,漢字 X1"), (904, "ä straße\x7fx1")], items


@pytest.mark.parametrize("block, short_part", [(2048, 200), (16, 20), (7, 1), (50, 10**9)])
def test_against_a_plain_version(spark, monkeypatch, block, short_part):
    """All lists short, all long, and both; blocks of few documents."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    check(spark, *corpus(block), short_part=short_part)


def test_queries_in_portions(spark, monkeypatch):
    docs, items = corpus(1)
    cut = lexical.query_portions(spark.createDataFrame(items, ITEMS), 40)
    sizes = [sum(len(own) for _, own in portion) for portion in cut]
    assert len(sizes) > 5 and max(sizes) < 80
    monkeypatch.setattr(lexical.query_portions, "__defaults__", (40,))
    check(spark, docs, items)


def test_long_texts_and_empty_tables(spark):
    check(spark, [(1, "word other " * 300_000), (2, "word"), (3, "x" * 2_000_000)], [(1, "word"), (2, "x" * 2_000_000), (3, "other word " * 100_000)])
    check(spark, [], [(1, "word")])
    check(spark, [(1, "word")], [])
    check(spark, [(1, None)], [(1, "word")])


def test_terms_are_runs_of_letters_and_digits():
    pick = random.Random(2)
    for _ in range(300):
        text = "".join(chr(pick.choice([pick.randrange(128), pick.randrange(0x80, 0x2100), 0x1F600])) for _ in range(30))
        assert [t.decode() for t in lexical.terms(text.encode())] == plain_terms(text)


def test_lists_below_the_bar_name_no_candidates():
    rare, common = (np.array([3, 9]), np.array([100, 90])), (np.arange(10), np.full(10, 20))
    at, scores = lexical.evaluate([rare, common], 95, 10)
    assert at.tolist() == [3, 9] and scores.tolist() == [120, 110]
    at, scores = lexical.evaluate([rare, common], 20, 10)
    assert at.tolist() == list(range(10)) and scores[3] == 120
