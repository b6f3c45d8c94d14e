"""Rank-order profiles against a plain version, and held-out accuracy."""

import zlib
from collections import Counter

from plumbline.llm import language_id as li
from plumbline.tables import Tables

SCHEMA = "doc_id long, text string, lang string"


def plain_profile(text, length):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    counts = Counter()
    padded = " " + " ".join(words) + " "
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            gram = padded[i : i + n]
            if (n == 1 and gram == " ") or (n == 3 and gram[1] == " "):
                continue
            counts[gram] += 1
    number = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:length] if words else []


def plain_language(text, profiles, length):
    own = plain_profile(text, length)
    far = {lang: sum(abs(p.index(g) - i) if g in p else length for i, g in enumerate(own)) for lang, p in profiles.items()}
    best = min(far, key=lambda lang: (far[lang], lang))
    return best, 1 - far[best] / (length * len(own))


def test_predictions_match_a_plain_version(spark):
    texts = {"de": "der die das und ist nicht über schön", "en": "the and of to that with this is", "fr": "le la les des été où et que"}
    rows = [(i, f"{texts[lang]} {i} {texts[lang][: i % 11]}", lang) for i, lang in enumerate(list(texts) * 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    profiles = {lang: plain_profile(" ".join(t for i, t, g in rows if g == lang and zlib.crc32(str(i).encode()) % 4 != 2), 40) for lang in texts}
    model = li.learn(df, 40)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in li.identify(df, model).collect()}
    for i, text, _ in rows:
        lang, score = plain_language(text, profiles, 40)
        assert got[i][0] == lang and abs(got[i][1] - score) < 1e-12


def test_nulls_empty_texts_repeats_and_clashing_columns(spark):
    rows = [(1, "das ist gut", "de"), (1, "das ist gut", "de"), (None, "und nun", "de"), (3, None, "de"), (4, "", None), (5, "12 !? 3", "de"), (7, "gut", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as lang_pred", "2 as lang_pred_", "3 as n", "4 as gram", "5 as place", "6 as share")
    found = li.identify(df, li.learn(df)).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in found) == [(0, "de"), (1, "de"), (1, "de"), (3, "und"), (4, "und"), (5, "und"), (7, "de")]
    assert all(0 <= r["score"] <= 1 for r in found)
    assert li.language_filter(df).columns == df.columns and li.language_filter(df).count() == 4


def test_no_rows_and_no_languages(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert li.identify(empty, li.learn(empty)).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text", None)], SCHEMA)
    assert [r["lang_pred"] for r in li.identify(unlabelled, li.learn(unlabelled)).collect()] == ["und"]


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "das ist gut " * 50_000, "de"), (8, "the cat is here " * 1000, "en")], SCHEMA)
    assert {r["doc_id"]: r["lang_pred"] for r in li.identify(df, li.learn(df)).collect()} == {1: "de", 8: "en"}


def test_held_out_accuracy(spark):
    docs = Tables(spark, "/root/testdata/sf0.001").documents
    model = li.learn(docs)
    found = li.identify(docs, model, ("doc_id", "lang")).filter(li.held_out(li.F.col("doc_id"))).collect()
    assert len(found) > 20 and sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)


def test_a_kept_text_is_sent_once(spark):
    docs = spark.createDataFrame([(1, "abc", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    found = li.identify(docs, li.Model([("en", ord("a"), 0)], 5), ("text", "doc_id"))
    assert "__text" not in found._jdf.queryExecution().analyzed().toString()
    assert [(r["doc_id"], r["text"], r["lang_pred"]) for r in found.orderBy("doc_id").collect()] == [(1, "abc", "en"), (2, None, "und")]
