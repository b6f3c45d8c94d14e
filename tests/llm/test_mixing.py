"""Mixing against plain water filling, and the properties of the mix."""

import re

from pyspark.sql import functions as F

from plumbline.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest, weights = 1.5 * total - sum(fixed.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / weights > 2 * sizes[s]]
        if not over:
            return fixed | {s: rest * weight[s] / weights for s in open_}
        fixed |= {s: 2 * sizes[s] for s in over}


def corpus():
    rows = [(i, " ".join(["w"] * (i * 37 % 300)), f"s{i % 7}" if i % 3 else "hot", 0) for i in range(600)]
    return rows + [(1, rows[1][1], "hot", 0), (1, rows[1][1], "hot", 0), (None, "a b c", None, 0), (9, None, "none", None), (10, "", "hot", 0), (11, "x y " * 5000, "big", 0), (12, " lead\tand  tail ", "é", 0)]


def test_targets_and_properties(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 50)
    monkeypatch.setattr(mixing, "RANGE_SLOTS", 16)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 64)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as size", "2 as taken", "3 as sid", "4 as block", "5 as __size", "6 as __own_0")
    found = mixing.with_taken(df, "doc_id", "source").collect()
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = plain_targets(sizes)
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = mixing.with_taken(df.repartition(5), "doc_id", "source").collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))

    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    words = mixed.select("source", F.size(F.regexp_extract_all("text", F.lit(mixing.WORD), 1)).alias("n"), "n_chars", F.length("text").alias("chars")).collect()
    per = {}
    for r in words:
        per[r["source"]] = per.get(r["source"], 0) + r["n"]
        assert r["n_chars"] == r["chars"]
    assert per == {s: n for s, n in taken.items() if n}


def test_schedule_is_even_all_along(spark):
    df = spark.createDataFrame([(i, "w " * 100, f"s{i % 4}", 0) for i in range(400)], SCHEMA)
    placed, mixed, sources = mixing.mix(df, "doc_id")
    share = {r["sid"]: r["words"] for r in sources.collect()}
    slots = sorted({(r["slot"], r["sid"]) for r in mixed.select("slot", "sid").distinct().collect()})
    total = sum(share.values())
    for cut in (20, 60, 120, 200):
        for sid, words in share.items():
            got = sum(s == sid for _, s in slots[:cut])
            assert abs(got - cut * words / total) <= 3


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.with_taken(empty, "doc_id").collect() == [] and mixing.mixed_documents(empty).collect() == []
    wordless = spark.createDataFrame([(1, None, "a", 0), (2, " ", None, 0)], SCHEMA)
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.with_taken(wordless, "doc_id").collect()] == [(0, 0.0, 0)] * 2
