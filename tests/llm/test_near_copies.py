"""Near copies against a plain version."""

import random

import numpy as np

import corpus_pipeline
from plumbline.llm import metric_join, near_copies, shingle_sets, simhash

SCHEMA = "doc_id long, text string"


def plain_survivors(rows):
    """Smallest ids of the components of rows whose sets of five-word shingles have Jaccard 0.8 or more."""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    kept, left = [], set(sets)
    while left:
        todo = [min(left)]
        kept.append(todo[0])
        left.discard(todo[0])
        while todo:
            a = sets[todo.pop()]
            near = {y for y in left if 5 * len(a & sets[y]) >= 4 * len(a | sets[y])}
            left -= near
            todo.extend(near)
    return kept


def planted():
    pick = random.Random(8)
    word = lambda: "".join(pick.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(40)]  # in half of all texts
    texts = [None, "", " \n", "one two", "ONE  two", "one two three"]
    for i in range(30):
        base = [word() for _ in range(pick.choice((6, 12, 40, 150, 600)))] + passage * (i % 2)
        texts.append(" ".join(base))
        for _ in range(6):
            copy = list(base)
            for _ in range(pick.randint(1, max(1, len(base) // 40))):
                copy[pick.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper())
            if pick.random() < 0.5:
                base = copy  # chains
    pick.shuffle(texts)
    return list(enumerate(texts))


def test_planted_copies_match_a_plain_version(spark):
    rows = planted()
    found = near_copies.drop_near_copies(spark.createDataFrame(rows, SCHEMA))
    want = plain_survivors(rows)
    assert 10 < len(want) < len(rows) - 50
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(want)


def test_order_of_shingles_never_decides(spark, monkeypatch):
    rows = planted()
    monkeypatch.setattr(shingle_sets, "SAMPLE_DOCS", 0)
    found = near_copies.drop_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(plain_survivors(rows))


def test_the_stage_drops_copies_of_080_to_095(spark):
    pick = random.Random(9)
    rows, shares = [], []
    for i in range(0, 200, 2):
        base = [str(pick.getrandbits(40)) for _ in range(pick.choice((60, 200, 500)))]
        n, changed = len(base) - 4, list(base)
        at = 0
        while True:  # changes five words apart cost five shingles each
            trial = list(changed)
            trial[at] = "new"
            grams = [{tuple(x[j : j + 5]) for j in range(n)} for x in (base, trial)]
            share = len(grams[0] & grams[1]) / len(grams[0] | grams[1])
            if share < 0.8 or (share < 0.95 and pick.random() < 0.3):
                break
            changed, at = trial, at + 7
        shares.append(share)
        rows += [(i, " ".join(base)), (i + 1, " ".join(changed))]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()}
    assert kept == set(range(0, 200, 2))


def test_columns_repeats_and_missing_ids(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (1, "A b c d e f"), (None, "x"), (None, "x"), (5, None), (4, "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "2 as hub", "3 as __kept")
    found = near_copies.drop_near_copies(df)
    assert found.columns == df.columns
    assert sorted((r["doc_id"] for r in found.collect()), key=repr) == sorted([1, 4, None, None], key=repr)
    assert near_copies.drop_near_copies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    text = {x: " ".join(f"{x}{i}" for i in range(30)) for x in "abcd"}
    rows = [(1, text["a"], 1), (1, text["b"], 2), (2, text["b"], 3), (3, text["c"], 4), (3, text["c"], 2), (3, text["c"], 9), (0, text["d"], 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    want = sorted([(1, text["a"], 1), (1, text["b"], 2), (3, text["c"], 2), (0, text["d"], 5)])
    for drop in (near_copies.drop_near_copies, simhash.drop_near_duplicates):
        assert sorted(tuple(r) for r in drop(df).collect()) == want


def test_one_large_group_and_one_common_passage(spark):
    """5000 near copies of one text, and a passage that 3000 other texts share."""
    pick = random.Random(10)
    base, passage = [f"b{i}" for i in range(60)], " ".join(f"p{i}" for i in range(50))
    rows = [(i, " ".join(f"e{pick.randrange(10**8)}" if pick.random() < 0.02 else w for w in base)) for i in range(5000)]
    rows += [(i, " ".join(f"w{pick.randrange(10**8)}" for _ in range(40)) + " " + passage) for i in range(5000, 8000)]
    kept = {r["doc_id"] for r in near_copies.drop_near_copies(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()}
    assert set(range(5000, 8000)) <= kept
    # a shingle stands at one place only, so that two texts share the places where theirs are equal
    numbers: dict = {}
    grams = np.array([[numbers.setdefault(tuple(t[j : j + 5]), len(numbers)) for j in range(56)] for _, text in rows[:5000] for t in [text.split()]])
    lone = sorted(kept & set(range(5000)))
    assert lone[0] == 0 and len(lone) < 4000
    for i in lone[1:]:  # what stays links with no smaller id
        common = (grams[:i] == grams[i]).sum(axis=1)
        assert not (5 * common >= 4 * (112 - common)).any()


def test_a_very_long_text(spark):
    words = [f"w{i}" for i in range(200_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:190_000])), (3, " ".join(words[:100_000])), (4, "x " * 500_000), (5, "x " * 400_000)]
    assert sorted(r["doc_id"] for r in near_copies.drop_near_copies(spark.createDataFrame(rows, SCHEMA)).collect()) == [1, 3, 4]


def test_fingerprints_propose_and_sets_decide(spark, monkeypatch):
    """What SimHash links goes if the sets link too, before any shingle is looked up."""
    pick = random.Random(12)
    long = [f"w{pick.getrandbits(40)}" for _ in range(3000)]
    tail = lambda: " ".join(f"t{pick.getrandbits(40)}" for _ in range(10))
    rows = [(1, " ".join(long)), (2, " ".join(long[:1500] + ["other"] + long[1501:])), (3, "a " * 1000 + tail()), (4, "a " * 1000 + tail()), (5, "alone"), (6, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    sets = shingle_sets.shingle_sets(df, 5, near_copies.SIMILARITY, fingerprints=True)
    assert {r["doc_id"]: r["fp"] for r in sets.collect()} == {i: simhash.fingerprint(text, 5) for i, text in rows}
    node = {r["node"]: r["doc_id"] for r in sets.collect()}
    groups = {}
    for r in near_copies.fingerprint_groups(sets).collect():
        groups.setdefault(r["region"], set()).add(node[r["node"]])
    assert sorted(map(sorted, groups.values())) == [[1, 2], [3, 4]]
    monkeypatch.setattr(metric_join, "_regions", lambda likely, *_: likely.selectExpr("node AS region", "node").limit(0))
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()) == [1, 3, 4, 5, 6]
