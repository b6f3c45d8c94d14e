"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from plumbline.llm import metric_join

SCHEMA = "doc_id long, text string"
LINK = metric_join.LINK


def plain_shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def plain(rows, words=4, link=LINK):
    sets = [plain_shingles(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    at = {}
    for i, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in at[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if link[1] * c >= link[0] * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    return sorted(((d, len(s), min((x for x in least[find(i)] if x is not None), default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def edited(pick, words, n):
    out = list(words)
    for _ in range(n):
        out[pick.randrange(len(out))] = f"e{pick.randrange(10**9)}"
    return out


def corpus(seed):
    """Unrelated texts, families at all distances, one passage in most texts, and repeats."""
    pick = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for _ in range(120):
        words = [f"w{pick.randrange(3000)}" for _ in range(pick.choice([1, 2, 3, 4, 5, 30, 60, 200]))]
        rows.append(" ".join(words + passage * pick.randrange(2)))
        for _ in range(pick.choice([0, 0, 0, 2, 6])):
            rows.append(" ".join(edited(pick, words, pick.randrange(1, 4))))
    base = [f"b{i}" for i in range(60)]
    rows += [" ".join(edited(pick, base, pick.randrange(0, 4))) for _ in range(250)]
    rows += [" ".join(passage), "The Same.", "the same.", "the  same.", "", None, " \n", "x"] + rows[:20]
    pick.shuffle(rows)
    return list(enumerate(rows)) + [(3, "other text of a known id"), (None, rows[0]), (None, "alone without any id")]


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 as node", "'x' as region", "2 as n", "3 as component_id")
    assert sorted((tuple(r) for r in metric_join.similar_documents(df).collect()), key=repr) == plain(rows)


def test_against_all_pairs(spark):
    check(spark, corpus(1))


def test_regions_split_by_joins_and_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "REGION_SHINGLES", 3000)
    monkeypatch.setattr(metric_join, "PIVOTS", 3)
    check(spark, corpus(2))


def test_odd_tables(spark):
    assert metric_join.similar_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    check(spark, [(1, None), (2, "")])
    long = "many words " * 300_000
    check(spark, [(5, long), (4, long + "and more"), (9, " ".join(f"w{i}" for i in range(100_000))), (7, " ".join(f"w{i}" for i in range(90_000)))])


def test_a_link_at_the_limit(spark):
    words = [f"w{i}" for i in range(103)]  # 100 shingles; 85 of them in the shorter one
    check(spark, [(1, " ".join(words)), (2, " ".join(words[:88])), (3, " ".join(words[:87]))])


@pytest.mark.parametrize("seed", range(6))
def test_regions_in_a_task(seed, monkeypatch):
    """Links inside a region tie what all pairs tie, at all sizes of leaves."""
    monkeypatch.setattr(metric_join, "LEAF", 4)
    pick = np.random.default_rng(seed)
    centres = [pick.choice(5000, 80, False) for _ in range(12)]
    sets = []
    for _ in range(220):
        own = set(centres[pick.integers(12)].tolist())
        for x in pick.choice(sorted(own), pick.integers(0, 14), False).tolist():
            own.remove(x)
            own.add(int(pick.integers(5000, 9000)))
        sets.append(np.array(sorted(own)))
    comps = np.arange(len(sets))
    home = pick.random(len(sets)) < 0.7
    root = comps.copy()

    def tied(pairs):
        root = list(range(len(sets)))
        for i, j in pairs:
            a, b = root[i], root[j]
            root = [a if x == b else x for x in root]
        return [root.index(x) for x in root]

    wanted = [(i, j) for i in range(len(sets)) for j in range(i) if (home[i] or home[j]) and metric_join.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), LINK)]
    found = metric_join.region_links(sets, comps, home, LINK)
    assert len(wanted) > 50 and set(map(frozenset, found)) <= set(map(frozenset, wanted))
    assert tied(found) == tied(wanted)
