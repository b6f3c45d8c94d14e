"""Operators on dense, skewed and far-flung inputs: what they give, and how many rows their joins make."""

import hashlib
import math
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from plumbline.operators import aggregate as a
from plumbline.operators import evidence as e
from plumbline.operators import joins as j
from plumbline.operators import sequence as s
from plumbline.sources import packages as pk

from .conftest import rows


def joined_rows(df):
    """The largest number of rows that a join of the query's last plan made."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, todo = [0], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
    return max(found)


# gaps


def test_one_stray_score_is_only_a_wide_gap(frame):
    df = frame("g int, score int", (1, 1), (1, 2_000_000_000), (1, 5), (1, 5), (2, 7), (3, None), (3, 4), (3, 1))
    assert rows(a.gap_summary(df, ["g"], "score", 3), "g", "score_rows", "max_score", "min_score", "missing_count", "missing_sample") == [
        (1, 3, 2_000_000_000, 1, 1_999_999_997, "1999999999,1999999998,1999999997"),
        (2, 1, 7, 7, 0, ""),
        (3, 3, 4, 1, 2, "3,2"),
    ]


def test_gaps_of_a_group_in_many_ranges(spark, many_ranges):
    rng = random.Random(1)
    scores = {rng.randrange(4000) for _ in range(1500)}
    df = spark.createDataFrame([(None if i % 2 else 1, x) for i in range(2) for x in scores], "g int, score int").repartition(6)
    missing = sorted(set(range(min(scores), max(scores))) - scores, reverse=True)
    want = [(g, len(scores), len(missing), ",".join(map(str, missing[:20]))) for g in (1, None)]
    assert rows(a.gap_summary(df, ["g"], "score", 20), "g", "score_rows", "missing_count", "missing_sample") == sorted(want, key=repr)


# lines


def plain_lines(ys, tolerance):
    out, start = {}, None
    for y in sorted(set(ys)):
        if start is None or y - start > tolerance:
            start = y
        out[y] = start
    return out


def test_a_dense_page_in_many_tasks(spark, many_ranges):
    """One stretch without a wide gap over all tasks, and pages of their own beside it."""
    rng = random.Random(2)
    ys = {1: [i * 0.75 for i in range(20_000)], 2: [round(rng.uniform(0, 300), 1) for _ in range(800)], 3: [5.0], 4: [0.1 * i for i in range(200)]}
    df = spark.createDataFrame([(p, y) for p, values in ys.items() for y in values], "page int, y double").repartition(8)
    placed = s.line_groups(df, ["page"], 4.0)
    got = {(r.page, r.y): r.first_y for r in placed.distinct().collect()}
    want = {(p, y): first for p, values in ys.items() for y, first in plain_lines(values, 4.0).items()}
    assert got == want
    assert placed.count() == sum(map(len, ys.values()))


@pytest.fixture
def many_ranges(spark):
    """Small inputs stay in as many partitions as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_stretches_hold_a_share_of_a_group(spark, many_ranges):
    df = s.in_stretches(spark.range(40_000).select(F.lit(1).alias("g"), F.col("id").alias("x")).repartition(8), ["g"], "x")
    assert df.groupBy("_stretch").count().agg(F.max("count")).first()[0] < 20_000
    told = s.carried(df, ["g"], "x", F.when(F.col("x") % 10_000 == 0, F.col("x")), "last")
    assert told.filter((F.col("x") > 0) & (F.col("last") != F.floor((F.col("x") - 1) / 10_000) * 10_000)).count() == 0
    back = s.carried(df, ["g"], "x", F.when(F.col("x") % 10_000 == 0, F.col("x")), "next", backward=True)
    assert back.filter(F.coalesce("next", F.lit(40_000)) != (F.floor(F.col("x") / 10_000) + 1) * 10_000).count() == 0


# nearest points


@pytest.mark.parametrize("points", [500, 5000])
def test_nearest_pairs_do_not_grow_with_density(spark, points):
    rng = random.Random(points)
    city = lambda n, at: [(1, at + i, rng.uniform(40, 41), rng.uniform(120, 121)) for i in range(n)]
    schema = "g int, place_id int, latitude double, longitude double"
    left, right = city(200, 0), city(points, 10_000)
    found = j.nearest_in_group(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["g"], "place_id")

    def km(a, b):
        (p1, l1), (p2, l2) = (map(math.radians, x) for x in (a, b))
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))

    got = {r.place_id: r.nearest_km for r in found.collect()}
    assert all(abs(got[i] - min(km(p, q) for _, _, *q in right)) < 1e-6 for _, i, *p in left)
    assert joined_rows(found) < 200 * 3 * j.LEAF_POINTS  # of 100,000 and 1,000,000 pairs


def test_points_that_no_cell_tells_apart(frame):
    schema = "g int, place_id int, latitude double, longitude double"
    poles = frame(schema, *[(1, i, 90.0, float(i)) for i in range(40)], (2, 1, -90.0, 0.0), (3, 1, None, 1.0))
    left = frame(schema, (1, 7, 89.0, 10.0), (1, 8, -90.0, 3.0), (2, 7, 90.0, 5.0), (4, 1, 0.0, 0.0), (3, 2, 0.0, 0.0), (1, 9, None, 0.0))
    got = {(r.g, r.place_id): round(r.nearest_km, 3) for r in j.nearest_in_group(left, poles, ["g"], "place_id").collect()}
    assert got == {(1, 7): 111.195, (1, 8): 20015.087, (2, 7): 20015.087}


# keywords


def test_items_and_strengths_by_bitmaps(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    texts = [(i, " ".join(word(rng.randrange(1, 12)) for _ in range(rng.randrange(30)))) for i in range(60)] + [(60, None), (61, "")]
    keywords = sorted({(f"i{i:03}", word(rng.randrange(2, 6))) for i in range(150) for _ in range(3)})
    args = spark.createDataFrame(texts, "id int, t string"), "id", "t", spark.createDataFrame(keywords, "item string, keyword string"), "item"
    want = {}
    for i, t in texts:
        for item, k in keywords:
            if k in (t or ""):
                want[item, i] = want.get((item, i), 0) + len(k)
    for token in (None, "[abc]+"):
        assert sorted(rows(j.item_hits(*args, token=token), "item", "id")) == sorted(want)
        assert {(r["item"], r["id"]): r["strength"] for r in j.item_strengths(*args, token=token).collect()} == want


def test_counts_either_way(frame):
    wanted = frame("row int, match_key string, size int", (1, "a", 10), (2, "a", 20), (2, "b", 20), (3, "c", 40))
    offered = frame("owner string, match_key string", ("A", "a"), ("B", "b"), ("N", "z"))
    listed = frame("row int, owner string, size int", (2, "A", 20), (3, "A", 40), (3, "N", 40))
    got = j.counts_either_way(wanted, offered, listed, "owner", "row", ["size"])
    assert rows(got, "owner", "rows", "size") == [("A", 3, 70), ("B", 1, 20), ("N", 1, 40)]


# names


def test_prefixes_over_all_characters(spark, many_ranges):
    rng = random.Random(4)
    make = lambda n: sorted({"".join(rng.choice("aé漢😀z") for _ in range(rng.randint(2, 8))) for _ in range(n)})
    local, profiles = make(300), make(400)
    got = j.prefix_suggestions(spark.createDataFrame([(x,) for x in local], "name string"), spark.createDataFrame([(x,) for x in profiles], "name string"), 3, 5)
    want = []
    for name in (x for x in local if len(x) >= 3):
        hits = sorted((p for p in profiles if len(p) >= 3 and (name.startswith(p) or p.startswith(name))), key=str.encode)
        want.append((name, len(hits), "|".join(hits) if len(hits) <= 5 else "", hits[0] if len(hits) == 1 else None))
    assert sorted(rows(got, "name", "prefix_matches", "candidates", "suggestion"), key=repr) == sorted(want, key=repr)


def test_a_common_beginning_lists_nothing(spark):
    names = spark.range(3000).select(F.concat(F.lit("common"), F.lpad("id", 5, "0")).alias("name"))
    got = j.prefix_suggestions(spark.createDataFrame([("common",), ("common00017x",), ("none",)], "name string"), names, 4, 3)
    assert rows(got, "name", "prefix_matches", "candidates") == [("common", 3000, ""), ("common00017x", 1, "common00017"), ("none", 0, "")]
    assert joined_rows(got) < 100


def plain_cascade(package, core, tokens, shared, score):
    out = []
    for name in package:
        exact = [c for n, c in core if n == name]
        holds = [c for n, c in core if name and n and n != name and (name in n or n in name)]
        near = []
        for n, c in core:
            p, q = set(tokens(name)), set(tokens(n))
            both = len(p & q)
            if n != name and not (name and n and (name in n or n in name)) and both >= shared and both / min(len(p), len(q)) >= score:
                near.append(c)
        for label, found in (("exact", exact), ("contains", holds), ("token_overlap", near)):
            if found:
                out.append((name, f"{'single' if len(found) == 1 else 'ambiguous'}_{label}", found[0] if len(found) == 1 else None))
                break
        else:
            out.append((name, "no_match", None))
    return sorted(out, key=repr)


def test_cascade_against_all_pairs(spark):
    rng = random.Random(5)
    name = lambda: " ".join("".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3)))
    package, core = sorted({name() for _ in range(120)} | {"", "a"}), [(name(), i) for i in range(90)]
    split = lambda c: F.array_distinct(F.split(c, " "))
    got = j.name_cascade(
        spark.createDataFrame([("s", n) for n in package], "scope string, name string"), spark.createDataFrame([("s", n, c) for n, c in core], "scope string, name string, code int"), ["scope"], split, 2, 0.5
    )
    assert rows(got, "name", "match_hint", "matched_code") == plain_cascade(package, core, lambda x: x.split(" "), 2, 0.5)


def test_one_common_piece_pairs_nothing(spark):
    """Every name holds the same piece; postings stand under rarer ones."""
    long = spark.range(2000).select(F.lit(1).alias("scope"), F.concat(F.lit("common name "), F.lpad("id", 6, "0")).alias("long"))
    short = spark.range(500).select(F.lit(1).alias("scope"), F.concat(F.lit("name "), F.lpad(F.col("id") * 3, 6, "0")).alias("short"))
    found = j.contained_names(short, long, ["scope"])
    assert found.count() == 500 and joined_rows(found) < 100_000  # of 1,000,000 pairs


# text and files


def test_five_hundred_metrics_in_one_plan(spark):
    metrics = [{"metric_key": f"m{i}", "label": f"label{i:03}", "unit": ["number", "score", "ratio"][i % 3], "aliases": [f"alias{i:03}", "shared"]} for i in range(500)]
    lines = spark.createDataFrame([(1, 0, "label007 5", "label007 5"), (1, 1, "the alias010 9.", "the alias010 9."), (1, 2, "nothing", "nothing"), (2, 0, "shared 3%", "shared 3%")], "doc int, line_no int, line string, context string")
    got = rows(e.metric_candidates(lines, ["doc"], metrics), "doc", "metric_key", "match_alias", "candidate_value", "confidence")
    assert [r for r in got if r[0] == 1] == [(1, "m10", "alias010", 9.0, "low"), (1, "m7", "label007", 5.0, "medium")]
    assert len([r for r in got if r[0] == 2]) == 500


def test_a_file_over_the_row_limit_is_hashed(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    folder = os.path.join(root, "t", "package_id=a b")
    os.makedirs(folder)
    size = (2 << 30) + 12_345  # sparse: it takes no disk
    with open(os.path.join(folder, "part.parquet"), "wb") as out:
        out.truncate(size)
    with open(os.path.join(folder, "small.parquet"), "wb") as out:
        out.write(b"abc")
    want = hashlib.sha256()
    for _ in range(size >> 20):
        want.update(bytes(1 << 20))
    want.update(bytes(size & ((1 << 20) - 1)))
    got = {r.file_path.rsplit("/", 1)[1]: r.file_sha256 for r in pk.file_hashes(spark, root, "t").collect()}
    assert got == {"part.parquet": want.hexdigest(), "small.parquet": hashlib.sha256(b"abc").hexdigest()}


def test_keywords_in_tasks_agree_with_joins(spark):
    words = ["alpha", "beta", "in", "pha", "gamma", "ta", "kin"]
    texts = spark.createDataFrame([(i, " ".join(words[(i * k) % 7] + "x" * (i % 3) for k in range(i % 6)) or None, None if i % 9 == 0 else i % 4) for i in range(60)], "doc long, body string, size long")
    keywords = spark.createDataFrame([(n % 4, w) for n, w in enumerate(words)] + [(3, "in"), (2, "alpha")], "item long, keyword string")
    held = j.held_keywords(texts, "doc", keywords, "item", "[a-z]+")
    hits = j.item_hits_in_tasks(texts, "doc", "body", held, "item", "bigint", "[a-z]+")
    assert "Exchange" not in hits._jdf.queryExecution().executedPlan().toString()
    assert sorted(hits.collect()) == sorted(j.item_hits(texts, "doc", "body", keywords, "item", "[a-z]+").collect())
    strengths = j.item_strengths(texts, "doc", "body", keywords, "item", "[a-z]+").join(texts, "doc").collect()
    found = j.item_totals_in_tasks(texts.coalesce(1), "doc", "body", "size", held, "item", "bigint", "[a-z]+", 3).collect()
    assert len(found) == 4
    for row in found:
        own = [x for x in strengths if x["item"] == row["item"]]
        best = sorted(own, key=lambda x: (-x["strength"], x["size"] is None, -(x["size"] or 0), x["doc"]))[:3]
        assert (row["texts"], row["measure"]) == (len(own), sum(x["size"] or 0 for x in own))
        assert [tuple(x) for x in row["top"]] == [(x["strength"], x["size"], x["doc"]) for x in best]


def test_repeated_text_ids_are_left_to_joins(spark):
    keywords = spark.createDataFrame([(1, "beta")], "item long, keyword string")
    twice = spark.createDataFrame([(1, "beta"), (1, "x")], "doc long, body string")
    assert j.held_keywords(twice, "doc", keywords, "item", "[a-z]+") is None
