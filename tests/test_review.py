"""Matching, merging and reconciliation on small and on skewed inputs."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import joins as j
from plumbline.operators import reconcile as rc
from plumbline.operators import review as r

from .conftest import rows


def spec(**kw):
    issues = {k: (i, "c", "a") for i, k in enumerate(["value_drift", "rekey_candidate", "package_only_unmatched", "core_only_unmatched", "zero_placeholder"])}
    return rc.Reconcile(**{"match": ("y", "s"), "variant": ("m",), "compare": ("v",), "scope": ("y", "s"), "issues": issues, "placeholder": {"v": [0]}, **kw})


def sides(frame):
    package = frame("y int, s int, m int, v int", (1, 1, 1, 5), (1, 1, 2, 6), (1, 1, 3, 7), (1, 2, 1, 8))
    core = frame("y int, s int, m int, v int", (1, 1, 1, 5), (1, 1, 2, 60), (1, 1, 9, 7), (1, 1, 8, 7), (1, 3, 1, 1), (2, 1, 1, 0))
    return package, core


def test_plan_by_group_scope(frame):
    plan = rc.reconciliation_plan(*sides(frame), spec())
    assert rows(plan, "issue_type", "y", "s", "package_m", "core_m", "candidate_count") == [
        ("package_only_unmatched", 1, 2, 1, None, 0),
        ("rekey_candidate", 1, 1, 3, 8, 2),
        ("value_drift", 1, 1, 2, 2, 0),
    ]


def test_plan_by_year_scope(frame):
    plan = rc.reconciliation_plan(*sides(frame), spec(scope=("y",)))
    assert rows(plan, "issue_type", "y", "s", "core_m") == [
        ("core_only_unmatched", 1, 3, 1),
        ("package_only_unmatched", 1, 2, None),
        ("rekey_candidate", 1, 1, 8),
        ("value_drift", 1, 1, 2),
    ]


def test_counts_add_up(frame):
    package, core = sides(frame)
    found = {k: n for k, n in rows(rc.compare_tables(package, core, spec()).groupBy("side").count())}
    assert found["matched"] + found["package_only"] == 4 and found["matched"] + found["core_only"] == 6


def test_merge_takes_the_row_in_full(frame):
    plan = frame("k string, status string, note string, fixed string", ("1", "todo", "old", "a"), ("2", "todo", "x", "b"))
    batch = frame("k string, status string, note string", (" 1 ", "done", ""))
    once = r.merge_batch(plan, batch, ["k"], ["status", "note"])
    assert rows(once, "k", "status", "note", "fixed", "is_changed", "changed_cells") == [("1", "done", "", "a", True, 2), ("2", "todo", "x", "b", False, 0)]
    again = r.merge_batch(once.drop("is_changed", "changed_cells"), batch, ["k"], ["status", "note"])
    assert again.filter("is_changed").count() == 0
    assert rows(r.merge_batch(plan, batch, ["k"], ["status", "note"], blank_keeps=True), "k", "note", "changed_cells") == [("1", "old", 1), ("2", "x", 0)]


@pytest.mark.parametrize("keys, message", [(("1", "1"), "duplicate key"), (("",), "blank key"), ((" ",), "blank key"), ((None,), "blank key"), (("1", "9"), "unknown key")])
def test_merge_stops_at_problems(frame, keys, message):
    plan = frame("k string, status string", ("1", "todo"), ("2", "todo"))
    batch = frame("k string, status string", *[(k, "done") for k in keys])
    with pytest.raises(Exception, match=message):
        r.merge_batch(plan, batch, ["k"], ["status"]).collect()


TASKS = "task_id int, status string, review_decision string, scope string, package_slot int, core_slot int, package_v int, core_v int"


def paired_plan(frame):
    plan = frame(
        TASKS,
        (1, "todo", "", "s", None, 10, None, 5), (2, "todo", "", "s", 20, None, 6, None), (3, "decided", "exclude_core", "s", None, 30, None, 0),
        (4, "decided", "remap_core", "s", 40, 40, 7, 8), (5, "decided", "use_package", "s", 50, None, 9, None),
    )
    return rc.apply_pairs(plan, frame("core_task int, package_task int", (1, 2)), pair_spec())


def pair_spec():
    return rc.Reconcile(match=["scope"], variant=["slot"], compare=["v"], scope=["scope"], issues={})


def test_a_pair_is_published_under_the_core_key_and_deletes_nothing(frame):
    plan = paired_plan(frame)
    assert rows(plan, "task_id", "status", "review_decision", "paired_task")[:2] == [(1, "decided", "pair_covered", 2), (2, "decided", "pair_replace", 1)]
    assert rows(rc.publish(plan, pair_spec()), "task_id", "scope", "slot", "v") == [(2, "s", 10, 6), (5, "s", 50, 9)]
    assert rows(rc.delete_plan(plan, pair_spec()), "scope", "slot", "reason", "task_count") == [("s", 30, "excluded", 1), ("s", 40, "rekeyed", 1)]


CLAIM_TASKS = "task_id int, issue_type string, status string, review_decision string, scope string, package_slot int, core_slot int, package_v int, core_v int"


def claim_plan(frame):
    """Hand-made tasks: 1-12 core-only rows, 20-27 package rows, a name for each."""
    core = lambda i, status="todo": (i, "core_only_unmatched", status, "", "s", None, 100 + i, None, i)
    package = lambda i, issue, status, decision, core=None: (i, issue, status, decision, "s", 200 + i, core, i, core and core + 1)
    plan = frame(
        CLAIM_TASKS,
        *[core(i) for i in range(1, 12)], core(12, "decided"),
        package(20, "package_only_unmatched", "todo", ""), package(21, "package_only_unmatched", "decided", "map_to_core_key", 900),
        package(22, "package_only_unmatched", "decided", "skip"), package(23, "value_drift", "decided", "use_package", 223),
        package(24, "value_drift", "decided", "keep_core", 224), package(25, "rekey_candidate", "todo", "", 925),
        package(26, "package_only_unmatched", "todo", ""), package(27, "package_only_unmatched", "todo", ""),
    )
    names = ["open", "open", "mapped", "skipped", "drift", "drift", "kept", "rekey", "twice", "nobody", "unplanned", "open"]
    core_names = frame("task_id int, name string", *[(i, n) for i, n in enumerate(names, 1) if i != 10], (10, ""))
    of = {20: "open", 21: "mapped", 22: "skipped", 23: "drift", 24: "kept", 25: "rekey", 26: "twice", 27: "twice"}
    candidates = frame("scope string, slot int, name string", *[("s", 200 + i, n) for i, n in of.items()], ("s", 300, "unplanned"), ("t", 301, "nobody"))
    return plan, core_names, candidates


def test_claims_in_plan_order(frame):
    plan, names, candidates = claim_plan(frame)
    claims = rc.pair_claims(plan, names, candidates, ["scope"], pair_spec())
    assert rows(claims, "core_task", "package_task", "reason") == sorted(
        [
            (1, 20, "exact_pair"), (2, 20, "exact_pair"), (3, 21, "exact_pair"), (4, None, "blocked_decision"), (5, 23, "exact_drift_pair"),
            (6, None, "has_other_task:value_drift:decided:remap_core"), (7, None, "has_other_task:value_drift:decided:keep_core"),
            (8, None, "has_other_task:rekey_candidate:todo:"), (9, None, "ambiguous_match"), (10, None, "missing_core_name"), (11, None, "no_plan_task"),
        ], key=repr,
    )
    done = rc.apply_pairs(plan, claims, pair_spec())
    found = {r["task_id"]: (r["status"], r["review_decision"], r["paired_task"], r["paired_key"] and r["paired_key"]["slot"]) for r in done.collect()}
    assert found[1] == ("decided", "pair_covered", 20, None) and found[2] == ("decided", "pair_covered", 20, None)
    assert found[20] == ("decided", "pair_replace", 2, 102)  # the last claim gives the key
    assert found[21] == ("decided", "pair_replace", 3, 103)
    assert found[23] == ("decided", "remap_core", 5, 105)
    assert found[6] == ("todo", "", None, None) and found[22] == ("decided", "skip", None, None)


def test_a_remapped_row_is_published_under_its_target_and_its_own_core_row_deleted_once(frame):
    plan, names, candidates = claim_plan(frame)
    done = rc.apply_pairs(plan, rc.pair_claims(plan, names, candidates, ["scope"], pair_spec()), pair_spec()).withColumn("status", F.lit("decided"))
    published = {r["task_id"]: (r["slot"], r["v"]) for r in rc.publish(done, pair_spec()).collect()}
    assert published == {20: (102, 20), 21: (103, 21), 23: (105, 23), 24: (224, 225)}
    assert rows(rc.delete_plan(done, pair_spec()), "slot", "reason", "task_count") == [(223, "rekeyed", 1)]


def test_claims_within_a_limit(frame):
    plan, names, candidates = claim_plan(frame)
    claims = rc.pair_claims(plan, names, candidates, ["scope"], pair_spec(), limit=2)
    assert {r["core_task"]: r["reason"] for r in claims.filter("reason like 'exact%' or reason = 'over_limit'").collect()} == {1: "exact_pair", 2: "exact_pair", 3: "over_limit", 5: "over_limit"}
    assert claims.filter("package_task is not null").count() == 2


def test_delete_plan_refuses_open_tasks_and_repeated_keys(frame):
    with pytest.raises(Exception, match="not decided"):
        rc.delete_plan(frame(TASKS, (1, "todo", "", "s", None, 1, None, 1)), pair_spec()).collect()
    twice = frame(TASKS, (1, "decided", "exclude_core", "s", None, 1, None, 1), (2, "decided", "remap_core", "s", 1, 1, 1, 1))
    with pytest.raises(Exception, match="deleted twice"):
        rc.delete_plan(twice, pair_spec()).collect()


def test_equal_rows_are_kept_apart(frame):
    df = frame("i int, g int, seeded boolean", (1, 1, True), (1, 1, True), (1, 1, False))
    assert r.capped_or_seeded(df, ["g"], [F.asc("i"), F.desc("seeded")], 1, F.col("seeded")).count() == 2


def test_cap_counts_seeded_rows(spark):
    rng = random.Random(1)
    table = [(i, i % 3, rng.random() < 0.2) for i in range(200)]
    got = r.capped_or_seeded(spark.createDataFrame(table, "i int, g int, seeded boolean"), ["g"], [F.asc("i")], 10, F.col("seeded"))
    want, used = [], {0: 0, 1: 0, 2: 0}
    for i, g, seeded in table:
        if seeded or used[g] < 10:
            want.append(i)
            used[g] += 1
    assert [x[0] for x in sorted(rows(got, "i"))] == want


def test_keyword_hits_equal_contains(spark):
    rng = random.Random(2)
    texts = [(i, "".join(rng.choice("abc ") for _ in range(rng.randint(0, 700)))) for i in range(40)] + [(99, "abcab" * 400)]
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 7))) for _ in range(30)})
    tdf, kdf = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame([(w,) for w in words], "keyword string")
    want = sorted((i, w) for i, t in texts for w in words if w in t)
    assert sorted(rows(j.keyword_hits(tdf, "id", "t", kdf))) == want
    assert sorted(rows(j.keyword_hits(tdf, "id", "t", kdf, token="[abc]+"))) == want


def test_keywords_of_any_length(frame):
    texts = frame("id int, t string", (1, "x" * 60 + "abc"), (2, "ab"), (3, ""), (4, None))
    found = j.keyword_hits(texts, "id", "t", frame("keyword string", ("ab",), ("x" * 50,), ("b",)))
    assert rows(found) == [(1, "ab"), (1, "b"), (1, "x" * 50), (2, "ab"), (2, "b")]


def test_keywords_that_no_token_holds_fail(frame):
    with pytest.raises(Exception, match="keyword does not fit"):
        j.keyword_hits(frame("id int, t string", (1, "abc def")), "id", "t", frame("keyword string", ("c d",)), token="[a-z]+").collect()


def test_prefix_suggestions_equal_pairs(spark):
    rng = random.Random(4)
    make = lambda n: sorted({"".join(rng.choice("ab") for _ in range(rng.randint(2, 9))) for _ in range(n)})
    local, profiles = make(60), make(80)
    got = j.prefix_suggestions(spark.createDataFrame([(x,) for x in local], "name string"), spark.createDataFrame([(x,) for x in profiles], "name string"), 4, 3)
    want = []
    for name in local:
        if len(name) >= 4:
            hits = sorted(p for p in profiles if len(p) >= 4 and (name.startswith(p) or p.startswith(name)))
            want.append((name, len(hits), "|".join(hits) if len(hits) <= 3 else "", hits[0] if len(hits) == 1 else None))
    assert sorted(rows(got, "name", "prefix_matches", "candidates", "suggestion"), key=repr) == sorted(want, key=repr)


def test_nearest_equals_brute_force(spark):
    import math

    rng = random.Random(6)
    point = lambda: (rng.uniform(-89, 89), rng.uniform(-180, 180))
    left = [(g, i, *point()) for i, g in enumerate([0] * 60 + [1] * 5)]
    right = [(g, i, *point()) for i, g in enumerate([0] * 40 + [1])] + [(0, 999, 89.9, 10.0), (0, 998, 10.0, 179.9)]
    left += [(0, 1000, 89.9, -170.0), (0, 1001, 10.0, -179.9)]

    def km(a, b):
        (p1, l1), (p2, l2) = (map(math.radians, a), map(math.radians, b))
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))

    schema = "g int, place_id int, latitude double, longitude double"
    got = {r.place_id: r.nearest_km for r in j.nearest_in_group(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["g"], "place_id").collect()}
    want = {}
    for g, i, *p in left:
        want[i] = min(km(p, q) for h, _, *q in right if h == g)
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_hot_key_keeps_every_row(spark):
    """A third of all rows under one key: nothing is dropped, and only one row per key comes back."""
    from plumbline.operators.sequence import dedupe

    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    last = dedupe(df, ["k"], ["v"], "replace")
    assert last.count() == 20001 and last.filter("k = 0").first().v == 29997
