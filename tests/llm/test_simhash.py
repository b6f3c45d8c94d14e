"""SimHash: fingerprints and components against plain versions."""

import random

import xxhash

from plumbline.llm import simhash

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance):
    values, root = list(values), {}
    for v in values:
        if v in root:
            continue
        root[v], todo = v, [v]
        while todo:
            x = todo.pop()
            for y in values:
                if y not in root and (x ^ y).bit_count() <= distance:
                    root[y] = v
                    todo.append(y)
    groups = {}
    for v in values:
        groups.setdefault(root[v], set()).add(v)
    return {frozenset(g) for g in groups.values()}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_one_segment_differs_in_at_most_one_bit():
    for distance in range(9):
        bounds = simhash.segment_bounds(distance)
        assert sum(n for _, n in bounds) == 64 and 2 * len(bounds) > distance and 2 * (len(bounds) - 1) <= distance


def test_components_match_a_plain_version(spark):
    pick = random.Random(3)
    for distance in (0, 3, 4, 7):
        values = set()
        for _ in range(12):
            centre = pick.getrandbits(64)
            values.add(centre)
            for _ in range(12):  # chains and balls around it
                centre ^= sum({1 << pick.randrange(64) for _ in range(pick.randint(1, 5))})
                values.add(centre)
        found = simhash.components(spark.createDataFrame([(signed(v),) for v in values], "fp long"), distance).collect()
        groups = {}
        for r in found:
            groups.setdefault(r["root"], set()).add(r["fp"] % (1 << 64))
        want = {g for g in plain_components(values, distance) if len(g) > 1}
        assert {frozenset(g) for g in groups.values()} == want


def test_fingerprints_of_odd_texts():
    pick = random.Random(4)
    texts = [None, "", " \t\n", "One", "one two three", "ÄÖ Ü ß A\x0bB\x0cC\x1cD  e", "a b c d " * 30]
    texts += [" ".join(pick.choice("aAbBéÉ漢") * pick.randint(1, 3) for _ in range(pick.randint(0, 60))) for _ in range(50)]
    for text in texts:
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_blocks_of_a_long_text(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(500))
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_documents(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(5, long), (3, long.upper()), (9, long + " more"), (4, None), (2, ""), (2, ""), (7, "quite another text of some words"), (None, "quite another text of some words"), (None, "alone here")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as fp", "2 as component_id", "3 as variant", "4 as root")
    found = simhash.near_duplicates(df)
    assert sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=repr) == sorted(
        [(5, 3), (3, 3), (9, 3), (4, 2), (2, 2), (2, 2), (7, 7), (None, 7), (None, None)], key=repr
    )
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([3, 2, 7, None, None], key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_large_ball_lists_no_pairs(spark):
    """A third of all rows around one centre: what the joins emit stays far below the number of pairs."""
    pick = random.Random(5)
    centre = pick.getrandbits(64)
    ball = {centre ^ sum({1 << pick.randrange(64) for _ in range(3)}) for _ in range(400)}
    values = ball | {pick.getrandbits(64) for _ in range(800)}
    found = simhash.components(spark.createDataFrame([(signed(v),) for v in values], "fp long")).collect()
    assert {frozenset([r["fp"] % (1 << 64) for r in found if r["root"] == x["root"]]) for x in found} == {g for g in plain_components(values, 4) if len(g) > 1}
