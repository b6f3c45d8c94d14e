"""Conversation repair against all edits of short conversations, and against itself in short stretches."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from plumbline.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        blank = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain(rows):
    """Conversations by a walk over (row, last role of the repaired part), which tries every edit."""
    out = []
    left = damage(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in left if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            last = text.rstrip(WHITE)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
            seen.add((role, text))
        # ends: "" nothing yet, s, u, a
        tops = {"": (0, "", [])}
        better = lambda found, end, way: end in found and found[end][:2] <= way[:2]

        def add(found, end, way):
            if not better(found, end, way):
                found[end] = way

        def follows(end, initial):
            return initial == "u" if end in ("", "s", "a") and initial != "s" else (end == "" if initial == "s" else end == "u" and initial == "a")

        def insert(found):
            for _ in range(4):
                for end, (cost, audit, made) in list(found.items()):
                    for role in ("user", "assistant"):
                        if follows(end, role[0]):
                            add(found, role[0], (cost + 2, audit + "I", [*made, f"{role}:"]))
            return found

        insert(tops)
        for (_, _, role, text), fault in zip(own, faults, strict=True):
            found = {}
            extra = fault == "truncated"
            for end, (cost, audit, made) in tops.items():
                add(found, end, (cost + 3, audit + "D", made))
                if fault in ("", "truncated"):
                    if role[:1] in ("s", "u", "a") and follows(end, role[0]):
                        add(found, role[0], (cost + extra, audit + "K", [*made, f"{role}:{text}"]))
                    for new in ("user", "assistant"):
                        if follows(end, new[0]):
                            add(found, new[0], (cost + 2 + extra, audit + "R", [*made, f"{new}:{text}"]))
            tops = insert(found)
        cost, audit, made = min((tops[end] for end in ("", "a") if end in tops), key=lambda x: x[:2])
        known = [r[1] for r in own if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in LEGAL for a, b in zip(own, own[1:]))
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, n=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(n).selectExpr("*", "'x' as digest", "1 as copies", "2 as at")
    assert sorted((tuple(r) for r in conversations.repair(df).collect()), key=repr) == plain(rows)


def test_grammar_states_and_costs():
    auto = conversations.AUTOMATON
    assert 0 in auto.final and len(auto.tops) <= 8
    for n in range(7):
        for roles in itertools.product("sua", repeat=n):
            tops = {0}
            for r in roles:
                tops = {t for x in tops for t in auto.moves.get((x, r), ())}
            assert bool(tops & auto.final) == bool(re.fullmatch("(s?(ua)+)?", "".join(roles)))
    assert conversations.repaired([{0: conversations.parsed("ua")}]) == (0, "KK")
    assert conversations.repaired([{0: conversations.parsed("s")}]) == (3, "D")
    assert conversations.repaired([{0: conversations.parsed("su")}]) == (2, "KKI")
    assert conversations.repaired([{0: conversations.parsed("uua")}]) == (2, "KIKK")
    assert conversations.repaired([{0: conversations.parsed("UxA")}]) == (5, "KDK")


@pytest.mark.parametrize("size", [1, 2, 3])
def test_stretches_give_the_whole(size):
    pick = random.Random(size)
    for _ in range(400):
        rows = "".join(pick.choices("suaxSUA-!", k=pick.randrange(12)))
        cut = [rows[i : i + size] for i in range(0, len(rows), size)]
        parts = [{node: conversations.parsed(x, node) for node in conversations.AUTOMATON.tops} for x in cut]
        assert conversations.repaired(parts) == conversations.repaired([{0: conversations.parsed(rows)}])


def test_against_a_plain_version(spark):
    pick = random.Random(3)
    texts = ["Yes.", "No!", "Why", "", " \n", "Well?", "a.b", None, "é。", "x  "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "umpire"]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(pick.randrange(9)):
            rows.append((conv, pick.choice([turn, turn, turn, turn + 3, None]), pick.choice(roles[: pick.choice([2, 3, 9])]), pick.choice(texts)))
    rows += rows[:40]
    check(spark, rows)


def test_one_long_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(conversations.stretches, "__defaults__", (7,))
    pick = random.Random(4)
    rows = [(1, i, pick.choice(["user", "assistant"]), pick.choice(["Yes.", "No", f"t{i}.", f"t{i}"])) for i in range(900)]
    rows += [(2, 5, "user", "Same.")] * 60 + [(2, 6, "assistant", "End.")] + [(3, i, ["user", "assistant"][i % 2], f"All {i} is well.") for i in range(30)]
    check(spark, rows, 8)


def test_long_texts_and_empty_tables(spark):
    long = "word " * 400_000
    check(spark, [(7, 1, "user", long + "."), (7, 2, "assistant", long), (8, 1, "system", " " * 1_000_000 + "x" + " " * 1_000_000)])
    assert conversations.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    check(spark, [(gone, 0, "user", "Hello.")])
