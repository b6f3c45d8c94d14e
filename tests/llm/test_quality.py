"""Quality rules against a plain version."""

import random
import re
from collections import Counter

from plumbline.llm import quality

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, repeated = len(words), len(covered)
    symbols, duplicates = sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines))
    failed = n < 10 or 100 * repeated > 20 * n
    upper, lower = (sum(bool(re.match(p, c)) for c in text) for p in ("[A-ZÄÉ]", "[a-zäéß]"))
    chars = sum(map(len, words))
    bad = 10 * symbols > n or 10 * duplicates > 4 * len(lines) or upper > lower or chars < 2 * n or chars > 15 * n
    return n, chars, symbols, duplicates, repeated, failed, not failed and not bad


def test_measures_and_verdict(spark):
    pick = random.Random(2)
    words = ["a", "ab", "été", "Wörter", "#x", "|", "LOUD", "😀", "x" * 40]
    texts = [None, "", " \t\n\x0b\f\r", "a", "a b c d e a b c d e", "a b c d e f", "\n\na b\na b\n a b\n", "a a a a a a", "x\x1cy"]
    for _ in range(150):
        some = pick.sample(words, pick.randint(1, 6))
        texts.append("".join(pick.choice(some) + pick.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(pick.randint(0, 60))))
    texts.append(" ".join(f"w{i}" for i in range(20_000)) + " end of it all here " * 2)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n_words", "2 as kept", "3 as m", "array('q') as __words")
    found = {r["doc_id"]: tuple(r)[1:] for r in quality.assess(df).collect()}
    for i, text in rows:
        assert found[i] == plain(text), text
    kept = quality.quality_filter(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, text in rows if plain(text)[-1]}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some words " * 3), (1, "some words " * 3), (None, "x")], SCHEMA)
    assert quality.assess(df).count() == 3
    assert quality.assess(df.limit(0)).collect() == []


def test_order_follows_rejection_and_changes_no_verdict(spark):
    rows = [(i, "good plain words for a text that is long enough to stay here " + ("## " * 20 if i % 2 else "")) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    rules = {"never": lambda m: m["n_words"] < 0, **quality.RULES}
    order = quality.ordered_rules(df, rules)
    assert order[0] == "symbols" and sorted(order) == sorted(rules)
    worded = quality.with_words(df, "doc_id", "text")
    m = quality.measures(quality.F.col("text"), quality.F.col("__words"))
    verdicts = [worded.select("doc_id", quality.cascade(rules, o, m).alias("kept")).orderBy("doc_id").collect() for o in (order, order[::-1])]
    assert verdicts[0] == verdicts[1]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "text")], SCHEMA)
    plan = quality.assess(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and df.count() == 1
