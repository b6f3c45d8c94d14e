"""Quality rules as a short-circuit cascade.

A rule is a condition on a text that rejects it. On a sample, each rule's rejection rate and running time are measured; the
cascade then tests the rules in descending order of rejection per time, and stops at the first that rejects. The order changes
what a text costs and never which texts are kept. Everything is a DataFrame expression; no Python runs on the executors.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.names import free_names
from plumbline.session import cut_lineage

#: White space that parts words, and the characters that count as symbols.
WHITE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
#: Words in a window whose repetition counts.
WINDOW = 5
#: Documents in the sample, in expectation.
SAMPLE_DOCS = 2000

Rule = Callable[[Mapping[str, Column]], Column]


def word_array(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"([^{WHITE}]+)"), 1), F.array().cast("array<string>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of so many words that the text holds twice or more, all its places counting.

    Windows are hashed first; only a text with two equal hashes has its windows sorted and compared in full.
    """
    n = F.size(words)
    at = F.sequence(F.lit(0), n - window)
    parts = lambda i: [F.get(words, i + k) for k in range(window)]
    suspicious = F.size(F.array_distinct(F.transform(at, lambda i: F.xxhash64(*parts(i))))) < n - window + 1

    def repeated(s: Column) -> Column:
        same = lambda x, k: (F.get(s, k - 1)["w"] == x["w"]) | (F.get(s, k + 1)["w"] == x["w"])
        return F.filter(s, lambda x, k: F.coalesce(F.when(k > 0, same(x, k)).otherwise(F.get(s, k + 1)["w"] == x["w"]), (k > 0) & (F.get(s, F.greatest(k - 1, F.lit(0)))["w"] == x["w"]), F.lit(False)))

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    windows = F.array_sort(F.transform(at, lambda i: F.struct(F.concat_ws(" ", *parts(i)).alias("w"), i.alias("p"))))
    found = _let(F.sort_array(F.transform(_let(windows, repeated), lambda x: x["p"])), covered)
    return F.when((n > window) & suspicious, found).otherwise(0).cast("bigint")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(f"[^{WHITE}]"))


def measures(text: Column, words: Column) -> dict[str, Column]:
    """Every measure that rules use, as expressions of a text and its words."""
    text = F.coalesce(text, F.lit(""))
    lines = lines_with_words(text)
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": repeated_words(words),
        "n_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("bigint"),
        "n_lower": F.length(F.regexp_replace(text, r"[^\p{Ll}]+", "")).cast("bigint"),
    }


#: Rules that every text must pass.
BASE_RULES: dict[str, Rule] = {
    "few_words": lambda m: m["n_words"] < 10,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
}
#: Rules of the cascade besides: symbols for one word in ten, four lines in ten that repeat, more capitals than small letters,
#: words of under two or over fifteen characters on average.
RULES: dict[str, Rule] = {
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 10 * m["n_dup_lines"] > 4 * m["n_lines"],
    "capitals": lambda m: m["n_upper"] > m["n_lower"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
}


def with_words(docs: DataFrame, *keep: str, name: str = "__words") -> DataFrame:
    """keep columns of docs and the words of the text. The generator makes one row of each, and holds the words back from being computed
    again in each expression that uses them."""
    return docs.select(*(F.col(f"`{c}`") for c in keep), F.explode(F.array(word_array(F.col("text")))).alias(name))


def ordered_rules(docs: DataFrame, rules: Mapping[str, Rule], sample_docs: int = SAMPLE_DOCS) -> list[str]:
    """Names of rules by rejection per cost, best first; ties and an empty sample keep the given order.

    The sample is drawn by Spark at random with a fixed seed, all partitions alike, and written once. A rule's cost is the time
    of counting its rejections less that of counting the sample's words.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    sample = cut_lineage(docs.select("text").sample(share, 7) if share < 1 else docs.select("text"), "rule-sample")
    worded = with_words(sample, "text")
    m = measures(F.col("text"), F.col("__words"))

    def timed(rejects: Column) -> tuple[float, int]:
        start = time.perf_counter()
        found = worded.agg(F.count_if(rejects).alias("n"), F.sum(F.size("__words")).alias("words")).first()
        return time.perf_counter() - start, found["n"]

    timed(F.lit(False))  # the first run compiles
    idle, _ = timed(F.lit(False))
    found = {name: timed(rule(m)) for name, rule in rules.items()}
    worth = {name: rejected / max(seconds - idle, 1e-3) for name, (seconds, rejected) in found.items()}
    return sorted(rules, key=lambda name: -worth[name])


def cascade(rules: Mapping[str, Rule], order: list[str], m: Mapping[str, Column]) -> Column:
    """Whether a text passes all rules, tested one after the other until one rejects."""
    kept = None
    for name in order:
        rejects = F.coalesce(rules[name](m), F.lit(False))
        kept = F.when(rejects, False) if kept is None else kept.when(rejects, False)
    return F.lit(True) if kept is None else kept.otherwise(True)


def assess(docs: DataFrame, rules: Mapping[str, Rule] | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept; one row per row of docs.

    docs: doc_id, text; other columns are left aside. A null or empty text has no words and fails the base rules.
    """
    rules = RULES if rules is None else rules
    order = ordered_rules(docs, rules, sample_docs)
    worded = with_words(docs, "doc_id", "text")
    m = measures(F.col("text"), F.col("__words"))
    given = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
    # a second generator row, so that each measure is computed once for all its uses
    measured = worded.select("doc_id", "text", F.explode(F.array(F.struct(*(m[c].alias(c) for c in given)))).alias("m"))
    have = {**m, **{c: F.col(f"m.{c}") for c in given}}
    failed = BASE_RULES["few_words"](have) | BASE_RULES["repeated_words"](have)
    kept = F.when(failed, False).otherwise(cascade(rules, order, have))
    return measured.select("doc_id", *(f"m.{c}" for c in given if c != "n_lines"), failed.alias("base_failed"), kept.alias("kept"))


def quality_filter(docs: DataFrame, rules: Mapping[str, Rule] | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Rows of docs that pass the base rules and the cascade's; the columns of docs. Base rules take their place in the cascade."""
    rules = {**BASE_RULES, **(RULES if rules is None else rules)}
    order = ordered_rules(docs, rules, sample_docs)
    (name,) = free_names(docs, "__words")
    worded = with_words(docs, *docs.columns, name=name)
    return worded.filter(cascade(rules, order, measures(F.col("text"), F.col(name)))).select(*(F.col(f"`{c}`") for c in docs.columns))
