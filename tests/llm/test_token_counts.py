"""Token counts against the library, with chunks of a few characters."""

import random

import pytest
from tokenizers import Tokenizer

from plumbline.llm import token_counts as tc
from plumbline.llm.queries import vocabulary_file

PATH = vocabulary_file("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def length(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def texts():
    pick = random.Random(1)
    parts = ["a", "Σ", "é", " ́", "\n", "  ", "\t", "'s", "<|endoftext|>", "é", "漢字", "12", "½", "!!", "\x1c", "\x85", " ", "😀", "THE", "İ", "ing", "<|start", "oftext|>"]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(250)]


def test_words_apart_count_as_the_whole(library):
    counter = tc.Counter(PATH)
    for text in texts():
        assert counter.count([text]) == [length(library, text)], text


def test_small_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    counter = tc.Counter(PATH)
    assert [counter.count([t])[0] for t in texts()[:60]] == [length(library, t) for t in texts()[:60]]


def test_chunks_are_spliced(spark, library):
    long = [*texts(), "word " * 300, "x" * 700, "a " + "b" * 400 + " c d " * 50, " " * 300 + "end", "<|endoftext|>" * 40, "漢" * 333]
    rows = [*enumerate(long), (3, long[3]), (None, "no id " * 30), (-1, None), (-2, "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as uid", "2 as k", "3 as n_tokens")
    found = tc.token_counts(df, PATH, huge_chars=20, chunk=16, overlap=4).collect()
    want = sorted(((i, len((t or "").encode()), length(library, t)) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_empty_table(spark):
    assert tc.token_counts(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_a_vocabulary_that_keeps_blanks_is_refused():
    with pytest.raises(ValueError, match="white space"):
        tc.tokenizer(vocabulary_file("byte_bpe_50k.json"))
