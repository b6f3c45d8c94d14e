"""BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from plumbline.llm import bpe
from plumbline.llm.queries import vocabulary_file

PATH = vocabulary_file("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def own():
    return bpe.ByteBpe(PATH)


def ids(own, text):
    return np.frombuffer(own.encode([text])[0], "<u4").tolist()


def check(own, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(own, text) == want, text[:80]
    assert own.decode(own.encode([text])[0]) == library.decode(want, skip_special_tokens=False)


def test_every_character_near_others(own, library):
    for point in [*range(0x700), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600]:
        c = chr(point)
        check(own, library, f"a{c}b {c}1{c}{c} !{c}?'s{c}")


def test_random_texts(own, library):
    pick = random.Random(1)
    parts = ["a", "b", " ", "\n", "  ", "\t", "'s", "'ll", "<|endoftext|>", "<|endof", "é", "漢", "1", "½", "!!", "\x1c", "\x85", "😀", "THE", "ing", "\x00", "."]
    for _ in range(1500):
        check(own, library, "".join(pick.choice(parts) for _ in range(pick.randint(0, 40))))


def test_long_words_take_the_heap(own, library):
    for text in ["a" * 3000, "ab" * 2000, "the" * 1000, " " * 2000, "é" * 500, "abcdefgh" * 40, "x" * bpe.SHORT_BYTES, "x" * (bpe.SHORT_BYTES + 1)]:
        check(own, library, text)


def test_small_memory_and_blocks_change_nothing(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 16)
    pick = random.Random(2)
    for _ in range(200):
        check(own, library, " ".join("".join(pick.choice("abcdé") for _ in range(pick.randint(1, 6))) for _ in range(pick.randint(0, 30))))


def test_documents(spark, library):
    rows = [(1, "Some text."), (1, "Some text."), (2, None), (3, ""), (None, "x <|endoftext|> y"), (4, "very long " * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as ids", "2 as n_tokens", "3 as __text")
    found = sorted((tuple(r) for r in bpe.round_trip_digests(df, PATH).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        encoded = library.encode(text or "", add_special_tokens=False).ids
        digest = lambda b: hashlib.sha256(b).hexdigest()
        want.append((doc_id, len(encoded), digest(np.array(encoded, "<u4").tobytes()), digest((text or "").encode())))
    assert found == sorted(want, key=repr)
    assert bpe.round_trip_digests(df.limit(0), PATH).collect() == []


def test_bytes_that_are_no_text(own, library):
    pick = random.Random(3)
    for _ in range(300):
        some = [pick.randrange(50257) for _ in range(pick.randint(0, 12))]
        assert own.decode(np.array(some, "<u4").tobytes()) == library.decode(some, skip_special_tokens=False)
