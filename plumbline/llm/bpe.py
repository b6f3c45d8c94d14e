"""Byte-level BPE: encoding with contiguous rank arrays, and decoding.

The vocabulary file is the JSON of a public byte-level tokenizer, named by path and read by every Python worker. Words come
from the usual pattern of such vocabularies. For all short words of one length together, the parts of each word and the merge
ranks of its adjacent parts lie in the rows of two arrays. Each step scans every row for its smallest rank, merges there,
deletes that boundary and looks up the ranks beside it anew; every row loses one boundary a step, so rows stay equally long,
and a row without a known pair is finished. Words longer than SHORT_BYTES, where scanning would cost the square of the length,
take their pairs from a heap in the same order.

White space before a word belongs to it, so a text falls apart into independent pieces wherever white space follows another
character; each worker remembers the ids of the pieces it met last.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.batches import portions

#: Words of up to so many bytes are merged in arrays.
SHORT_BYTES = 48
#: Pieces and words that a worker remembers at most; beyond, it starts anew.
REMEMBERED = 150_000
#: Characters that are encoded together.
BLOCK_CHARS = 1 << 20
NO_RANK = np.iinfo(np.int32).max

# The white space of Unicode, and the word pattern of the vocabulary's pre-tokenizer.
SPACE = "\t-\r \x85\xa0  -     　"
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

NEIGHBOURS = re.compile(f"[{SPACE}][{SPACE}]")
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WORD = regex.compile(WORDS)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: itself if it prints, else the next one from 256 on."""
    prints = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = itertools.count(256)
    return [chr(b if b in prints else next(others)) for b in range(256)]


class Memory:
    """The first REMEMBERED strings met, with their ids. It starts anew when it knows under half of what is asked for."""

    def __init__(self):
        self.known: dict[str, bytes] = {}

    def look_up(self, wanted: set[str], make: Callable[[set[str]], dict[str, bytes]]) -> Mapping[str, bytes]:
        """Ids of all wanted strings; make gives those of unknown ones."""
        unknown = wanted.difference(self.known)
        if not unknown:
            return self.known
        if len(self.known) + len(unknown) > REMEMBERED and 2 * len(unknown) > len(wanted):
            self.known, unknown = {}, wanted
        made = make(unknown)
        if len(self.known) + len(made) > REMEMBERED:
            known = self.known
            return {w: made[w] if w in made else known[w] for w in wanted}
        self.known.update(made)
        return self.known


def pieces_of(text: str) -> list[str]:
    """Pieces that are encoded apart: white space, if any, and what follows it."""
    if "\0" in text or NEIGHBOURS.search(text):
        return PIECE.findall(text)
    # white space stands alone everywhere: a piece begins at each, so the text is cut before the two usual kinds
    pieces = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return pieces if pieces[0] else pieces[1:]


def words_of(piece: str) -> list[str]:
    """Words of a piece. Letters, after a space or not, with a full stop or comma or without: no pattern is needed."""
    if piece[0] == "\n" and len(piece) > 1 and not piece[1].isspace():
        return ["\n", *words_of(piece[1:])]
    body = piece[1:] if piece[0] == " " else piece
    if body.isalpha():
        return [piece]
    if body[-1:] in (".", ",") and body[:-1].isalpha():
        return [piece[:-1], piece[-1]]
    return WORD.findall(piece)


class ByteBpe:
    """One vocabulary. Ids are as in the file; added tokens inside a text are their own ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path}: added tokens that strip or stand alone are not supported")
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        vocab: dict[str, int] = model["vocab"]
        self.byte_ids = np.array([vocab[letter] for letter in letters], np.int64)
        self.tokens: list[bytes] = [b""] * (max([*vocab.values(), *(t["id"] for t in added)]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = bytes(byte_of[x] for x in token)
        self.added = {t["content"]: t["id"] for t in added}
        for token, i in self.added.items():
            self.tokens[i] = token.encode()
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.rank_of = {int(k): int(r) for k, r in zip(self.keys, self.key_ranks, strict=True)}
        self.words, self.pieces = Memory(), Memory()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of ids; NO_RANK where a pair does not merge."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], NO_RANK)

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of one length."""
        out: list[bytes] = [b""] * len(words)
        parts = self.byte_ids[np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)]
        which = np.arange(len(words))
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while True:
            width = parts.shape[1]
            if width > 1:
                at = ranks.argmin(axis=1)
                least = ranks[np.arange(len(at)), at]
                done = least == NO_RANK
            else:
                done = np.ones(len(parts), bool)
            if done.any():
                packed = parts[done].astype("<u4").tobytes()
                for i, word in enumerate(which[done].tolist()):
                    out[word] = packed[4 * width * i : 4 * width * (i + 1)]
                live = ~done
                if not live.any():
                    return out
                parts, ranks, which, at, least = parts[live], ranks[live], which[live], at[live], least[live]
            rows = np.arange(len(parts))
            parts[rows, at] = self.merged[least]
            column = np.arange(width - 1)
            parts = np.take_along_axis(parts, column + (column > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= at[:, None]), axis=1)
            for side in (-1, 0):  # the pairs that end and begin with the merged part
                pair = at + side
                inside = (pair >= 0) & (pair < width - 2)
                r, c = rows[inside], pair[inside]
                ranks[r, c] = self.ranks(parts[r, c], parts[r, c + 1])

    def merge_long(self, word: bytes) -> bytes:
        """Packed ids of one word: linked parts, pairs from a heap by rank and place."""
        ids: list[int] = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1) if (rank := self.rank_of.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != a or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := self.rank_of.get(ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of each word."""
        found: dict[str, bytes] = {}
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode()
            if len(data) <= SHORT_BYTES:
                by_length.setdefault(len(data), []).append((word, data))
            else:
                found[word] = self.merge_long(data)
        for same in by_length.values():
            found.update(zip((w for w, _ in same), self.merge_short([d for _, d in same]), strict=True))
        return found

    def encode_pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of each piece."""
        split = [words_of(piece) for piece in pieces]
        ids = self.words.look_up({w for words in split for w in words}, self.encode_words)
        joined = [ids[words[0]] if len(words) == 1 else b"".join([ids[w] for w in words]) for words in split]
        return dict(zip(pieces, joined, strict=True))

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts without added tokens."""
        split = [pieces_of(text) for text in texts]
        ids = self.pieces.look_up(set(itertools.chain.from_iterable(split)), self.encode_pieces)
        return [b"".join([ids[p] for p in pieces]) for pieces in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each packed as little-endian unsigned 32-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        block: list[str] = []
        owners: list[int] = []
        size = 0

        def flush():
            nonlocal size
            for owner, ids in zip(owners, self.encode_plain(block), strict=True):
                out[owner].append(ids)
            block.clear()
            owners.clear()
            size = 0

        for i, text in enumerate(texts):
            for part, token in self.stretches(text):
                if token is None:
                    block.append(part)
                    owners.append(i)
                    size += len(part)
                    if size >= BLOCK_CHARS:
                        flush()
                else:
                    flush()
                    out[i].append(token.to_bytes(4, "little"))
        flush()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def stretches(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Plain stretches of at most about BLOCK_CHARS, cut where pieces meet, and added tokens between them."""
        at = 0
        found = self.added_pattern.finditer(text) if self.added_pattern and any(t in text for t in self.added) else ()
        for match in itertools.chain(found, [None]):
            end = match.start() if match else len(text)
            while end - at > BLOCK_CHARS:
                cut = PIECE_STARTS.search(text, at + BLOCK_CHARS - 1, end)
                stop = cut.end() if cut else end
                if stop - at >= end - at:
                    break
                yield text[at:stop], None
                at = stop
            if end > at:
                yield text[at:end], None
            if match:
                yield match.group(), self.added[match.group()]
                at = match.end()

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


PIECE_STARTS = re.compile(f"[^{SPACE}](?=[{SPACE}])")


@functools.cache
def vocabulary(path: str) -> ByteBpe:
    """One per worker and file."""
    return ByteBpe(path)


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """The columns keep of docs, and `ids`: the token ids of the whole text, packed as little-endian unsigned 32-bit numbers;
    with_text adds `text`, what these ids decode to.

    One row per row of docs. Null and empty texts have no ids (an empty binary). No special tokens are added. Columns of docs
    other than keep and text are left aside, whatever their names.
    """
    fields = [f for f in docs.schema.fields if f.name in keep]
    made = [T.StructField("ids", T.BinaryType())] + [T.StructField("text", T.StringType())] * with_text
    schema = T.StructType([*fields, *made])
    n = len(fields)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for part in portions(rows, n):
            ids = bpe.encode([x or "" for x in part.column(n).to_pylist()])
            texts = [pa.array([bpe.decode(x) for x in ids], pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(ids, pa.binary()), *texts], schema.names)

    return docs.select(*(F.col(f"`{f.name}`") for f in fields), F.col("text").alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows of encoded with `text`, the decoded form of `ids`. Null ids: null text."""

    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())])
    at = encoded.columns.index("ids")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for part in portions(rows, at):
            texts = [None if x is None else bpe.decode(x) for x in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (lower-case hexadecimal) of each row of docs."""
    return encode(docs, path, with_text=True).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"),
    )
