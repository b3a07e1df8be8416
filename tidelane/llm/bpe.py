"""Byte-level BPE encoding and decoding with the vocabulary file of a public tokenizer.

A text is cut into units before each single space that a non-space follows; no token crosses such a
cut, so units are encoded once and kept in a bounded table per Python worker. A unit is split by the
pattern of byte-level BPE, and each piece is merged with a priority queue of ranks over a doubly
linked list of symbols: a popped entry is stale, and skipped, if one of its two symbols has been
merged meanwhile. Decoding concatenates the vocabulary's byte strings.

Null and empty texts have no tokens. Extra columns pass through; an input column named like an output column
is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.llm.frames import mapped

# The pattern that byte-level BPE splits a text by before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CUT = re.compile(r" (?=\S)")
_UNEVEN = re.compile(r" (?!\S)")
#: Most units after a space, pieces and other units that a worker keeps, and the longest of them, in characters.
KEPT_SPACED, KEPT_PIECES, KEPT_UNITS, KEPT_LENGTH = 250_000, 100_000, 20_000, 48


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ids, merge ranks and byte strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        byte_of = byte_alphabet()
        to_bytes = lambda s: bytes(byte_of[c] for c in s)
        ids = {to_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (to_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.strings[i] = token
        for token, i in self.special.items():
            self.strings[i] = token.encode()


def merge(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one piece. The queue holds (rank, position, left id, right id); an entry is stale
    if its symbols are no longer the neighbours it was made for."""
    symbols = [vocabulary.byte_ids[b] for b in piece]
    n = len(symbols)
    if n < 2:
        return symbols
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    merges = vocabulary.merges
    queue = []
    for i in range(n - 1):
        if found := merges.get((symbols[i], symbols[i + 1])):
            queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(queue)
    while queue:
        _, i, left, right, merged = heapq.heappop(queue)
        j = after[i]
        if j < 0 or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], symbols[j] = merged, -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if found := merges.get((merged, symbols[k])):
                heapq.heappush(queue, (found[0], i, merged, symbols[k], found[1]))
        h = before[i]
        if h >= 0 and (found := merges.get((symbols[h], merged))):
            heapq.heappush(queue, (found[0], h, symbols[h], merged, found[1]))
    return [s for s in symbols if s >= 0]


class _Kept(dict):
    """A table that computes what it lacks, keeps short entries and starts anew when full."""

    def __init__(self, most: int, make):
        self.most, self.make = most, make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Texts to ids packed as little-endian unsigned 32-bit integers, and back."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(PATTERN)
        self.special = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.vocabulary.special, key=len, reverse=True))) + ")")
            if self.vocabulary.special
            else None
        )
        self.pieces = _Kept(KEPT_PIECES, lambda piece: self.pack(merge(piece.encode(), self.vocabulary)))
        self.units = _Kept(KEPT_UNITS, lambda unit: b"".join([self.pieces[p] for p in self.pattern.findall(unit)]))
        self.spaced = _Kept(KEPT_SPACED, lambda rest: b"".join([self.pieces[p] for p in self.pattern.findall(" " + rest)]))

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special and self.special.search(text):
            return b"".join(
                self.pack([self.vocabulary.special[part]]) if i % 2 else self._plain(part)
                for i, part in enumerate(self.special.split(text))
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        rest = text.split(" ") if not _UNEVEN.search(text) else _CUT.split(text)
        spaced = self.spaced
        return self.units[rest[0]] + b"".join([spaced[x] for x in rest[1:]])

    def decode(self, packed: bytes) -> str:
        strings = self.vocabulary.strings
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join([strings[i] for i in ids]).decode("utf-8", errors="replace")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, made once per Python process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def bpe_encode(docs: DataFrame, path: str, text: str = "text", to: str = "token_ids") -> DataFrame:
    """Add the token ids of a text column, packed as little-endian unsigned 32-bit integers."""

    def start():
        encode = encoder(path).encode
        return lambda batch: [pa.array([encode(x) for x in batch.column(text).to_pylist()], pa.binary())]

    return mapped(docs, [T.StructField(to, T.BinaryType())], start, text=text)


def bpe_decode(tokens: DataFrame, path: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """Add the text of packed token ids; null ids give an empty text."""

    def start():
        decode = encoder(path).decode
        return lambda batch: [pa.array([decode(x or b"") for x in batch.column(ids).to_pylist()], pa.string())]

    return mapped(tokens, [T.StructField(to, T.StringType())], start)


def bpe_round_trip(
    docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded"
) -> DataFrame:
    """Encode a text column and decode the ids again in one pass over the rows; the ids and the decoded text replace the text."""

    def start():
        one = encoder(path)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            packed = [one.encode(x) for x in batch.column(text).to_pylist()]
            return [pa.array(packed, pa.binary()), pa.array([one.decode(x) for x in packed], pa.string())]

        return compute

    new = [T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())]
    return mapped(docs, new, start, drop=[text], text=text)


def token_count(ids: str = "token_ids") -> Column:
    """Number of tokens in a packed column; null counts as none."""
    return (F.coalesce(F.octet_length(ids), F.lit(0)) / 4).cast("long")
