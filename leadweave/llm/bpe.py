"""BPE encoding and decoding with a public vocabulary, by a segment tree over the ranks of adjacent pairs.

A text is handled as the vocabulary's own library does: special tokens standing in the raw text are one id each; the rest
is composed (NFC), white space becomes one space, letters are lowered one by one, and a pattern cuts words; white space is
dropped. The UTF-8 bytes of a word are its first symbols, the last one marked as a word end. The leaves of a tree hold
(rank, place) of each adjacent pair, inner nodes the smallest child: the root is the leftmost pair of lowest rank. A merge
changes three leaves, each in logarithmic time, until the root holds no pair. Decoding joins the tokens of the ids by spaces.

The vocabulary is read once by the driver and broadcast (a file of a few MB); documents are encoded where they lie, without
a shuffle. Words met before are remembered, up to `MEMORY` bytes a worker. Texts are read in slices of about 1 MB, a longer
text in pieces that end at a space, so memory follows the longest text, not the batch.

Defined cases: null and empty texts, and texts of white space only, have no ids and decode to the empty string; null ids
and repeated rows are rows like others; other columns of the table, whatever their names, are not read; an empty table
gives an empty result; a very long word costs n log n steps. Bytes without a symbol in the vocabulary are left out. Letter
classes and cases follow the library's Unicode version; compositions added to Unicode after version 15.1 are not made.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from leadweave.llm.words import batch_slices, column_of

MEMORY = 128 << 20  # bytes of remembered words a worker
PIECE = 1 << 20  # characters of a long text handled at a time
NO_PAIR = 1 << 62
WIDE = 32  # children of a node of the tree
PLACES = (1 << 32) - 1

# White space of Unicode.
SPACE = "\t-\r \x85\xa0  -     　"
# Code points that `regex` takes for letters or digits, assigned after the library's Unicode version (16).
YOUNGER_RANGES = """
558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4 a7dd-a7dd a7e2-a7e2 a7f1-a7f1
ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a-11b0a 11db0-11ddb 11de0-11de9 11df1-11df1 1246f-1246f
12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191
191a0-191d2 1b123-1b128 1b168-1b168 1d6a6-1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2
1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
"""
YOUNGER = "".join(f"{chr(int(a, 16))}-{chr(int(b, 16))}" for a, b in (r.split("-") for r in YOUNGER_RANGES.split()))
# Capitals younger than this Python's case table (first, last, distance to the small letter).
YOUNGER_CAPITALS = [(0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
                    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B)]

# The library's word pattern for lowered text: for the first 256 characters, for all, and for text with younger characters.
CONTRACTED = "'(?:s|t|re|ve|m|ll|d)"
LATIN, LATIN_DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
LATIN_WORDS = re.compile(rf"[{LATIN}]+|[{LATIN_DIGITS}]|{CONTRACTED}|[^{SPACE}{LATIN}{LATIN_DIGITS}]+")
WORDS = regex.compile(rf"\p{{L}}+|\p{{N}}|{CONTRACTED}|[^{SPACE}\p{{L}}\p{{N}}]+")
HAS_YOUNGER = re.compile(f"[{YOUNGER}]")
YOUNGER_WORDS = regex.compile(rf"(?:(?![{YOUNGER}])\p{{L}})+|(?![{YOUNGER}])\p{{N}}|{CONTRACTED}|(?:[{YOUNGER}]|[^{SPACE}\p{{L}}\p{{N}}])+")
CASES = {ord("Σ"): "σ"} | {c: chr(c + step) for first, last, step in YOUNGER_CAPITALS for c in range(first, last + 1)}
HAS_CASES = re.compile("[" + "".join(map(chr, CASES)) + "]")
A_SPACE = re.compile(f"[{SPACE}]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    names = {b: chr(b) for b in plain}
    others = [b for b in range(256) if b not in names]
    names |= {b: chr(256 + n) for n, b in enumerate(others)}
    return [names[b] for b in range(256)]


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def normal(text: str) -> tuple[str, bool]:
    """The text composed and lowered letter by letter, and whether it has Latin-1 characters only."""
    if is_latin(text):
        return text.lower(), True
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if HAS_CASES.search(text):
        text = text.translate(CASES)
    return text.lower(), False


def words(text: str, latin: bool) -> Iterator[list[str]]:
    """The words of a normal text, in lists; a long text is cut at white space, which no word contains."""
    find = (LATIN_WORDS if latin else YOUNGER_WORDS if HAS_YOUNGER.search(text) else WORDS).findall
    at = 0
    while at < len(text):
        space = A_SPACE.search(text, at + PIECE) if len(text) - at > PIECE else None
        to = space.start() if space else len(text)
        yield find(text, at, to)
        at = to


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Merges:
    """Merges of adjacent symbols: rank and result of a pair."""

    def __init__(self, pairs: list[tuple[int, int, int]]):
        """`pairs`: (left, right, result) in the order of rank."""
        self.rank = {a << 32 | b: n for n, (a, b, _) in reversed(list(enumerate(pairs)))}
        self.result = [c for _, _, c in pairs]

    def apply(self, symbols: list[int]) -> list[int]:
        """Merges the leftmost pair of lowest rank until no pair can be merged."""
        n = len(symbols)
        if n < 2:
            return symbols
        rank, result, symbols = self.rank.get, self.result, list(symbols)
        leaves = []
        for i, (a, b) in enumerate(pairwise(symbols)):
            r = rank(a << 32 | b)
            leaves.append(NO_PAIR if r is None else r << 32 | i)
        levels = [leaves]
        while len(levels[-1]) > 1:  # up to the root; a node is the least of its `WIDE` children
            low = levels[-1]
            levels.append([min(low[j : j + WIDE]) for j in range(0, len(low), WIDE)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        root, climbs = levels[-1], list(pairwise(levels))
        while root[0] != NO_PAIR:
            i = root[0] & PLACES
            j = after[i]
            k = after[j]
            merged = symbols[i] = result[root[0] >> 32]
            symbols[j] = -1
            after[i] = k
            h = before[i]
            if h >= 0:
                r = rank(symbols[h] << 32 | merged)
                leaves[h] = NO_PAIR if r is None else r << 32 | h
            if k < n:
                before[k] = i
                leaves[j] = NO_PAIR
                r = rank(merged << 32 | symbols[k])
                leaves[i] = NO_PAIR if r is None else r << 32 | i
            else:
                leaves[i] = NO_PAIR
            if n <= WIDE + 1:  # the root stands on the leaves
                if n > 2:
                    root[0] = min(leaves)
                continue
            places = {max(h, 0), i, min(j, n - 2)}
            for low, high in climbs:
                places = {p // WIDE for p in places}
                for p in places:
                    high[p] = min(low[p * WIDE : p * WIDE + WIDE])
        return [s for s in symbols if s >= 0]


class Vocabulary:
    """A byte-level vocabulary with word ends and its merges, from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, self.end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.tokens: list[str | None] = [None] * (max([*ids.values(), *special.values()]) + 1)
        for token, number in [*ids.items(), *special.items()]:
            self.tokens[number] = token
        names = byte_symbols()
        self.inner = [ids.get(name) for name in names]
        self.last = [ids.get(name + self.end) for name in names]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = Merges([(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.known, self.old, self.held = {}, {}, 0

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "old": {}, "held": 0}

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        symbols = [*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]]
        return self.merges.apply([s for s in symbols if s is not None] if None in symbols else symbols)

    def _ids(self, word: str) -> bytes:
        packed = self.known.get(word) or self.old.get(word) or pack(self.encode_word(word))
        cost = 200 + len(word) + len(packed)
        if word not in self.known and cost <= MEMORY >> 8:  # a very long word is not remembered
            if self.held + cost > MEMORY // 2:  # words not met since the last time are forgotten
                self.known, self.old, self.held = {}, self.known, 0
            self.known[word], self.held = packed, self.held + cost
        return packed

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out = []
        for n, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if n % 2:
                out.append(pack([self.special[part]]))
                continue
            for found in words(*normal(part)):
                packed = list(map(self.known.get, found))
                if None in packed:
                    packed = [p or self._ids(w) for p, w in zip(packed, found)]
                out.append(b"".join(packed))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """Tokens of packed ids, special ones included, joined by spaces; unknown ids are left out."""
        tokens, top = self.tokens, len(self.tokens)
        return " ".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist() if i < top and tokens[i] is not None])


def encode(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, ids, decoded) of every row: ids packed as little-endian unsigned 32-bit integers, and the text they decode to.

    `path` is the tokenizer file, read on the driver only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        vocabulary = shared.value
        for part in batch_slices(batches, "text"):
            packed = [vocabulary.encode(t) for t in column_of(part, "text").to_pylist()]
            decoded = [vocabulary.decode(p) for p in packed]
            yield pa.RecordBatch.from_arrays([column_of(part, "id"), pa.array(packed, pa.binary()), pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    pairs = docs.select(docs[id_column].alias("id"), docs[text].cast("string").alias("text"))
    fields = [T.StructField("id", docs.schema[id_column].dataType), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    return pairs.mapInArrow(run, T.StructType(fields))


def decode(tokens: DataFrame, path: str, ids: str = "ids", id_column: str = "id") -> DataFrame:
    """(id, decoded) of rows of packed ids; null ids decode to the empty string."""
    shared = tokens.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                text = shared.value.decode(batch.column(1)[n].as_py() or b"")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(n, 1), pa.array([text], pa.string())], ["id", "decoded"])

    pairs = tokens.select(tokens[id_column].alias("id"), tokens[ids].cast("binary").alias("ids"))
    return pairs.mapInArrow(run, T.StructType([T.StructField("id", tokens.schema[id_column].dataType), T.StructField("decoded", T.StringType())]))
