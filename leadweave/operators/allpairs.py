"""Matching pairs of two sets of names by comparing all of them, in numpy on Arrow batches.

The names of one side are sent to all tasks, sorted by length; each name of the other side is compared with all names of fitting
lengths. Every test before the last is implied by the match condition (see `fuzzy`): D edits change at most D letters and 3 D
bigrams, where each letter or bigram counts with its number among equal ones. The distance D of two names is odd or even as the
sum of their lengths is, which lowers its bound by one for half of the pairs.

1. The 64 numbered letters that part the names best, as the bits of one word: one name and `CHUNK` others at a time.
2. For pairs that are left, a fingerprint of all bigrams, and all `LETTER_WORDS` words of such letters.
3. The longest common subsequence, bit-parallel over the letters of a name of at most `WORD` letters, for many pairs at once.
   Pairs whose dealt side is longer are left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..fixed_values import NAME_MATCH_PERCENT

TILE, CHUNK, WORD = 128, 8192, 64
# Pairs whose common subsequences are looked for at once.
TOGETHER = 1 << 13
LETTER_WORDS, BIGRAM_WORDS = 8, 16
MARKS = [f"m{w}" for w in range(BIGRAM_WORDS)]
NAMED = "ord bigint, name_key string, n int"
MARKED = ", ".join([NAMED, *(f"{m} bigint" for m in MARKS)])
# Names whose fingerprints are made at once.
MARKED_ROWS = 1 << 12
# Pairs of orders; those that are not sure are still to be compared, and have their names.
FOUND = "a bigint, b bigint, sure boolean, ka string, kb string"
LANES = np.uint64(0x00FF00FF00FF00FF)
LOW_BITS = np.array([(1 << i) - 1 for i in range(WORD + 1)], np.uint64)
# Bits of a letter, of an item that is counted, and of the number of a letter that has a bit of its own.
LETTER, ITEM, NUMBER = 21, 42, 8


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the number of each text's."""
    decoded = [t.decode("utf-8", "surrogateescape") for t in texts.cast(pa.binary()).to_pylist()]
    flat = np.frombuffer("".join(decoded).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat, np.fromiter(map(len, decoded), np.int64, len(decoded))


def _numbered(item: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The items (of up to `ITEM` bits) of all rows, sorted, with their rows and their numbers among equal items of a row."""
    both = np.sort(row << ITEM | item)
    place = np.arange(len(both))
    first = np.maximum.accumulate(np.where(np.diff(both, prepend=-1) != 0, place, 0))
    return both & ((1 << ITEM) - 1), both >> ITEM, place - first


def _sets(bit: np.ndarray, row: np.ndarray, rows: int, words: int) -> np.ndarray:
    """The bits of each row as words: an array a word."""
    out = np.zeros(words * rows, np.uint64)
    np.bitwise_or.at(out, (bit >> 6) * rows + row, np.uint64(1) << (bit & 63).astype(np.uint64))
    return out.reshape(words, rows)


def fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over names (`NAMED`): the fingerprints of their bigrams too (`MARKED`)."""
    for batch in batches:
        for at in range(0, batch.num_rows, MARKED_ROWS):
            part = batch.slice(at, MARKED_ROWS)
            flat, size = _letters(part["name_key"])
            row, flat = np.repeat(np.arange(len(size)), size), flat.astype(np.int64)
            pair = row[1:] == row[:-1]
            item, row, number = _numbered((flat[:-1] << LETTER | flat[1:])[pair], row[1:][pair])
            mixed = (item + (number << ITEM)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            bit = ((mixed >> np.uint64(32)) % np.uint64(64 * BIGRAM_WORDS)).astype(np.int64)
            words = _sets(bit, row, len(size), BIGRAM_WORDS).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, words)], [*part.schema.names, *MARKS])


@dataclass
class Names:
    """Names sorted by length and order."""

    ord: np.ndarray
    n: np.ndarray
    first: np.ndarray  # the first word of `letters`
    letters: np.ndarray  # sets of the letters in `chosen` and of bigrams, a row a name
    bigrams: np.ndarray
    chosen: np.ndarray  # numbered letters that have a bit, and the bits
    bit: np.ndarray
    code: np.ndarray  # letters of all names in a row, as places in `alphabet`
    alphabet: np.ndarray
    start: np.ndarray
    plain: np.ndarray  # whether a name has `n` letters here too
    text: pa.Array

    @classmethod
    def read(cls, table: pa.Table, like: Names | None = None) -> Names:
        """Names of rows (`MARKED`), with the same bits of letters as other names if given."""
        number = lambda c: np.asarray(table[c]).astype(np.int64)
        by = np.lexsort((number("ord"), number("n")))
        text, n = table["name_key"].combine_chunks().take(pa.array(by)), number("n")[by]
        flat, size = _letters(text)
        known = np.zeros(int(flat.max(initial=0)) + 1, bool)
        known[flat] = True
        item, row, nth = _numbered(flat.astype(np.int64), np.repeat(np.arange(len(size)), size))
        few = nth < 1 << NUMBER
        item, row = (item << NUMBER | nth)[few], row[few]
        if like is None:
            items, counts = np.unique(item, return_counts=True)
            best = np.argsort(-counts * (1 - counts / max(len(n), 1)), kind="stable")[: 64 * LETTER_WORDS]
            own = np.argsort(items[best])
            chosen, bit = items[best][own], own
        else:
            chosen, bit = like.chosen, like.bit
        place = np.minimum(np.searchsorted(chosen, item), max(len(chosen) - 1, 0))
        there = np.flatnonzero(chosen[place] == item) if len(chosen) else np.zeros(0, np.int64)
        letters = _sets(bit[place[there]], row[there], len(n), LETTER_WORDS)
        bigrams = np.stack([number(c).view(np.uint64) for c in MARKS], axis=1)[by]
        code = (np.cumsum(known) - 1)[flat].astype(np.int32)
        return cls(number("ord")[by], n, letters[0], letters.T.copy(), bigrams, chosen, bit, code, np.flatnonzero(known), np.cumsum(size) - size, size == n, text)


class Tile:
    """Names `first` to `last` of `ys` with the places of their letters as bits."""

    def __init__(self, ys: Names, first: int, last: int, xs: Names):
        self.ys, self.xs, self.first = ys, xs, first
        short = [(i, np.flatnonzero(ys.plain[first:last] & (ys.n[first:last] > i) & (ys.n[first:last] <= WORD))) for i in range(WORD)]
        read = [(i, rows, ys.code[ys.start[first + rows] + i]) for i, rows in short if len(rows)]
        own = np.unique(np.concatenate([np.zeros(0, np.int32), *(code for _, _, code in read)]))
        self.masks = np.zeros((last - first, len(own) + 1), np.uint64)  # the last column: letters that no name of the tile has
        for i, rows, code in read:
            self.masks[rows, np.searchsorted(own, code)] |= np.uint64(1 << i)
        # From letters of `xs` to columns.
        place = np.searchsorted(xs.alphabet, letters := ys.alphabet[own])
        there = place < len(xs.alphabet)
        there[there] = xs.alphabet[place[there]] == letters[there]
        self.column = np.full(len(xs.alphabet), len(own))
        self.column[place[there]] = np.flatnonzero(there)

    def common(self, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Lengths of the longest common subsequences of pairs of a short name of the tile and a name of `xs`.

        A row of the comparison table is a number: a zero bit is a step up. Each letter of x updates it with one addition.
        """
        out = np.empty(len(x), np.int64)
        masks, width = self.masks.ravel(), self.masks.shape[1]
        by = np.argsort(-self.xs.n[x], kind="stable")
        for at in range(0, len(by), TOGETHER):
            part = by[at : at + TOGETHER]
            row = np.full(len(part), ~np.uint64(0))
            n, start, base = self.xs.n[x[part]], self.xs.start[x[part]], (y[part] - self.first) * width
            reach = len(part) - np.searchsorted(n[::-1], np.arange(n[0]), "right")  # names of more than i letters
            for i, k in enumerate(reach):
                v = row[:k]
                met = v & masks[base[:k] + self.column[self.xs.code[start[:k] + i]]]
                row[:k] = (v + met) | (v - met)
            out[part] = np.bitwise_count(~row & LOW_BITS[self.ys.n[y[part]]])
        return out


def most_apart(n: np.ndarray, m: int, slack: int) -> np.ndarray:
    """The largest distance of matching names of n and m letters."""
    apart = (slack * (n + m) - 1) // 1000
    return apart - ((apart - n - m) & 1)


def _left_over(xs: Names, ys: Names, slack: int, first: int, last: int, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (y, x) of names `first` to `last` of `ys` and names of `xs` that the tests before the last leave."""
    bits, count, near, n = np.empty(CHUNK, np.uint64), np.empty(CHUNK, np.uint8), np.empty(CHUNK, bool), -1
    for i in range(first, last):
        if ys.n[i] != n:
            n = int(ys.n[i])
            begin, equal = int(np.searchsorted(xs.n, n * (1000 - slack) / (1000 + slack))), int(np.searchsorted(xs.n, n))
            beyond, end = (int(np.searchsorted(xs.n, m, "right")) for m in (n, n * (1000 + slack) / (1000 - slack)))
            # Lengths next to these limits may be too far apart.
            begin += int(np.count_nonzero(np.abs(xs.n[begin:equal] - n) > most_apart(xs.n[begin:equal], n, slack)))
            end -= int(np.count_nonzero(np.abs(xs.n[beyond:end] - n) > most_apart(xs.n[beyond:end], n, slack)))
            limit = np.minimum(most_apart(xs.n[begin:end], n, slack), 255).astype(np.uint8)
        if within:  # the names before this one
            end = equal + int(np.searchsorted(xs.ord[equal:beyond], ys.ord[i]))
        found = []
        for at in range(begin, end, CHUNK):
            size = min(CHUNK, end - at)
            np.bitwise_xor(xs.first[at : at + size], ys.first[i], out=bits[:size])
            np.less_equal(np.bitwise_count(bits[:size], out=count[:size]), limit[at - begin : at - begin + size], out=near[:size])
            found.append(np.flatnonzero(near[:size]) + at)
        if found:
            x = np.concatenate(found)
            apart = limit[x - begin].astype(np.uint64)
            for mine, others, times in ((ys.bigrams, xs.bigrams, 3), (ys.letters, xs.letters, 1)):
                fits = np.flatnonzero(_differing(others[x] ^ mine[i]) <= times * apart)
                x, apart = x[fits], apart[fits]
            yield np.full(len(x), i), x


def _differing(sets: np.ndarray) -> np.ndarray:
    """The number of bits of each row; a row is a multiple of eight words. Their counts, a byte each, are added in lanes of 16 bits."""
    eights = np.bitwise_count(sets).view(np.uint64)
    eights = (eights & LANES) + (eights >> np.uint64(8) & LANES)
    both = eights[:, 0]
    for w in range(1, eights.shape[1]):
        both = both + eights[:, w]
    return both * np.uint64(0x0001000100010001) >> np.uint64(48)


def _matches(xs: Names, ys: Names, slack: int, within: bool) -> Iterator[pa.RecordBatch]:
    for first in range(0, len(ys.n), TILE):
        last = min(first + TILE, len(ys.n))
        tile, held, size = None, [], 0
        for y, x in _left_over(xs, ys, slack, first, last, within):
            held.append((y, x))
            size += len(y)
            if size >= 2 * TOGETHER:
                tile = tile or Tile(ys, first, last, xs)
                yield _judged(tile, *map(np.concatenate, zip(*held)), within)
                held, size = [], 0
        if size:
            yield _judged(tile or Tile(ys, first, last, xs), *map(np.concatenate, zip(*held)), within)


def _judged(tile: Tile, y: np.ndarray, x: np.ndarray, within: bool) -> pa.RecordBatch:
    xs, ys = tile.xs, tile.ys
    sure = ys.plain[y] & xs.plain[x] & (ys.n[y] <= WORD)
    alike = ~sure
    total = ys.n[y[sure]] + xs.n[x[sure]]
    alike[sure] = tile.common(y[sure], x[sure]) * 400 > total * (2 * NAME_MATCH_PERCENT - 1)
    y, x, sure = y[alike], x[alike], sure[alike]
    a, b, unsure = xs.ord[x], ys.ord[y], pa.array(~sure)
    if within:
        a, b = np.minimum(a, b), np.maximum(a, b)
    name = lambda names, at: pc.if_else(unsure, names.text.take(pa.array(at)), pa.scalar(None, names.text.type)).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sure), name(xs, x), name(ys, y)], ["a", "b", "sure", "ka", "kb"])


def comparison(shared, slack: int, within: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For `mapInArrow` over the names of one side: its pairs (`FOUND`) with the broadcast names of the other.

    `within`: both sides are one set of distinct orders; every pair is found once, the earlier name as `a`.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _matches(shared.value, Names.read(pa.Table.from_batches([batch]), shared.value), slack, within)

    return run
