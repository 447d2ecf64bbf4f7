"""Words of many texts at once, on the bytes of an Arrow string column.

A word is a maximal run of bytes that are digits, letters or part of a character beyond ASCII; A-Z are
lowered. On UTF-8 bytes this equals the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on lowered text, because
every byte of a character beyond ASCII is 0x80 or more. Null texts have no words. Nothing is cut: a batch is
handled in slices of whole texts, and a text larger than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit keys (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[65:91] = IS_WORD[128:] = True
BYTE_KEY = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_BASE = U64(0xD1342543DE82EF95)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int):
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, step in enumerate((_BASE, U64(pow(int(_BASE), -1, 1 << 64)))):
            steps = np.full(size, step)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def run_keys(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each byte run, the same wherever the run stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(low) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(BYTE_KEY[low] * up[:-1], out=total[1:])
        keys = (total[ends] - total[starts]) * down[starts]
        return mix(keys + (ends - starts).astype(np.uint64) * U64(0x9E3779B97F4A7C15))


@dataclass
class Words:
    """Words of the texts of a slice; `first[i]:first[i + 1]` are those of text i."""

    low: np.ndarray  # lowered bytes of all texts
    offsets: np.ndarray  # where each text begins in `low`
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)

    def keys(self) -> np.ndarray:
        return run_keys(self.low, self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.low[self.starts[i] : self.ends[i]].tobytes()


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run passes the border of a text."""
    n = len(member)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, stops = member.copy(), member.copy()
    begins[1:] &= ~member[:-1] | edge[1:n]
    stops[:-1] &= ~member[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def words_of(column: pa.Array) -> Words:
    if column.null_count:
        column = column.fill_null("")
    raw, offsets = string_bytes(column)
    low = LOWER[raw]
    starts, ends = runs(IS_WORD[low], offsets)
    return Words(low, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes that cover the column."""
    if not len(column):
        return
    _, offsets = string_bytes(column.fill_null(""))
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield at, to
        at = to


def batch_slices(batches, column: str, most: int = SLICE_BYTES):
    """Each record batch in row slices of about `most` bytes of `column`."""
    for batch in batches:
        for at, to in slices(batch.column(batch.schema.get_field_index(column)), most):
            yield batch.slice(at, to - at)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) of every run of `width` words; a text of fewer words, but not none, is one shingle."""
    keys, counts = words.keys(), words.counts
    if not len(keys):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    number = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    text = np.repeat(np.arange(words.n_texts), number)
    within = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    at = words.first[text] + within
    size = np.minimum(counts[text], width)
    out = size.astype(np.uint64)
    padded = np.concatenate([keys, np.zeros(width, np.uint64)])
    with np.errstate(over="ignore"):
        for i in range(width):
            step = mix(out * U64(0x9E3779B97F4A7C15) + padded[at + i])
            out = step if i == 0 else np.where(i < size, step, out)
    return out, text
