"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are runs of `width` words of benchmark items (an item of fewer words is one pattern). Patterns of one
length share a table set: the shift table says how far a window may move when it ends in a given pair of words,
suffix buckets list the patterns that end in a pair, a prefix check and a word-by-word comparison confirm.
Documents are searched where they lie, with no shuffle: the tables of a block of items are broadcast, and a
block holds at most `block_words` item words, so its size is bounded however many items there are. More blocks
mean further passes in the same stage, each adding its spans to the row.

Defined cases: null and empty texts have no words and no spans; null or empty items have no patterns; repeated
documents are judged one by one; repeated items give their id once; null item ids are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadweave.llm.words import U64, batch_slices, column_of, mix, words_of

WIDTH = 13
BLOCK_WORDS = 500_000
SHIFT_BITS = 20
LANE_WORDS = 256
SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                                 T.StructField("item", T.StringType())]))
_GOLDEN = U64(0x9E3779B97F4A7C15)


def _pairs(keys: np.ndarray) -> np.ndarray:
    """Key of the block of words (i - 1, i), kept at i."""
    out = keys.copy()
    with np.errstate(over="ignore"):
        out[1:] = mix(keys[:-1] * _GOLDEN + keys[1:])
    return out


class Tables:
    """Shift table, suffix buckets and patterns of one length."""

    def __init__(self, length: int, keys: np.ndarray, texts: list[bytes], items: np.ndarray):
        self.length, self.items, self.texts = length, items, texts
        self.block = min(2, length)
        blocks = [_pairs(row) if self.block == 2 else row for row in keys]
        longest = length - self.block + 1
        self.shift = np.full(1 << SHIFT_BITS, min(longest, 255), np.uint8)
        for at in range(self.block - 1, length):
            slot = np.array([b[at] for b in blocks], np.uint64) & U64((1 << SHIFT_BITS) - 1)
            np.minimum.at(self.shift, slot.astype(np.int64), np.uint8(min(length - 1 - at, 255)))
        suffix = np.array([b[-1] for b in blocks], np.uint64)
        order = np.argsort(suffix, kind="stable")
        self.order, self.suffix = order, suffix[order]
        self.prefix = np.array([b[self.block - 1] for b in blocks], np.uint64)[order]

    def search(self, words, keys, pairs, text_of):
        """(first word, item number) of every occurrence, counted over the whole slice."""
        n, m = len(keys), self.length
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if n < m:
            return none
        blocks = pairs if self.block == 2 else keys
        jump = self.shift[(blocks & U64((1 << SHIFT_BITS) - 1)).astype(np.int64)]
        at = np.arange(m - 1, n, LANE_WORDS)  # lanes that move along together
        stop = np.minimum(at + LANE_WORDS, n)
        found = []
        while len(at):
            step = jump[at]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        end = np.concatenate(found)
        lo = np.searchsorted(self.suffix, blocks[end], "left")
        size = np.searchsorted(self.suffix, blocks[end], "right") - lo
        end = np.repeat(end, size)
        pattern = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        first = end - m + 1
        same = (text_of[first] == text_of[end]) & (blocks[first + self.block - 1] == self.prefix[pattern])
        first, pattern = first[same], self.order[pattern[same]]
        kept = [i for i, (f, p) in enumerate(zip(first, pattern)) if self._equal(words, int(f), self.texts[p])]
        return first[kept], self.items[pattern[kept]]

    def _equal(self, words, first: int, text: bytes) -> bool:
        last = first + self.length
        gap = words.low[words.starts[first] : words.ends[last - 1]].tobytes()
        if gap == text:  # single blanks between the words, as usual
            return True
        return b" ".join(words.word(i) for i in range(first, last)) == text


def build_tables(rows: list[tuple[str, str]], width: int) -> tuple[list[Tables], list[str]]:
    """Tables of the windows of (item id, text) rows, one for each pattern length."""
    names = sorted({r[0] for r in rows})
    number = {n: i for i, n in enumerate(names)}
    words = words_of(pa.array([r[1] for r in rows], pa.large_string()))
    keys = words.keys()
    of: dict[int, dict] = {}
    for i, (name, _) in enumerate(rows):
        lo, hi = int(words.first[i]), int(words.first[i + 1])
        m = min(width, hi - lo)
        for at in range(lo, hi - m + 1) if m else ():
            text = b" ".join(words.word(j) for j in range(at, at + m))
            of.setdefault(m, {}).setdefault((text, number[name]), keys[at : at + m])
    return [Tables(m, np.array(list(found.values())), [t for t, _ in found], np.array([i for _, i in found]))
            for m, found in sorted(of.items())], names


def _merged(first: np.ndarray, last: np.ndarray, item: np.ndarray) -> list[tuple[int, int, int]]:
    """Overlapping or touching spans of one item as one."""
    out: list[tuple[int, int, int]] = []
    for i in np.lexsort((first, item)):
        if out and out[-1][2] == item[i] and first[i] <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], int(last[i])), out[-1][2])
        else:
            out.append((int(first[i]), int(last[i]), int(item[i])))
    return out


def search_slice(column: pa.Array, tables: list[Tables], names: list[str]):
    """Per text of a slice: number of words and its spans (first word, last word, item)."""
    words = words_of(column)
    keys, text_of = words.keys(), words.text_of
    pairs = _pairs(keys) if len(keys) else keys
    hits = [(f, f + t.length - 1, i) for t in tables for f, i in [t.search(words, keys, pairs, text_of)]]
    spans: list[list[dict]] = [[] for _ in range(len(column))]
    if hits:
        first, last, item = (np.concatenate([h[k] for h in hits]) for k in range(3))
        owner = text_of[first] if len(first) else first
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order])) + 1
        for part in np.split(order, cuts) if len(order) else ():
            i = int(owner[part[0]])
            base = int(words.first[i])
            spans[i] = [{"first": a - base, "last": b - base, "item": names[c]}
                        for a, b, c in _merged(first[part], last[part], item[part])]
    return words.counts, spans


def pattern_blocks(benchmark: DataFrame, width: int, block_words: int):
    """Benchmark items in blocks of at most about `block_words` words, each read on its own."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
             .filter("item IS NOT NULL AND text IS NOT NULL"))
    total = items.agg(F.sum(F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    number = -(-int(total) // block_words)
    for k in range(number):
        block = items if number == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(number)) == k)
        yield build_tables([(r["item"], r["text"]) for r in block.collect()], width)


def find_spans(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text", width: int = WIDTH,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns `carry` of docs with `n_words` and `spans`, the occurrences of benchmark windows.

    The names of `carry` come back as `c0`, `c1`, ... so that they cannot clash with the new columns.
    """
    spark = docs.sparkSession
    base = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(carry)], docs[text].cast("string").alias("text"),
                       F.lit(0).cast("bigint").alias("n_words"), F.array().cast(SPAN).alias("spans"))
    out = base
    blocks = pattern_blocks(benchmark, width, block_words)
    block = next(blocks, ([], []))
    while block:
        shared, block = spark.sparkContext.broadcast(block), next(blocks, None)  # the driver holds one block at a time
        last = block is None
        schema = T.StructType([f for f in base.schema.fields if not (last and f.name == "text")])
        arrow = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("item", pa.string())]))

        def scan(batches, shared=shared, last=last):
            tables, names = shared.value
            for part in batch_slices(batches, "text"):
                counts, spans = search_slice(column_of(part, "text"), tables, names)
                before = column_of(part, "spans").to_pylist()
                put = {"n_words": pa.array(counts, pa.int64()),
                       "spans": pa.array([a + b for a, b in zip(before, spans)], arrow)}
                names_out = [n for n in part.schema.names if not (last and n == "text")]
                yield pa.RecordBatch.from_arrays([put.get(n, column_of(part, n)) for n in names_out], names_out)

        out = out.mapInArrow(scan, schema)
    return out


def hit_words(spans: Column) -> Column:
    """Number of words inside any span."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["first"].alias("a"), s["last"].alias("b"))))
    start = F.struct(F.lit(-1).cast("bigint").alias("to"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(ordered, start, lambda acc, s: F.struct(
        F.greatest(acc["to"], s["b"]).alias("to"),
        (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["b"] - F.greatest(acc["to"], s["a"] - 1))).alias("n"))
    )["n"]


def judged(found: DataFrame) -> DataFrame:
    """Adds the digest: hit words, items and whether a twentieth of the words or more are hit."""
    items = F.array_sort(F.array_distinct(F.col("spans.item")))
    return (found.withColumn("n_hit", hit_words(F.col("spans"))).withColumn("items", items)
            .withColumn("n_items", F.size("items").cast("bigint"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without contaminated rows, columns as they were."""
    found = judged(find_spans(docs, benchmark, [*docs.columns]))
    kept = found.filter(~F.col("contaminated"))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    found = judged(find_spans(docs, benchmark, ["doc_id"]))
    return found.select(F.col("c0").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")
