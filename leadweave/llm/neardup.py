"""Near-duplicate documents by ProbMinHash over weighted shingles, banding and exact verification.

A shingle is a run of five words; its weight is 1 + ln of its count in the text. Every shingle is a Poisson process
whose rate is its weight: its points arrive in time order, each falls into one of 240 registers, and a register keeps
the shingle that came first. Two texts agree in a register with the probability Jaccard similarity of their weights.
A text is done when its next points come later than every register's first arrival.

Links are by set similarity, so a text that repeats shingles gets a second sketch, in which every shingle has weight 1
(without repeats both sketches are the same); the buckets of both count. Two texts agree in a register of the second
sketch with the probability set similarity: its forty bands of six registers miss a pair of similarity 0.8 with
probability 5e-6, however often shingles are repeated. The weighted bands only add candidates.

Copies (equal words) collapse before banding. The texts of a band bucket link to its smallest member; what hangs
together this way is a family, the only place where links can be. A family is cut into blocks of about 256 texts and
every two blocks are compared in one task, exactly, by set similarity of the shingles; a task gives back a spanning
forest of the links it found. So no bucket, family or class is ever gathered whole, no pair list is written, and no
link between two candidate texts is lost. A class is a connected component of links; it is named by its least id.

Defined cases: null and empty texts have no words, link with nothing and are classes of their own; a text of one to
four words is one shingle; repeated rows are copies of each other; rows with a null id have a null class and are kept; texts
of any length are read whole; extra columns, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.llm.components import components
from leadweave.llm.urls import encode, hashed, passing
from leadweave.llm.words import U64, batch_slices, column_of, mix, shingles, words_of
from leadweave.session import cut

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 40, 6
BLOCK = 256
# The filter that keeps texts outside families from being shuffled is sized for so many ids at most (10 MB).
FILTER_IDS = 8_000_000
_GOLDEN = U64(0x9E3779B97F4A7C15)


def signatures(keys: np.ndarray, weights: np.ndarray, text: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """ProbMinHash register contents of each text; (key, weight, text) are its distinct shingles. 0: no shingle."""
    time = np.full(n_texts * registers, np.inf)
    held = np.zeros(n_texts * registers, np.uint64)
    arrival = np.zeros(len(keys))
    on, turn = np.arange(len(keys)), 0
    while len(on):
        with np.errstate(over="ignore"):
            draw = mix(keys[on] + _GOLDEN * U64(2 * turn + 1))
            place = mix(keys[on] + _GOLDEN * U64(2 * turn + 2))
        arrival[on] -= np.log(((draw >> U64(11)).astype(np.float64) + 0.5) / 2.0**53) / weights[on]
        at = text[on] * registers + (place % U64(registers)).astype(np.int64)
        np.minimum.at(time, at, arrival[on])
        first = time[at] == arrival[on]
        held[at[first]] = keys[on[first]]
        last = time.reshape(n_texts, registers).max(axis=1)
        on = on[arrival[on] < last[text[on]]]
        turn += 1
    return held.reshape(n_texts, registers)


def band_buckets(held: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Bucket of every text in every band of its registers."""
    held = held.reshape(len(held), bands, rows)
    with np.errstate(over="ignore"):
        bucket = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(held), bands))
        for i in range(rows):
            bucket = mix(bucket * _GOLDEN + held[:, :, i])
    return bucket


def sketch(column: pa.Array, width: int, bands: int, rows: int):
    """Per text: the key of its whole word sequence in two halves (0, 0: no words) and the list of its band buckets."""
    words = words_of(column)
    key, text = shingles(words, width)
    order = np.lexsort((key, text))
    skey, stext = key[order], text[order]
    new = np.ones(len(skey), bool)
    new[1:] = (skey[1:] != skey[:-1]) | (stext[1:] != stext[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(skey)))
    skey, stext = skey[at], stext[at]
    weighted = band_buckets(signatures(skey, 1 + np.log(count), stext, words.n_texts, bands * rows), bands, rows)
    repeats = np.unique(stext[count > 1])
    own = np.isin(stext, repeats)
    plain = band_buckets(signatures(skey[own], np.ones(int(own.sum())), np.searchsorted(repeats, stext[own]), len(repeats), bands * rows), bands, rows)
    buckets = list(weighted)
    for i, more in zip(repeats.tolist(), plain):
        buckets[i] = np.unique(np.concatenate([weighted[i], more]))
    with np.errstate(over="ignore"):
        # whole sequence: words weighted by odd powers of their place
        place = np.arange(len(words.starts)) - np.repeat(words.first[:-1], words.counts)
        keys = words.keys()
        halves = []
        for salt in (3, 5):
            scattered = np.concatenate([[U64(0)], np.cumsum(mix(keys ^ mix(place.astype(np.uint64) * U64(2) + U64(salt))), dtype=np.uint64)])
            halves.append(np.where(words.counts > 0, (scattered[words.first[1:]] - scattered[words.first[:-1]]) | U64(1), U64(0)))
    return halves, buckets


def forest_of(linked: np.ndarray, same: bool = False) -> list[tuple[int, int]]:
    """Edges (row, column) of a spanning forest of a matrix of links; rows and columns are one set if `same`."""
    fresh = [np.ones(n, bool) for n in linked.shape]
    if same:
        fresh[1] = fresh[0]
    out = []
    for row in np.flatnonzero(linked.any(axis=1)).tolist():
        queue = [(0, row)] if fresh[0][row] else []
        fresh[0][row] = False
        while queue:
            side, x = queue.pop()
            near = np.flatnonzero((linked[:, x] if side else linked[x]) & fresh[1 - side])
            fresh[1 - side][near] = False
            out += [(y, x) if side else (x, y) for y in near.tolist()]
            queue += [(0 if same else 1 - side, y) for y in near.tolist()]
    return out


def forest(shingles_of: list[np.ndarray], side: np.ndarray, similarity: float, same: bool) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between texts of side 0 and side 1 (of all texts if `same`)."""
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    size = np.array([len(s) for s in shingles_of])
    every = np.concatenate([shingles_of[i] for i in right])
    owner = np.repeat(np.arange(len(right)), size[right])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    linked = np.zeros((len(left), len(right)), bool)
    for row, i in enumerate(left):
        lo = np.searchsorted(every, shingles_of[i], "left")
        n = np.searchsorted(every, shingles_of[i], "right") - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        common = np.bincount(owner[at], minlength=len(right))
        linked[row] = common >= similarity * (size[i] + size[right] - common) - 1e-9
    return [(left[i], right[j]) for i, j in forest_of(linked, same)]


def _families(sketches: DataFrame) -> DataFrame:
    """(id, component) of the smallest texts of copies that share a band bucket, directly or over others."""
    smallest = sketches.filter("k1 <> 0").groupBy("k1", "k2").agg(F.min(F.struct("id", "buckets")).alias("s")).select("s.*")
    buckets = cut(smallest.select("id", F.explode("buckets").alias("bucket")), "buckets")
    heads = buckets.groupBy("bucket").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return components(buckets.join(heads, "bucket").filter("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b")))


def _links(texts: DataFrame, families: DataFrame, width: int, similarity: float, block: int) -> DataFrame:
    """(a, b): spanning forests of the links between the blocks of each family."""
    sizes = families.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    placed = (families.join(sizes, "component")
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    ids = families.select(*hashed(F.col("id")))
    inside = encode(ids, max(1, min(families.count(), FILTER_IDS)), 0.01, 1)
    near = passing(texts.select("*", *hashed(F.col("id"))), inside).drop("a", "b")
    text = near.join(placed, "id").groupBy("id", "component", "blocks", "block").agg(F.min("text").alias("text"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = (text.withColumn("other", other)
             .select("component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "text"))

    def compare(table: pa.Table) -> pa.Table:
        same = table["x"][0].as_py() == table["y"][0].as_py()
        rows = []
        for batch in table.combine_chunks().to_batches():
            for part in batch_slices([batch], "text"):
                key, owner = shingles(words_of(column_of(part, "text")), width)
                rows += [np.unique(k) for k in np.split(key, np.searchsorted(owner, np.arange(1, part.num_rows)))]
        pairs = forest(rows, np.asarray(table["side"]), similarity, same)
        ids = table["id"]
        return pa.table({"a": ids.take([p[0] for p in pairs] if pairs else pa.array([], pa.int64())),
                         "b": ids.take([p[1] for p in pairs] if pairs else pa.array([], pa.int64()))})

    return tasks.groupBy("component", "x", "y").applyInArrow(compare, "a long, b long")


def classes(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
            block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id) of every row."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))

    def read(batches):
        for part in batch_slices(batches, "text"):
            (k1, k2), buckets = sketch(column_of(part, "text"), width, bands, rows)
            ends = np.cumsum([0, *map(len, buckets)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *buckets]).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "id"), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), lists], ["id", "k1", "k2", "buckets"])

    sketches = cut(texts.filter("id IS NOT NULL").mapInArrow(read, "id long, k1 long, k2 long, buckets array<long>"), "sketches")
    families = cut(_families(sketches), "families")
    linked = components(_links(texts, families, width, similarity, block))
    copies = sketches.filter("k1 <> 0").groupBy("k1", "k2").agg(F.min("id").alias("id"))
    named = copies.join(linked, "id", "left").select("k1", "k2", F.coalesce("component", "id").alias("class_id"))
    found = sketches.select("id", "k1", "k2").join(named, ["k1", "k2"], "left")
    known = found.select(F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"))
    return known.unionByName(texts.filter("id IS NULL").select(F.col("id").alias("doc_id"), F.lit(None).cast("bigint").alias("class_id")))


def one_per_class(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` with the least id of their class, one for each class; columns as they were.

    A class is named by its least id, so the rows to keep are those whose own id names their class. An id that stands
    on several rows keeps one of each distinct text.
    """
    kept = classes(docs, **settings).filter("doc_id = class_id").select(F.col("doc_id").alias("_lw_id")).distinct()
    rows = docs.join(kept, F.col("doc_id").cast("bigint") == F.col("_lw_id"), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id IS NULL"))
