"""Keyword search from postings: which rows hold which short runs of letters.

Every row is listed under the runs of one, two and three letters (grams) that its searched columns hold, A-Z and a-z alike.
A search lists the grams that its terms must have, takes the rows that are listed under all of them, and tests these rows in
full (if there are more than `SENT_ROWS`, all rows are tested before they meet the listed ones). A term of three letters or more asks for its runs of three, a shorter one for the whole of it; wild cards part a
term. Old listings of changed rows are not taken back: they can only add rows to test.

Grams are numbers made of their letters. A task lists `BLOCK` rows at a time: a listing holds the rows of the block under one gram,
so far fewer listings than pairs of row and gram are shuffled and sorted, and none grows with the table: a gram that very many
rows hold has many listings.

Listings are dealt to buckets of the gram and extended by every state version with the rows that are new or changed, so a
search reads the buckets of its grams only, and of these the parts whose range holds them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import SEARCH_COLUMNS
from ..functions.text import matches_terms
from ..session import cut
from ..sources.tables import finished_versions

BUCKETS = 64
LONGEST = 3
# Rows of a block, and the number of their grams at which a block ends before.
BLOCK, BLOCK_GRAMS = 1024, 1 << 20
# Rows taken from an Arrow batch, and letters of a text read, at a time.
TAKEN, PIECE = 64, 1 << 20
# Rows of a few numbers that are sent to all tasks, so that the texts they are joined to stay where they are.
SENT_ROWS = 1_000_000
# Bits of a letter in a gram; its code point plus one, so that none is zero.
BITS = 21
LETTER = (1 << BITS) - 1
LISTING = "gram bigint, id bigint, more array<bigint>"


def gram_code(gram: str) -> int:
    code = 0
    for letter in gram:
        code = code << BITS | ord(letter) + 1
    return code


def _distinct(ascending: np.ndarray) -> np.ndarray:
    return ascending[np.flatnonzero(np.diff(ascending, prepend=-1))]


def _piece_grams(text: str) -> np.ndarray:
    letters = np.zeros(len(text) + LONGEST - 1, np.int64)
    letters[: len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters[: len(text)] += 1
    letters[(letters > 0xD800) & (letters <= 0xE000)] = 0  # no letter: see `row_grams`
    packed = letters[: len(text)].copy()
    for k in range(1, LONGEST):
        packed = packed << BITS | letters[k : k + len(text)]
    packed.sort()
    packed, out, whole = _distinct(packed), [], True
    for n in range(1, LONGEST + 1):
        run = packed >> BITS * (LONGEST - n)
        whole = whole & (run & LETTER > 0)
        out.append(_distinct(run[whole]))
    return np.concatenate(out)


def row_grams(texts: Iterable[bytes | None]) -> np.ndarray:
    """Codes of the distinct runs of one to `LONGEST` letters of each of the texts, ascending."""
    # A byte FF parts the texts; like all bytes that are no character it is read as a surrogate, and no gram holds one.
    text = b"\xff".join(t for t in texts if t).lower().decode("utf-8", "surrogateescape")
    pieces = [_piece_grams(text[at : at + PIECE + LONGEST - 1]) for at in range(0, len(text), PIECE)]
    return pieces[0] if len(pieces) == 1 else np.unique(np.concatenate([np.zeros(0, np.int64), *pieces]))


def _block(ids: list[int], grams: list[np.ndarray]) -> pa.RecordBatch:
    """Listings of some rows: `id` is the first row under the gram, `more` the others, each as what it differs from `id` by (exclusive or)."""
    every = np.concatenate(grams)
    order = np.argsort(every, kind="stable")  # merges the rows' ascending grams
    every, row = every[order], np.repeat(np.array(ids, np.int64), [len(g) for g in grams])[order]
    starts = np.flatnonzero(np.diff(every, prepend=-1))
    first = row[starts]
    differs = np.delete(row ^ np.repeat(first, np.diff(starts, append=len(row))), starts)
    ends = np.append(starts - np.arange(len(starts)), len(differs)).astype(np.int32)
    return pa.record_batch({"gram": every[starts], "id": first, "more": pa.ListArray.from_arrays(pa.array(ends), pa.array(differs))})


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, grams, held = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, TAKEN):
            some = batch.slice(at, TAKEN)
            texts = zip(*[some.column(name).cast(pa.binary()).to_pylist() for name in SEARCH_COLUMNS])
            for row, of_row in zip(some.column("id").to_pylist(), texts):
                found = row_grams(of_row)
                if not len(found):
                    continue
                ids.append(row)
                grams.append(found)
                held += len(found)
                if len(ids) == BLOCK or held >= BLOCK_GRAMS:
                    yield _block(ids, grams)
                    ids, grams, held = [], [], 0
    if ids:
        yield _block(ids, grams)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int").alias("bucket")


def listings(rows: DataFrame, buckets: int) -> DataFrame:
    """(gram, id, more, bucket) of state rows: the rows under a gram, block by block (see `_block`)."""
    found = rows.filter("id IS NOT NULL").select("id", *SEARCH_COLUMNS).mapInArrow(_blocks, LISTING)
    return found.select("*", _bucket(buckets))


def asked_grams(query: str) -> list[str]:
    """Grams that a row must hold to match all terms."""
    out = set()
    for term in query.split():
        for run in re.split("[%_]", "".join(c.lower() if "A" <= c <= "Z" else c for c in term)):
            n = min(len(run), LONGEST)
            out |= {run[i : i + n] for i in range(len(run) - n + 1)} if n else set()
    return sorted(out)


@dataclass
class Postings:
    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def _write(self, rows: DataFrame, version: int) -> None:
        dealt = listings(rows, self.buckets).repartitionById(self.buckets, "bucket").sortWithinPartitions("bucket", "gram", "id")
        dealt.write.partitionBy("bucket").parquet(f"{self.root}/version={version}")

    def extend(self, after: DataFrame, version: int, before: DataFrame | None = None) -> None:
        """Lists the rows of a state version that are new, or whose searched columns differ from the version before."""
        if before is not None:
            print_of = F.xxhash64(*[F.coalesce(F.col(c), F.lit("")) for c in SEARCH_COLUMNS])
            old = before.select("id", print_of.alias("_print"))
            old = F.broadcast(old) if before.count() <= SENT_ROWS else old
            after = after.withColumn("_print", print_of).join(old, ["id", "_print"], "left_anti").drop("_print")
        self._write(after, version)

    def candidates(self, query: str, version: int) -> DataFrame | None:
        """(id) of the rows up to a state version that hold every gram; null if the query asks for none."""
        grams = asked_grams(query)
        versions = [v for v in finished_versions(self.spark, self.root) if v <= version]
        if not grams or not versions:
            return None
        codes = self.spark.createDataFrame([(gram_code(g),) for g in grams], "gram bigint")
        wanted, dealt = zip(*[(r["gram"], r["bucket"]) for r in codes.select("gram", _bucket(self.buckets)).collect()])
        rows = self.spark.read.schema(f"{LISTING}, bucket int").option("basePath", self.root).parquet(*[f"{self.root}/version={v}" for v in versions])
        held = rows.filter(F.col("bucket").isin(*set(dealt)) & F.col("gram").isin(*wanted))
        others = F.transform("more", lambda differs: differs.bitwiseXOR(F.col("id")))
        listed = held.select("gram", F.explode(F.concat(F.array("id"), others)).alias("id"))
        if len(wanted) == 1:
            return listed.select("id").distinct()
        return listed.distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(wanted)).select("id")

    def search(self, state: DataFrame, query: str, version: int) -> DataFrame:
        """Rows of the state (of that version) that match the query: the same as a scan with `matches_terms`."""
        test, found = matches_terms(query, SEARCH_COLUMNS), self.candidates(query, version)
        if found is None:
            return state.filter(test)
        listed = cut(found.select("id", F.lit(True).alias("_listed")), "candidates")
        if listed.count() > SENT_ROWS:  # the test comes first, so that texts are not shuffled
            return state.join(listed, "id", "left_semi").filter(test)
        # A test that mentions the listing stays in the join and is tried on its rows only.
        listed = F.broadcast(listed.withColumnRenamed("id", "_id"))
        return state.join(listed, (F.col("id") == F.col("_id")) & F.when(F.col("_listed"), test), "left_semi")
