"""URL filter: a cascade of Bloom filters that is exact on the corpus's own keys.

The universe is every distinct key (host and path) of the corpus; some of its keys are listed. Level 1 encodes the
listed keys, level 2 the unlisted ones that level 1 lets through by mistake, level 3 the listed ones that level 2 lets
through, and so on until nothing is let through. A key's answer is the parity of the first level that turns it away, so
membership is exact for every key of the universe and a url is judged in place, without a join.

Keys fall into shards by hash so that the filters of a shard stay below `shard_keys` keys; each shard is broadcast on
its own and judges its own urls in the same pass. Only the filters reach the driver, one shard at a time.

Rules name a host (with its subdomains) and the beginning of a path; the longest fitting rule decides. The keys listed
for the cascade are those a rule blocks, and those without a rule whose host is listed by one of its words.

Defined cases: a null url, or one without `://`, has an empty host and path, no rule, and is allowed; repeated urls get
the same verdict; null ids pass through; an empty table gives an empty result; urls of any length are read whole; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadweave.llm.words import U64, column_of, mix
from leadweave.session import cut

# Fixed values of the task: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Words between dots and hyphens of a host that put it on the list where no rule speaks.
LISTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "track", "viagra", "xxx")
SHARD_KEYS = 2_000_000
DRIVER_KEYS = 50_000
LATER_RATE = 0.1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=None) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    fits = None
    for verdict, rule_host, rule_path in sorted(rules or RULES, key=lambda r: -len(r[1] + r[2])):
        on = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(on, value) if fits is None else fits.when(on, value)
    return fits


def listed_host(host: Column, words=LISTED_WORDS) -> Column:
    return F.arrays_overlap(F.split(host, r"[.-]"), F.array(*[F.lit(w) for w in words]))


@dataclass
class Filter:
    bits: np.ndarray  # words of 64 bits
    hashes: int
    level: int

    def positions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size = U64(len(self.bits) * 64)
        with np.errstate(over="ignore"):
            start = mix(a + U64(self.level) * U64(0x9E3779B97F4A7C15))
            return np.stack([(start + U64(i) * (b | U64(1))) % size for i in range(self.hashes)])

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.bits):
            return np.zeros(len(a), bool)
        at = self.positions(a, b)
        return ((self.bits[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1)).all(axis=0)


def empty_filter(keys: int, rate: float, level: int) -> Filter:
    words = max(1, int(np.ceil(-keys * np.log(rate) / np.log(2) ** 2 / 64)))
    return Filter(np.zeros(words, np.uint64), max(1, round(-np.log2(rate))), level)


def member(cascade: list[Filter], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether keys are listed: the first level that turns a key away is an even one."""
    out = np.zeros(len(a), bool)
    at = np.arange(len(a))
    for i, level in enumerate(cascade):
        inside = level.holds(a[at], b[at])
        out[at[~inside]] = i % 2 == 1
        at = at[inside]
    out[at] = len(cascade) % 2 == 1
    return out


def _hashes(batch):
    return np.asarray(column_of(batch, "a")).view(np.uint64), np.asarray(column_of(batch, "b")).view(np.uint64)


def hashed(key: Column) -> list[Column]:
    """The two hashes a, b that stand for a key in filters."""
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b")]


def encode(keys: DataFrame, number: int, rate: float, level: int) -> Filter:
    """The filter of a table of keys; tasks set bits, equal words are joined before they reach the driver."""
    out = empty_filter(number, rate, level)

    def words(batches):
        for batch in batches:
            at = out.positions(*_hashes(batch)).reshape(-1)
            order = np.argsort(at)
            at = at[order]
            word = (at >> U64(6)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, int)
            value = np.bitwise_or.reduceat(U64(1) << (at & U64(63)), first) if len(word) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(value.view(np.int64))], ["word", "value"])

    got = keys.mapInArrow(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()  # the filter
    out.bits[np.asarray(got["word"])] = np.asarray(got["value"]).view(np.uint64)
    return out


def passing(keys: DataFrame, level: Filter) -> DataFrame:
    """The rows (with hashes a, b) that a filter lets through."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def test(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.holds(*_hashes(batch))))

    return keys.mapInArrow(test, keys.schema)


def _finish(inside: np.ndarray, outside: np.ndarray, level: int) -> list[Filter]:
    """The last levels, over few keys (two columns of hashes each)."""
    out = []
    while len(inside):
        f = empty_filter(len(inside), LATER_RATE, level)
        at = f.positions(inside[:, 0], inside[:, 1]).reshape(-1)
        np.bitwise_or.at(f.bits, (at >> U64(6)).astype(np.int64), U64(1) << (at & U64(63)))
        out.append(f)
        inside, outside, level = outside[f.holds(outside[:, 0], outside[:, 1])], inside, level + 1
    return out


def cascade(listed: DataFrame, unlisted: DataFrame) -> list[Filter]:
    """Cascade over tables of distinct keys (a, b: two hashes of a key), which must not overlap."""
    out: list[Filter] = []
    inside, outside = listed, unlisted
    n, m = inside.count(), outside.count()
    while n:
        if n + m <= DRIVER_KEYS:
            both = [np.stack([np.asarray(t[c]).view(np.uint64) for c in ("a", "b")], axis=1) for t in (inside.toArrow(), outside.toArrow())]
            return out + _finish(*both, len(out) + 1)
        rate = min(0.5, max(1e-3, 0.7 * n / max(m, 1))) if not out else LATER_RATE
        out.append(encode(inside, n, rate, len(out) + 1))
        inside, outside = cut(passing(outside, out[-1]), "cascade"), inside
        n, m = inside.count(), n
    return out


def with_membership(rows: DataFrame, universe: DataFrame, column: str = "member", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """`rows` (with hashes a, b of their keys) and whether each key is listed, by the cascade of `universe` (a, b, listed)."""
    spark = rows.sparkSession
    known = cut(universe, "universe")
    shards = max(1, -(-known.count() // shard_keys))
    schema = T.StructType([*rows.schema.fields, T.StructField(column, T.BooleanType())])
    out = rows.select("*", F.lit(None).cast("boolean").alias(column))
    for s in range(shards):
        mine = known.filter(F.pmod(F.col("b"), F.lit(shards)) == s)
        shared = spark.sparkContext.broadcast(cascade(mine.filter("listed").select("a", "b"), mine.filter("NOT listed").select("a", "b")))

        def judge(batches, s=s, shared=shared):
            for batch in batches:
                a, b = _hashes(batch)
                here = np.mod(b.view(np.int64), shards) == s
                before = np.asarray(column_of(batch, column).fill_null(False)).astype(bool)
                verdict = np.where(here, member(shared.value, a, b), before)
                names = [n for n in batch.schema.names if n != column]
                yield pa.RecordBatch.from_arrays([*[column_of(batch, n) for n in names], pa.array(verdict)], [*names, column])

        out = out.mapInArrow(judge, schema)
    return out


def filter_urls(pages: DataFrame, rules=None, words=LISTED_WORDS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    key = F.concat("host", "path")
    rows = rows.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules)).select("*", *hashed(key))
    blocked = F.coalesce(F.col("rule.verdict") == "block", listed_host(F.col("host"), words))
    universe = rows.select("a", "b", blocked.alias("listed")).groupBy("a", "b").agg(F.bool_or("listed").alias("listed"))
    judged = with_membership(rows.select("page_id", "host", "path", F.col("rule.rule").alias("rule"), "a", "b"), universe, shard_keys=shard_keys)
    return judged.select("page_id", "host", "path", "rule", F.when(F.col("member"), "block").otherwise("allow").alias("verdict"))
