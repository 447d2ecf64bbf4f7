"""A stored index of the state's names: signatures beside the state, extended by every version.

An upsert looks up the names of its batch. Without an index, each run reads all state names and signs them anew. The
index keeps the signature rows of the similarity join (see `fuzzy`), dealt to buckets of the signature, one folder a state
version. Names of companies never change and ids only grow, so a version adds the rows of its new names, and the first
match of a name is the least id over all versions. What a lookup needs is read from the buckets its signatures fall in.

Every name also has a row under a signature of the whole key, so that equal names, short ones included, are found the same
way. Number of buckets, signature width and the order of bigrams are fixed when the index is made; any order is exact.
Folders count once their write committed, like state versions; a version above the state's is a write that the state did not
follow, and is not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import alike, sorted_tokens
from ..session import cut
from ..sources.tables import finished_versions
from .fuzzy import (
    BROADCAST_ROWS, FINGERPRINTS, PAIR_BUDGET, _few_comparisons, _few_matches, _group_pairs, _plausible, _sampled, _shuffled, _spread, bigram_order, describe, first_match, signature_width, signatures,
)

BUCKETS = 64
# Names for which pairs of bigrams are used as signatures from the start.
WIDE_FROM = 30_000
WHOLE = "whole"
# So many pairs in signature groups are always compared there; more of them only where they are fewer than `PAIR_COST` of all pairs,
# since a pair of a group costs as much as many pairs of a comparison of all.
FEW_PAIRS, PAIR_COST = 100_000_000, 0.05


def _names(rows: DataFrame) -> DataFrame:
    """(ord, name_key): the distinct non-blank name keys of (id, normalized_name), each at its least id."""
    keyed = rows.select(F.col("id").alias("ord"), sorted_tokens("normalized_name").alias("name_key")).filter("name_key <> ''")
    return keyed.groupBy("name_key").agg(F.min("ord").alias("ord")).select("ord", "name_key")


@dataclass
class NameIndex:
    spark: SparkSession
    root: str
    order: list[str]
    width: int
    buckets: int

    @classmethod
    def create(cls, state: DataFrame, root: str, version: int, buckets: int = BUCKETS, width: int | None = None) -> NameIndex:
        """Index of the names of a state, stored as its version."""
        spark = state.sparkSession
        names = cut(_names(state), "index-names")
        index = cls(spark, root, bigram_order(names), width or signature_width(names.count()), buckets)
        row = [(index.order, index.width, index.buckets)]
        spark.createDataFrame(row, "bigrams array<string>, width int, buckets int").coalesce(1).write.parquet(f"{root}/settings")
        index._write(names, version)
        return index

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> NameIndex:
        row = spark.read.parquet(f"{root}/settings").first()
        return cls(spark, root, row["bigrams"], row["width"], row["buckets"])

    def signed(self, keys: DataFrame) -> DataFrame:
        """Signature rows (sig, ord, name_key, n, fingerprints, bucket) of distinct keys (ord, name_key)."""
        similar = signatures(describe(_spread(keys, "ord"), self.order), self.width)
        whole = keys.select(F.xxhash64(F.lit(WHOLE), "name_key").alias("sig"), "ord", "name_key")
        rows = similar.unionByName(whole, allowMissingColumns=True)
        return rows.withColumn("bucket", F.pmod(F.col("sig"), F.lit(self.buckets)).cast("int"))

    def _write(self, names: DataFrame, version: int) -> None:
        rows = self.signed(names)
        rows.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "sig").write.partitionBy("bucket").parquet(f"{self.root}/rows/version={version}")

    def extend(self, fresh: DataFrame, version: int) -> None:
        """Adds the names of new state rows (id, normalized_name); a name that the index knows keeps its lesser id."""
        names = cut(_names(fresh), "index-names")
        whole = names.select(F.xxhash64(F.lit(WHOLE), "name_key").alias("sig"), "name_key").withColumn("bucket", F.pmod(F.col("sig"), F.lit(self.buckets)).cast("int"))
        known = self.rows(version - 1, self._touched(whole))
        if known is not None:
            names = cut(names.join(known.filter("n IS NULL").select("name_key"), "name_key", "left_anti").select("ord", "name_key"), "index-names")
        self._write(names, version)

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most `buckets` numbers

    def rows(self, version: int, touched: list[int] | None = None) -> DataFrame | None:
        """Signature rows up to a state version; only the files of the touched buckets are listed and read."""
        versions = [v for v in finished_versions(self.spark, f"{self.root}/rows") if v <= version]
        if not versions:
            return None
        fields = "sig long, ord long, name_key string, n int, " + ", ".join(f"{f} long" for f in FINGERPRINTS) + ", bucket int"
        read = self.spark.read.schema(fields).option("basePath", f"{self.root}/rows")
        rows = read.parquet(*[f"{self.root}/rows/version={v}" for v in versions])
        return rows if touched is None else rows.filter(F.col("bucket").isin(touched))

    def _affordable(self, ps: DataFrame, xs: DataFrame, probes: int, names: int, budget: int) -> bool:
        """Whether the signature groups hold far fewer pairs than there are, and a sample of the probe matches within the budgets."""
        pairs = _group_pairs(ps, xs)
        if pairs > FEW_PAIRS and pairs > PAIR_COST * probes * names or not _few_comparisons(probes, names, budget):
            return False
        some, each = _sampled(ps, probes)
        met = xs.alias("x").join(F.broadcast(some.alias("y")), F.expr("x.sig = y.sig") & _plausible("x", "y"))
        return _few_matches(met.select("x.ord", F.col("y.ord").alias("probe")).distinct().count() * each, max(probes, 1), budget)

    def first_match(self, probe: DataFrame, version: int, budget: int = PAIR_BUDGET) -> DataFrame:
        """(ord, match): for every probe key (ord, name_key) that matches one, the least id of the state's names up to a version."""
        asked = cut(self.signed(probe), "asked")
        found = self.rows(version, self._touched(asked))
        if found is None:
            return probe.select("ord", F.col("ord").alias("match")).limit(0)
        equal = found.filter("n IS NULL").select("sig", "name_key", F.col("ord").alias("match"))
        same = asked.filter("n IS NULL").select("sig", "name_key", "ord").join(equal, ["sig", "name_key"]).select("ord", "match")
        ps, xs = asked.filter("n IS NOT NULL").drop("bucket"), found.filter("n IS NOT NULL").drop("bucket")
        if not self._affordable(ps, xs, probe.count(), found.filter("n IS NULL").count(), budget):
            # names so alike that their groups hold more than all pairs, or crowds: probed in order, in chunks that shed what has matched
            every = self.rows(version).filter("n IS NULL").groupBy("name_key").agg(F.min("ord").alias("ord")).select("ord", "name_key")
            return first_match(probe, cut(every, "index-names"), budget)
        if ps.count() <= BROADCAST_ROWS:
            joined = xs.alias("x").join(F.broadcast(ps).alias("y"), F.expr("x.sig = y.sig") & _plausible("x", "y"))
        else:
            joined = _shuffled(ps, xs, _plausible("x", "y"))
        near = joined.select(F.col("x.ord").alias("match"), F.col("y.ord").alias("ord"), F.col("x.name_key").alias("ka"), F.col("y.name_key").alias("kb"))
        near = near.dropDuplicates(["ord", "match"])
        similar = near.filter(alike("ka", "kb")).select("ord", "match")
        return same.unionByName(similar).groupBy("ord").agg(F.min("match").alias("match"))
