"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.session import cut, lookup


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of `links` (a, b); a component is its smallest id.

    Alternates large stars (every larger neighbour of a node links to the node's smallest neighbour) and small stars
    (every smaller one does) until nothing changes. Each round aggregates minima before its shuffle, sends the minima of
    nodes with very many links to their links instead of gathering these, and writes its links to the shared folder.
    """
    now = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        before = tuple(state)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        met, _ = _with_least(both, 2 * state[0])
        large = met.filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = cut(large.filter("a <> b").distinct(), "links")
        met, least = _with_least(large, state[0])
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "links")


def _with_least(links: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """(`links` with the least neighbour `m` of `a`, the table of these); about `number` links."""
    least = cut(links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    return lookup(links, least.select("a", "m"), "a", least.select("a", "n"), number, plain=0), least.select("a", "m")
