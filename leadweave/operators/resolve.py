"""Which sightings are the same company: order-dependent duplicate resolution as set operations.

Sightings arrive in `seq` order. A sighting joins the company of the first sighting with its web domain,
else the earliest company leader with a matching name, else it leads a new company. As sets:

1. The first sighting per domain, and every sighting without domain, can reach the name test; all other
   sightings follow the first one of their domain.
2. Sightings with equal name keys always end with the same leader, so the name test works on distinct
   keys, each at the order of its first sighting. A crowd of copies collapses here.
3. Leaders form the greedy independent set of the match graph in order: a key is a leader if no
   earlier leader matches it, else it follows the earliest such leader. Keys are decided in growing
   batches: pairs are only formed inside a batch; its new leaders then claim all later keys they match, so
   crowds of similar keys shrink to their leaders instead of being paired in full. (Greedy
   independent sets in parallel prefixes: Blelloch, Fineman, Shun, SPAA 2012.)
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hosts import host
from ..functions.names import company_key, sorted_tokens
from ..session import cut, discard, lookup
from .fuzzy import (
    BROADCAST_ROWS, PAIR_BUDGET, SMALL_SET, _next_chunk, matching_pairs, matching_self, prepared, self_affordable, signature_width,
)

FIRST_BATCH = 100_000
# So many matching pairs (16 bytes each) are decided by the driver.
FEW_EDGES = 2_000_000


def greedy_leaders(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(ord, leader) for every node, given matching pairs (a earlier, b later).

    Each round decides every node whose earlier neighbours allow it: none left undecided or leading
    -> leader; the earliest leading one precedes all undecided ones -> follower. Few pairs are decided in order, without rounds.
    """
    if edges.count() <= FEW_EDGES:
        return cut(nodes.select("ord").join(_decided_in_order(edges), "ord", "left").select("ord", F.coalesce("leader", "ord").alias("leader")), "leaders")
    late = edges.select(F.col("b").alias("ord")).distinct()
    state = nodes.select("ord").join(late.withColumn("_late", F.lit(True)), "ord", "left").select(
        "ord", F.when(F.col("_late"), F.lit(None).cast("bigint")).otherwise(F.col("ord")).alias("leader")
    )
    state = cut(state, "leaders")
    while not state.filter("leader IS NULL").isEmpty():
        earlier = state.select(F.col("ord").alias("a"), F.col("leader").alias("la"))
        open_nodes = state.filter("leader IS NULL").select(F.col("ord").alias("b"))
        seen = (
            edges.join(open_nodes, "b").join(earlier, "a").groupBy("b").agg(
                F.min(F.when(F.col("la") == F.col("a"), F.col("a"))).alias("lead"),
                F.min(F.when(F.col("la").isNull(), F.col("a"))).alias("open"),
            )
        )
        decided = (
            F.when(F.col("leader").isNotNull(), F.col("leader"))
            .when(F.col("lead").isNull() & F.col("open").isNull(), F.col("ord"))
            .when(F.col("open").isNull() | (F.col("lead") < F.col("open")), F.col("lead"))
        )
        before = state
        state = cut(
            state.join(seen, F.col("ord") == F.col("b"), "left").select("ord", decided.alias("leader")), "leaders"
        )
        discard(before)
    return state


def _decided_in_order(edges: DataFrame) -> DataFrame:
    """(ord, leader) of the followers."""
    table = edges.select("a", "b").toArrow()  # at most FEW_EDGES rows
    a, b = (np.asarray(table[c]).astype(np.int64) for c in ("a", "b"))
    leader, order = {}, np.lexsort((a, b))
    for earlier, later in zip(a[order].tolist(), b[order].tolist()):  # the pairs of a node, earliest first, after those of all nodes before it
        if earlier not in leader:
            leader.setdefault(later, earlier)
    rows = pa.table({"ord": pa.array(list(leader), pa.int64()), "leader": pa.array(list(leader.values()), pa.int64())})
    return edges.sparkSession.createDataFrame(rows, "ord bigint, leader bigint")


def key_leaders(keys: DataFrame, first_batch: int = FIRST_BATCH, budget: int = PAIR_BUDGET) -> DataFrame:
    """(ord, leader) for distinct non-blank name keys (ord, name_key)."""
    short = keys.filter(F.char_length("name_key") < 3).select("ord", F.col("ord").alias("leader"))
    todo = cut(prepared(keys, float(keys.count()) ** 2), "keys")
    left = todo.count()
    width = signature_width(min(left, first_batch))
    parts, batch = [short], first_batch
    while left:
        part, later, size = _next_chunk(todo, left, batch, lambda d, n: self_affordable(d, n, budget))
        pairs = cut(matching_self(part, width, size <= SMALL_SET), "pairs")
        state = greedy_leaders(part, pairs)
        parts.append(state)
        left -= size
        if left:
            leaders = part.join(state.filter("ord = leader").select("ord"), "ord", "left_semi")
            claimed = _claim(later, leaders, width)
            parts.append(claimed.select(F.col("b").alias("ord"), "leader"))
            todo = cut(later.join(claimed, F.col("ord") == F.col("b"), "left_anti"), "keys")
            left = todo.count()
            batch *= 4
    return reduce(DataFrame.unionByName, parts)


def _claim(later: DataFrame, leaders: DataFrame, width: int) -> DataFrame:
    """(b, leader): later keys matched by one of the new leaders, with the earliest of them."""
    return cut(matching_pairs(later, leaders, width).groupBy("b").agg(F.min("a").alias("leader")), "claimed")


def name_groups(keys: DataFrame, first_batch: int = FIRST_BATCH, budget: int = PAIR_BUDGET) -> DataFrame:
    """(ord, name_key, leader, members): each key with the earliest leader it matches and the size of that leader's group.

    One row a key: a crowd of alike names costs its number of names, not their pairs (`fuzzy.self_pairs` gives those).
    Every key matches its leader, and leaders do not match each other.
    """
    decided = cut(keys.select("ord", "name_key").join(key_leaders(keys, first_batch, budget), "ord"), "decided")
    sizes = cut(decided.groupBy("leader").agg(F.count(F.lit(1)).alias("members")), "sizes")
    counts = sizes.select("leader", F.col("members").alias("n"))
    return lookup(decided, sizes, "leader", counts, decided.count()).select("ord", "name_key", "leader", "members")


def revise_leaders(decided: DataFrame, keys: DataFrame, first_batch: int = FIRST_BATCH, budget: int = PAIR_BUDGET) -> DataFrame:
    """(ord, name_key, leader) of `keys` (ord, name_key), from an earlier decision (ord, name_key, leader) about other keys or orders.

    Only what a change reaches is decided again. Open at first are keys that are new or have another order, and the
    followers of leaders that went or moved. A round gives every open key the earliest standing leader before it; those
    without one are decided among themselves. Each new leader then takes the later keys it matches from later leaders;
    a leader it takes stops leading, and its followers are open in the next round.

    The rounds end: standing leaders before the least open key are final, so that key is decided for good, and only
    followers of a leader taken by an open key, that is, later keys, are opened. The least open order rises every round.
    """
    old = decided.select("name_key", F.col("ord").alias("old"), "leader")
    told = keys.select("ord", "name_key").join(old, "name_key", "left")
    gone = decided.filter("ord = leader").select("name_key", F.col("ord").alias("old")).join(keys, "name_key", "left").filter("ord IS NULL OR ord <> old")
    kept = F.when(F.char_length("name_key") < 3, F.col("ord")).when(F.col("old") == F.col("ord"), F.col("leader"))
    state = _without(cut(told.select("ord", "name_key", kept.alias("leader")), "revised"), cut(gone.select(F.col("old").alias("leader")), "gone"))
    is_open = F.col("leader").isNull()
    seen, described = None, None
    while True:
        counted = state.agg(F.count_if(is_open).alias("n"), F.min(F.when(is_open, F.col("ord"))).alias("least"), F.count(F.lit(1)).alias("all")).first()
        if not counted["n"]:
            return state
        if seen is not None and counted["least"] <= seen:
            raise RuntimeError("open keys must move on")  # see above: cannot happen
        seen = counted["least"]
        if described is None:
            described, width = cut(prepared(keys, float(counted["all"]) * counted["n"]), "keys"), signature_width(counted["all"])
        part = lambda condition: described.join(state.filter(condition).select("ord"), "ord", "left_semi")  # noqa: E731, B023
        undecided = cut(part(is_open), "open")
        met = matching_pairs(part(F.col("leader") == F.col("ord")), undecided, width).filter("b < a")
        claims = cut(met.groupBy("a").agg(F.min("b").alias("claim")).withColumnRenamed("a", "ord"), "claims")
        led = cut(key_leaders(undecided.join(claims, "ord", "left_anti").select("ord", "name_key"), first_batch, budget).withColumnRenamed("leader", "led"), "led")
        fresh = cut(described.join(led.filter("ord = led").select("ord"), "ord", "left_semi"), "new-leaders")
        taken = matching_pairs(described.join(led, "ord", "left_anti"), fresh, width).filter("a < b").groupBy("b").agg(F.min("a").alias("new"))
        standing = F.coalesce("leader", "claim", "led")
        changed = state.join(claims, "ord", "left").join(led, "ord", "left").join(taken.withColumnRenamed("b", "ord"), "ord", "left").select(
            "ord", "name_key", F.least("new", standing).alias("leader"), (F.col("leader").eqNullSafe(F.col("ord")) & (F.col("new") < F.col("ord"))).alias("_fell"))
        changed = cut(changed, "revised")
        state = _without(changed.drop("_fell"), changed.filter("_fell").select(F.col("ord").alias("leader")))


def _without(state: DataFrame, leaders: DataFrame) -> DataFrame:
    """`state` in which the followers of the given leaders are open; one leader may hold many of the keys."""
    number = leaders.count()
    if not number:
        return state
    lost = leaders.withColumn("_lost", F.lit(True))
    if number <= BROADCAST_ROWS:
        marked = state.join(F.broadcast(lost), "leader", "left")
    else:
        counts = state.filter("leader IS NOT NULL").groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
        marked = lookup(state, lost, "leader", counts, state.count())
    return cut(marked.select("ord", "name_key", F.when(F.col("_lost").isNull(), F.col("leader")).alias("leader")), "revised")


def with_keys(sightings: DataFrame) -> DataFrame:
    """Adds `domain` and the sorted-token `name_key` of the normalised company name."""
    return sightings.withColumn("domain", host("website")).withColumn(
        "name_key", sorted_tokens(company_key("company_name"))
    )


def domain_heads(narrow: DataFrame) -> DataFrame:
    """(domain, seq, name_key, n): the first sighting of each domain and its number of sightings."""
    return cut(
        narrow.filter("domain <> ''").groupBy("domain").agg(
            F.min(F.struct("seq", "name_key")).alias("head"), F.count(F.lit(1)).alias("n")
        ).select("domain", "head.seq", "head.name_key", "n"),
        "heads",
    )


def tested_names(narrow: DataFrame, heads: DataFrame) -> DataFrame:
    """First order of every name key that reaches the name test, with its rows among heads and bare sightings."""
    return cut(
        heads.select("name_key", "seq", F.lit(1).alias("h"), F.lit(0).alias("b"))
        .unionByName(narrow.filter("domain = ''").select("name_key", "seq", F.lit(0).alias("h"), F.lit(1).alias("b")))
        .filter("name_key <> ''")
        .groupBy("name_key").agg(F.min("seq").alias("ord"), F.sum("h").alias("h"), F.sum("b").alias("b")),
        "names",
    )


def _leaders(keys: DataFrame, first_batch: int, budget: int, decided: DataFrame | None) -> DataFrame:
    names = keys.select("ord", "name_key")
    if decided is None:
        return key_leaders(names, first_batch, budget)
    return revise_leaders(decided, names, first_batch, budget).select("ord", "leader")


def decided_names(sightings: DataFrame, first_batch: int = FIRST_BATCH, budget: int = PAIR_BUDGET, decided: DataFrame | None = None) -> DataFrame:
    """(ord, name_key, leader) of the names of a set of sightings: what a later run with more, fewer or other sightings starts from."""
    narrow = cut(with_keys(sightings).select("seq", "domain", "name_key"), "keyed")
    keys = tested_names(narrow, domain_heads(narrow))
    return keys.select("ord", "name_key").join(_leaders(keys, first_batch, budget, decided), "ord")


def assign_leaders(sightings: DataFrame, first_batch: int = FIRST_BATCH, budget: int = PAIR_BUDGET, decided: DataFrame | None = None) -> DataFrame:
    """Adds `leader`, the `seq` of the sighting that leads the company of each sighting.

    `decided`: names decided by an earlier run (`decided_names`); then only names that a change reaches are decided again.
    """
    keyed = cut(with_keys(sightings), "keyed")  # read many times below: the channels run once
    narrow = keyed.select("seq", "domain", "name_key")
    heads = domain_heads(narrow)
    keys = tested_names(narrow, heads)
    by_ord = _leaders(keys, first_batch, budget, decided)
    by_name = cut(keys.join(by_ord, "ord").select("name_key", "leader", "h", "b"), "by-name")
    sizes = by_name.agg(F.sum("h"), F.sum("b")).first()
    names = by_name.select("name_key", "leader")
    # A head with a blank name leads itself.
    by_domain = lookup(heads, names, "name_key", by_name.select("name_key", F.col("h").alias("n")), sizes[0] or 0).select(
        "domain", F.coalesce("leader", "seq").alias("leader"), "n"
    )
    total = heads.agg(F.sum("n")).first()[0] or 0
    columns = keyed.columns
    with_domain = lookup(
        keyed.filter("domain <> ''"), by_domain.select("domain", "leader"), "domain",
        by_domain.select("domain", "n"), total,
    )
    without = keyed.filter("domain = ''")
    named = lookup(
        without.filter("name_key <> ''"), names, "name_key",
        by_name.select("name_key", F.col("b").alias("n")), sizes[1] or 0,
    )
    nameless = without.filter("name_key = ''").withColumn("leader", F.col("seq"))
    out = [*columns, "leader"]
    return with_domain.select(*out).unionByName(named.select(*out)).unionByName(nameless.select(*out))
