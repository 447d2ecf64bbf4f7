"""Mixing sources to target weights as a subset-sum fit over document lengths.

Sources get targets by weight (no source more than `most` times its size, the excess reshared). Each source takes all
its documents as often as its target holds them whole; the rest of the target is fitted from single documents: the
documents are counted by exact length, every length gives its share rounded down, single lengths follow in a seeded
order while far from the budget, and a bounded-knapsack table over what remains picks how many more of each length to
take. If the sum misses the budget, documents taken so far are given back, as many as a larger table allows (64 MB over
all its steps), and chosen anew. The choice is the best there is when the whole budget fits that table; beyond that, what is
missing is less than the length of any document that is not taken. Which documents of a length are taken follows a
seeded hash of the row.

Only lengths with their counts meet in one task per source. The n-th hash of a length is found by counting ranges of
hashes first, so no length, however common, is sorted whole. The sum may lie above the budget where that is nearer.

Defined cases: null and empty texts have size 0 and take nothing; a very long text is one document of its length, read whole; a null source is a source of its own, the last one;
null ids are mixed like others; repeated rows count one by one and ties of the hash are cut by number; an empty table
gives an empty result; columns of `docs` named like the new ones are replaced by them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadweave.session import cut

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, 7
TABLE_WORDS = 1 << 16
# A choice that misses its budget is made anew with documents given back, in tables of so many bits in all (64 MB).
WIDE_BITS = 1 << 29
FEW_LENGTHS = 24
BROADCAST_ROWS = 100_000


def size_of(text: Column) -> Column:
    """Number of runs of characters that are not white space."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def pick_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED, table: int = TABLE_WORDS) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to `budget` from below."""
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    rest = budget - int((lengths * taken).sum())
    order = np.random.default_rng(seed).permutation(len(lengths))
    for i in order:  # at most one more of each length, until the table can hold the rest
        if rest <= table:
            break
        if taken[i] < counts[i] and lengths[i] <= rest:
            taken[i] += 1
            rest -= int(lengths[i])
    while rest > table:  # lengths so uneven that one of each did not do
        moved = False
        for i in sorted(order, key=lambda i: -lengths[i]):
            more = min(int(counts[i] - taken[i]), rest // int(lengths[i])) if lengths[i] else 0
            taken[i] += more
            rest -= more * int(lengths[i])
            moved |= more > 0
        if not moved:
            return _refill(lengths, counts, taken, rest, order)
    taken, rest = _fill(lengths, counts, taken, rest, order)
    return taken if not rest else _refill(lengths, counts, taken, rest, order)


def nearest_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to `budget`, from below if both sides are as near.

    What comes nearest from above leaves out what comes nearest from below to the words that the budget leaves.
    """
    below = pick_lengths(lengths, counts, budget, seed)
    missing, total = budget - int((lengths * below).sum()), int((lengths * counts).sum())
    if missing <= 0 or budget >= total:
        return below
    above = counts - pick_lengths(lengths, counts, total - budget, seed)
    return above if int((lengths * above).sum()) - budget < missing else below


def _fill(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, rest: int, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Bounded knapsack over what is not taken: the words nearest to `rest` from below, and what is missing then."""
    taken = taken.copy()
    # bit b of `reach` says that b words can be made; counts are split into powers of two
    reach, steps, limit = 1, [], (1 << (rest + 1)) - 1
    for i in order:
        left, size, part = int(counts[i] - taken[i]), int(lengths[i]), 1
        while size and left and size <= rest and not reach >> rest & 1:
            part_now = min(part, left)
            steps.append((i, part_now, reach))
            reach |= reach << part_now * size & limit if part_now * size <= rest else 0
            left, part = left - part_now, part * 2
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    missing = rest - at
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += part
            at -= part * int(lengths[i])
    return taken, missing


def _refill(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, rest: int, order: np.ndarray) -> np.ndarray:
    """A better choice than `taken`, of which `rest` words are missing: documents go back as far as a table of WIDE_BITS allows."""
    for pool in (order, order[:FEW_LENGTHS]):  # few lengths leave a larger table
        steps = sum(int(counts[i]).bit_length() for i in pool)
        room, back = WIDE_BITS // max(steps, 1) - rest, taken.copy()
        for most in (1, None):  # one of each length, then all that fits
            for i in pool:
                n = min(int(back[i]), room // int(lengths[i])) if lengths[i] and room > 0 else 0
                n = n if most is None else min(n, most)
                back[i] -= n
                room -= n * int(lengths[i])
        wide = rest + int((lengths * (taken - back)).sum())
        better, missing = _fill(lengths, counts, back, wide, pool)
        if missing < rest:
            taken, rest = better, missing
        if not rest:
            break
    return taken


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(src, source_size, target) of the table of sources (src, source_size); this small table alone is ordered in one task.

    Sources are capped in the order of cap over weight: one is capped while its even share of what is left reaches its cap.
    """
    by_name = Window.orderBy(F.col("src") == "", "src")  # "": the null source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    before = Window.orderBy(F.col("cap") / F.col("w"), "src").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0.0)
    rows = (rows.withColumn("budget", F.sum("source_size").over(whole) * F.lit(share)).withColumn("all_w", F.sum("w").over(whole))
            .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), zero))
            .withColumn("left_w", F.col("all_w") - F.coalesce(F.sum("w").over(before), zero))
            .withColumn("capped", F.col("cap") * F.col("left_w") <= F.col("left") * F.col("w")))
    rows = (rows.withColumn("left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), zero))
            .withColumn("left_w", F.sum(F.when(~F.col("capped"), F.col("w"))).over(whole)))
    return rows.select("src", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("left") * F.col("w") / F.col("left_w")).alias("target"))


def _plan(rows: DataFrame, weights, share, most, seed) -> DataFrame:
    """(src, size, c, source_size, target, base, n): every document `base` times and `n` of the length once more."""
    lengths = rows.groupBy("src", "size").agg(F.count(F.lit(1)).alias("c"))
    sources = lengths.groupBy("src").agg(F.sum(F.col("size") * F.col("c")).alias("source_size"))
    goals = targets(sources, weights, share, most)
    goals = goals.withColumn("base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("bigint"))
    goals = goals.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("base") * F.col("source_size")))

    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by("size")
        budget = int(np.rint(table["rest"][0].as_py()))
        n = nearest_lengths(np.asarray(table["size"]), np.asarray(table["c"]), budget, seed)
        return table.drop_columns(["rest"]).append_column("n", pa.array(n))

    joined = lengths.join(F.broadcast(goals) if sources.count() <= BROADCAST_ROWS else goals, "src")
    schema = "src string, size long, c long, source_size long, target double, base long, n long"
    return cut(joined.select("src", "size", "c", "source_size", "target", "base", "rest").groupBy("src").applyInArrow(choose, schema), "mix-plan")


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(src, size, h_cut, ties) for lengths taken in part: rows below h_cut are taken, and `ties` of those at it."""
    part = plan.filter("n > 0 AND n < c").select("src", "size", "n", F.ceil(F.sqrt("c")).cast("bigint").alias("ranges"))
    share = (F.shiftrightunsigned("h", 11) / F.lit(2.0**53)) * F.col("ranges")
    ranged = rows.select("src", "size", "h").join(part, ["src", "size"]).withColumn("range", F.floor(share)).drop("ranges")
    counts = ranged.groupBy("src", "size", "n", "range").agg(F.count(F.lit(1)).alias("k"))
    upto = F.sum("k").over(Window.partitionBy("src", "size").orderBy("range"))
    at = counts.withColumn("upto", upto).filter("upto >= n AND upto - k < n").select("src", "size", "range", (F.col("n") - F.col("upto") + F.col("k")).alias("nth"))
    inside = ranged.select("src", "size", "range", "h").join(at, ["src", "size", "range"])
    order = Window.partitionBy("src", "size", "range").orderBy(F.shiftrightunsigned("h", 1), "h")
    numbered = inside.repartition("src", "size", "range").withColumn("row", F.row_number().over(order)).withColumn("rank", F.rank().over(order))
    return numbered.filter("row = nth").select("src", "size", F.col("h").alias("h_cut"), (F.col("nth") - F.col("rank") + 1).alias("ties"))


def mix(docs: DataFrame, carry: list[str], weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Columns `carry` of every document with size, source_size, target and taken (words the mix takes of it)."""
    source = F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit(""))
    base = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(carry)], source.alias("src"), size_of(docs["text"]).alias("size"),
                       F.xxhash64(F.lit(seed), docs["doc_id"], F.xxhash64(docs["text"])).alias("h"))
    rows = cut(base.select("src", "size", "h"), "mix-rows")
    plan = _plan(rows, weights, share, most, seed)
    whole = cut(plan.join(_cuts(rows, plan), ["src", "size"], "left"), "mix-cuts")
    known = base.join(F.broadcast(whole) if whole.count() <= BROADCAST_ROWS else whole, ["src", "size"])
    tie = (F.col("h") == F.col("h_cut")) & (F.col("ties") > 0)
    below = F.struct(F.shiftrightunsigned("h", 1), F.col("h")) < F.struct(F.shiftrightunsigned("h_cut", 1), F.col("h_cut"))
    more = F.when(F.col("n") >= F.col("c"), 1).when(F.col("n") == 0, 0).when(below, 1).otherwise(0)
    lone = known.filter(~F.coalesce(tie, F.lit(False))).withColumn("more", more)
    nth = F.row_number().over(Window.partitionBy("src", "size", "h").orderBy(F.lit(0)))
    tied = known.filter(F.coalesce(tie, F.lit(False))).withColumn("more", (nth <= F.col("ties")).cast("int"))
    taken = (F.col("size") * (F.col("base") + F.col("more"))).cast("bigint")
    made = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": taken}
    return lone.unionByName(tied).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry) if c not in made], *[v.alias(k) for k, v in made.items()])


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents that the mix takes, with all their columns and how often it takes each (`copies`)."""
    plain = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "copies")]
    return mix(docs, plain, **settings).filter("taken > 0").withColumn("copies", (F.col("taken") / F.col("size")).cast("int"))
