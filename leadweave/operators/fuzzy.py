"""Similarity join of name keys: exact, without comparing all pairs of a group.

Two keys match when 2*LCS/(n+m) rounds to at least 85 %, that is, when their insert/delete distance
D stays below S*(n+m) with S = 0.155. Everything below follows from that bound.

* Keys are cut into numbered bigrams (gram, nth occurrence). A deletion destroys at most two bigrams
  of its key, an insertion at most one, so two matching keys of lengths n and m share at least
  floor(0.2675*(n+m)) bigrams, and a key of length n shares at least floor(0.4632*n) with any partner.
* All keys order their bigrams by the same rule, rare ones first. If at least w bigrams are shared,
  the first |G| - shared + w bigrams of both keys have w in common (prefix filtering with w-element
  signatures). Signatures are single bigrams for small sets. For large ones they are pairs (w = 2), and single
  bigrams only where a pair is not guaranteed (keys of up to 4 characters) or not needed (keys of 64 and more).
* Signature groups are probed with an equi join. Inside the join condition, lengths and fingerprints
  (128 bits of letters, 256 bits of bigrams) must agree: every bit that differs is a letter or bigram missing on
  one side, so more than D (or 3 D) differing bits rule the pair out; what is left meets the
  built-in bounded `levenshtein`, never above D. Only survivors leave the join; the exact LCS decides.

Sets of up to `FEW_PAIRS` pairs, and larger ones whose signature groups hold more pairs than there are, are compared in full
instead, block by block, with the same cheap tests in front (`allpairs.py`): such a comparison costs a few nanoseconds a pair,
the signatures of a key some hundred microseconds.

Nothing is capped: every bound is implied by the match condition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import alike
from ..session import cut, discard
from .allpairs import FOUND, MARKED, MARKS, Names, comparison, fingerprints

SLACK = 155  # thousandths
# Signature classes by the longer key of a pair: up to SHORT, then pairs of bigrams, then from LONG on.
SHORT, LONG = 4, 64
# Sets of keys up to this size use single-bigram signatures.
SMALL_SET = 30_000
# Bigrams whose frequency orders the prefixes; all others count as rare.
RANKED_BIGRAMS = 500
LETTER_WORDS, BIGRAM_WORDS = 2, 4

# An index side of at most this many signature rows (about 100 bytes each) is broadcast.
BROADCAST_ROWS = 200_000
# Comparisons that one join may cost: in all, or per key of the larger side if that is more.
PAIR_BUDGET = 500_000_000
PAIRS_PER_KEY = 1_000_000
# So few pairs are all compared at once; beyond that, the pairs in signature groups are counted first.
FEW_PAIRS = 300_000_000_000
# Keys of the index side (about 200 bytes each) that one block of such a comparison sends to all tasks.
BLOCK_ROWS = 200_000
# Matching pairs of a join, estimated from so many keys of the probe side: in all, or per key. Crowds of alike keys exceed this.
SAMPLE_KEYS = 500
SURVIVOR_BUDGET = 5_000_000
SURVIVORS_PER_KEY = 200
# Comparisons and rows of one signature group that one task may get; larger groups are split.
TASK_PAIRS = 1_000_000_000
TASK_ROWS = 2_000_000
# A split table of at most this many signatures (16 bytes each) is broadcast.
BROADCAST_SPLITS = 1_000_000


def _fingerprint(items: str, words: int, name: str) -> dict[str, Column]:
    """Set of hashed items as `words` 64-bit columns."""
    one = F.lit(1).cast("bigint")
    out = {}
    for w in range(words):
        bit = lambda h: F.call_function("shiftleft", one, F.pmod(h, F.lit(64)).cast("int"))
        mine = lambda h, w=w: F.pmod(F.floor(h / 64), F.lit(words)) == w
        out[f"{name}{w}"] = F.aggregate(
            items, F.lit(0).cast("bigint"), lambda acc, h: F.when(mine(h), acc.bitwiseOR(bit(h))).otherwise(acc)
        )
    return out


FINGERPRINTS = [f"l{w}" for w in range(LETTER_WORDS)] + [f"b{w}" for w in range(BIGRAM_WORDS)]


def _numbered(ordered: str) -> Column:
    """Items of a sorted array column, each followed by its occurrence number."""
    first = lambda g: F.array_position(ordered, g)
    return F.transform(ordered, lambda g, i: F.concat(g, F.lit("\u0001"), (i - first(g) + 2).cast("string")))


def _bigrams(key: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(key) - 1), lambda i: F.substr(key, i, F.lit(2)))


def bigram_order(keys: DataFrame) -> list[str]:
    """The RANKED_BIGRAMS most frequent bigrams, rarest first. Any order keeps the join exact."""
    counts = keys.filter("char_length(name_key) >= 3").select(F.explode(_bigrams(F.col("name_key"))).alias("g"))
    top = counts.groupBy("g").count().orderBy(F.col("count").desc(), "g").limit(RANKED_BIGRAMS).collect()
    return [r["g"] for r in reversed(top)]


def describe(keys: DataFrame, order: list[str]) -> DataFrame:
    """Adds to (ord, name_key) its length, fingerprints and bigrams in common order.

    Keys of fewer than three characters match no other key and are left out. Arrays that lambdas refer
    to are columns of their own, or they would be built anew for every element.
    """
    ranked = F.split(F.lit("\u0002".join(order)), "\u0002")  # folds into one constant
    rank = lambda g: F.array_position(ranked, F.substr(g, F.lit(1), F.lit(2)))
    hashed = lambda c: F.transform(c, lambda x: F.pmod(F.xxhash64(x), F.lit(1 << 40)))
    return (
        keys.withColumn("n", F.char_length("name_key"))
        .filter("n >= 3")
        .withColumns({
            "_pairs": F.sort_array(_bigrams(F.col("name_key"))),
            "_chars": F.sort_array(F.split("name_key", "")),
        })
        .withColumns({"_grams": _numbered("_pairs"), "_letters": _numbered("_chars")})
        .withColumns({
            "_ranked": F.sort_array(F.transform("_grams", lambda g: F.struct(rank(g).alias("r"), g.alias("g")))),
            "_lh": hashed("_letters"),
            "_bh": hashed("_grams"),
        })
        .withColumns(_fingerprint("_lh", LETTER_WORDS, "l") | _fingerprint("_bh", BIGRAM_WORDS, "b"))
        .select("ord", "name_key", "n", *FINGERPRINTS, F.transform("_ranked", lambda x: x["g"]).alias("grams"))
    )


def prepared(keys: DataFrame, pairs: float, others: DataFrame | None = None) -> DataFrame:
    """Keys (ord, name_key) of three characters and more, as the joins below take them: with their fingerprints, or described where
    so many pairs are at stake that signatures may be compared. Bigrams are ordered by how frequent they are in `others`."""
    if pairs > FEW_PAIRS:
        return describe(_spread(keys, "ord"), bigram_order(keys if others is None else others))
    return _marked(_spread(keys.select("ord", "name_key", F.char_length("name_key").alias("n")).filter("n >= 3"), "ord"))


def _both_described(probe: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with their bigrams in one order."""
    if "grams" in probe.columns and "grams" in index.columns:
        return probe, index
    order = bigram_order(index)
    side = lambda rows: cut(describe(_spread(rows.select("ord", "name_key"), "ord"), order), "described")
    return side(probe), side(index)


def signature_width(size: int) -> int:
    return 1 if size <= SMALL_SET else 2


def signatures(described: DataFrame, width: int = 1) -> DataFrame:
    """One row per key and signature: (sig, ord, name_key, n, fingerprints)."""
    n, size = F.col("n"), F.size("grams")
    # Shared bigrams with any partner: more than 0.4632 n - 1.
    spare = size - F.floor(n * 0.4632).cast("int")
    kept = ["ord", "name_key", "n", *FINGERPRINTS]
    single = lambda c: F.transform("_single", lambda g: F.xxhash64(F.lit(c), g))
    heads = described.withColumn("_single", F.slice("grams", 1, F.least(size, spare + 1)))
    if width == 1:
        return heads.select(F.explode(single(0)).alias("sig"), *kept)
    reach = (1000 + SLACK) / (1000 - SLACK)  # a partner is at most this much longer
    heads = heads.withColumns({
        "_head": F.slice("grams", 1, F.least(size, spare + 2)),
        "_middle": (n * reach > SHORT) & (n < LONG),
    })
    hashed = lambda i: F.transform(
        F.slice("_head", i + 1, F.size("_head")), lambda g: F.xxhash64(F.lit(2), F.element_at("_head", i), g)
    )
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.size("_head") - 1), hashed))
    none = F.array().cast("array<bigint>")
    every = F.concat(
        F.when(n <= SHORT, single(1)).otherwise(none),
        F.when(F.col("_middle"), pairs).otherwise(none),
        F.when(n * reach >= LONG, single(3)).otherwise(none),
    )
    return heads.select(F.explode(every).alias("sig"), *kept)


def _agree(a: str, b: str) -> Column:
    """Lengths and fingerprints allow a match."""
    limit = f"{SLACK} * ({a}.n + {b}.n)"
    bits = lambda name, words: " + ".join(f"bit_count({a}.{name}{w} ^ {b}.{name}{w})" for w in range(words))
    return F.expr(
        f"1000 * abs({a}.n - {b}.n) < {limit}"
        f" AND 1000 * ({bits('l', LETTER_WORDS)}) < {limit}"
        f" AND 1000 * ({bits('b', BIGRAM_WORDS)}) < 3 * {limit}"
    )


def _limit(a: str, b: str) -> str:
    return f"cast({SLACK} * ({a}.n + {b}.n) div 1000 as int)"


def _plausible(a: str, b: str) -> Column:
    return _agree(a, b) & F.expr(f"levenshtein({a}.name_key, {b}.name_key, {_limit(a, b)}) >= 0")


def _verified(joined: DataFrame) -> DataFrame:
    """Pairs (a, b) of the join of index side `x` and probe side `y` whose keys really match."""
    near = joined.select(
        F.col("x.ord").alias("a"), F.col("y.ord").alias("b"),
        F.col("x.name_key").alias("ka"), F.col("y.name_key").alias("kb"),
    ).dropDuplicates(["a", "b"])
    return near.filter(alike("ka", "kb")).select("a", "b")


def _spread(rows: DataFrame, *by: str) -> DataFrame:
    """Hash partitions that stay as they are: these joins compute far more than they read, so small
    partitions must not be merged by size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _split_groups(ps: DataFrame, xs: DataFrame) -> DataFrame:
    """(sig, parts) of the signature groups too large for one task."""
    p = ps.groupBy("sig").agg(F.count(F.lit(1)).alias("p"))
    x = xs.groupBy("sig").agg(F.count(F.lit(1)).alias("x"))
    work = F.greatest(
        F.ceil(F.col("p").cast("double") * F.col("x") / TASK_PAIRS), F.ceil(F.col("p").cast("double") / TASK_ROWS)
    )
    parts = F.least(work, F.col("p").cast("bigint")).cast("int")
    return p.join(x, "sig").select("sig", parts.alias("parts")).filter("parts > 1")


def _shuffled(ps: DataFrame, xs: DataFrame, condition: Column) -> DataFrame:
    """Join of probe signatures `y` and index signatures `x` by shuffle.

    Large groups are split: their probe rows go to several tasks, their index rows to each of these.
    """
    split = cut(_split_groups(ps, xs), "split")
    size = split.count()
    if size == 0:
        return _spread(ps, "sig").alias("y").join(_spread(xs, "sig").alias("x"), F.expr("x.sig = y.sig") & condition)
    if size <= BROADCAST_SPLITS:
        split = F.broadcast(split)
    parts = F.coalesce("parts", F.lit(1))
    ps = ps.join(split, "sig", "left").withColumn("salt", F.pmod(F.xxhash64("ord"), parts).cast("int")).drop("parts")
    xs = xs.join(split, "sig", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    ps, xs = _spread(ps, "sig", "salt"), _spread(xs, "sig", "salt")
    return ps.alias("y").join(xs.alias("x"), F.expr("x.sig = y.sig AND x.salt = y.salt") & condition)


def self_pairs(described: DataFrame, width: int = 1, small: bool = True) -> DataFrame:
    """Matching pairs within one set of keys: later `b`, earlier `a`."""
    sig = signatures(described, width)
    condition = F.expr("x.ord < y.ord") & _plausible("x", "y")
    if small:  # no group can be too large
        sig = _spread(sig, "sig")
        return _verified(sig.alias("x").join(sig.alias("y"), F.expr("x.sig = y.sig") & condition))
    return _verified(_shuffled(sig, sig, condition))


def _group_pairs(ps: DataFrame, xs: DataFrame) -> float:
    """Comparisons inside the groups of two signature sets."""
    p = ps.groupBy("sig").agg(F.count(F.lit(1)).alias("p"))
    x = xs.groupBy("sig").agg(F.count(F.lit(1)).alias("x"))
    return p.join(x, "sig").agg(F.sum(F.col("p").cast("double") * F.col("x")).alias("pairs")).first()["pairs"] or 0.0


def _sampled(probe: DataFrame, number: int) -> tuple[DataFrame, int]:
    """About SAMPLE_KEYS of `number` keys, and the number of keys that each stands for."""
    each = max(1, number // SAMPLE_KEYS)
    return probe.filter(F.pmod(F.xxhash64("ord"), F.lit(each)) == 0), each


def _few_matches(pairs: int, keys: int, budget: int) -> bool:
    return pairs <= max(min(budget, SURVIVOR_BUDGET), SURVIVORS_PER_KEY * keys)


def _few_comparisons(probes: int, keys: int, budget: int) -> bool:
    return probes * keys <= max(budget, PAIRS_PER_KEY * max(probes, keys))


def affordable(probe: DataFrame, index: DataFrame, keys: int, budget: int, within: bool = False) -> bool:
    """Whether joining two sets of keys stays within the budgets; `keys` is the size of the index side. `within`: both are one set.

    Dividing the index does not save comparisons; it helps where crowds of alike keys would be paired. How many pairs match is
    therefore estimated: a sample of the probe side meets the whole index side.
    """
    probes = probe.count()
    if not _few_comparisons(probes, keys, budget):
        return False
    some, each = _sampled(probe, probes)
    met = _compared(_marked(some), _spread(_marked(index), "ord"))
    return _few_matches((met.filter("b < a") if within else met).count() * each, keys, budget)


def self_affordable(described: DataFrame, keys: int, budget: int) -> bool:
    return affordable(described, described, keys, budget, within=True)


def _few(probe: DataFrame, index: DataFrame) -> bool:
    return float(probe.count()) * index.count() <= FEW_PAIRS


def plainly(probe: DataFrame, index: DataFrame, width: int) -> bool:
    """Whether comparing all pairs of described keys costs no more than the signature groups of both sides would."""
    every = float(probe.count()) * index.count()
    return every <= FEW_PAIRS or every <= _group_pairs(signatures(probe, width), signatures(index, width))


def _marked(rows: DataFrame) -> DataFrame:
    """Keys with the fingerprints of a comparison of all pairs."""
    if MARKS[0] in rows.columns:
        return rows.select("ord", "name_key", "n", *MARKS)
    return rows.select("ord", "name_key", "n").mapInArrow(fingerprints, MARKED)


def _compared(index: DataFrame, probe: DataFrame, within: bool = False) -> DataFrame:
    """Matching pairs of two sets of keys with fingerprints; the index side `a` is sent to all tasks, the probe side `b` stays dealt."""
    shared = index.sparkSession.sparkContext.broadcast(Names.read(index.toArrow()))
    found = probe.mapInArrow(comparison(shared, SLACK, within), FOUND)
    return found.filter(F.col("sure") | alike("ka", "kb")).select("a", "b")


def plain_pairs(probe: DataFrame, index: DataFrame, within: bool = False, block_rows: int | None = None) -> DataFrame:
    """Matching pairs by comparing all: index side `a`, probe side `b`. `within`: both are one set, `a` is the earlier key.

    The probe side stays dealt to all tasks, by length, so that a task meets few lengths. The index side is sent to them in
    blocks, one after the other, so memory follows the block, not the table.
    """
    xs = cut(_marked(index), "plain")
    ys = xs if within else _marked(probe)
    ys = ys.repartitionByRange(int(ys.sparkSession.conf.get("spark.sql.shuffle.partitions")), "n", "ord")
    blocks = max(1, -(-xs.count() // (block_rows or BLOCK_ROWS)))
    if blocks == 1:
        return _compared(xs, ys, within)
    parts = [cut(_compared(xs.filter(F.pmod(F.xxhash64("ord"), F.lit(blocks)) == i), ys, within), "block") for i in range(blocks)]
    return reduce(DataFrame.unionByName, parts)


def matching_pairs(probe: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """Matching pairs between two sets of prepared keys, the cheaper way: index side `a`, probe side `b`."""
    if _few(probe, index):
        return plain_pairs(probe, index)
    probe, index = _both_described(probe, index)
    return plain_pairs(probe, index) if plainly(probe, index, width) else probe_pairs(probe, index, width)


def matching_self(keys: DataFrame, width: int, small: bool) -> DataFrame:
    """Matching pairs within one set of prepared keys, the cheaper way: later `b`, earlier `a`."""
    if _few(keys, keys):
        return plain_pairs(keys, keys, within=True)
    keys, _ = _both_described(keys, keys)
    return plain_pairs(keys, keys, within=True) if plainly(keys, keys, width) else self_pairs(keys, width, small)


def probe_pairs(probe: DataFrame, index: DataFrame, width: int = 1, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Matching pairs between two sets of keys: index side `a`, probe side `b`.

    A counted, small index side is broadcast, so the probe side keeps its partitions and hot signatures stay
    spread over them. A larger one is joined by shuffle with large groups split.
    """
    xs = signatures(index, width)
    if xs.count() <= broadcast_rows:
        ps = signatures(_spread(probe, "ord"), width)
        return _verified(ps.alias("y").join(F.broadcast(xs).alias("x"), F.expr("x.sig = y.sig") & _plausible("x", "y")))
    return _verified(_shuffled(signatures(probe, width), xs, _plausible("x", "y")))


def nth_order(df: DataFrame, share: float) -> int:
    """Value of `ord` below which about `share` of the rows lie."""
    return df.agg(F.percentile_approx("ord", share, 10000)).first()[0]


def first_match(
    probe: DataFrame, index: DataFrame, budget: int = PAIR_BUDGET, first_chunk: int = 200_000
) -> DataFrame:
    """For every probe key the matching index key of lowest order: (ord, match).

    Both inputs hold distinct keys as (ord, name_key). The index is probed in order, in growing
    chunks; a matched probe key leaves at once, so a crowd of alike keys is never paired with each of
    its look-alikes. A chunk that would match too often, or cost more than `budget`, is divided first.
    """
    # Equal keys need no similarity join.
    same = probe.alias("p").join(index.alias("i"), "name_key").select(F.col("p.ord").alias("ord"), F.col("i.ord").alias("equal"))
    pairs = float(probe.count()) * index.count()
    rest, todo = cut(prepared(probe, pairs, index), "probe"), cut(prepared(index, pairs, index), "index")
    left = todo.count()
    width = signature_width(max(left, rest.count()))
    found, chunk = [], first_chunk
    while left:
        part, later, size = _next_chunk(todo, left, chunk, lambda d, n: affordable(rest, d, n, budget))
        pairs = cut(matching_pairs(rest, part, width).groupBy("b").agg(F.min("a").alias("match")), "match")
        found.append(pairs)
        left -= size
        if left:
            before = rest
            rest = cut(rest.join(pairs, F.col("ord") == F.col("b"), "left_anti"), "probe")
            discard(before)
            if rest.isEmpty():
                break
            todo = later
            chunk *= 4
    # An equal key competes with the similar keys; the lowest order wins.
    both = same.select("ord", F.col("equal").alias("match"))
    for pairs in found:
        both = both.unionByName(pairs.select(F.col("b").alias("ord"), "match"))
    return both.groupBy("ord").agg(F.min("match").alias("match"))


def _next_chunk(todo: DataFrame, left: int, chunk: int, affordable, free: int = 1_000):
    """Leading part of `todo` by order, the rest, and the size of the part.

    The part holds about `chunk` rows, divided until `affordable(part, size)` agrees; parts of up to `free`
    rows are taken as they are.
    """
    want = min(chunk, left)
    while True:
        if want < left:
            edge = nth_order(todo, want / left)
            part, later = todo.filter(F.col("ord") <= edge), todo.filter(F.col("ord") > edge)
            size = part.count()
        else:
            part, later, size = todo, todo.filter(F.lit(False)), left
        if size <= free or want <= 1 or affordable(part, size):
            return part, later, size
        want = max(1, min(want, size) // 3)
