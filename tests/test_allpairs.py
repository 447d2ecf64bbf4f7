import random

import numpy as np
import pyarrow as pa
import pytest
from model import alike

from leadweave.operators import allpairs, fuzzy
from leadweave.operators import resolve as R


def names_of(rng, number):
    """Names alike by few edits, longer and shorter than a word of bits, and with letters beyond 16 bits."""
    letters = "abcdeé 0漢𝒳"
    out = []
    for _ in range(number):
        base = [rng.choice(letters) for _ in range(rng.choice([3, 4, 9, 20, 31, 62, 64, 66, 90]))]
        for _ in range(4):
            s = list(base)
            for _ in range(rng.randint(0, 6)):
                s.insert(rng.randint(0, len(s)), rng.choice(letters)) if rng.random() < 0.5 or len(s) < 4 else s.pop(rng.randrange(len(s)))
            out.append("".join(s))
    return [k for k in dict.fromkeys(out) if len(k) >= 3]


def marked(names):
    rows = pa.record_batch({"ord": np.arange(len(names)), "name_key": names, "n": np.array([len(k) for k in names], np.int32)})
    return pa.Table.from_batches(list(allpairs.fingerprints([rows])))


def pairs(xs, ys, names, within):
    rows = [r for batch in allpairs._matches(xs, ys, fuzzy.SLACK, within) for r in batch.to_pylist()]
    assert all(r["sure"] == (r["ka"] is None) and (r["sure"] or r["ka"] in names) for r in rows)
    found = [(r["a"], r["b"]) for r in rows if r["sure"] or alike(r["ka"], r["kb"])]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("seed", [1, 2])
def test_comparison_against_all_pairs(seed, monkeypatch):
    monkeypatch.setattr(allpairs, "CHUNK", 64)
    monkeypatch.setattr(allpairs, "TILE", 16)
    monkeypatch.setattr(allpairs, "TOGETHER", 8)
    names = names_of(random.Random(seed), 50)
    table = marked(names)
    xs = allpairs.Names.read(table)
    want = {(i, j) for i in range(len(names)) for j in range(len(names)) if alike(names[i], names[j])}
    assert pairs(xs, allpairs.Names.read(table, xs), names, True) == {(a, b) for a, b in want if a < b}
    some = allpairs.Names.read(table.slice(20, 60), xs)
    assert pairs(xs, some, names, False) == {(a, b) for a, b in want if 20 <= b < 80}
    none = allpairs.Names.read(table.slice(0, 0))
    assert pairs(none, some, names, False) == set()


def test_sets_of_many_pairs_need_no_signatures(spark, monkeypatch):
    """A hundred million pairs and more are compared in full: no name is described, no signature is made."""
    monkeypatch.setattr(fuzzy, "signatures", None)
    monkeypatch.setattr(fuzzy, "describe", None)
    rng = random.Random(3)
    names = list(dict.fromkeys("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(24)) for _ in range(10_500)))
    names += [k + "x" for k in names[:5]]
    keys = spark.createDataFrame(list(enumerate(names)), "ord bigint, name_key string")
    got = {r.ord: r.leader for r in R.key_leaders(keys).filter("ord <> leader").collect()}
    assert got == {len(names) - 5 + i: i for i in range(5)}


@pytest.mark.parametrize("seed", [1, 2])
def test_few_pairs_are_decided_as_many(spark, monkeypatch, seed):
    rng = random.Random(seed)
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)})
    leaders, want = [], {}
    for i in range(60):
        want[i] = next((j for j in leaders if (j, i) in edges), i)
        if want[i] == i:
            leaders.append(i)
    nodes, rows = spark.createDataFrame([(i,) for i in range(60)], "ord bigint"), spark.createDataFrame(edges, "a bigint, b bigint")
    for few in (R.FEW_EDGES, 0):
        monkeypatch.setattr(R, "FEW_EDGES", few)
        assert {r.ord: r.leader for r in R.greedy_leaders(nodes, rows).collect()} == want
