"""The stored name index against a search over all state names, and upserts that read it."""

import datetime as dt
import random

import pytest
from conftest import make
from test_resolve import near_copies, random_rows

from leadweave.operators import fuzzy, name_index, upsert
from leadweave.operators.name_index import NameIndex
from leadweave.plans import runs
from leadweave.session import cut
from leadweave.sources.tables import finished_versions, read_state

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def state_names(spark, names, start=1):
    return spark.createDataFrame([(start + i, n) for i, n in enumerate(names)], "id long, normalized_name string")


@pytest.mark.parametrize("seed, width, budget, broadcast", [(1, 1, fuzzy.PAIR_BUDGET, 200_000), (2, 2, fuzzy.PAIR_BUDGET, 0), (3, 1, 1, 200_000)])
def test_first_match_over_versions(spark, tmp_path, monkeypatch, seed, width, budget, broadcast):
    """Names added in three versions; equal, similar, short and blank names; crowds that go the chunked way."""
    monkeypatch.setattr(name_index, "BROADCAST_ROWS", broadcast)
    if budget == 1:
        monkeypatch.setattr(fuzzy, "PAIRS_PER_KEY", 0)
    rng = random.Random(seed)
    names = near_copies(rng, ["acme foods north", "delta pharma works", "gamma flavor house", "omega"], 30) + ["ab", "x", "", "abc", "abcd"]
    root, cuts = str(tmp_path / "names"), [0, 50, 80, len(names)]
    index = None
    for version, (a, b) in enumerate(zip(cuts, cuts[1:]), 1):
        part = state_names(spark, names[a:b] + names[:3], 1 + a * 10)
        if index is None:
            index = NameIndex.create(part, root, version, buckets=8, width=width)
        else:
            index.extend(part, version)
    asked = [n for n in near_copies(rng, ["acme foods north", "gamma flavor housed", "zeta"], 12)] + names[::7] + ["ab", "nothing like it"]
    probe = spark.createDataFrame(list(enumerate(dict.fromkeys(n for n in asked if n))), "ord long, name_key string")
    again = NameIndex.open(spark, root)
    for version in (1, 3):
        known = [(1 + a * 10 + i, n) for v, (a, b) in enumerate(zip(cuts, cuts[1:]), 1) if v <= version for i, n in enumerate(names[a:b] + names[:3])]
        keys = name_index._names(spark.createDataFrame(known, "id long, normalized_name string"))
        want = {r["ord"]: r["match"] for r in fuzzy.first_match(probe, keys).collect()}
        assert {r["ord"]: r["match"] for r in again.first_match(probe, version, budget).collect()} == want and want


def test_a_lookup_reads_the_touched_buckets_only(spark, tmp_path):
    rng = random.Random(5)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(14)).strip() for _ in range(400)]
    index = NameIndex.create(state_names(spark, names), str(tmp_path / "names"), 1, buckets=64)
    probe = spark.createDataFrame([(1, names[7][::-1])], "ord long, name_key string")
    touched = index._touched(index.signed(probe))
    plan = index.rows(1, touched)
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert 0 < len(touched) < 40 and "PartitionFilters: [" in scan and "bucket" in scan.split("PartitionFilters: [")[1]
    assert sorted(r["bucket"] for r in plan.select("bucket").distinct().collect()) == sorted(set(touched))
    assert index.first_match(probe.limit(0), 1).count() == 0


def test_stored_upserts_equal_upserts_over_the_whole_state(spark, tmp_path):
    rng = random.Random(8)
    home, state = str(tmp_path), upsert.empty_state(spark)
    for n, day in enumerate(DAYS[:2]):
        batch = cut(runs.resolve(make(spark, random_rows(rng, 40))), "batch")
        state, counts = upsert.upsert(state, batch, day, resolved=True)
        version, stored_counts = upsert.stored_upsert(spark, home, batch, day, resolved=True)
        assert version == n + 1 and stored_counts == counts
        rows = read_state(spark, f"{home}/state")
        assert sorted(map(str, rows.collect())) == sorted(map(str, state.select(*rows.columns).collect()))
        state = cut(rows, "state")
    assert finished_versions(spark, f"{home}/names/rows") == [1, 2]


def test_an_index_left_behind_catches_up(spark, tmp_path):
    home = str(tmp_path)
    upsert.stored_upsert(spark, home, make(spark, [{"company_name": "Alpha Foods"}]), DAYS[0])
    upsert.write_state(upsert.upsert(read_state(spark, f"{home}/state"), make(spark, [{"company_name": "Beta Works"}]), DAYS[1])[0], f"{home}/state")
    _, counts = upsert.stored_upsert(spark, home, make(spark, [{"company_name": "Beta Work"}, {"company_name": "Gamma"}]), DAYS[2], resolved=True)
    assert counts == {"new_count": 1, "updated_count": 1} and finished_versions(spark, f"{home}/names/rows") == [1, 2, 3]
