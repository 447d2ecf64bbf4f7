import datetime as dt
import random

import pytest
from conftest import BLANK, make
from model import upsert as model_upsert
from test_resolve import keyed, random_rows

from leadweave.functions.names import company_key, sorted_tokens
from leadweave.operators import reports, upsert
from leadweave.operators.resolve import with_keys
from leadweave.plans import runs
from leadweave.schemas import STATE_COLUMNS
from leadweave.settings import Settings
from leadweave.sources import tables

DAY, NEXT = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def store(spark, rows, day=DAY):
    return upsert.upsert(upsert.empty_state(spark), make(spark, rows), day)


@pytest.mark.parametrize("seed", [3, 4])
def test_upsert_against_model(spark, seed):
    rng = random.Random(seed)
    first = runs.resolve(make(spark, random_rows(rng, 40)))
    state, _ = upsert.upsert(upsert.empty_state(spark), first, DAY)
    second = runs.resolve(make(spark, random_rows(rng, 40)))
    got, counts = upsert.upsert(state, second, NEXT)
    old = [r.asDict() for r in state.withColumn("name_key", sorted_tokens("normalized_name")).orderBy("id").collect()]
    batch = [r.asDict() for r in with_keys(second).withColumn("normalized_name", company_key("company_name")).orderBy("seq").collect()]
    want, new, updated = model_upsert(old, batch, NEXT)
    assert counts == {"new_count": new, "updated_count": updated}
    got = {r.id: r.asDict() for r in got.collect()}
    assert {i: {c: r[c] for c in STATE_COLUMNS} for i, r in got.items()} == {w["id"]: {c: w[c] for c in STATE_COLUMNS} for w in want}


@pytest.mark.parametrize("seed", [5])
def test_unresolved_upsert_against_model(spark, seed):
    """Repeated domains, alike names and blanks inside one batch: rows see the rows before them."""
    rng = random.Random(seed)
    state = upsert.empty_state(spark)
    for day, size in ((DAY, 30), (NEXT, 50)):
        batch_rows = make(spark, random_rows(rng, size))
        old = [r.asDict() for r in state.withColumn("name_key", sorted_tokens("normalized_name")).orderBy("id").collect()]
        batch = [r.asDict() for r in with_keys(batch_rows).withColumn("normalized_name", company_key("company_name")).orderBy("seq").collect()]
        want, new, updated = model_upsert(old, batch, day)
        state, counts = upsert.upsert(state, batch_rows, day)
        assert counts == {"new_count": new, "updated_count": updated}
        got = {r.id: r.asDict() for r in state.collect()}
        assert {i: {c: r[c] for c in STATE_COLUMNS} for i, r in got.items()} == {w["id"]: {c: w[c] for c in STATE_COLUMNS} for w in want}


def test_rows_of_one_batch_see_each_other(spark):
    state, counts = store(spark, [
        {"company_name": "Acme Foods", "website": "acme.com"}, {"company_name": "Acme Foods Inc", "website": "acme.com"},
        {"company_name": "Blank Lab"}, {"company_name": "Blank Lab", "website": "lab.com"}, {"company_name": "Other", "website": "lab.com"},
        {"company_name": "Blank Lab", "website": "second.com"}, {"company_name": "New One", "website": "second.com"}])
    assert counts == {"new_count": 3, "updated_count": 4}
    assert [(r.normalized_name, r.domain, r.run_count) for r in state.orderBy("id").collect()] == [
        ("acme foods", "acme.com", 2), ("blank lab", "lab.com", 4), ("new one", "second.com", 1)]


def test_report_keeps_its_order_and_line_breaks(spark, tmp_path):
    state, _ = store(spark, [{"company_name": n, "score": s, "notes": 'a, "b"\nc'} for n, s in (("A", 5), ("B", 50), ("C", 20))])
    tables.write_report(state, str(tmp_path / "report"))
    back = tables.read_report(spark, str(tmp_path / "report")).collect()
    assert [(r.company_name, r.notes) for r in back] == [(n, 'a, "b"\nc') for n in "BCA"]


def test_many_channels_keep_numbers_apart(spark):
    from leadweave.operators.contacts import enrich
    from leadweave.plans.channels import all_channels

    parts = {f"own{i}": make(spark, [{"company_name": f"c{i}", "website": "x.com" if i % 2 else ""}]) for i in range(20)}
    boxes = spark.createDataFrame([], "domain string, pattern string, pos long, value string, first_name string, last_name string, position string, confidence int")
    rows = enrich(all_channels(parts), boxes, 5)
    assert rows.count() == rows.select("seq").distinct().count() == 20
    with pytest.raises(ValueError):
        all_channels({f"own{i}": parts["own0"] for i in range(200)})


def test_first_and_second_upsert(spark):
    state, counts = store(spark, [{"company_name": "Acme Inc", "website": "acme.com", "source_channel": "web_search"}])
    assert counts == {"new_count": 1, "updated_count": 0}
    row = state.first()
    assert (row.status, row.run_count, row.tier, row.normalized_name, row.domain) == ("NEW", 1, "PARK", "acme", "acme.com")
    state, changed = upsert.set_status(state, "Acme", "CONTACTED", dt.datetime(2024, 1, 1), "called")
    again = make(spark, [{"company_name": "Acme", "website": "acme.com", "source_channel": "apollo", "contact_email": "a@b.c"}])
    state, counts = upsert.upsert(state, again, NEXT)
    row = state.first()
    assert counts == {"new_count": 0, "updated_count": 1}
    assert (row.run_count, row.source_channel, row.contact_email) == (2, "apollo, web_search", "a@b.c")
    assert (row.status, row.status_notes, row.first_seen, row.last_seen) == ("CONTACTED", "called", DAY, NEXT)


FOUR = [{"company_name": c, "contact_email": e, "email_verified": v, "tier": t, "score": s}
        for c, e, v, t, s in [("A", "a@x", "", "HOT", 90), ("B", "b@x", "", "WARM", 50), ("C", "c@x", "valid", "HOT", 80), ("D", "", "", "HOT", 70)]]


def test_verification_set_and_counts(spark):
    state, counts = store(spark, FOUR)
    assert counts["new_count"] == 4  # one-letter names do not match each other
    assert reports.needs_verification(state, ["HOT", "WARM"]).count() == 2
    assert reports.needs_verification(state, ["HOT"]).count() == 1
    assert {r.tier: r.cnt for r in reports.tier_counts(state).collect()} == {"HOT": 3, "WARM": 1}
    answers = spark.createDataFrame([("a@x", "valid")], "email string, verified string")
    updated, result = runs.verify_emails(state, answers, Settings())
    assert {r.company_name: r.email_verified for r in updated.collect()} == {"A": "valid", "B": "unknown", "C": "valid", "D": ""}
    assert [(r.verified, r.cnt) for r in result.collect()] == [("unknown", 1), ("valid", 1)]


def test_search(spark):
    state, _ = store(spark, [{"company_name": "Acme Fragrance", "state": "TX"}, {"company_name": "Best Foods", "state": "TX"}])
    assert upsert.search(state, "fragrance TX").count() == 1
    assert upsert.search(state, "  ").count() == 2
    assert upsert.search(state, "fr_grance").count() == 1


def test_empty_reports(spark):
    empty = upsert.empty_state(spark)
    assert tuple(reports.score_summary(empty).first()) == (0, None)
    assert reports.run_average(make(spark, [{"company_name": "a"}])).first()[0] == 0.0


def test_snapshots_and_history(spark, tmp_path):
    root = str(tmp_path / "state")
    assert tables.read_state(spark, root).count() == 0
    state, _ = store(spark, FOUR)
    assert tables.write_state(state, root) == 1
    assert tables.write_state(tables.read_state(spark, root).filter("id > 1"), root) == 2
    assert tables.read_state(spark, root).count() == 3 and tables.read_state(spark, root, 1).count() == 4
    (tmp_path / "state" / "version=9").mkdir()  # an unfinished write is not seen
    assert tables.finished_versions(spark, root) == [1, 2]
    history = str(tmp_path / "history")
    for n in (5, 7):
        tables.append_run(spark, history, raw_count=n)
    assert [(r.id, r.raw_count) for r in tables.read_runs(spark, history).collect()] == [(2, 7), (1, 5)]


def test_stages(spark, tmp_path):
    folder = str(tmp_path / "run")
    one, two = make(spark, [{"company_name": "one"}]), make(spark, [{"company_name": "two"}])
    tables.write_stage(two, folder, "apollo", 7)
    tables.write_stage(one, folder, "web_search")
    assert (tmp_path / "run" / "stage=04_apollo").exists()
    assert tables.read_stage(spark, folder, "apollo").first().company_name == "two"
    assert [r.company_name for r in tables.read_all_stages(spark, folder).collect()] == ["one", "two"]


def test_csv_report(spark, tmp_path):
    state, _ = store(spark, FOUR[:1])
    tables.write_report(state, str(tmp_path / "csv"))
    lines = [line for part in sorted((tmp_path / "csv").glob("part-*")) for line in part.read_text().splitlines()]
    assert len(lines) == 2 and lines[0].startswith("id,company_name,")
    tables.write_report(upsert.empty_state(spark), str(tmp_path / "none"))
    assert "".join(p.read_text() for p in (tmp_path / "none").glob("part-*")) == ""
