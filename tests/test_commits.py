"""Writers that meet: state versions and run ids; scores of returning rows; responses that cannot be read."""

import datetime as dt
import threading

import pytest
from conftest import make

from leadweave.operators import upsert
from leadweave.schemas import SEARCH_RESPONSE
from leadweave.settings import Settings
from leadweave.sources import responses, tables

DAY, NEXT = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_two_writers_do_not_share_a_version(spark, tmp_path):
    root = str(tmp_path / "state")
    first = upsert.upsert(upsert.empty_state(spark), make(spark, [{"company_name": "Alpha"}]), DAY)[0]
    assert tables.write_state(first, root, 0) == 1
    mine, other = (upsert.upsert(tables.read_state(spark, root), make(spark, [{"company_name": n}]), NEXT)[0] for n in ("Beta", "Gamma"))
    assert tables.write_state(other, root, 1) == 2
    with pytest.raises(tables.VersionConflict):
        tables.write_state(mine, root, 1)
    assert tables.finished_versions(spark, root) == [1, 2]
    assert sorted(r.company_name for r in tables.read_state(spark, root).collect()) == ["Alpha", "Gamma"]
    assert not [p for p in (tmp_path / "state").iterdir() if p.name.startswith("_staged")]


def test_an_upsert_that_was_overtaken_is_done_again(spark, tmp_path, monkeypatch):
    """Another writer commits while the first one works: both companies are in the end, with ids of their own."""
    home = str(tmp_path)
    upsert.stored_upsert(spark, home, make(spark, [{"company_name": "Alpha"}]), DAY, indexed=False)
    real, overtaken = upsert.write_state, []

    def slow_write(rows, root, base):
        if not overtaken:
            overtaken.append(base)
            other = upsert.upsert(tables.read_state(spark, root), make(spark, [{"company_name": "Gamma Works"}]), NEXT)[0]
            real(other, root, base)
        return real(rows, root, base)

    monkeypatch.setattr(upsert, "write_state", slow_write)
    version, counts = upsert.stored_upsert(spark, home, make(spark, [{"company_name": "Beta"}, {"company_name": "Gamma Work"}]), NEXT, indexed=False)
    assert (version, counts) == (3, {"new_count": 1, "updated_count": 1})
    rows = tables.read_state(spark, f"{home}/state").orderBy("id").collect()
    assert [(r.id, r.company_name, r.run_count) for r in rows] == [(1, "Alpha", 1), (2, "Gamma Works", 2), (3, "Beta", 1)]


def test_runs_that_end_at_once_have_ids_of_their_own(spark, tmp_path):
    path, ids = str(tmp_path / "history"), []

    def add():
        for _ in range(3):
            ids.append(tables.append_run(spark, path, raw_count=5))

    threads = [threading.Thread(target=add) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(ids) == list(range(1, 10))
    assert sorted(r.id for r in tables.read_runs(spark, path).collect()) == list(range(1, 10))
    with pytest.raises(tables.VersionConflict):
        tables.append_run(spark, path, id=4)


def test_returning_rows_are_scored_anew_on_request(spark):
    settings = Settings()
    state, _ = upsert.upsert(upsert.empty_state(spark), make(spark, [
        {"company_name": "Alpha", "source_channel": "web_search", "score": 9, "tier": "PARK", "state": "TX"}, {"company_name": "Other", "score": 3}]), DAY)
    batch = make(spark, [{"company_name": "Alpha", "source_channel": "apollo", "contact_email": "a@b.c", "contact_title": "Director of Logistics", "vertical": "food"}])
    plain = {r.company_name: r for r in upsert.upsert(state, batch, NEXT, resolved=True)[0].collect()}
    assert (plain["Alpha"].score, plain["Alpha"].tier, plain["Alpha"].score_breakdown) == (9, "PARK", "")
    again = {r.company_name: r for r in upsert.upsert(state, batch, NEXT, resolved=True, rescore=upsert.Rescore(settings, ["TX"]))[0].collect()}
    assert again["Alpha"].score > 9 and again["Alpha"].score_breakdown.startswith("Signal:15 + Compliance:0 + Geo:15 + Enrich:15 = 45")
    assert again["Other"] == plain["Other"] and again["Alpha"].run_count == 2


def test_each_response_is_read_or_put_aside(spark):
    good = '{"query_seq": 1, "channel": "c", "organic": [{"title": "t", "link": "l"}]}'
    lines = [good, good[:30], "[1]", "", None, "  ", '{"query_seq": "x", "channel": "c"}', '{"channel": "c"}', '{"query_seq": 2, "channel": "c", "more": 1}', "nonsense", "{}"]
    table = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "file int, value string")
    kept, aside = responses.sorted_out(table, SEARCH_RESPONSE, ["query_seq", "channel"])
    assert sorted(r.query_seq for r in kept.collect()) == [1, 2] and kept.columns == SEARCH_RESPONSE.fieldNames()
    assert {r.file: r.reason for r in aside.collect()} == {
        1: "broken", 2: "no object", 3: "blank", 4: "blank", 5: "blank", 6: "wrong type", 7: "lacks a field", 9: "no object", 10: "lacks a field"}
    assert {r.file: r.value for r in aside.collect()}[1] == good[:30]


def test_intermediate_tables_of_a_step_go_with_it(spark, tmp_path, monkeypatch):
    from leadweave import session

    monkeypatch.setattr(session, "work_folder", lambda _: str(tmp_path / "work"))
    left = lambda: sorted(p.name.split("-")[0] for p in (tmp_path / "work").iterdir())
    kept = session.cut(spark.range(3), "kept")
    with session.temporary_tables(spark):
        session.cut(spark.range(3), "outer")
        with session.temporary_tables(spark):
            assert session.cut(spark.range(3), "inner").count() == 3
        assert left() == ["kept", "outer"]
    upsert.stored_upsert(spark, str(tmp_path), make(spark, [{"company_name": "Alpha Foods", "website": "a.com"}]), DAY)
    assert left() == ["kept"] and kept.count() == 3
