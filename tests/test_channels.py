import datetime as dt

import pytest
from conftest import make
from pyspark.sql import functions as F

from leadweave import schemas
from leadweave.operators import contacts, reports, requests, scoring
from leadweave.plans import channels, runs
from leadweave.settings import Settings
from leadweave.sources import responses, tables

S = Settings()
HIT = "seq bigint, channel string, vertical string, keyword string, title string, link string, snippet string, from_index boolean"


def hits(spark, *rows):
    return spark.createDataFrame([(i, "c", "fragrance", "k", t, u, s, f) for i, (t, u, s, f) in enumerate(rows)], HIT)


def test_web_channel(spark):
    out = channels.web_channel(hits(
        spark, ("Acme Fragrance | Leading Manufacturer", "https://acmefragrance.com/about", "Top fragrance maker in TX", False),
        ("YouTube - Fragrance", "https://youtube.com/watch?v=123", "video", False),
        ("Other", "http://www.acmefragrance.com", "again", False))).collect()
    assert [(r.company_name, r.website, r.vertical, r.source_channel, r.notes) for r in out] == [
        ("Acme Fragrance", "acmefragrance.com", "fragrance", "web_search", "Top fragrance maker in TX")]


def test_signal_channel(spark):
    out = channels.signal_channel(hits(
        spark, ("Acme Foods - Walmart Supplier", "https://acmefoods.com", "a Walmart vendor with SQEP and OTIF penalties", False),
        ("8th and Walton Consulting", "https://8thandwalton.com", "We help with SQEP", False),
        ("Random Company", "https://random.com", "No signals here", False))).collect()
    assert [(r.website, r.compliance_signals, r.vertical) for r in out] == [
        ("acmefoods.com", "sqep_mentioned, otif_mentioned, walmart_supplier", "")]


def test_import_channel(spark):
    out = channels.import_channel(hits(
        spark, ("Acme Foods Inc - ImportYeti", "https://importyeti.com/company/acme-foods", "Import data", True),
        ("ACME foods inc - ImportYeti", "https://importyeti.com/x", "again", True), (" - ImportYeti", "https://importyeti.com/y", "", True),
        ("Beta Drug Imports | US Importer", "https://betadrug.com", "importer", False)))
    assert [(r.company_name, r.website, r.import_products) for r in out.orderBy("seq").collect()] == [
        ("Acme Foods Inc", "", "k"), ("Beta Drug Imports", "betadrug.com", "k")]


ORG = '{"query_seq": 1, "vertical": "food", "keyword": "k", "organizations": [%s]}'


def test_organisation_channel(spark):
    orgs = [
        '{"id": "1", "name": "Acme", "primary_domain": "www.acme.com", "phone": "+1 555", "organization_revenue_printed": "$10M-$50M", "keywords": ["a", "b"]}',
        '{"id": "2", "name": "Small", "primary_domain": "small.com", "organization_revenue": 100.9}',
        '{"id": "3", "name": "Abroad", "primary_domain": "abroad.com", "phone": "+44 20"}',
        '{"id": "4", "name": "", "primary_domain": "noname.com", "sanitized_phone": "555"}',
        '{"id": "5", "name": "German", "primary_domain": "firma.de"}', '{"id": "6", "name": "No domain"}',
    ]
    table = responses.organisations(responses.parse_responses(spark.createDataFrame([(ORG % ",".join(orgs),)], "value string"), schemas.ORGANISATION_RESPONSE))
    people = spark.createDataFrame([
        ("1", 0, "Ann", "A", "Plant Manager", "a@x"), ("1", 1, "Bob", "", "Logistics", "b@x"), ("1", 2, "Cy", "C", "Freight", "c@x"),
        ("4", 0, "Di", "D", "Buyer", "d@x")], "org_id string, pos int, first_name string, last_name string, title string, email string")
    out = channels.organisation_channel(table, people, S).orderBy("seq").collect()
    assert [(r.company_name, r.website, r.phone, r.estimated_revenue, r.product_keywords, r.contact_name, r.contact_source) for r in out] == [
        ("Acme", "acme.com", "+1 555", 10_000_000, "a, b", "Bob", "apollo"), ("noname.com", "noname.com", "555", None, "", "", "")]


def test_responses(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"query_seq": 2, "organic_results": [{"title": "T", "link": "L"}]}\n{"query_seq": 1, "organic": [{"snippet": "S"}]}\n{"query_seq": 3}\n')
    raw = responses.read_responses(spark, str(tmp_path), schemas.SEARCH_RESPONSE)
    rows = lambda p=None: [(r.seq, r.title, r.link, r.snippet) for r in responses.search_hits(raw, p).orderBy("seq").collect()]
    assert rows() == [(65536, "", "", "S"), (131072, "T", "L", "")]
    assert rows("serpapi") == [(131072, "T", "L", "")] and rows("serper") == [(65536, "", "", "S")] and rows("other") == []


BOX = "domain string, pattern string, pos bigint, value string, first_name string, last_name string, position string, confidence int"


def test_enrichment(spark):
    rows = make(spark, [
        {"company_name": "a", "website": "a.com"}, {"company_name": "b", "website": "b.com", "contact_email": "x@b.com"},
        {"company_name": "c", "website": "http://www.c.com", "notes": "n"}, {"company_name": "d", "website": "d.com", "contact_source": "apollo"},
        {"company_name": "e", "website": "e.com"}, {"company_name": "f", "website": "cnn.com"}, {"company_name": "g", "website": "a.com"}])
    boxes = spark.createDataFrame([
        ("a.com", None, 0, "m@a", "Max", "M", "Marketing Manager", 95), ("a.com", None, 1, "d@a", "Di", "L", "Director of Logistics", 91),
        ("a.com", None, 2, "o@a", "Op", "", "COO", 99), ("c.com", "{first}", None, "", "", "", "", None)], BOX)
    out = {r.company_name: r for r in contacts.enrich(rows, boxes, 3).collect()}
    assert (out["a"].contact_name, out["a"].contact_source, out["a"].email_confidence) == ("Di L", "hunter", 91)
    assert out["c"].notes == "n\nHunter email pattern: {first}@c.com" and out["d"].contact_source == "apollo"
    assert out["g"].contact_email == ""  # over the quota
    order = sorted(out.values(), key=lambda r: r.seq)
    assert [r.company_name for r in order] == ["a", "c", "e", "g", "b", "d", "f"]


@pytest.mark.parametrize("most", [100_000, 0])
def test_enrichment_deals_no_rows_by_a_missing_host(spark, monkeypatch, most):
    """Rows that are not searched must not meet in one task; both ways of the lookup give the same."""
    monkeypatch.setattr(contacts, "BROADCAST_ROWS", most)
    rows = make(spark, [{"company_name": f"n{i}", "website": f"s{i % 7}.com" if i % 3 else ""} for i in range(60)])
    boxes = spark.createDataFrame([(f"s{i}.com", None, i, f"m@{i}", "Di", "L", "Director of Logistics", 9) for i in range(5)], BOX)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        out = contacts.enrich(rows, boxes, 9)
        assert "SortMergeJoin [_host" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = sorted((r.company_name, r.contact_email) for r in out.collect() if r.contact_email)
    searched = [i for i in range(60) if i % 3][:9]
    assert got == sorted((f"n{i}", f"m@{i % 7}") for i in searched if i % 7 < 5) and out.count() == 60


def test_patterns_of_crowded_domains(spark, monkeypatch):
    """A third of the rows without domain and a third with one domain: the same rows as a plain join, by a broadcast of these keys."""
    from leadweave import session
    monkeypatch.setattr(session, "HOT_PARTS", 10)
    domain = lambda i: [None if i % 2 else "", "hot.com", f"s{i % 40}.com"][i % 3]
    rows = spark.createDataFrame([(i, domain(i), "n" * i) for i in range(240)], "seq bigint, domain string, notes string")
    known = spark.createDataFrame([("hot.com", "f.last"), (None, "x")] + [(f"s{i}.com", None if i % 4 else f"p{i}") for i in range(30)], "domain string, pattern string")
    found = contacts.with_patterns(rows, known)
    want = rows.join(known.filter("pattern IS NOT NULL"), "domain").select("seq", "domain", "notes", "pattern")
    got = sorted(found.select(*want.columns).collect())
    assert got == sorted(want.collect()) and {r.domain for r in got} > {"hot.com"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin [domain" in contacts.with_patterns(rows, known)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("row,score,tier,part", [
    ({"source_channel": "web_search, apollo, sqep", "compliance_signals": "walmart_supplier, sqep_mentioned", "state": "TX", "vertical": "food",
      "contact_email": "a@b", "contact_title": "Director of Logistics"}, 98, "HOT", "Signal:25"),
    ({"source_channel": "web_search,apollo", "state": "TX", "vertical": "pharma", "contact_email": "a@b", "contact_title": "CEO"}, 44, "NURTURE", "x 1.1(pharma)"),
    ({"source_channel": "web_search", "state": "NY"}, 4, "PARK", "x 0.8(unknown) = 4 -> PARK"),
    ({"source_channel": "web_search", "state": "TX", "vertical": "food,pharma"}, 26, "NURTURE", "1.3(food)"),
    ({"source_channel": "web_search", "vertical": "food"}, 6, "PARK", "= 5 x 1.3(food) = 6"),
    ({"contact_title": "Project Coordinator", "contact_email": "a@b", "vertical": ", ,"}, 12, "PARK", "Enrich:15"),
    ({"notes": "Hunter email pattern: x", "contact_name": "A", "vertical": "flavor"}, 5, "PARK", "x 1.0(flavor)"),
])
def test_scores(spark, row, score, tier, part):
    out = scoring.score_companies(make(spark, [{"company_name": "a"} | row]), S, ["TX", "LA", "AR", "OK"]).first()
    assert (out.score, out.tier) == (score, tier) and part in out.score_breakdown


def test_requests(spark):
    kw = requests.vertical_keywords(spark, S)
    assert requests.web_requests(kw, ["TX", "LA"]).count() == 20
    assert requests.import_requests(requests.import_keywords(spark, S)).count() == 10
    assert requests.organisation_requests(kw, 4).count() == 40
    terms = spark.createDataFrame(list(enumerate(S.signal_terms)), "pos int, term string")
    calls = requests.request_counts(kw, terms, requests.import_keywords(spark, S), requests.resolve_states(S))
    assert sum(r.calls for r in calls.collect()) == 52
    first = requests.web_requests(kw, ["TX", "LA"]).orderBy("vpos", "kpos", "spos").first()
    assert first.query == "fragrance manufacturer TX"


def test_states():
    assert requests.resolve_states(S) == ["TX", "LA", "AR", "OK"]
    assert requests.resolve_states(S, "west, south_central")[:2] == ["CA", "WA"]
    assert len(requests.resolve_states(S, nationwide=True)) == 50
    with pytest.raises(ValueError):
        requests.resolve_states(S, "nowhere")
    with pytest.raises(ValueError):
        requests.resolve_states(Settings(default_state_list=None))


def test_full_run_twice(spark, tmp_path):
    web = channels.web_channel(hits(spark, ("Acme Foods - Home", "acmefoods.com", "SQEP in Austin, TX", False), ("Beta Inc", "beta.com", "", False)))
    boxes = spark.createDataFrame([("acmefoods.com", None, 0, "l@acmefoods.com", "Lo", "G", "Logistics", 90)], BOX)
    home = str(tmp_path)
    first = runs.full_run(spark, home, {"web_search": web}, boxes, S, ["TX"], dt.date(2024, 1, 1), {"serpapi_credits": 2}, run_id="1")
    assert (first.raw_count, first.dedup_count, first.new_count, first.updated_count) == (2, 2, 2, 0)
    second = runs.full_run(spark, home, {"web_search": web}, None, S, ["TX"], dt.date(2024, 1, 2), run_id="2")
    assert (second.new_count, second.updated_count, second.version) == (0, 2, 2)
    best = reports.by_score(tables.read_state(spark, f"{home}/state")).first()
    assert (best.company_name, best.state, best.contact_source, best.run_count, best.score) == ("Acme Foods", "TX", "hunter", 2, 54)
    assert [r.new_count for r in tables.read_runs(spark, f"{home}/history").collect()] == [0, 2]
    board = spark.read.parquet(f"{home}/reports/2024-01-02/dashboard")
    assert {(r.key, r.value) for r in board.filter("section = 'Run Summary'").collect()} == {("New", "0"), ("Returning", "2"), ("Total", "2")}


def test_plans(spark):
    """No pair-wise joins and no Python outside the similarity check."""
    from leadweave.operators import fuzzy
    keys = spark.createDataFrame([(1, "abc def"), (2, "abc deg")], "ord bigint, name_key string")
    plan = fuzzy.self_pairs(fuzzy.describe(keys, ["ab"]))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    scored = scoring.score_companies(make(spark, [{"company_name": "a"}]), S, ["TX"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan.replace("PythonRDD", "")
