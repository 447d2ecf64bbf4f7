"""Keyword search from postings against a scan of all rows."""

import datetime as dt
import random

from conftest import make

from leadweave.operators import postings, upsert
from leadweave.operators.postings import BLOCK, PIECE, Postings, asked_grams, gram_code, row_grams

DAY = dt.date(2024, 1, 1)


def test_grams_of_terms():
    assert asked_grams("FOOD tx a") == ["a", "foo", "ood", "tx"]
    assert asked_grams("a%bc_defg É") == ["a", "bc", "def", "efg", "É"] and asked_grams(" %_ ") == []


def test_search_equals_a_scan(spark, tmp_path):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abAB éx,%_\\😀") for _ in range(rng.randrange(n)))
    rows = [{"company_name": f"Name {i} {text(6)}", "city": text(4), "notes": text(40), "product_keywords": text(12)} for i in range(150)]
    rows += [{"company_name": "Long", "notes": "ab" * 10_000 + "needle"}, {"company_name": "x"}]
    state, _ = upsert.upsert(upsert.empty_state(spark), make(spark, rows), DAY, resolved=True)
    old = state.filter("id % 3 <> 0").selectExpr(*[c if c != "notes" else "CASE WHEN id % 4 = 0 THEN 'stale words' ELSE notes END AS notes" for c in state.columns])
    listed = Postings(spark, str(tmp_path / "postings"), buckets=8)
    listed.extend(old, 1)
    listed.extend(state, 2, old)
    seen = 0
    for query in ["a", "AB x", "é", "\\", "needle", "a_b", "b%x é", "%", "stale", "name 1", "éx,"]:
        want = sorted(r.id for r in upsert.search(state, query).collect())
        assert sorted(r.id for r in listed.search(state, query, 2).collect()) == want, query
        seen += 0 < len(want) < 150
    assert seen >= 5
    assert sorted(r.id for r in listed.search(old, "stale", 1).collect()) == sorted(r.id for r in upsert.search(old, "stale").collect()) != []
    assert Postings(spark, str(tmp_path / "none")).candidates("abc", 1) is None


def test_only_changed_rows_are_listed_again(spark, tmp_path):
    state, _ = upsert.upsert(upsert.empty_state(spark), make(spark, [{"company_name": f"Company {c}"} for c in "pqrs"]), DAY, resolved=True)
    listed = Postings(spark, str(tmp_path / "p"), buckets=4)
    listed.extend(state, 1)
    listed.extend(state.selectExpr(*[c if c != "city" else "IF(id = 2, 'Oslo', city) AS city" for c in state.columns]), 2, state)
    again = spark.read.parquet(str(tmp_path / "p" / "version=2")).select("id").distinct().collect()
    assert [r.id for r in again] == [2]


def test_listings_are_fewer_than_pairs_of_row_and_gram(spark, tmp_path):
    """The rows of a block are one listing a gram: what is dealt out and sorted does not follow rows times grams."""
    n = 3 * BLOCK
    state, _ = upsert.upsert(upsert.empty_state(spark), make(spark, [{"company_name": "x", "notes": "some words that all rows hold"}] * n), DAY, resolved=True)
    state = state.coalesce(1)
    listed = Postings(spark, str(tmp_path / "p"), buckets=4)
    listed.extend(state, 1)
    grams = len(row_grams([b"x", b"some words that all rows hold"]))
    assert grams <= spark.read.parquet(str(tmp_path / "p" / "version=1")).count() <= 4 * grams
    assert listed.candidates("WORDS x", 1).count() == n and listed.candidates("wordy", 1).count() == 0


def test_grams_of_rows_equal_plain_ones():
    rng = random.Random(5)
    def plain(texts):
        low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "") for t in texts]
        return sorted({gram_code(t[i : i + n]) for t in low for n in (1, 2, 3) for i in range(len(t) - n + 1)})
    for _ in range(200):
        texts = [rng.choice([None, "", "".join(rng.choice("aAbZzÉéK\0\ufffd😀\U0010ffff ") for _ in range(rng.randrange(12)))]) for _ in range(4)]
        assert row_grams([t if t is None else t.encode() for t in texts]).tolist() == plain(texts)
    long = "ab" * (PIECE // 2) + "xyz" + "c" * PIECE  # runs that reach over the pieces a text is read in
    assert row_grams([long.encode(), b"q"]).tolist() == plain([long, "q"])
    assert row_grams([b"a\xc3\xc3\xa9", b"\xff"]).tolist() == plain(["a", "é"])  # bytes that are no character are in no gram


def test_ids_of_any_kind_are_listed(spark, tmp_path):
    """Ids may be far apart, negative, repeated or null; a null id is never found."""
    state, _ = upsert.upsert(upsert.empty_state(spark), make(spark, [{"company_name": f"Company {i}"} for i in range(6)]), DAY, resolved=True)
    ids = "element_at(array(-9223372036854775808, 9223372036854775807, 7, 7, 0, CAST(NULL AS BIGINT)), CAST(id AS INT))"
    state = state.selectExpr(*[c if c != "id" else f"{ids} AS id" for c in state.columns]).coalesce(1)
    listed = Postings(spark, str(tmp_path / "p"), buckets=4)
    listed.extend(state, 1)
    found = [r.id for r in listed.search(state, "COMPANY", 1).collect()]
    assert sorted(found) == [-(2**63), 0, 7, 7, 2**63 - 1]
    assert [r.id for r in listed.search(state, "company 3", 1).collect()] == [7]


def test_only_listed_rows_are_tested(spark, tmp_path, monkeypatch):
    """Few listed rows are met before the test; with more, the test comes first. Both find the same."""
    state, _ = upsert.upsert(upsert.empty_state(spark), make(spark, [{"company_name": f"Company {i}", "notes": "old"} for i in range(30)]), DAY, resolved=True)
    new = state.selectExpr(*[c if c != "notes" else "IF(id % 7 = 0, 'new words', notes) AS notes" for c in state.columns])
    for sent in (postings.SENT_ROWS, 0):
        monkeypatch.setattr(postings, "SENT_ROWS", sent)
        listed = Postings(spark, str(tmp_path / f"p{sent}"), buckets=4)
        listed.extend(state, 1)
        listed.extend(new, 2, state)
        found = listed.search(new, "NEW y", 2)
        lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert any("Filter" in line and "RLIKE" in line for line in lines) == (sent == 0)
        assert sorted(r.id for r in found.collect()) == [7, 14, 21, 28]
        assert listed.search(new, "old", 2).count() == 26
        again = spark.read.parquet(str(tmp_path / f"p{sent}" / "version=2")).selectExpr("explode(concat(array(id), transform(more, x -> x ^ id))) AS id")
        assert sorted({r.id for r in again.collect()}) == [7, 14, 21, 28]
