"""Pages, urls, vectors, mixing, tool calls and the pipeline against plain versions."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadweave.llm import mixing, toolcalls, urls, vectors
from leadweave.llm.html import extract, main_text, minimum_cut

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_sums_above_the_budget_count_where_they_are_nearer():
    assert mixing.nearest_lengths(np.array([100]), np.array([1]), 90).tolist() == [1]
    assert mixing.nearest_lengths(np.array([100]), np.array([3]), 190).tolist() == [2] and mixing.nearest_lengths(np.array([100]), np.array([3]), 150).tolist() == [1]
    rng = np.random.default_rng(3)
    for _ in range(200):
        lengths = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 6), replace=False))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        sums = {int(sum(n * x for n, x in zip(take, lengths))) for take in itertools.product(*[range(c + 1) for c in counts])}
        got = mixing.nearest_lengths(lengths, counts, budget)
        assert (got <= counts).all() and abs(int((lengths * got).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_minimum_cut_equals_enumeration():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randrange(1, 8)
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(label):
            return sum(abs(o) for o, on in zip(odds, label) if (o > 0) != on) + sum(w for a, b, w in edges if label[a] != label[b])

        best = min(cost(label) for label in itertools.product([False, True], repeat=n))
        assert math.isclose(cost(minimum_cut(odds, edges)), best, abs_tol=1e-9)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{a:b}</style></head><body class="main">
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for everyone. Do you agree with it?</p></div>
<article><h1>A &lt;title&gt;</h1><p>First   paragraph, with <b>bold</b>&nbsp;text &amp; more.
<div class="advert">Buy this wonderful product now, it is good for you and your family.</div>
<p>Second<br>line.</p><script>var x = "</p><p>no";</script><ul><li>One item<li>Two</ul><!-- <p>gone</p> -->
<table><tr><td>Cell one<td>Cell two</table></article>
<aside><p>Also read this long text about other things, which is not part of it.</p></aside>
<section id="comments"><p>I do not agree with this article at all. It is not good.</p></section>
<form><label>Your name</label><button>Send it</button></form><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    text, kept, blocks = main_text(PAGE)
    assert text == "A <title>\nFirst paragraph, with bold text & more.\nSecond line.\nOne item\nTwo\nCell one\nCell two"
    assert kept == 7 and blocks > kept


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<!--", "<script>", "</p></div>", "<nav>menu</nav>", "\x00<a b='>"])
def test_odd_pages_do_not_fail(html):
    assert isinstance(main_text(html)[0], str)


def test_extract_keeps_every_row(spark):
    deep = "<div>" * 3000 + "<p>Deep text that is long enough to be seen as content, surely.</p>"
    rows = [(1, None, None, 0), (1, "u", "", 0), (None, "u", "<article><p>Text.</p></article>", 0), (4, "u", deep, 0), (4, "u", deep, 0)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).orderBy("n_chars").collect()
    assert [r["n_chars"] for r in got] == [0, 0, 5, 60, 60] and got[2]["text"] == "Text."
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("on_driver, shard_keys", [(0, 150), (50_000, 2_000_000)])
def test_cascade_is_exact(spark, monkeypatch, on_driver, shard_keys):
    monkeypatch.setattr(urls, "DRIVER_KEYS", on_driver)
    hosts = ["a.example.org", "EXAMPLE.org", "example.org.com", "b.com", "com", "casino-x.net", "notcom.net", "spam.org"]
    paths = ["", "/", "/es/1", "/en/12", "/en/2", "/fr/x", "/de/y?q#f", "#top"]
    rows = [(i, f"http://{h}{p}", 1) for i, (h, p) in enumerate(itertools.product(hosts, paths))] * 2 + [(None, "x://y", 1), (99, None, 1), (98, "no url", 1), (97, "://", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict int")
    got = urls.filter_urls(pages, shard_keys=30 if on_driver == 0 else shard_keys).collect()
    assert len(got) == len(rows)
    for r in got:
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        listed = any(w in urls.LISTED_WORDS for w in r["host"].replace("-", ".").split("."))
        rule, verdict = max(fits)[1:] if fits else (None, "block" if listed else "allow")
        assert (r["rule"], r["verdict"]) == (rule, verdict), r
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_every_level_of_a_cascade_is_used():
    rng = np.random.default_rng(3)
    keys = rng.integers(1, 2**63, (4000, 2), dtype=np.int64).astype(np.uint64)
    levels = urls._finish(keys[:700], keys[700:], 1)
    assert len(levels) > 2 and (urls.member(levels, keys[:, 0], keys[:, 1]) == (np.arange(4000) < 700)).all()


@pytest.mark.parametrize("block", [8, 512])
def test_vector_links_equal_brute_force(spark, block):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * rng.choice([0.02, 0.06])).tolist(), int(i % 12 % 3)) for i in range(180)]
    rows += [(200 + i, rows[0][1], 0) for i in range(20)] + [(230, [0.0] * 16, 0), (231, None, 0), (232, [], 0), (233, [math.nan] * 16, 0), (234, rows[0][1], None),
             (235, [None] * 16, 0), (236, [1.0, 2.0], 0), (237, [2.0, 4.0], 0), (238, [math.inf] * 16, 0), (None, rows[0][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit("clash"))
    got = {r["vec_id"]: r for r in vectors.near_vectors(table, block=block).collect()}
    sound = {i: (np.array(v) / np.linalg.norm(v), y) for i, v, y in rows
             if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: {j for j, (w, z) in sound.items() if j != i and y == z and len(w) == len(v) and v @ w >= 0.98} for i, (v, y) in sound.items()}
    name = {i: i for i, _, _ in rows if i is not None}
    for _ in range(len(name)):
        name = {i: min([name[i], *(name[j] for j in links.get(i, ()))]) for i in name}
    found = sum(got[i]["n_links"] for i in name)
    assert len(got) == len(rows) and all(got[i]["n_links"] <= len(links.get(i, ())) for i in name)
    assert found >= 0.99 * sum(map(len, links.values()))
    assert sum(got[i]["component_id"] != name[i] for i in name) <= 2
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in name) and got[None]["n_links"] == 0
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_lengths_meet_the_budget():
    rng = random.Random(2)
    for case in range(60):
        lengths = np.array(sorted(rng.sample(range(1, 60), rng.randrange(1, 6))))
        counts = np.array([rng.randrange(1, 5) for _ in lengths])
        budget = rng.randrange(0, int((lengths * counts).sum()) + 5)
        taken = mixing.pick_lengths(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all() and (lengths * taken).sum() <= max(budget, 0)
        gap = budget - int((lengths * taken).sum())
        assert gap < lengths.max() or (taken == counts).all()
    many = mixing.pick_lengths(np.arange(1, 3000), np.full(2999, 4), 7_654_321, table=1 << 12)
    assert int((np.arange(1, 3000) * many).sum()) == 7_654_321


def test_taken_lengths_are_given_back_for_a_better_sum():
    for seed in range(20):
        taken = mixing.pick_lengths(np.array([80_000, 90_000, 120_000]), np.array([1, 1, 1]), 170_000, seed)
        assert taken.tolist() == [1, 1, 0]
        assert mixing.pick_lengths(np.array([3, 10]), np.array([4, 1]), 10, seed).tolist() == [0, 1]
    rng = random.Random(9)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(1, 40), 4))) * 10_000
        counts = np.array([rng.randrange(1, 4) for _ in lengths])
        budget = rng.randrange(1, int((lengths * counts).sum()))
        sums = (sum(n * int(s) for n, s in zip(pick, lengths)) for pick in itertools.product(*[range(c + 1) for c in counts]))
        assert int((lengths * mixing.pick_lengths(lengths, counts, budget)).sum()) == max(s for s in sums if s <= budget)


def test_mix_meets_its_targets(spark):
    rng = random.Random(4)
    sources = ["b", "a", None, "", "ä", "z"]
    rows = [(i if i % 50 else 0, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice([0, 1, 3, 7, 11]))), "en", rng.choice(sources[:5] if i % 3 else ["a"]), 0) for i in range(1500)]
    rows += [(9000, None, None, "z", None), (None, "one two", None, None, None), (9001, " \t", None, "z", None)] + [(9002, "same text here", "en", "a", 0)] * 400
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash"))
    got = mixing.mix(docs, ["doc_id", "source", "size"])
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    found = got.collect()
    assert len(found) == len(rows)
    sizes, taken, goal = {}, {}, {}
    for r in found:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        goal[r["source"]] = r["target"]
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
        if not over:
            want |= {s: weight[s] * share for s in open_}
            break
        want |= {s: 2.0 * sizes[s] for s in over}
        left, open_ = left - sum(2 * sizes[s] for s in over), open_ - over
    for s in order:
        assert math.isclose(goal[s], want[s], rel_tol=1e-9, abs_tol=1e-9) and abs(taken[s] - goal[s]) <= 1.0, s
    again = mixing.mix(docs, ["doc_id"]).groupBy("doc_id", "size").agg(F.sum("taken")).collect()
    first = got.groupBy("doc_id", "size").agg(F.sum("taken")).collect()
    assert sorted(map(str, again)) == sorted(map(str, first))
    assert mixing.mix(docs.limit(0), ["doc_id"]).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, None, None, None, None)], DOCS), ["doc_id"]).first()["taken"] == 0


SCHEMAS = {"sum": {"properties": {"a": "integer", "b": "number", "tags": "array"}, "required": ["a"]}}


def test_tool_calls_are_linked_ordered_and_validated(spark):
    calls = [("c1", 1, 1, "sum", '{"b": 2.5, "a": 1}'), ("c2", 1, 2, "sum", '{"a": 1, "x": {"$ref": "c1"}}'), ("c3", 1, 3, "sum", '{"a": 1, "b": {"$ref":"c2"}}'),
             ("c4", 1, 4, "sum", '{"a": {"$ref": "c5"}}'), ("c5", 1, 5, "sum", '{"a": {"$ref": "c4"}}'), ("c6", 1, 6, "sum", '{"a": {"$ref": "c5"}}'),
             ("c7", 1, 7, "sum", '{"a": {"$ref": "gone"}}'), ("c8", 1, 8, "sum", "[1]"), ("c9", 1, 9, "sum", None), ("d1", 1, 10, "other", "{}"),
             ("d2", 1, 11, "sum", '{"b": "2", "tags": [1]}'), (None, 1, 12, "sum", '{"a": 1}'), ("d3", 2, 2, "sum", '{"a": 2}'), ("d3", 2, 1, "sum", '{"a": 1}')]
    results = [("c1", 1, 20, "3"), ("d3", 2, 5, "late"), ("d3", 2, 3, "early"), ("zz", 1, 30, "?"), ("c8", 1, 31, None)]
    got = {r["call_id"]: r for r in toolcalls.link(
        spark.createDataFrame(calls, "call_id string, conv_id long, turn long, name string, arguments string"),
        spark.createDataFrame(results, "call_id string, conv_id long, turn long, content string"), SCHEMAS).collect()}
    assert [got[c]["level"] for c in ("c1", "c2", "c3", "c4", "c5", "c6", "c7")] == [0, 1, 2, None, None, None, 0]
    status = {c: r["status"] for c, r in got.items()}
    assert status == {"c1": "linked", "c2": "invalid", "c3": "invalid", "c4": "cyclic", "c5": "cyclic", "c6": "cyclic", "c7": "missing_ref", "c8": "invalid",
                      "c9": "invalid", "d1": "invalid", "d2": "invalid", "d3": "linked", "zz": "orphan"}
    assert got["c2"]["errors"] == "unknown:x" and got["c3"]["errors"] == "type:b" and got["d1"]["errors"] == "unknown_tool"
    assert got["d2"]["errors"] == "missing:a,type:b" and got["c8"]["errors"] == got["c9"]["errors"] == "invalid_json"
    assert got["c1"]["json"] == '{"arguments":{"a":1,"b":2.5},"id":"c1","name":"sum","result":"3"}'
    assert (got["d3"]["n_calls"], got["d3"]["n_results"], got["d3"]["turn"], json.loads(got["d3"]["json"])["result"]) == (2, 2, 1, "early")


def test_chats_become_rows_of_json(spark):
    call = json.dumps({"tool_calls": [{"id": "t1", "function": {"name": "sum", "arguments": '{"a": 1}'}}]})
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", 'Say "hi"\n'), (1, 2, "assistant", "hi"), (1, 3, "user", "x"), (1, 4, "assistant", call),
            (1, 5, "tool", '{"tool_call_id": "t1", "content": "1"}'), (2, 0, "assistant", "alone"), (3, 0, None, None), (None, None, "user", "lost"), (4, 0, "user", None)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("name", F.lit("clash"))
    got = {(r["conv_id"], r["turn"], r["kind"]): r for r in toolcalls.format_chats(chats, SCHEMAS).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        (1, 0, "message"): "plain", (1, 1, "call"): "linked", (1, 3, "call"): "unanswered", (1, 4, "call"): "linked", (2, 0, "call"): "orphan",
        (3, 0, "message"): "plain", (None, None, "message"): "plain", (4, 0, "call"): "invalid"}
    assert got[1, 1, "call"]["json"] == '{"arguments":{"prompt":"Say \\"hi\\"\\n","words":2},"id":"1:1","name":"reply","result":"hi"}'
    assert toolcalls.format_chats(chats.limit(0)).count() == 0


def test_identifiers_belong_to_their_conversation_and_no_call_is_lost(spark):
    def call(*made):
        return json.dumps({"tool_calls": [{"id": i, "function": {"name": "sum", "arguments": a}} for i, a in made]})

    def result(i, content):
        return json.dumps({"tool_call_id": i, "content": content})

    rows = [(1, 0, "assistant", call(("k", '{"a": 1}'), ("m", '{"a": {"$ref": "k"}}'))), (1, 1, "tool", result("k", "one")), (2, 0, "assistant", call(("k", '{"a": 2}'))),
            (2, 1, "tool", result("k", "two")), (3, 0, "tool", result("k", "three")), (4, 0, "assistant", call(("m", '{"a": {"$ref": "k"}}'))),
            (5, 0, "assistant", call((None, '{"a": {"$ref": "k"}}'), ("k", '{"a": 5}'), ("k", '{"a": 5}'), ("k", '{"a": 6}'))), (5, 1, "tool", result("k", "y")),
            (5, 2, "tool", result("k", "z")), (6, 0, "user", "x"), (6, 1, "assistant", '{"tool_calls": []}'), (None, 0, "assistant", call(("k", '{"a": 7}')))]
    got = toolcalls.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), SCHEMAS).collect()
    short = lambda r: (r["conv_id"] or 0, r["turn"], r["call_id"] or "", r["status"], r["level"], r["n_calls"], r["n_results"], json.loads(r["json"]).get("result"))
    assert sorted(map(short, got), key=str) == sorted([
        (0, 0, "k", "unlinked", 0, 1, 0, None), (1, 0, "k", "linked", 0, 1, 1, "one"), (1, 0, "m", "invalid", 1, 1, 0, None), (2, 0, "k", "linked", 0, 1, 1, "two"),
        (3, 0, "k", "orphan", 0, 0, 1, "three"), (4, 0, "m", "missing_ref", 0, 1, 0, None), (5, 0, "", "unlinked", 1, 1, 0, None), (5, 0, "k", "linked", 0, 3, 2, "y"),
        (5, 0, "k", "duplicate", 0, 1, 0, None), (5, 0, "k", "duplicate", 0, 1, 0, None), (5, 2, "k", "duplicate", 0, 0, 1, "z"),
        (6, 0, "6:0", "linked", 0, 1, 1, '{"tool_calls": []}')], key=str)


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline as pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.unionByName(docs.limit(5)).unionByName(spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0)], docs.schema))
    columns = odd.columns
    for name, stage in pipeline.STAGES:
        before, odd = odd, stage(spark, odd, folder)
        odd.write.parquet(f"{tmp_path}/{name}")
        odd = spark.read.parquet(f"{tmp_path}/{name}")
        assert odd.columns[: len(columns)] == columns and odd.select(columns).exceptAll(before.select(columns)).count() == 0
        if name != "mixing":
            assert odd.columns == columns
    assert odd.count() > 0
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
