"""Decontamination, classifiers, near duplicates and licenses against one-row-at-a-time versions."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from leadweave.llm import licenses, neardup, quality, toxicity
from leadweave.llm.components import components
from leadweave.llm.decontaminate import contamination, decontaminate
from leadweave.llm.labelled import platt
from leadweave.llm.words import shingles, words_of

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_words(text):
    return PATTERN.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def prose(rng, n, names="alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi".split()):
    return " ".join(rng.choice(names) + (rng.choice(["", "", ",", ".\n", " - "])) for _ in range(n))


def docs_of(spark, texts, **more):
    rows = [(i, t, "en", "src", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def test_words_match_the_pattern():
    texts = ["", None, "A b-C", "Éa_b^c", "x" * 3_000_000 + " y", "İstanbul Kelvin K", "a\x7fb", " 12ab "]
    words = words_of(pa.array(texts, pa.string()))
    got = [[words.word(i).decode() for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:])]
    assert got == [plain_words(t) for t in texts]
    keys, text = shingles(words_of(pa.array(["a b c d e f", "a b", "", "z a b c d e"])), 5)
    assert list(text) == [0, 0, 1, 3, 3] and keys[0] == keys[4] and len(set(keys.tolist())) == 4


@pytest.mark.parametrize("block_words", [40, 500_000])
def test_spans_equal_brute_force(spark, block_words):
    rng = random.Random(3)
    items = [(i, prose(rng, 30)) for i in range(6)] + [(90, "Zeta alpha"), (91, None), (None, "mu nu xi"), (5, "Zeta alpha"), (7, "...")]
    texts = [prose(rng, 60) for _ in range(20)] + [None, "", "...", "zeta ALPHA"]
    texts += [prose(rng, 20) + " " + t + " " + prose(rng, 5) for _, t in items[:6]] * 2
    from leadweave.llm.decontaminate import find_spans, judged

    docs, bench = docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    found = judged(find_spans(docs, bench, ["doc_id"], block_words=block_words)).collect()
    got = {r["c0"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found}
    for i, text in enumerate(texts):
        words, hit, ids = plain_words(text), set(), set()
        for item, passage in items:
            w = plain_words(passage)
            m = min(13, len(w))
            for k, at in itertools.product(range(len(w) - m + 1), range(len(words) - m + 1)) if m and item is not None else ():
                if words[at : at + m] == w[k : k + m]:
                    hit |= set(range(at, at + m))
                    ids.add(str(item))
        assert got[i] == (len(words), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(words)), text


def test_decontamination_of_odd_tables(spark):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    odd = spark.createDataFrame([(1, "one two", 3), (1, "one two", 3), (None, None, None)], "doc_id long, text string, spans int")
    assert [tuple(r) for r in decontaminate(odd, bench).collect()] == [(None, None, None)]
    assert contamination(odd.limit(0), bench).count() == 0
    assert contamination(odd, bench.limit(0)).filter("contaminated").count() == 0


def labelled(spark, rng, n, bad):
    texts = [prose(rng, 40) for _ in range(n)] + [bad(prose(rng, 40)) for _ in range(n)]
    labels = [(i, int(i < n), int(i >= n)) for i in range(2 * n)]
    return docs_of(spark, [*texts, None, "", "!!"]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_separates_held_out_rows(spark):
    docs, labels = labelled(spark, random.Random(1), 120, lambda t: " ".join(w.upper() + "!!" for w in t.split()))
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    assert len(got) == 243 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["predicted"] == int(r["doc_id"] < 120) for r in got.values() if r["held_out"] and r["doc_id"] < 240)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id BETWEEN 120 AND 239").count() == 0
    assert {r["score"] for r in quality.quality(docs, labels.filter("quality = 1")).collect()} == {0.5}
    assert quality.quality(docs.limit(0), labels).count() == 0 and quality.quality(docs, labels.limit(0)).count() == 243


def test_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(0)
    rows = [np.array([int(y), 2 + int(rng.integers(3))]) for y in rng.integers(2, size=60)]
    label = np.array([int(r[0]) for r in rows])
    values = [np.ones(2) for _ in rows]
    w, bias = quality.descend(rows, values, label, np.full(60, 10.0), rounds=200)
    margin = np.array([w[r].sum() + bias for r in rows]) * np.where(label == 1, 1, -1)
    assert (margin > 0.99).all() and abs(w[1] + w[0]) < 0.5


def brute_segments(scores):
    """Maximal segments by definition: the best segment, then the same on both sides of it."""
    best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 1e-9:
        return []
    _, _, a, b = best
    return brute_segments(scores[:a]) + [(a, b - 1)] + [(x + b, y + b) for x, y in brute_segments(scores[b:])]


def test_segments_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = rng.normal(-0.3, 1, rng.integers(0, 14))
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(scores)] == brute_segments(list(scores))


def test_toxicity_separates_held_out_rows(spark):
    docs, labels = labelled(spark, random.Random(2), 120, lambda t: t + " you vermin rotten " + t)
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(r["predicted"] == int(r["doc_id"] >= 120) for r in found.values() if r["held_out"] and r["doc_id"] < 240)
    assert found[240]["predicted"] == found[241]["predicted"] == 0 and found[240]["passages"] == []
    hit = next(r for r in found.values() if r["held_out"] and 120 <= r["doc_id"] < 240)
    words = plain_words(docs.filter(f"doc_id = {hit['doc_id']}").first()["text"])
    assert any("vermin" in words[p["first"] : p["last"] + 1] for p in hit["passages"])
    assert toxicity.drop_toxic(docs, labels).filter("doc_id BETWEEN 120 AND 239").count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_extreme_value_scale_and_calibration():
    scores, share = np.array([2.0, -1.0]), np.array([0.2, 0.8])
    scale = toxicity.extreme_scale(scores, share)
    assert math.isclose(float(share @ np.exp(scale * scores)), 1.0, rel_tol=1e-6) and scale > 0
    slope, _ = platt(np.array([-2.0, -1, 1, 2]), np.array([0.0, 0, 1, 1]), np.ones(4))
    assert slope > 0


def similar(a, b):
    return len(a & b) >= 0.8 * len(a | b) - 1e-9


def brute_classes(texts):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := plain_words(t)) else set() for t in texts]
    name = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(len(texts)), 2):
            if name[a] != name[b] and sets[a] and sets[b] and similar(sets[a], sets[b]):
                name[a] = name[b] = min(name[a], name[b])
                changed = True
    return name


@pytest.mark.parametrize("block", [4, 256])
def test_near_duplicates_equal_brute_force(spark, block):
    rng = random.Random(5)
    texts = []
    for _ in range(6):
        base = prose(rng, rng.choice([4, 40, 120])).split(" ")
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(["new", "other", "word"])
            texts.append(" ".join(copy))
    texts += [texts[0].upper(), "one", "ONE.", None, "", "", prose(rng, 30_000)]
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs, block=block).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)
    if block == 4:
        twice = docs.unionByName(docs.limit(3)).withColumn("class_id", docs["lang"]).unionByName(
            docs.limit(1).withColumn("doc_id", docs["doc_id"] * None).withColumn("class_id", docs["lang"]))
        kept = neardup.one_per_class(twice, block=block)
        assert kept.columns == twice.columns
        ids = sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect())
        assert ids == sorted(set(brute_classes(texts))) and kept.count() == len(ids) + 1
        assert neardup.classes(docs.limit(0)).count() == 0


def test_repeated_passages_do_not_hide_near_duplicates(spark):
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    texts = []
    for _ in range(30):
        base, menu = fresh(80), fresh(24)
        texts += [" ".join([base, *[menu] * 2]), " ".join([base, *[menu] * 1000])]  # equal sets of shingles
    for _ in range(30):
        shared, menu = fresh(104), fresh(24)
        texts += [shared, " ".join([shared, *[menu] * 10])]  # similarity 100/128: no link
    for _ in range(30):
        shared, menu = fresh(114), fresh(20)
        texts += [shared, " ".join([shared, *[menu] * 10])]  # similarity 110/134, above 0.8
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [i if 60 <= i < 120 else i - i % 2 for i in range(len(texts))]


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(4)
    keys = rng.integers(1, 2**63, 60, dtype=np.int64).astype(np.uint64)
    weights = [dict(zip(keys[:40].tolist(), rng.uniform(0.5, 4, 40))), dict(zip(keys[20:].tolist(), rng.uniform(0.5, 4, 40)))]
    rows = [(k, w, i) for i, d in enumerate(weights) for k, w in d.items()]
    held = neardup.signatures(np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), 2, 4000)
    a, b = weights
    want = sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in {*a, *b}) for x in a if x in b)
    assert abs((held[0] == held[1]).mean() - want) < 0.03


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (300, 200), (200, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 300: 200}


def test_licenses_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = "licensed under the cc by nc 4 0 apache license version 2 mit released general public gnu work this is".split()
    texts = [prose(rng, 12, vocabulary) for _ in range(60)] + [
        None, "", "CC BY cc-by CC\nBY", "mit license MIT License", "Released under the MIT License.\n" + "x " * 50_000 + "Apache License",
        "apache license apache license gnu general public license mit license", "Licensed under the Apache License, Version 2.0"]
    docs = docs_of(spark, texts + [texts[-1]]).withColumn("labels", pytest.importorskip("pyspark.sql.functions").lit("clash"))
    sets = [(n, set(licenses.template_words(t))) for n, t in licenses.TEMPLATES]
    for r in licenses.scan(docs).collect():
        text = (texts + [texts[-1]])[r["doc_id"]] or ""
        words = plain_words(text)
        places = [(at, label) for p, label in licenses.PHRASES.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()]
        shares = {n: max(len(s & set(plain_words(line))) / len(s) for line in text.split("\n")) for n, s in sets}
        own = {n for n, s in sets if shares[n] >= 0.9 - 1e-9}
        base = {p[1] for p in places}
        assert r["n_words"] == len(words) and r["n_base"] == len(places), text
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None)), text
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | own)), text
        assert math.isclose(r["score"], max((shares[n] for n in own), default=0.0))
    assert licenses.scan(docs.limit(0)).count() == 0
