"""The whole pipeline against plain versions of its decisions."""

import itertools
import random
import re

import pytest

import corpus_pipeline as pipeline
from leadweave.llm import mixing, quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, id string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NAMES = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omicron rho sigma tau".split()


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def one_a_class(rows):
    """Least id of each class of rows whose shingle sets are alike to 0.8, and the rows without an id."""
    sets, leader = {}, {}
    for r in rows:
        if r["doc_id"] is not None:
            sets.setdefault(r["doc_id"], shingles(r["text"]))
    ids = sorted(sets)
    leader = {i: i for i in ids}

    def find(i):
        while leader[i] != i:
            i = leader[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9:
            p, q = sorted((find(a), find(b)))
            leader[q] = p
    return {i for i in ids if find(i) == i}


def contaminated(text, bench):
    w, hit = words(text), set()
    for item in bench:
        p = words(item)
        m = min(13, len(p))
        for k, at in itertools.product(range(len(p) - m + 1), range(len(w) - m + 1)) if m else ():
            if w[at : at + m] == p[k : k + m]:
                hit |= set(range(at, at + m))
    return bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, home = random.Random(21), str(tmp_path_factory.mktemp("tables"))
    prose = lambda n: " ".join(rng.choice(NAMES) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))
    texts, labels, bench = [], [], [prose(30), prose(14), "short item", None, ""]
    for i in range(420):
        kind = i % 6
        text = prose(rng.randrange(30, 70))
        if kind == 1:
            text = " ".join(w.upper() + "!!" for w in text.split())  # junk
        elif kind == 2:
            text += " you vermin rotten " + prose(20) + " vermin"
        elif kind == 3 and i > 60:
            near = texts[i - 3 - 6 * rng.randrange(5)].split()
            near[rng.randrange(len(near))] = "changed"
            text = " ".join(near)
        elif kind == 4 and i % 4 == 0:
            text = prose(20) + " " + bench[rng.randrange(2)] + " " + prose(10)
        texts.append(text)
        labels.append((i, int(kind != 1), int(kind == 2)))
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t), 0.0, "x") for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, prose(40), "en", "s0", 1, 0.0, "x"), (900, None, None, None, None, None, None), (901, "", "en", "s1", 0, 0.0, ""),
             (902, " ".join(NAMES[j % 17] + str(j) for j in range(30_000)), "en", "s1", 1, 0.0, "long")]
    for name, table in (("documents", spark.createDataFrame(rows, DOCS)), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")),
                        ("benchmark", spark.createDataFrame(list(enumerate(bench)), "item_id long, text string"))):
        table.coalesce(2).write.parquet(f"{home}/{name}.parquet")
    return home


def test_run_equals_its_decisions_one_by_one(spark, folder):
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    key = lambda r: str(sorted(r.asDict().items(), key=str))
    docs, labels, bench = read("documents"), read("labels"), [r["text"] for r in read("benchmark").collect()]
    now = docs
    for operator, (name, stage) in zip((quality.quality, toxicity.toxicity), pipeline.STAGES):
        scored = {(r["doc_id"]): r["score"] for r in operator(now, labels).collect()}
        before, now = now.collect(), stage(spark, now, folder)
        keeps = (lambda s: s >= 0.3) if name == "quality" else (lambda s: s < 0.3)
        assert sorted(map(key, now.collect())) == sorted(key(r) for r in before if keeps(scored[r["doc_id"]])), name
        assert 0 < now.count() < len(before)
        now = spark.createDataFrame(now.collect(), docs.schema)
    rows = now.collect()
    kept = one_a_class(rows)
    now = pipeline.near_duplicates(spark, now, folder)
    single = {key(r): r for r in rows if r["doc_id"] is None or r["doc_id"] in kept}
    assert sorted(map(key, now.collect())) == sorted(single) and len(single) < len(rows)
    now = spark.createDataFrame(now.collect(), docs.schema)
    clean = [r for r in now.collect() if not contaminated(r["text"], bench)]
    now, all_of = pipeline.decontamination(spark, now, folder), now.count()
    assert sorted(map(key, now.collect())) == sorted(map(key, clean)) and len(clean) < all_of
    now = spark.createDataFrame(now.collect(), docs.schema)
    last = pipeline.mixing(spark, now, folder).collect()
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(now, ["doc_id"]).filter("taken > 0").collect()}
    assert {r["doc_id"]: r["taken"] for r in last} == taken and {902, None} <= {r["doc_id"] for r in clean}
    assert {r["doc_id"]: (r["taken"], r["copies"]) for r in pipeline.run(spark, folder).collect()} == {r["doc_id"]: (r["taken"], r["copies"]) for r in last}
