"""Toxicity learned from thousands of labelled rows, many of them copies, and judged on unseen texts."""

import random

import numpy as np
import pytest

from leadweave.llm import toxicity
from leadweave.llm.words import words_of

import pyarrow as pa

DOCS = "doc_id long, text string, label int, score double"
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xo zu".split()
STEMS = ["grubak", "voltri", "snarpe"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 5)))


def text(rng, toxic, common, n=None):
    words = [rng.choice(common) if rng.random() < 0.5 else word(rng) for _ in range(n or rng.randrange(15, 120))]
    for _ in range(max(1, len(words) // 25) if toxic else 0):
        words.insert(rng.randrange(len(words) + 1), rng.choice(STEMS) + rng.choice(SYLLABLES))
    return " ".join(words)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    common = [word(rng) for _ in range(40)]
    rows, labels = [], []
    for i in range(9000):
        toxic = i % 2
        if i % 3 == 2 and i > 60:  # a third are copies, a word changed
            words = rows[i - 60 + 2 * rng.randrange(20) + (rows[i - 60][2] != toxic)][1].split()
            words[rng.randrange(len(words))] = word(rng)
            new = " ".join(words)
            toxic = int(any(w.startswith(tuple(STEMS)) for w in words))
        else:
            new = text(rng, toxic, common)
        rows.append((i, new, toxic, 0.0))
        labels.append((i, 1, toxic))
    unseen = [(20_000 + i, text(rng, i % 2, common), i % 2, 0.0) for i in range(600)]
    long = [(30_000, text(rng, 0, common, 60_000), 0, 0.0), (30_001, text(rng, 1, common, 20_000), 1, 0.0)]
    odd = [(None, "no id", 0, 0.0), (40_000, None, 0, 0.0), (40_001, "", 0, 0.0), (40_002, "same", 0, 0.0), (40_002, "same", 0, 0.0)]
    return spark.createDataFrame([*rows, *unseen, *long, *odd], DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_unseen_texts_are_judged_by_their_words(tables):
    docs, labels = tables
    truth = {r["doc_id"]: r["label"] for r in docs.filter("doc_id >= 20000").select("doc_id", "label").collect()}
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    found = {r["doc_id"]: r for r in got}
    fresh = [i for i in truth if i < 30_000]
    assert np.mean([found[i]["predicted"] for i in fresh if truth[i]]) > 0.97
    assert np.mean([found[i]["predicted"] for i in fresh if not truth[i]]) < 0.02
    assert found[30_000]["predicted"] == 0 and found[30_001]["predicted"] == 1
    assert all(found[i]["predicted"] == 0 and found[i]["passages"] == [] for i in (None, 40_000, 40_001, 40_002))
    clean = [len(found[i]["passages"]) for i in fresh if not truth[i]]
    assert np.mean(clean) < 0.05


def test_copies_are_one_piece_of_evidence(spark):
    rng = random.Random(4)
    base = [" ".join(word(rng) for _ in range(60)) for _ in range(400)]
    copied = " ".join([*(word(rng) for _ in range(30)), "harmless", *(word(rng) for _ in range(30))])
    rows = [(i, 0, base[i]) for i in range(200)] + [(i, 1, base[i]) for i in range(200, 400)] + [(400 + i, 1, copied + f" n{i}") for i in range(150)]
    sample = spark.createDataFrame(rows, "doc_id long, label int, text string")
    keys = toxicity._sample_counts(sample)[0]
    harmless = words_of(pa.array(["harmless"])).keys()[0]
    assert harmless not in keys
    n0, n1 = toxicity._apart_counts(sample, toxicity.Lookup(np.array([harmless], np.uint64)))
    assert (n0[0], n1[0]) == (0, 1)


def test_significance_is_the_likelihood_ratio():
    assert np.isclose(toxicity.significance([0], [8], 270, 25)[0], np.sqrt(2 * 8 * np.log(295 / 25)))
    assert toxicity.significance([30], [0], 100, 100)[0] < 0 and toxicity.significance([5], [5], 100, 100)[0] == 0
