import random
import re

import pytest
from model import common_length
from pyspark.sql import functions as F

from leadweave import fixed_values as V
from leadweave.functions import hosts, names, text


def values(spark, build, inputs):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r[0] for r in df.orderBy("i").select(build("x")).collect()]


def check(spark, build, table):
    assert values(spark, build, list(table)) == list(table.values())


def test_host(spark):
    check(spark, hosts.host, {
        "https://www.acme.com/about": "acme.com", "http://ACME.COM": "acme.com", "www.acme.com": "acme.com", "": "",
        "user:pw@x.com:80/p": "x.com", "ftp://x.com": "ftp", "  HTTPS://www.www.a.com?x": "www.a.com",
        "http://my_shop.com#top": "my_shop.com", "\thttps://a.b.c/d@e": "a.b.c", None: "",
    })


def test_blocked(spark):
    check(spark, lambda c: hosts.is_blocked(c, [" MyNoise.com ", ""]), {
        "": True, "walmart.com": True, "marketplace.walmart.com": True, "notwalmart.com": False, "acme.com": False,
        "acme.co.uk": True, "co.uk": False, "acme.gov": True, "gov": True, "news.mynoise.com": True, "mynoise.com": True,
        "a.in": True, "in": False, " ACME.DE ": True, "x.glassdoor.co.in": True, "state.edu": True, "education": False,
    })
    assert len(V.BLOCKED_SUFFIXES) == 164 and len(V.BLOCKED_COUNTRY_ENDINGS) == 18


def test_not_listed(spark):
    rows = spark.createDataFrame([(1, "a.b.com"), (2, "b.com"), (3, "c.com"), (4, "xb.com")], "id int, d string")
    listed = spark.createDataFrame([("b.com",)], "entry string")
    assert sorted(r.id for r in hosts.not_listed(rows, "d", "id", listed).collect()) == [3, 4]


def test_company_key(spark):
    check(spark, names.company_key, {
        "Acme Corporation, Inc.": "acme corporation", "The  Acme  Group LLC": "the acme", "Acme International Holdings": "acme",
        "x inc holdings": "x inc", "inc": "inc", ", inc": "", "acme , ,": "acme", "Acme Co., Ltd.": "acme", "": "",
        "Coco": "coco", "A  B, Company": "a b", "Group Holdings": "group",
    })


def test_company_key_is_linear(spark):
    assert values(spark, names.company_key, ["a" + "," * 20000 + "x"]) == ["a" + "," * 20000 + "x"]


def test_sorted_tokens(spark):
    check(spark, names.sorted_tokens, {"Beta  acme-Co.": "acme beta co", "": "", "É_b a": "a b é"})


def test_name_from_host(spark):
    check(spark, hosts.name_from_host, {
        "bellff.com": "Bellff", "shop.3m-co.com": "3M-Co", "x_y.com": "X_Y", "": "", "a.co.uk": "Uk", ".com": ".com",
    })


def test_name_from_title(spark):
    build = lambda c: hosts.name_from_title(c, F.lit("fallback-3m.com"))
    fall = "Fallback-3M"
    check(spark, build, {
        "Acme Fragrance | Leading Manufacturer": "Acme Fragrance", "Acme Foods - Best in TX": "Acme Foods",
        "Candle Co": fall, "9 best": fall, "Acme Foods...": fall, "Acme, Inc.!": "Acme, Inc", "   ": fall, "": fall,
        "Great long manufacturing company name here": fall, "Fine manufacturing": "Fine manufacturing", "x" * 61: fall,
        "x" * 60: "x" * 60, "Acme — Home": "Acme", "Acme: Home": "Acme", "Acme:Home": "Acme:Home", "!!!": fall,
    })


def test_import_title(spark):
    check(spark, hosts.name_from_import_title, {"Acme Foods Inc - ImportYeti": "Acme Foods Inc", "- importyeti ": "", "Acme": "Acme"})


def test_extract_state(spark):
    check(spark, text.extract_state, {
        "Phoenix, AZ 85001": "AZ", "in West Virginia": "VA", "at , XX then texas, TX": "TX", "Arkansas": "AR",
        "ékansas kansasé": "", "": "", None: "", "Ohio and Alabama": "AL", "Twin Falls, IDaho": "ID", "in New  York": "",
    })


def test_parse_amount(spark):
    check(spark, text.parse_amount, {
        "$10M-$50M": 10_000_000, "$1M-$10M": 1_000_000, "$100K-$500K": 100_000, "$1B+": 1_000_000_000, "$1.1m": 1_100_000,
        "8M": None, None: None, "unknown": None,
    })


def test_signals(spark):
    build = lambda c: F.array_join(text.detect_signals(c, F.lit("")), ",")
    check(spark, build, {
        "Walmart vendor with SQEP and OTIF penalties": "sqep_mentioned,otif_mentioned,walmart_supplier",
        "Walmart store": "", "refined sugar": "compliance_pain", "chargeback": "compliance_pain",
    })


def test_common_length(spark):
    """Built-in expressions against the plain table; one word, several words, and their borders."""
    rng = random.Random(1)
    rows = [("", ""), ("a", ""), ("", "b"), ("abc", "cba"), ("é😀x", "x😀é"), ("a" * 62, "a" * 62), ("a" * 63, "a" * 70), ("ab" * 100, "ba" * 90)]
    for _ in range(400):
        letters = rng.choice(["ab", "abcdefgh ", "abcdefghijklmnopqrstuvwxyzé😀"])
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(1 + rng.choice([3, 10, 30, 61, 62, 63, 64, 65, 124, 125, 200]))))
        b = list(a)
        for _ in range(rng.randrange(0, 8)):
            if b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randrange(len(b) + 1), rng.choice(letters))
        rows.append((a, "".join(b)))
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", names.lcs_length("a", "b").alias("n")).collect()
    assert [r["n"] for r in got] == [common_length(r["a"], r["b"]) for r in got]


def test_rounding_at_the_threshold(spark):
    # 84.5 rounds to the even 84 and is no match
    df = spark.createDataFrame([(169, 400), (170, 400)], "lcs int, total int")
    assert [r[0] for r in df.select(names.is_match(F.col("lcs"), F.col("total"))).collect()] == [False, True]


def test_terms_match_like_the_plain_way(spark):
    """`%` and `_` are wild, all else stands for itself; only A-Z and a-z are the same."""
    def like(term, value):
        small = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        pattern = "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in small(term))
        return re.search(pattern, small(value), re.S) is not None

    values = ["FOOD and more", "f\no\nd", "\u212ag \u017f \u0130 \u00c9", "kg s i \u00e9", "a.b*c(d)\\e^f$", "", "\U0001f600x", "100%_", "f" * 5000, "oof", None]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, a string").withColumn("b", F.lit("Tx"))
    for query in ["food", "f%D", "f_o_d", "%", "%%o%f%", "KG", "s I", "\u00c9", ".b*c(", "\\e^f$", "_x tX", "%_x", "0%_", "f%d%x", "zz TX", "\u212a"]:
        want = [i for i, v in enumerate(values) if all(like(t, "tx") or (v is not None and like(t, v)) for t in query.split())]
        assert sorted(r.i for r in rows.filter(text.matches_terms(query, ["a", "b"])).collect()) == want, query
