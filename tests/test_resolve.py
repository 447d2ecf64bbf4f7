import random

import pytest
from conftest import BLANK, make
from model import alike, resolve as model_resolve

from leadweave.functions.names import company_key, sorted_tokens
from leadweave.operators import fuzzy, merge
from leadweave.operators import resolve as R
from leadweave.operators.resolve import key_leaders, revise_leaders
from leadweave.plans.runs import resolve
from leadweave.schemas import SIGHTING_COLUMNS
from leadweave.session import cut


def near_copies(rng, bases, copies, alphabet="abcdefgh 0é"):
    out = []
    for b in bases:
        for _ in range(copies):
            s = list(b)
            for _ in range(rng.randint(0, 5)):
                if rng.random() < 0.5 and s:
                    del s[rng.randrange(len(s))]
                else:
                    s.insert(rng.randint(0, len(s)), rng.choice(alphabet))
            out.append(" ".join(sorted("".join(s).split())))
    out = [k for k in dict.fromkeys(out) if k]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def keys():
    rng = random.Random(5)
    words = lambda n: "".join(rng.choice(rng.choice(["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz "])) for _ in range(n))
    return near_copies(rng, [words(rng.choice([3, 4, 5, 6, 8, 12, 20, 30, 50, 62, 66, 90])) for _ in range(50)], 7)


@pytest.mark.parametrize("width", [1, 2])
def test_pairs_are_exact(spark, keys, width):
    want = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if alike(keys[i], keys[j])}
    df = spark.createDataFrame(list(enumerate(keys)), "ord bigint, name_key string")
    described = fuzzy.describe(df, fuzzy.bigram_order(df)).cache()
    assert {tuple(r) for r in fuzzy.self_pairs(described, width).collect()} == want


def test_split_groups_change_nothing(spark, keys, monkeypatch):
    df = spark.createDataFrame(list(enumerate(keys)), "ord bigint, name_key string")
    described = fuzzy.describe(df, fuzzy.bigram_order(df)).cache()
    plain = {tuple(r) for r in fuzzy.self_pairs(described).collect()}
    monkeypatch.setattr(fuzzy, "TASK_PAIRS", 50)
    assert {tuple(r) for r in fuzzy.self_pairs(described, small=False).collect()} == plain
    monkeypatch.setattr(fuzzy, "BROADCAST_SPLITS", 0)
    probed = fuzzy.probe_pairs(described, described, broadcast_rows=0).filter("a < b")
    assert {tuple(r) for r in probed.collect()} == plain


@pytest.mark.parametrize("block", [1000, 40])
def test_comparing_all_pairs_is_exact(spark, keys, block):
    want = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if alike(keys[i], keys[j])}
    df = spark.createDataFrame(list(enumerate(keys)), "ord bigint, name_key string")
    described = fuzzy.describe(df, fuzzy.bigram_order(df)).cache()
    assert {tuple(r) for r in fuzzy.plain_pairs(described, described, within=True, block_rows=block).collect()} == want
    both = {tuple(r) for r in fuzzy.plain_pairs(described, described.filter("ord < 100"), block_rows=block).filter("a < b").collect()}
    assert both == {(a, b) for a, b in want if a < 100}


def test_names_of_few_bigrams_are_compared_in_one_batch(spark, monkeypatch):
    """Signature groups hold more pairs than there are, and few names match: such a set is not divided, and all pairs are compared."""
    rng = random.Random(8)
    words = ["".join(rng.choice("enrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    dense = sorted({" ".join(sorted(rng.sample(words, 5))) for _ in range(600)})
    spread = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(20)) for _ in range(300)]
    described = {}
    for name, rows in (("dense", dense), ("spread", spread)):
        df = spark.createDataFrame(list(enumerate(rows)), "ord bigint, name_key string")
        described[name] = fuzzy.describe(df, fuzzy.bigram_order(df)).cache()
    monkeypatch.setattr(fuzzy, "FEW_PAIRS", 0)
    assert fuzzy.plainly(described["dense"], described["dense"], 2) and not fuzzy.plainly(described["spread"], described["spread"], 2)
    monkeypatch.setattr(fuzzy, "SURVIVORS_PER_KEY", 2)
    assert fuzzy.self_affordable(described["dense"], len(dense), 1_000)
    want = {(i, j) for i in range(len(dense)) for j in range(i + 1, len(dense)) if alike(dense[i], dense[j])}
    assert {tuple(r) for r in fuzzy.matching_self(described["dense"], 2, True).collect()} == want


def test_crowds_are_divided(spark, monkeypatch):
    crowd = near_copies(random.Random(2), ["a crowd of names that are all alike"], 200)
    df = spark.createDataFrame(list(enumerate(crowd)), "ord bigint, name_key string")
    monkeypatch.setattr(fuzzy, "SURVIVORS_PER_KEY", 2)
    described = fuzzy.describe(df, fuzzy.bigram_order(df)).cache()
    assert not fuzzy.self_affordable(described, len(crowd), 1_000) and fuzzy.self_affordable(described, len(crowd), 10**6)


@pytest.mark.parametrize("batch,budget,free", [(10**6, 10**9, 2000), (60, 10**9, 2000), (200, 3000, 20)])
def test_leaders_in_batches(spark, keys, batch, budget, free, monkeypatch):
    leaders, want = [], {}
    for i, k in enumerate(keys):
        want[i] = next((j for j in leaders if alike(keys[j], k)), i)
        if want[i] == i:
            leaders.append(i)
    monkeypatch.setattr(fuzzy, "PAIRS_PER_KEY", 0)
    monkeypatch.setattr(fuzzy, "SURVIVORS_PER_KEY", 0)
    monkeypatch.setattr(fuzzy._next_chunk, "__defaults__", (free,))
    df = spark.createDataFrame(list(enumerate(keys)), "ord bigint, name_key string")
    assert {r.ord: r.leader for r in R.key_leaders(df, batch, budget).collect()} == want


@pytest.mark.parametrize("chunk", [10**6, 30])
def test_first_match(spark, keys, chunk):
    half = len(keys) // 2
    index, probe = keys[:half], keys[half:] + keys[:3]
    df = lambda rows: spark.createDataFrame(list(enumerate(rows)), "ord bigint, name_key string")
    want = {i: j for i, k in enumerate(probe) if (j := next((j for j, x in enumerate(index) if alike(k, x)), None)) is not None}
    got = {r.ord: r.match for r in fuzzy.first_match(df(probe), df(index), first_chunk=chunk).collect()}
    assert got == want


def keyed(spark, rows):
    df = make(spark, rows)
    keys = R.with_keys(df).select("seq", "domain", "name_key").collect()
    by_seq = {k.seq: k for k in keys}
    return df, [{"seq": i} | BLANK | r | {"domain": by_seq[i].domain, "name_key": by_seq[i].name_key} for i, r in enumerate(rows)]


def random_rows(rng, n):
    names = near_copies(rng, ["acme foods", "beta scents", "gamma", "delta drug works", "epsilon"], 4, "aeo ")
    pick = lambda *xs: rng.choice(xs)
    return [{
        "company_name": pick(rng.choice(names), rng.choice(names) + " Inc", rng.choice(names) + ", LLC", "", "Inc, inc", "ab"),
        "website": pick("", "", f"www.s{rng.randint(0, 9)}.com", f"https://s{rng.randint(0, 9)}.com/x"),
        "vertical": pick("", "food", "pharma,food", " flavor , "), "source_channel": pick("web_search", "apollo", "sqep, import"),
        "product_keywords": pick("", "a, b", "b,c"), "compliance_signals": pick("", "x"), "city": pick("", "Dallas"),
        "estimated_revenue": pick(None, 0, 5, 7), "estimated_employees": pick(None, 0), "score": pick(0, 3),
        "contact_source": pick("", "hunter", "apollo", "form"), "contact_name": pick("", "Ann", "Bob"),
        "contact_email": pick("", "a@b.c"), "contact_title": pick("", "COO"), "email_confidence": pick(None, 0, 50),
        "email_verified": pick("", "valid"), "notes": pick("", "n1", "n2"), "tier": pick("", "HOT"),
    } for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_resolution_and_merge_against_model(spark, seed):
    rows = random_rows(random.Random(seed), 60)
    df, full = keyed(spark, rows)
    leaders, merged = model_resolve(full)
    placed = R.assign_leaders(df).cache()
    assert {r.seq: r.leader for r in placed.select("seq", "leader").collect()} == leaders
    got = {r.seq: r.asDict() for r in merge.merge_companies(placed).collect()}
    assert set(got) == set(merged)
    for seq, want in merged.items():
        assert {c: got[seq][c] for c in SIGHTING_COLUMNS} == {c: want[c] for c in SIGHTING_COLUMNS}, seq


def one(spark, *rows):
    return sorted((r.asDict() for r in resolve(make(spark, list(rows))).collect()), key=lambda r: r["seq"])


def test_domain_merge(spark):
    out = one(spark, {"company_name": "Acme", "website": "acme.com", "source_channel": "web_search", "vertical": "food"},
              {"company_name": "Acme Inc", "website": "acme.com", "source_channel": "apollo", "vertical": "pharma",
               "contact_name": "John", "contact_source": "apollo"})
    assert len(out) == 1
    assert out[0]["source_channel"] == "apollo, web_search" and out[0]["vertical"] == "food, pharma"
    assert out[0]["contact_name"] == "John" and out[0]["contact_source"] == "apollo"


def test_name_merge_and_no_merge(spark):
    out = one(spark, {"company_name": "Acme Fragrance Co", "compliance_signals": "sqep_mentioned"}, {"company_name": "Acme Fragrance Company"})
    assert len(out) == 1 and out[0]["compliance_signals"] == "sqep_mentioned"
    assert len(one(spark, {"company_name": "Acme Corp", "website": "acme.com"}, {"company_name": "Beta Inc", "website": "beta.com"})) == 2


def test_contact_rules(spark):
    hunter = {"company_name": "A", "website": "a.com", "contact_source": "hunter", "contact_name": "H", "contact_email": "h@a.com"}
    apollo = {"company_name": "A", "website": "a.com", "contact_source": "apollo", "contact_name": "P"}
    out = one(spark, hunter, apollo)[0]
    assert (out["contact_name"], out["contact_email"]) == ("P", "")  # the better source also brings its blanks
    out = one(spark, hunter | {"contact_email": ""}, hunter)[0]
    assert out["contact_email"] == ""  # equal sources keep the first block


def test_chain_is_not_one_company(spark):
    a, b, c = "aaaaaaaaaabbbbbbbbbb", "aaaaaaaaaabbbbbbbccc", "aaaaaaaaaabbbbcccccc"
    assert alike(a, b) and alike(b, c) and not alike(a, c)
    assert [r["company_name"] for r in one(spark, *[{"company_name": x} for x in (a, b, c)])] == [a, c]


def test_lone_row_keeps_its_text(spark):
    assert one(spark, {"company_name": "Solo", "vertical": "b,a ,b"})[0]["vertical"] == "b,a ,b"


def test_crowds_of_copies(spark):
    """A third of the rows share one domain, a third one name; tasks see keys, not copies."""
    rows = [{"company_name": f"Firm {i} {i * 7919 % 1000}", "website": "big.com"} for i in range(400)]
    rows += [{"company_name": "Same Name Ltd"} for _ in range(400)]
    rows += [{"company_name": "".join(chr(97 + (i * k) % 26) for k in (3, 5, 7, 11, 13, 17, 19, 23))} for i in range(26)]
    df, full = keyed(spark, rows)
    leaders, _ = model_resolve(full)
    assert {r.seq: r.leader for r in R.assign_leaders(df).select("seq", "leader").collect()} == leaders


def test_lookup_of_hot_keys(spark, monkeypatch):
    from leadweave import session
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)], "id int, k string")
    table = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    counts = rows.groupBy("k").count().withColumnRenamed("count", "n")
    want = sorted(tuple(r) for r in rows.join(table, "k", "left").select("id", "k", "v").collect())
    monkeypatch.setattr(session, "PLAIN_ROWS", 0)
    monkeypatch.setattr(session, "HOT_PARTS", 10)
    got = session.lookup(rows, table, "k", counts, 3000)
    assert got.filter("k = 'hot'").count() == 2000
    assert sorted(tuple(r) for r in got.select("id", "k", "v").collect()) == want


def test_row_order_in_ranges(spark, monkeypatch):
    from leadweave import session
    monkeypatch.setattr(session, "PLAIN_ROWS", 10)
    rows = spark.range(5000).selectExpr("id * id AS seq").repartition(7)
    got = session.row_order(rows, "seq", "id", 100).orderBy("seq").collect()
    assert [r.id for r in got] == list(range(101, 5101))


def leaders_of(keys, **limits):
    return {r["name_key"]: (r["ord"], r["leader"]) for r in keys.join(key_leaders(keys, **limits), "ord").collect()}


@pytest.mark.parametrize("seed", range(2))
def test_revised_leaders_equal_a_full_decision(spark, seed):
    """Keys that come, go and move, in crowds of alike names, against deciding all of them anew."""
    rng = random.Random(seed)
    stems = ["acme foods north", "delta pharma works", "gamma flavor house", "ab", "x"]
    def name():
        base = list(rng.choice(stems))
        for _ in range(rng.randrange(0, 4)):
            base[rng.randrange(len(base))] = rng.choice("abcdefgh ")
        return "".join(base).strip() or "z"
    pool = sorted({name() for _ in range(260)})
    kept = {k: o for o, k in enumerate(rng.sample(pool, 2 * len(pool) // 3))}
    schema = "ord long, name_key string"
    keys = spark.createDataFrame([(o, k) for k, o in kept.items()], schema)
    decided = cut(keys.join(key_leaders(keys), "ord"), "decided")
    for _ in range(2):
        for k in rng.sample(sorted(kept), 6):
            del kept[k]
        free = [o for o in range(400) if o not in kept.values()]
        for k, o in zip(rng.sample(sorted(set(pool) - set(kept)), 8), rng.sample(free, 8)):
            kept[k] = o
        for k, o in zip(rng.sample(sorted(kept), 4), rng.sample(range(400, 900), 4)):
            kept[k] = o
        keys = spark.createDataFrame([(o, k) for k, o in kept.items()], schema)
        decided = revise_leaders(decided, keys)
        assert {r["name_key"]: (r["ord"], r["leader"]) for r in decided.collect()} == leaders_of(keys)
    assert sorted(r["ord"] for r in revise_leaders(decided, keys).collect()) == sorted(kept.values())
    assert revise_leaders(decided, keys.limit(0)).count() == 0


def test_followers_of_a_lost_leader_are_spread_again(spark, monkeypatch):
    from leadweave.operators import resolve

    monkeypatch.setattr(resolve, "BROADCAST_ROWS", 0)
    names = ["alpha beta gamma"] + [f"alpha beta gamm{c}" for c in "bcdef"] + ["other thing"]
    keys = spark.createDataFrame(list(enumerate(names)), "ord long, name_key string")
    decided = cut(keys.join(key_leaders(keys), "ord"), "decided")
    now = keys.filter("ord > 0")
    assert {r["name_key"]: (r["ord"], r["leader"]) for r in revise_leaders(decided, now).collect()} == leaders_of(now)


def test_groups_of_a_crowd_are_linear(spark):
    rng = random.Random(6)
    names = near_copies(rng, ["acme foods north", "delta pharma works"], 40) + ["ab", "zz top of all"]
    keys = spark.createDataFrame(list(enumerate(names)), "ord long, name_key string")
    rows = R.name_groups(keys).collect()
    assert sorted(r.ord for r in rows) == list(range(len(names)))
    leaders = [k for k, r in enumerate(sorted(rows, key=lambda r: r.ord)) if r.leader == k]
    for r in rows:
        earlier = [k for k in leaders if k < r.ord and alike(r.name_key, names[k])]
        assert r.leader == (earlier[0] if earlier else r.ord) and r.members == sum(x.leader == r.leader for x in rows)


def test_texts_are_fetched_not_aggregated(spark, monkeypatch):
    """Groups are decided by numbers: no sort aggregate, and one company with most rows is not gathered."""
    from leadweave import session

    monkeypatch.setattr(session, "PLAIN_ROWS", 0)
    rows = make(spark, [{"company_name": f"N{i}", "notes": "" if i < 50 else f"note {i}", "contact_source": "apollo" if i == 70 else "", "contact_email": f"e{i}",
                         "source_channel": "web_search"} for i in range(90)]).selectExpr("*", "IF(seq < 80, 0, seq) AS leader")
    merged = merge.merge_companies(rows)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Python" not in plan
    got = {r.seq: r for r in merged.collect()}
    assert len(got) == 11 and (got[0].company_name, got[0].notes, got[0].contact_email, got[0].contact_source) == ("N0", "note 50", "e70", "apollo")
    assert got[85].notes == "note 85"
