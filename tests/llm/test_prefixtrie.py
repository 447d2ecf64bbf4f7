"""The prefix trie of conversations against one built turn by turn."""

import hashlib
import random
import zlib

import pytest

from leadweave.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        path = tuple(own.get(first, [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items())


def got_trie(spark, rows, **limits):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "0 AS path", "1 AS block")
    found = prefixtrie.conversation_trie(table, **limits)
    assert sorted(found.columns) == sorted(COLUMNS)
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=lambda r: (r[0], r[1]))


def random_rows(rng, n, longest):
    openings = [[(rng.choice(["user", "système", None]), rng.choice(["hi", "ho", "été", "", None])) for _ in range(longest)] for _ in range(3)]
    rows = []
    for c in rng.sample(range(-40, 2 * n), n):
        turns = rng.choice(openings)[: rng.randrange(0, longest + 1)] + [("user", rng.choice("abc")) for _ in range(rng.randrange(0, 4))]
        order = sorted(rng.sample(range(50 * longest), len(turns)))
        rows += [(c, t if i else rng.choice([None, t]), *turn) for i, (t, turn) in enumerate(zip(order, turns))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [1, 40, prefixtrie.CELLS])
def test_trie_equals_the_plain_one(spark, cells):
    rng = random.Random(cells)
    rows = random_rows(rng, 60, 12) + [(None, 1, "user", "lost")]
    assert got_trie(spark, rows, cells=cells) == plain_trie(rows)


def test_crowds_of_equal_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 900) for t in range(3)] + [(5000 + c, 0, "user", str(c)) for c in range(50)]
    assert got_trie(spark, rows, cells=64) == plain_trie(rows)


def test_long_conversations_and_texts(spark):
    rows = [(c, t, "user", "x" * (200_000 if t == 3 else t % 7)) for c in (3, 10, 15) for t in range(700)] + [(20, 0, "", "")]
    assert got_trie(spark, rows, cells=1000) == plain_trie(rows)


def test_no_rows_no_nodes(spark):
    assert got_trie(spark, []) == [] and got_trie(spark, [(None, 1, "a", "b")]) == []


def test_conversations_left_without_turns(spark):
    rows = [(c, None, None, None) for c in range(1, 40) if c % 5]
    assert got_trie(spark, rows) == plain_trie(rows)


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(7, 1, "user", "again")] * 6 + [(8, 1, "user", "again")] * 3 + [(5, 1, "user", "again")] * 12
    assert got_trie(spark, rows) == plain_trie(rows)
