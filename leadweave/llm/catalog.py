"""The registered queries of this folder and their expected results as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadweave.llm.bpe import encode
from leadweave.llm.covertree import hard_negatives, quantised
from leadweave.llm.decontaminate import contamination
from leadweave.llm.html import extract
from leadweave.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, needed, scan, template_words
from leadweave.llm.mixing import mix
from leadweave.llm.neardup import classes
from leadweave.llm.prefixtrie import conversation_trie
from leadweave.llm.quality import quality
from leadweave.llm.toolcalls import format_chats
from leadweave.llm.toxicity import toxicity
from leadweave.llm.urls import LISTED_WORDS, RULES, filter_urls
from leadweave.llm.vectors import near_vectors

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark, folder):
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


def op8_urls(spark, folder):
    return filter_urls(table(spark, folder, "pages"))


def op10_licenses(spark, folder):
    return scan(table(spark, folder, "documents"))


def _list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _rule_case(value):
    """CASE over the rules, longest first."""
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    return " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'" for v, h, p in rules)


OP1_WITH = f"""d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS t
      FROM (SELECT item, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
x AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS t
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
o AS (SELECT doc_id, i, x.m, item FROM x JOIN p ON x.t = p.t AND x.m = p.m),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM o) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id),
r AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
             CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256
      FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id))"""


def op2_main_text(spark, folder):
    return extract(table(spark, folder, "pages"))


def op3_tool_calls(spark, folder):
    return format_chats(table(spark, folder, "conversations"))


def op4_mixing(spark, folder):
    return mix(table(spark, folder, "documents"), ["doc_id"])


def op5_quality(spark, folder):
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_vectors(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))


def op7_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_neardup(spark, folder):
    return classes(table(spark, folder, "documents"))


def op11_bpe(spark, folder):
    import public_tokenizers  # only this query needs the vocabulary files

    tokens = encode(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokens.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                         F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark, folder):
    return conversation_trie(table(spark, folder, "conversations"))


def op13_hard_negatives(spark, folder):
    return hard_negatives(quantised(table(spark, folder, "embeddings")))


# crc32 of the decimal conversation id, bit by bit (lowest bit of each byte first)
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
    lambda s: list_transform(range(8), lambda k: (ord(s) >> CAST(k AS INT)) & 1)))), lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)))"""
OP12_SQL = f"""WITH t AS (SELECT conv_id AS c, list(sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) || '-' || octet_length(encode(coalesce(text, '')))
                                   ORDER BY turn NULLS FIRST) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, l, CAST({CRC32} AS BIGINT) % 9 AS h FROM t),
p AS (SELECT h.c, list_concat(coalesce(t.l[1:h.h], []), h.l[h.h + 1:]) AS path FROM h LEFT JOIN t ON t.c = h.c - h.c % 5),
x AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM p),
n AS (SELECT path[1:d] AS node, d AS depth, min(c) AS conv_id, count(*) AS n_convs FROM x GROUP BY ALL),
e AS (SELECT path AS node, string_agg(c, ',' ORDER BY c) AS ids FROM p GROUP BY path),
k AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.node, n.depth, n_children IS NULL AS leaf, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * CAST(string_split(n.node[n.depth], '-')[2] AS BIGINT) END AS own FROM n LEFT JOIN k USING (node)),
s AS (SELECT node[1:d] AS node, count(*) FILTER (leaf) AS n_leaves, sum(own) AS saved_tokens FROM (SELECT node, leaf, own, unnest(range(0, depth + 1)) AS d FROM v) GROUP BY ALL)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n LEFT JOIN n a ON a.depth = n.depth - 1 AND a.node = n.node[1:n.depth - 1] LEFT JOIN k ON k.node = n.node LEFT JOIN e ON e.node = n.node JOIN s ON s.node = n.node"""
OP13_SQL = """WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""

QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_main_text": op2_main_text, "op3_tool_calls": op3_tool_calls, "op4_mixing": op4_mixing, "op5_quality": op5_quality,
           "op6_vectors": op6_vectors, "op7_toxicity": op7_toxicity, "op8_urls": op8_urls, "op10_licenses": op10_licenses,
           "op9_neardup": op9_neardup, "op11_bpe": op11_bpe, "op12_prefix_trie": op12_prefix_trie, "op13_hard_negatives": op13_hard_negatives}
SQL = {"op1_decontaminate": f"WITH {OP1_WITH} SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM r",
       "op6_vectors": """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)""",
       "op8_urls": rf"""WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {_rule_case(lambda v, h, p: h + p)} END AS rule,
  CASE {_rule_case(lambda v, h, p: v)} WHEN regexp_matches(host, '(^|[.-])({"|".join(LISTED_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM u""",
       "op10_licenses": rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w, {LOWERED} AS low FROM documents),
p AS (SELECT unnest([{", ".join(f"{{'phrase': {_list(k.split())}, 'label': '{v}'}}" for k, v in PHRASES.items())}]) AS p),
o AS (SELECT r, i - 1 AS pos, p.label AS label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), p WHERE w[i:i + len(p.phrase) - 1] = p.phrase),
b AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM o GROUP BY r),
t AS (SELECT unnest([{", ".join(f"{{'label': '{k}', 'words': {_list(template_words(v))}, 'needed': {needed(len(template_words(v)), THRESHOLD)}}}" for k, v in TEMPLATES)}]) AS t),
l AS (SELECT r, regexp_extract_all(unnest(string_split(low, chr(10))), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
m AS (SELECT r, t.label AS label, len(list_intersect(t.words, w)) / len(t.words) AS share FROM l, t WHERE len(list_intersect(t.words, w)) >= t.needed),
g AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS score FROM m GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, g.labels))), ','), '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN g USING (r)""",
       "op3_tool_calls": r"""WITH c AS (SELECT conv_id || ':' || turn AS call_id, conv_id, turn, text,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id || ':' || (turn - 1) AS call_id, conv_id, turn, text FROM conversations WHERE role = 'assistant')
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, 'call' AS kind, coalesce(c.call_id, r.call_id) AS call_id,
  CASE WHEN c.call_id IS NOT NULL THEN 'reply' END AS name, r.turn AS result_turn, 0 AS level,
  CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status, '' AS errors,
  CAST(c.call_id IS NOT NULL AS BIGINT) AS n_calls, CAST(r.call_id IS NOT NULL AS BIGINT) AS n_results,
  CASE WHEN c.call_id IS NULL THEN CAST(json_object('id', r.call_id, 'result', r.text) AS VARCHAR)
       WHEN r.call_id IS NULL THEN CAST(json_object('arguments', json_object('prompt', c.text, 'words', n), 'id', c.call_id, 'name', 'reply') AS VARCHAR)
       ELSE CAST(json_object('arguments', json_object('prompt', c.text, 'words', n), 'id', c.call_id, 'name', 'reply', 'result', r.text) AS VARCHAR) END AS json
FROM c FULL JOIN r USING (call_id)
UNION ALL SELECT conv_id, turn, 'message', NULL, NULL, NULL, 0, 'plain', '', 0, 0, CAST(json_object('content', text, 'role', role) AS VARCHAR)
FROM conversations WHERE role NOT IN ('user', 'assistant')""",
       "op12_prefix_trie": OP12_SQL, "op13_hard_negatives": OP13_SQL}
