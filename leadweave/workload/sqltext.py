"""DuckDB SQL fragments that state the expected results, independent of the Spark code."""

from __future__ import annotations

from .. import fixed_values as V
from .. import settings as C
from ..schemas import CONTACT_COLUMNS, FILL_COLUMNS, LIST_COLUMNS, SIGHTING_COLUMNS, SIGHTING_FIELDS
from . import inputs as I

TYPES = {n: t.simpleString() for n, t in SIGHTING_FIELDS}
TODAY = "DATE '2024-04-01'"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def rec(recipe: str) -> str:
    return "(" + I.for_duckdb(recipe) + ")"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def host(x: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({strip(x)}, '(?i)^(?:https?://)?(?:[^/?#]*@)?([^:/?#]*)', 1)), '^www\.', '')"


def blocked(x: str, user=()) -> str:
    below = f"len(list_filter([{quoted(list(V.BLOCKED_SUFFIXES) + list(user))}], lambda s: d = s OR ends_with(d, '.' || s))) > 0"
    country = f"len(list_filter([{quoted(V.BLOCKED_COUNTRY_ENDINGS)}], lambda s: ends_with(d, '.' || s))) > 0"
    return f"({x} = '' OR (SELECT {below} OR {country} FROM (SELECT lower({strip(x)}) AS d)))"


def name_from_host(x: str) -> str:
    bare = rf"regexp_replace(lower({strip(x)}), '\.({'|'.join(V.NAME_ENDINGS)})$', '')"
    title = (r"array_to_string(list_transform(range(1, length(l) + 1), lambda i: CASE WHEN i = 1 OR NOT "
             r"regexp_matches(l[i - 1], '\p{L}') THEN upper(l[i]) ELSE l[i] END), '')")
    return f"(SELECT CASE WHEN l = '' THEN {x} ELSE {title} END FROM (SELECT string_split({bare}, '.')[-1] AS l))"


def name_from_title(title: str, domain: str) -> str:
    starts = " OR ".join(f"starts_with(lo, '{w}')" for w in V.ARTICLE_BEGINNINGS)
    service = " OR ".join(f"contains(lo, '{w}')" for w in V.SERVICE_WORDS)
    return rf"""(SELECT CASE WHEN t = '' OR length(p) > 60 OR {starts} OR regexp_matches(p, '^\d+\s')
      OR (({service}) AND length(p) > 30) OR contains(p, '...') OR rtrim(p, '.:,;!?') = ''
      THEN {name_from_host(domain)} ELSE rtrim(p, '.:,;!?') END
      FROM (SELECT t, p, lower(p) AS lo FROM (SELECT t, {strip(r"string_split_regex(t, '\s*[|—]\s*|\s+-\s+|\s*:\s+')[1]")} AS p
      FROM (SELECT {title} AS t))))"""


def index_name(title: str) -> str:
    return strip(rf"regexp_replace({title}, '(?i)\s*-\s*ImportYeti\s*$', '')")


def signal_list(title: str, snippet: str) -> str:
    pain = " OR ".join(f"contains(x, '{w}')" for w in V.PAIN_WORDS)
    return f"""(SELECT list_filter([CASE WHEN contains(x, 'sqep') THEN 'sqep_mentioned' END,
      CASE WHEN contains(x, 'otif') THEN 'otif_mentioned' END,
      CASE WHEN contains(x, 'walmart') AND (contains(x, 'supplier') OR contains(x, 'vendor')) THEN 'walmart_supplier' END,
      CASE WHEN {pain} THEN 'compliance_pain' END], lambda s: s IS NOT NULL)
      FROM (SELECT lower({title} || ' ' || {snippet}) AS x))"""


def signal_text(title: str, snippet: str) -> str:
    return f"array_to_string({signal_list(title, snippet)}, ', ')"


def state_of(text: str) -> str:
    codes = quoted(c for _, c in V.US_STATES)
    edge = r"[^\p{L}\p{N}_]"
    named = " ".join(
        rf"WHEN regexp_matches(lo, '(^|{edge}){n}({edge}|$)') THEN '{c}'" for n, c in V.US_STATES)
    return rf"""(SELECT CASE WHEN code IN ({codes}) THEN code {named} ELSE '' END FROM
      (SELECT lower({text}) AS lo, regexp_extract({text}, ',[\s\p{{Z}}]*([A-Z]{{2}})(?:{edge}|$)', 1) AS code))"""


def amount(x: str) -> str:
    rx = r"'(?i)\$([0-9]+(?:\.[0-9]+)?)\s*([KMB])'"
    return f"""CAST(trunc(CAST(nullif(regexp_extract({x}, {rx}, 1), '') AS DOUBLE) *
      CASE upper(regexp_extract({x}, {rx}, 2)) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 END) AS BIGINT)"""


def revenue(number: str, printed: str) -> str:
    return f"coalesce(CAST(trunc({number}) AS BIGINT), {amount(printed)})"


def company_key(x: str) -> str:
    n = rf"regexp_replace({strip(f'lower({x})')}, '[\s\p{{Z}}]+', ' ', 'g')"
    return strip(f"regexp_replace(regexp_replace({n}, '{I.LEGAL}', ''), '{I.DESCRIPTIVE}', '')")


def tokens(x: str) -> str:
    return (rf"array_to_string(list_sort(string_split(trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')), ' ')")


def lcs(a: str, b: str) -> str:
    """Longest common subsequence by the plain table method, one row per character of `a`."""
    chars = lambda s: f"list_transform(string_split({s}, ''), lambda c: [unicode(c)])"
    step = (f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda acc, j: list_append(acc, "
            f"CASE WHEN unicode(substr({b}, j[1], 1)) = x[1] THEN prev[j[1]] + 1 ELSE greatest(acc[-1], prev[j[1] + 1]) END), [CAST(0 AS BIGINT)])")
    zeros = f"list_transform(range(0, length({b}) + 1), lambda z: CAST(0 AS BIGINT))"
    return f"list_reduce({chars(a)}, lambda prev, x: {step}, {zeros})[-1]"


def items(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, ','), lambda v: trim(v)), lambda v: v <> '')"


def union_text(x: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_distinct(flatten(list({items(x)})))), ', '), '')"


NEAR = """1000 * abs(length({a}) - length({b})) < 155 * (length({a}) + length({b}))
  AND 1000 * levenshtein({a}, {b}) < 2 * 155 * (length({a}) + length({b}))"""  # levenshtein counts bytes here


def match(a: str, b: str) -> str:
    return f"400 * {lcs(a, b)} > 169 * (length({a}) + length({b}))"


def leader_ctes(source: str) -> str:
    """CTEs ending in `placed` (sightings with domain, name_key, leader), decided one by one in order."""
    return f"""s AS MATERIALIZED (SELECT *, {host('website')} AS domain, {tokens(company_key('company_name'))} AS name_key
      FROM {rec(source)} q),
    heads AS (SELECT domain, min(seq) AS head FROM s WHERE domain <> '' GROUP BY domain),
    reps AS MATERIALIZED (SELECT s.seq, s.domain, s.name_key FROM s LEFT JOIN heads h ON s.domain = h.domain
      WHERE s.domain = '' OR s.seq = h.head),
    near AS MATERIALIZED (SELECT a.seq AS a, b.seq AS b, a.name_key AS ka, b.name_key AS kb FROM reps a JOIN reps b
      ON a.seq < b.seq AND a.name_key <> '' AND b.name_key <> '' AND {NEAR.format(a='a.name_key', b='b.name_key')}),
    edges AS MATERIALIZED (SELECT a, b FROM near WHERE ka = kb OR {match('ka', 'kb')}),
    adj AS MATERIALIZED (SELECT b, list(a ORDER BY a) AS nb, row_number() OVER (ORDER BY b) AS k FROM edges GROUP BY b),
    walk(k, b, lead, gone) AS (
      SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[])
      UNION ALL
      SELECT adj.k, adj.b, list_filter(adj.nb, lambda a: NOT list_contains(walk.gone, a))[1],
        CASE WHEN len(list_filter(adj.nb, lambda a: NOT list_contains(walk.gone, a))) > 0
             THEN list_append(walk.gone, adj.b) ELSE walk.gone END
      FROM walk JOIN adj ON adj.k = walk.k + 1),
    rep_leader AS (SELECT r.seq, r.domain, coalesce(w.lead, r.seq) AS leader FROM reps r LEFT JOIN walk w ON r.seq = w.b),
    placed AS MATERIALIZED (SELECT s.*, coalesce(d.leader, o.leader) AS leader FROM s
      LEFT JOIN (SELECT domain, leader FROM rep_leader WHERE domain <> '') d ON s.domain = d.domain
      LEFT JOIN rep_leader o ON s.seq = o.seq AND s.domain = '')"""


RANK = "CASE contact_source WHEN 'apollo' THEN 2 WHEN 'hunter' THEN 1 ELSE 0 END"


def first_filled(c: str) -> str:
    blank = f"{c} <> ''" if TYPES[c] == "string" else f"{c} <> 0"
    return f"arg_min({c}, seq) FILTER (WHERE {blank})"


def merged_cte(source: str = "placed", name: str = "merged") -> str:
    """CTE with one merged row per leader."""
    cols = {"company_name": "arg_min(company_name, seq)", "scraped_date": "arg_min(scraped_date, seq)"}
    for c in LIST_COLUMNS:
        cols[c] = f"CASE WHEN count(*) > 1 THEN {union_text(c)} ELSE arg_min({c}, seq) END"
    for c in CONTACT_COLUMNS:
        blank = f"{c} <> ''" if TYPES[c] == "string" else f"{c} IS NOT NULL"
        loose = f"arg_min({c}, seq) FILTER (WHERE {blank})"
        loose = f"coalesce({loose}, '')" if TYPES[c] == "string" else loose
        best = f"(list({c} ORDER BY {RANK} DESC, seq))[1]"
        cols[c] = f"CASE WHEN max({RANK}) > 0 THEN {best} ELSE {loose} END"
    for c in FILL_COLUMNS:
        last = "''" if TYPES[c] == "string" else f"(list({c} ORDER BY seq))[1]"
        cols[c] = f"coalesce({first_filled(c)}, {last})"
    body = ", ".join(f"{cols[c]} AS {c}" for c in SIGHTING_COLUMNS)
    return f"{name} AS MATERIALIZED (SELECT leader AS seq, {body} FROM {source} GROUP BY leader)"


# --- scoring -----------------------------------------------------------------
def mult_items(x: str = "vertical") -> str:
    return items(f"lower({x})")


def multiplier(x: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v:.4f}" for k, v in C.VERTICAL_MULTIPLIERS.items())
    return f"CAST(CASE {x} {arms} ELSE {C.UNKNOWN_MULTIPLIER:.4f} END AS DOUBLE)"


SIGNAL_POINTS = (f"(SELECT CASE WHEN n >= 4 THEN 35 WHEN n = 3 THEN 25 WHEN n = 2 THEN 15 WHEN n = 1 THEN 5 ELSE 0 END "
                 f"FROM (SELECT len(list_distinct({items('source_channel')})) AS n))")
COMPLIANCE_POINTS = "(" + " + ".join(
    f"CASE WHEN list_contains({items('lower(compliance_signals)')}, '{k}') THEN {v} ELSE 0 END" for k, v in C.SIGNAL_POINTS.items()) + ")"


def geo_points(states) -> str:
    return f"CASE WHEN state <> '' AND state IN ({quoted(states)}) THEN 15 ELSE 0 END"


def contains_word(x: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{w}')" for w in words) + ")"


IS_LOGISTICS = contains_word("contact_title", V.LOGISTICS_TITLES)
ENRICH_POINTS = (f"CASE WHEN trim(contact_email) <> '' AND trim(contact_title) <> '' AND {IS_LOGISTICS} THEN 15 "
                 f"WHEN trim(contact_email) <> '' THEN 10 WHEN contains(notes, 'Hunter email pattern') THEN 5 "
                 f"WHEN trim(contact_name) <> '' THEN 3 ELSE 0 END")
BEST_MULT = f"coalesce(list_max(list_transform({mult_items()}, lambda v: {multiplier('v')})), 0.8)"
BEST_LABEL = f"coalesce(list_filter({mult_items()}, lambda v: {multiplier('v')} = {BEST_MULT})[1], 'unknown')"


def scored_cte(source: str, states, name: str = "scored") -> str:
    keep = ", ".join(c for c in ["seq", *SIGHTING_COLUMNS] if c not in ("score", "score_breakdown", "tier"))
    return f"""{name}_p AS MATERIALIZED (SELECT *, {SIGNAL_POINTS} AS p1, {COMPLIANCE_POINTS} AS p2, {geo_points(states)} AS p3,
      {ENRICH_POINTS} AS p4, CAST({BEST_MULT} AS DOUBLE) AS m, {BEST_LABEL} AS v FROM {source}),
    {name}_s AS MATERIALIZED (SELECT *, CAST(round_even((p1 + p2 + p3 + p4) * m, 0) AS INT) AS fs FROM {name}_p),
    {name} AS MATERIALIZED (SELECT {keep}, fs AS score,
      CASE WHEN fs >= 70 THEN 'HOT' WHEN fs >= 45 THEN 'WARM' WHEN fs >= 25 THEN 'NURTURE' ELSE 'PARK' END AS tier,
      'Signal:' || p1 || ' + Compliance:' || p2 || ' + Geo:' || p3 || ' + Enrich:' || p4 || ' = ' || (p1 + p2 + p3 + p4) || ' x '
      || CAST(m AS VARCHAR) || '(' || v || ') = ' || fs || ' -> ' ||
      CASE WHEN fs >= 70 THEN 'HOT' WHEN fs >= 45 THEN 'WARM' WHEN fs >= 25 THEN 'NURTURE' ELSE 'PARK' END AS score_breakdown
      FROM {name}_s)"""


# --- contacts ----------------------------------------------------------------
CHOICE = "CASE WHEN {first} THEN 1 WHEN {second} THEN 2 END"


def choice(x: str) -> str:
    return CHOICE.format(first=contains_word(x, V.FIRST_CHOICE_TITLES), second=contains_word(x, V.SECOND_CHOICE_TITLES))


BEST_BOX = f"""SELECT domain, value, first_name, last_name, position, confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {choice('position')}, coalesce(confidence, 0) DESC, pos) AS rn
  FROM {rec(I.MAILBOXES)} m WHERE pos IS NOT NULL AND {choice('position')} IS NOT NULL) WHERE rn = 1"""
PATTERNS = f"SELECT domain, max(pattern) AS pattern FROM {rec(I.MAILBOXES)} m WHERE pattern <> '' GROUP BY domain"
BEST_PERSON = f"""SELECT org_id, trim(first_name || ' ' || last_name) AS contact_name, title AS contact_title, email AS contact_email,
  'apollo' AS contact_source FROM (SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY {choice('title')}, pos) AS rn
  FROM {rec(I.PEOPLE)} p WHERE {choice('title')} IS NOT NULL) WHERE rn = 1"""

WANTED = "website <> '' AND contact_email = '' AND contact_source <> 'apollo'"


def enriched_cte(source: str, quota: int, user=(), name: str = "enriched") -> str:
    changed = {
        "contact_name": "CASE WHEN b.domain IS NOT NULL THEN trim(b.first_name || ' ' || b.last_name) ELSE q.contact_name END",
        "contact_title": "CASE WHEN b.domain IS NOT NULL THEN b.position ELSE q.contact_title END",
        "contact_email": "CASE WHEN b.domain IS NOT NULL THEN b.value ELSE q.contact_email END",
        "email_confidence": "CASE WHEN b.domain IS NOT NULL THEN b.confidence ELSE q.email_confidence END",
        "contact_source": "CASE WHEN b.domain IS NOT NULL THEN 'hunter' ELSE q.contact_source END",
        "notes": "CASE WHEN b.domain IS NULL AND p.pattern IS NOT NULL THEN CASE WHEN q.notes = '' THEN '' ELSE q.notes || chr(10) END "
                 "|| 'Hunter email pattern: ' || p.pattern || '@' || q.h ELSE q.notes END",
    }
    cols = ", ".join(f"{changed.get(c, 'q.' + c)} AS {c}" for c in SIGHTING_COLUMNS)
    return f"""{name}_w AS MATERIALIZED (SELECT *, {WANTED} AND NOT {blocked('website', user)} AS wanted FROM {source}),
    {name}_q AS MATERIALIZED (SELECT *, CASE WHEN wanted AND row_number() OVER (PARTITION BY wanted ORDER BY seq) <= {quota}
      THEN {host('website')} END AS h FROM {name}_w),
    {name} AS MATERIALIZED (SELECT CASE WHEN q.wanted THEN q.seq ELSE q.seq + 2305843009213693952 END AS seq, {cols}
      FROM {name}_q q LEFT JOIN ({BEST_BOX}) b ON q.h = b.domain LEFT JOIN ({PATTERNS}) p ON q.h = p.domain)"""


# --- upsert ------------------------------------------------------------------
UPDATABLE = [c for c in SIGHTING_COLUMNS if c not in LIST_COLUMNS and c not in ("company_name", "scraped_date")]


def match_ctes(batch: str, state: str = I.OLD_STATE) -> str:
    """CTEs ending in `hits` (seq, target) for the rows of `batch` against the old state."""
    return f"""t AS MATERIALIZED (SELECT * FROM {rec(state)} o),
    tk AS MATERIALIZED (SELECT id, {tokens('normalized_name')} AS tkey FROM t),
    b AS MATERIALIZED (SELECT *, {host('website')} AS domain, {company_key('company_name')} AS normalized_name,
      {tokens(company_key('company_name'))} AS name_key FROM {batch}),
    dm AS MATERIALIZED (SELECT b.seq, min(t.id) AS target FROM b JOIN t ON b.domain = t.domain AND b.domain <> '' GROUP BY b.seq),
    nn AS MATERIALIZED (SELECT b.seq, tk.id, b.name_key AS ka, tk.tkey AS kb FROM b JOIN tk
      ON b.name_key <> '' AND tk.tkey <> '' AND {NEAR.format(a='b.name_key', b='tk.tkey')}
      WHERE b.seq NOT IN (SELECT seq FROM dm)),
    nm AS (SELECT seq, min(id) AS target FROM nn WHERE ka = kb OR {match('ka', 'kb')} GROUP BY seq),
    hits AS MATERIALIZED (SELECT * FROM dm UNION ALL SELECT * FROM nm)"""


def placed_ctes(batch: str, state: str = I.OLD_STATE, today: str = TODAY) -> str:
    """CTEs ending in `t` (the old state and the rows that found a company) and `hits` (seq, target) of all other rows.

    `walk` takes the rows of the batch one by one. It carries the founders and the domains given so far, and the company
    of each row: a state id, or minus the number of the row that founded it.
    """
    owner = "list_filter(w.owners, lambda o: o.domain = r.domain)"
    earlier = "list_filter(r.nb, lambda n: list_contains(w.founders, n))"
    fresh = {"id": "(SELECT max(id) FROM t0) + row_number() OVER (ORDER BY seq)", "tier": "CASE WHEN tier = '' THEN 'PARK' ELSE tier END",
             "status": "'NEW'", "first_seen": today, "last_seen": today, "run_count": "CAST(1 AS INT)",
             "status_updated": "CAST(NULL AS TIMESTAMP)", "status_notes": "''"}
    from ..schemas import STATE_COLUMNS
    new = ", ".join(f"{fresh.get(c, c)} AS {c}" for c in STATE_COLUMNS)
    return f"""t0 AS MATERIALIZED (SELECT * FROM {rec(state)} o),
    tk AS MATERIALIZED (SELECT id, {tokens('normalized_name')} AS tkey FROM t0),
    b AS MATERIALIZED (SELECT *, {host('website')} AS domain, {company_key('company_name')} AS normalized_name,
      {tokens(company_key('company_name'))} AS name_key, row_number() OVER (ORDER BY seq) AS k FROM {rec(batch)} q),
    dm AS (SELECT b.k, min(t0.id) AS id FROM b JOIN t0 ON b.domain = t0.domain AND b.domain <> '' GROUP BY b.k),
    nn AS MATERIALIZED (SELECT b.k, tk.id, b.name_key AS ka, tk.tkey AS kb FROM b JOIN tk
      ON b.name_key <> '' AND tk.tkey <> '' AND {NEAR.format(a='b.name_key', b='tk.tkey')}),
    nm AS (SELECT k, min(id) AS id FROM nn WHERE ka = kb OR {match('ka', 'kb')} GROUP BY k),
    bb AS MATERIALIZED (SELECT y.k, x.k AS a, x.name_key AS ka, y.name_key AS kb FROM b x JOIN b y
      ON x.k < y.k AND x.name_key <> '' AND y.name_key <> '' AND {NEAR.format(a='x.name_key', b='y.name_key')}),
    nb AS (SELECT k, list(a ORDER BY a) AS nb FROM bb WHERE ka = kb OR {match('ka', 'kb')} GROUP BY k),
    r AS MATERIALIZED (SELECT b.k, b.domain, dm.id AS by_domain, nm.id AS by_name, coalesce(s.domain = '', false) AS bare, coalesce(nb.nb, CAST([] AS BIGINT[])) AS nb,
      b.domain = '' AS blank FROM b LEFT JOIN dm USING (k) LEFT JOIN nm USING (k) LEFT JOIN t0 s ON s.id = nm.id LEFT JOIN nb USING (k)),
    walk(k, company, founders, blanks, owners) AS (
      SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST([] AS STRUCT(domain VARCHAR, company BIGINT)[])
      UNION ALL
      SELECT k, CASE how WHEN 0 THEN by_domain WHEN 1 THEN owned WHEN 2 THEN by_name WHEN 3 THEN -first ELSE -k END,
        CASE WHEN how = 4 THEN list_append(founders, k) ELSE founders END,
        CASE WHEN how = 4 AND blank THEN list_append(blanks, k) ELSE blanks END,
        CASE WHEN NOT blank AND how = 4 THEN list_append(owners, {{'domain': domain, 'company': -k}})
             WHEN NOT blank AND how = 2 AND bare AND len(list_filter(owners, lambda o: o.company = by_name)) = 0
               THEN list_append(owners, {{'domain': domain, 'company': by_name}})
             WHEN NOT blank AND how = 3 AND list_contains(blanks, first) AND len(list_filter(owners, lambda o: o.company = -first)) = 0
               THEN list_append(owners, {{'domain': domain, 'company': -first}}) ELSE owners END
      FROM (SELECT r.*, w.founders, w.blanks, w.owners, {owner}[1].company AS owned, {earlier}[1] AS first,
              CASE WHEN r.by_domain IS NOT NULL THEN 0 WHEN NOT r.blank AND len({owner}) > 0 THEN 1 WHEN r.by_name IS NOT NULL THEN 2
                   WHEN len({earlier}) > 0 THEN 3 ELSE 4 END AS how
            FROM walk w JOIN r ON r.k = w.k + 1)),
    fresh AS MATERIALIZED (SELECT b.k, {new} FROM b JOIN walk w ON w.k = b.k AND w.company = -b.k),
    t AS MATERIALIZED (SELECT * FROM t0 UNION ALL SELECT * EXCLUDE (k) FROM fresh),
    hits AS MATERIALIZED (SELECT b.seq, CASE WHEN w.company > 0 THEN w.company ELSE f.id END AS target
      FROM walk w JOIN b ON b.k = w.k LEFT JOIN fresh f ON f.k = -w.company WHERE w.company <> -b.k)"""


def upsert_ctes(today: str = TODAY) -> str:
    """CTEs ending in `next_state`, from `b`, `t` and `hits`."""
    fold = ", ".join(f"{first_filled(c)} AS n_{c}" for c in UPDATABLE)
    changed = {c: f"CASE WHEN f.id IS NULL THEN t.{c} ELSE array_to_string(list_sort(list_distinct(list_concat({items('t.' + c)}, f.u_{c}))), ', ') END"
               for c in LIST_COLUMNS}
    for c in UPDATABLE:
        blank = "''" if TYPES[c] == "string" else "0"
        changed[c] = f"coalesce(nullif(t.{c}, {blank}), f.n_{c}, t.{c})"
    changed["domain"] = "coalesce(nullif(t.domain, ''), f.n_domain, t.domain)"
    changed["last_seen"] = f"CASE WHEN f.id IS NULL THEN t.last_seen ELSE {today} END"
    changed["run_count"] = "CAST(t.run_count + coalesce(f.n, 0) AS INT)"
    from ..schemas import STATE_COLUMNS
    old = ", ".join(f"{changed.get(c, 't.' + c)} AS {c}" for c in STATE_COLUMNS)
    fresh = {"id": "(SELECT max(id) FROM t) + row_number() OVER (ORDER BY seq)", "tier": "CASE WHEN tier = '' THEN 'PARK' ELSE tier END",
             "status": "'NEW'", "first_seen": today, "last_seen": today, "run_count": "CAST(1 AS INT)",
             "status_updated": "CAST(NULL AS TIMESTAMP)", "status_notes": "''"}
    new = ", ".join(f"{fresh.get(c, c)} AS {c}" for c in STATE_COLUMNS)
    return f"""m AS MATERIALIZED (SELECT b.*, h.target FROM b JOIN hits h ON b.seq = h.seq),
    f AS MATERIALIZED (SELECT target AS id, count(*) AS n, {fold},
      arg_min(domain, seq) FILTER (WHERE domain <> '') AS n_domain,
      {', '.join(f"flatten(list({items(c)})) AS u_{c}" for c in LIST_COLUMNS)} FROM m GROUP BY target),
    old_rows AS (SELECT {old} FROM t LEFT JOIN f ON t.id = f.id),
    new_rows AS (SELECT {new} FROM b WHERE seq NOT IN (SELECT seq FROM hits)),
    next_state AS (SELECT * FROM old_rows UNION ALL SELECT * FROM new_rows)"""
