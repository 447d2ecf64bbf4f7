"""One query per operator, over the whole derived tables, with its expected result as SQL where SQL can say it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import hosts, names, text
from ..operators import contacts, firsthit, fuzzy, merge, postings, reports, requests, resolve, scoring, upsert
from ..plans import channels, runs
from ..schemas import (
    CONTACT_COLUMNS, DOMAIN_RESPONSE, FILL_COLUMNS, LIST_COLUMNS, ORGANISATION_RESPONSE, PEOPLE_RESPONSE,
    RUN_SCHEMA, SEARCH_RESPONSE, SIGHTING_COLUMNS, STATE_COLUMNS, STATE_SCHEMA, VERIFICATION_RESPONSE,
)
from ..session import cut, row_order, work_folder
from ..settings import Settings
from ..sources import responses, tables
from . import inputs as I
from . import sqltext as Q

TODAY = dt.date(2024, 4, 1)
RUN_DAY = dt.date(2024, 3, 1)
NOW = dt.datetime(2024, 4, 1, 12)
USER_BLOCKED = ("cheap-pills.example.com", " SPAM-farm.example.org ", "")
CLEAN_USER = ["cheap-pills.example.com", "spam-farm.example.org"]
SETTINGS = Settings(user_blocked=USER_BLOCKED)
STATES = requests.resolve_states(SETTINGS)
QUOTA = 40

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function as the query of its name, with the SQL of its expected result."""
    def add(build):
        QUERIES[build.__name__] = I.deriving_once(build)
        if sql is not None:
            SQL[build.__name__] = sql
        return build
    return add


def D(spark: SparkSession, folder: str, recipe: str) -> DataFrame:
    return I.derive(spark, folder, recipe)


def hits(spark, sf):
    return D(spark, sf, I.HITS)


def sightings(spark, sf):
    return D(spark, sf, I.SIGHTINGS)


def state(spark, sf):
    return D(spark, sf, I.STATE)


H, S, T, O, P, M = (Q.rec(r) for r in (I.HITS, I.SIGHTINGS, I.STATE, I.ORGANISATIONS, I.PEOPLE, I.MAILBOXES))
ALL_STATE = ", ".join(STATE_COLUMNS)
ALL_SIGHTING = ", ".join(SIGHTING_COLUMNS)

# ---------------------------------------------------------------- sources ----
RESPONSES = f"""
SELECT page_id AS query_seq, 'web_search' AS channel, 'food' AS vertical, 'k' AS keyword,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, url AS link, {I.PAGE_TEXT} AS snippet
FROM pages
"""


def search_lines(spark, sf, shape: str) -> DataFrame:
    """Saved search responses as JSON text: three hits per page, the last without snippet."""
    base = D(spark, sf, RESPONSES)
    hit = lambda n, snippet: F.struct(F.concat("title", F.lit(f" #{n}")).alias("title"), F.col("link"), snippet.alias("snippet"))
    found = F.array(hit(0, F.col("snippet")), hit(1, F.col("snippet")), hit(2, F.lit(None).cast("string")))
    body = F.struct("query_seq", "channel", "vertical", "keyword", found.alias(shape))
    return base.select(F.to_json(body).alias("value"))


def search_sql(shape: str) -> str:
    one = (f"SELECT query_seq * 65536 + {{n}} AS seq, channel, vertical, keyword, title || ' #{{n}}' AS title, link, "
           f"{{s}} AS snippet FROM {Q.rec(RESPONSES)} r")
    return " UNION ALL ".join(one.format(n=n, s="snippet" if n < 2 else "''") for n in range(3))


@query(search_sql("organic_results"))
def source_search_hits_shape_a(spark, sf):
    return responses.search_hits(responses.parse_responses(search_lines(spark, sf, "organic_results"), SEARCH_RESPONSE), "serpapi")


@query(search_sql("organic"))
def source_search_hits_shape_b(spark, sf):
    return responses.search_hits(responses.parse_responses(search_lines(spark, sf, "organic"), SEARCH_RESPONSE), "serper")


@query(search_sql("organic"))
def source_search_hits_any_shape(spark, sf):
    return responses.search_hits(responses.parse_responses(search_lines(spark, sf, "organic"), SEARCH_RESPONSE))


DAMAGE = {0: "broken", 1: "no object", 2: "blank", 3: "wrong type", 4: "lacks a field"}


@query(f"""SELECT query_seq, CASE query_seq % 13 {' '.join(f"WHEN {k} THEN '{v}'" for k, v in DAMAGE.items())} ELSE 'kept' END AS outcome,
  CAST(CASE WHEN query_seq % 13 < {len(DAMAGE)} THEN 0 ELSE 3 END AS BIGINT) AS hits FROM {Q.rec(RESPONSES)} r""")
def source_quarantine(spark, sf):
    """Every third of the saved responses is damaged in one of five ways; each line is either read or put aside with a reason."""
    seq = F.get_json_object("value", "$.query_seq").cast("bigint")
    lines = search_lines(spark, sf, "organic_results").withColumn("line", seq)
    way, value = F.col("line") % 13, F.col("value")
    damaged = (F.when(way == 0, F.substr(value, F.lit(1), F.floor(F.char_length("value") / 2).cast("int"))).when(way == 1, F.lit("[1, 2]")).when(way == 2, F.lit("  "))
               .when(way == 3, F.regexp_replace("value", r'"channel":"[^"]*"', '"channel":"web_search","organic":"none"'))
               .when(way == 4, F.regexp_replace("value", r'"channel":"[^"]*",', "")).otherwise(value))
    kept, aside = responses.sorted_out(cut(lines.select("line", damaged.alias("value")), "lines"), SEARCH_RESPONSE, ["query_seq", "channel"])
    hits = responses.search_hits(kept, "serpapi").groupBy(F.floor(F.col("seq") / responses.POSITIONS).alias("query_seq")).agg(F.count(F.lit(1)).alias("hits"))
    read = kept.select("query_seq").join(hits, "query_seq", "left").select("query_seq", F.lit("kept").alias("outcome"), F.coalesce("hits", F.lit(0)).alias("hits"))
    return read.unionByName(aside.select(F.col("line").alias("query_seq"), F.col("reason").alias("outcome"), F.lit(0).cast("bigint").alias("hits")))


def organisation_lines(spark, sf) -> DataFrame:
    o = D(spark, sf, I.ORGANISATIONS)
    org = F.struct(
        F.col("org_id").alias("id"), "name", "phone", "sanitized_phone", "primary_domain", "organization_revenue",
        "organization_revenue_printed", F.split("product_keywords", ", ").alias("keywords"))
    return o.select(F.to_json(F.struct(F.col("seq").alias("query_seq"), "vertical", "keyword", F.array(org).alias("organizations"))).alias("value"))


@query(f"SELECT seq * 65536 AS seq, vertical, keyword, org_id, name, phone, sanitized_phone, primary_domain, organization_revenue, "
       f"organization_revenue_printed, product_keywords FROM {O} o")
def source_organisations(spark, sf):
    return responses.organisations(responses.parse_responses(organisation_lines(spark, sf), ORGANISATION_RESPONSE))


PEOPLE_LISTS = """
SELECT o_orderkey, o_clerk_a, o_clerk_b FROM (
  SELECT o_orderkey, 'Logistics ' || o_orderpriority AS o_clerk_a, 'Buyer ' || o_orderstatus AS o_clerk_b FROM orders) x
"""


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS org_id, CAST(0 AS INT) AS pos, 'A' AS first_name, '' AS last_name, o_clerk_a AS title, 'a@b.c' AS email "
       f"FROM {Q.rec(PEOPLE_LISTS)} p UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(1 AS INT), 'B', 'C', o_clerk_b, '' FROM {Q.rec(PEOPLE_LISTS)} p")
def source_people(spark, sf):
    base = D(spark, sf, PEOPLE_LISTS)
    person = lambda first, last, title, mail: F.struct(
        F.lit(first).alias("first_name"), F.lit(last).cast("string").alias("last_name"), F.col(title).alias("title"),
        F.lit(mail).cast("string").alias("email"))
    body = F.struct(F.col("o_orderkey").cast("string").alias("org_id"),
                    F.array(person("A", None, "o_clerk_a", "a@b.c"), person("B", "C", "o_clerk_b", None)).alias("people"))
    return responses.people(responses.parse_responses(base.select(F.to_json(body).alias("value")), PEOPLE_RESPONSE))


@query(f"SELECT domain, pattern, CAST(CASE WHEN pos IS NULL THEN NULL ELSE 0 END AS INT) AS pos, value, first_name, last_name, position, "
       f"confidence FROM {M} m")
def source_domain_contacts(spark, sf):
    m = D(spark, sf, I.MAILBOXES)
    box = F.struct("value", "first_name", "last_name", "position", "confidence")
    boxes = F.when(F.col("pos").isNotNull(), F.array(box))
    lines = m.select(F.to_json(F.struct("domain", F.struct("pattern", boxes.alias("emails")).alias("data"))).alias("value"))
    return responses.mailboxes(responses.parse_responses(lines, DOMAIN_RESPONSE))


ANSWERS = """
SELECT DISTINCT 'p' || CAST(doc_id AS STRING) || '@x.com' AS email,
       CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'valid' WHEN 2 THEN 'invalid' ELSE 'accept_all' END AS answer
FROM documents
"""


def answer_table(spark, sf) -> DataFrame:
    data = F.when(F.col("answer").isNotNull(), F.struct(F.col("answer").alias("status")))
    lines = D(spark, sf, ANSWERS).select(F.to_json(F.struct("email", data.alias("data"))).alias("value"))
    return responses.verifications(responses.parse_responses(lines, VERIFICATION_RESPONSE))


VERIFIED = f"SELECT email, coalesce(answer, 'unknown') AS verified FROM {Q.rec(ANSWERS)} a"


@query(VERIFIED)
def source_verifications(spark, sf):
    return answer_table(spark, sf)


@query(f"SELECT {ALL_STATE} FROM {T} t")
def source_state_table(spark, sf):
    root = f"{work_folder(spark)}/state-{uuid.uuid4().hex}"
    tables.write_state(state(spark, sf), root)
    return tables.read_state(spark, root).select(*STATE_COLUMNS)


@query(f"SELECT * FROM {Q.rec(I.RUNS)} r")
def source_run_history(spark, sf):
    path = f"{work_folder(spark)}/runs-{uuid.uuid4().hex}"
    D(spark, sf, I.RUNS).write.parquet(path)
    return tables.read_runs(spark, path)


@query(f"SELECT seq, {ALL_SIGHTING} FROM {S} s")
def source_stage_snapshot(spark, sf):
    folder = f"{work_folder(spark)}/run-{uuid.uuid4().hex}"
    tables.write_stage(sightings(spark, sf), folder, "dedup", 3)
    return tables.read_stage(spark, folder, "dedup").select("seq", *SIGHTING_COLUMNS)


# ------------------------------------------------------------------ sinks ----
@query(f"SELECT {', '.join(f'coalesce(CAST({c} AS VARCHAR), {chr(39)*2}) AS {c}' for c in STATE_COLUMNS)} FROM {T} t")
def sink_csv_export(spark, sf):
    """Every column of the report as read back, notes with line breaks included."""
    path = f"{work_folder(spark)}/report-{uuid.uuid4().hex}"
    tables.write_report(state(spark, sf), path)
    return tables.read_report(spark, path).select(*[F.coalesce(c, F.lit("")).alias(c) for c in STATE_COLUMNS])


SHEET = ", ".join(V.SHEET_COLUMNS)
ORDER = "ORDER BY score DESC, id"


@query(f"SELECT {SHEET} FROM {T} t WHERE first_seen = DATE '2024-03-01' {ORDER}")
def sink_new_this_run(spark, sf):
    return reports.sheet(state(spark, sf).filter(F.col("first_seen") == F.lit(RUN_DAY)))


@query(f"SELECT {SHEET} FROM {T} t {ORDER}")
def sink_full_sheet(spark, sf):
    return reports.sheet(state(spark, sf))


@query(f"""WITH t AS MATERIALIZED (SELECT * FROM {T} q),
  fresh AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rn FROM t WHERE first_seen = DATE '2024-03-01')
SELECT 'Status Breakdown' AS section, CAST(rn AS INT) AS pos, status AS key, CAST(n AS VARCHAR) AS value FROM (
  SELECT status, count(*) AS n, row_number() OVER (ORDER BY status) AS rn FROM t GROUP BY status) WHERE rn <= 8
UNION ALL SELECT 'Tier Distribution', CAST(rn AS INT), tier, CAST(n AS VARCHAR) FROM (
  SELECT tier, count(*) AS n, row_number() OVER (ORDER BY tier) AS rn FROM t GROUP BY tier) WHERE rn <= 5
UNION ALL SELECT 'Run Summary', 1, 'New', CAST(count(*) AS VARCHAR) FROM fresh
UNION ALL SELECT 'Run Summary', 2, 'Returning', CAST(count(*) AS VARCHAR) FROM t WHERE first_seen <> DATE '2024-03-01'
UNION ALL SELECT 'Run Summary', 3, 'Total', CAST(count(*) AS VARCHAR) FROM t
UNION ALL SELECT 'Top New Prospects', CAST(rn AS INT), company_name,
  concat_ws(' | ', state, vertical, CAST(score AS VARCHAR), tier, contact_email) FROM fresh WHERE rn <= 10""")
def sink_dashboard(spark, sf):
    return reports.dashboard(state(spark, sf), RUN_DAY)


@query(f"SELECT * FROM {Q.rec(I.RUNS)} r ORDER BY run_date DESC, id DESC")
def sink_run_log(spark, sf):
    return tables.latest_first(D(spark, sf, I.RUNS))


@query(f"""WITH t AS MATERIALIZED (SELECT * FROM {T} q), fresh AS (SELECT * FROM t WHERE first_seen = DATE '2024-03-01')
SELECT 'all' AS report, count(*) AS n, CAST(sum(score) AS BIGINT) AS total FROM t
UNION ALL SELECT 'full', count(*), CAST(sum(score) AS BIGINT) FROM t
UNION ALL SELECT 'new_this_run', count(*), CAST(sum(score) AS BIGINT) FROM fresh
UNION ALL SELECT 'dashboard', least(8, (SELECT count(DISTINCT status) FROM t)) + least(5, (SELECT count(DISTINCT tier) FROM t)) + 3 + least(10, (SELECT count(*) FROM fresh)), NULL
UNION ALL SELECT 'run_log', 1, (SELECT count(*) FROM t)""")
def sink_published_reports(spark, sf):
    """The report files of a state and its run history as read back."""
    home = f"{work_folder(spark)}/home-{uuid.uuid4().hex}"
    tables.write_state(state(spark, sf), f"{home}/state")
    tables.append_run(spark, f"{home}/history", raw_count=tables.read_state(spark, f"{home}/state").count())
    runs.publish(spark, home, RUN_DAY)
    folder = f"{home}/reports/{RUN_DAY}"
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    parts = [("all", tables.read_report(spark, f"{folder}/all"), "score"), ("full", read("full"), "score"), ("new_this_run", read("new_this_run"), "score"),
             ("dashboard", read("dashboard").withColumn("none", F.lit(None)), "none"), ("run_log", read("run_log"), "raw_count")]
    counted = [rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(of).cast("bigint")).alias("total")).select(F.lit(name).alias("report"), "n", "total")
               for name, rows, of in parts]
    return reduce(DataFrame.unionByName, counted)


def published(spark, sf, report: str) -> DataFrame:
    """Rows of a report of the state as they stand in its files, numbered in that order."""
    home = f"{work_folder(spark)}/home-{uuid.uuid4().hex}"
    tables.write_state(state(spark, sf), f"{home}/state")
    for n in (3, 1, 2):
        tables.append_run(spark, f"{home}/history", raw_count=n, run_date=dt.datetime(2024, 1, n), states_used=f"S{n}")
    runs.publish(spark, home, RUN_DAY)
    return tables.in_written_order(spark, f"{home}/reports/{RUN_DAY}/{report}")


@query(f"SELECT {SHEET}, row_number() OVER ({ORDER}) AS position FROM {T} t")
def sink_written_full_sheet(spark, sf):
    return published(spark, sf, "full")


@query(f"SELECT {SHEET}, row_number() OVER ({ORDER}) AS position FROM {T} t WHERE first_seen = DATE '2024-03-01'")
def sink_written_new_sheet(spark, sf):
    return published(spark, sf, "new_this_run")


@query(SQL["sink_dashboard"])
def sink_written_dashboard(spark, sf):
    return published(spark, sf, "dashboard").drop("position")


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), 1, 3, 'S3'), (2, 3, 1, 'S1'), (3, 2, 2, 'S2')) v(id, position, raw_count, states_used)")
def sink_written_run_log(spark, sf):
    return published(spark, sf, "run_log").select("id", "position", "raw_count", "states_used")


@query(f"""SELECT module, stage_no, CAST(credits AS INT) AS credits_used, count(*) AS companies FROM {S} s,
  (SELECT 'apollo' AS module, '04' AS stage_no, 7 AS credits UNION ALL SELECT 'other', '99', 0) m GROUP BY ALL""")
def sink_stage_write(spark, sf):
    folder = f"{work_folder(spark)}/run-{uuid.uuid4().hex}"
    rows = sightings(spark, sf)
    tables.write_stage(rows, folder, "apollo", 7)
    tables.write_stage(rows, folder, "other")
    return tables.read_all_stages(spark, folder).groupBy("module", "stage_no", "credits_used").agg(F.count(F.lit(1)).alias("companies"))


@query(f"""WITH t AS (SELECT * FROM {T} q) SELECT CAST(2 AS BIGINT) AS id, count(*) AS raw_count,
  count(*) FILTER (WHERE tier = 'HOT') AS hot_count, avg(nullif(score, 0)) AS avg_score FROM t
  UNION ALL SELECT 1, 0, 0, 0.0""")
def sink_run_append(spark, sf):
    path = f"{work_folder(spark)}/runs-{uuid.uuid4().hex}"
    tables.append_run(spark, path)
    rows = state(spark, sf)
    figures = rows.agg(F.count(F.lit(1)).alias("raw_count"), F.count_if(F.col("tier") == "HOT").alias("hot_count"),
                       F.avg(F.nullif("score", F.lit(0))).alias("avg_score")).first().asDict()
    tables.append_run(spark, path, **figures)
    return tables.read_runs(spark, path).select("id", "raw_count", "hot_count", "avg_score")


# --------------------------------------------------------------- requests ----
def keyword_rows(spark, sf) -> DataFrame:
    return D(spark, sf, I.KEYWORDS)


K = Q.rec(I.KEYWORDS)


def state_values(states) -> str:
    return "(VALUES " + ", ".join(f"({i}, '{s}')" for i, s in enumerate(states)) + ") st(spos, state)"


@query(f"SELECT vertical, vpos, kpos, CAST(spos AS INT) AS spos, keyword, state, keyword || ' ' || state AS query FROM {K} k, {state_values(STATES)}")
def requests_web(spark, sf):
    return requests.web_requests(keyword_rows(spark, sf), STATES)


TERMS = "SELECT item_id AS pos, text AS term FROM benchmark"


@query("SELECT item_id AS pos, text AS query FROM benchmark")
def requests_signal(spark, sf):
    return requests.signal_requests(D(spark, sf, TERMS))


@query(f"""SELECT vertical, vpos, kpos, keyword, CAST(0 AS INT) AS qpos, 'site:importyeti.com "' || keyword || '"' AS query FROM {K} k
  UNION ALL SELECT vertical, vpos, kpos, keyword, CAST(1 AS INT), '"' || keyword || '" manufacturer importer USA' FROM {K} k""")
def requests_import(spark, sf):
    return requests.import_requests(keyword_rows(spark, sf))


@query(f"SELECT vertical, vpos, kpos, keyword, CAST(page AS INT) AS page FROM {K} k, (SELECT unnest(range(1, 5)) AS page) QUALIFY row_number() OVER (PARTITION BY vertical, page ORDER BY kpos) <= 3")
def requests_organisation(spark, sf):
    return requests.organisation_requests(keyword_rows(spark, sf), 4)


@query(f"""SELECT 'web_search' AS channel, CAST(count(*) * {len(STATES)} AS BIGINT) AS calls FROM {K} k
  UNION ALL SELECT 'sqep', count(*) FROM benchmark UNION ALL SELECT 'import_search', CAST(2 * count(*) AS BIGINT) FROM {K} k""")
def requests_counts(spark, sf):
    kw = keyword_rows(spark, sf)
    return requests.request_counts(kw, D(spark, sf, TERMS), kw, STATES)


TWO_LISTS = requests.resolve_states(SETTINGS, "northeast, south_central")


@query(f"SELECT state, CAST(list_position([{Q.quoted(TWO_LISTS)}], state) AS INT) AS place, count(*) AS companies FROM {S} s "
       f"WHERE state IN ({Q.quoted(TWO_LISTS)}) GROUP BY state")
def requests_target_states(spark, sf):
    place = F.array_position(F.array(*[F.lit(s) for s in TWO_LISTS]), F.col("state")).cast("int")
    rows = sightings(spark, sf).filter(F.col("state").isin(TWO_LISTS))
    return rows.groupBy("state", place.alias("place")).agg(F.count(F.lit(1)).alias("companies"))


@query(f"SELECT vertical, keyword FROM {K} k WHERE vertical IN ('Brand#1', 'Brand#7')")
def requests_vertical_filter(spark, sf):
    return requests.only_verticals(D(spark, sf, I.KEYWORDS), ["Brand#1", "Brand#7", "none"]).select("vertical", "keyword")


@query(f"SELECT seq, channel FROM {H} h WHERE channel IN ('web_search', 'sqep')")
def requests_channel_filter(spark, sf):
    return requests.only_channels(hits(spark, sf), None, ["web_search", "sqep"]).select("seq", "channel")


# ---------------------------------------------------------------- filters ----
@query(f"SELECT seq, host, {Q.blocked('host', CLEAN_USER)} AS blocked FROM (SELECT seq, {Q.host('link')} AS host FROM {H} h)")
def filter_blocked_domain(spark, sf):
    h = hits(spark, sf).select("seq", hosts.host("link").alias("host"))
    return h.withColumn("blocked", hosts.is_blocked("host", USER_BLOCKED))


@query(f"SELECT seq, link FROM {H} h WHERE len(list_filter([{Q.quoted(CLEAN_USER)}], lambda u: {Q.host('link')} = u OR ends_with({Q.host('link')}, '.' || u))) > 0")
def filter_user_block_list(spark, sf):
    only_user = hosts._ends_on(hosts.host("link"), hosts.clean_block_list(USER_BLOCKED), proper=False)
    return hits(spark, sf).filter(only_user).select("seq", "link")


USABLE = f"(SELECT * FROM (SELECT *, {Q.host('link')} AS host FROM {H} h) WHERE NOT {Q.blocked('host', CLEAN_USER)})"


@query(f"SELECT seq, host FROM {USABLE} u")
def filter_usable_hits(spark, sf):
    return channels.usable_hits(hits(spark, sf), USER_BLOCKED).select("seq", "host")


@query(f"SELECT seq, signals FROM (SELECT seq, {Q.signal_text('title', 'snippet')} AS signals FROM {H} h) WHERE signals <> ''")
def filter_signal_hits(spark, sf):
    found = hits(spark, sf).withColumn("s", text.detect_signals("title", "snippet")).filter(F.size("s") > 0)
    return found.select("seq", F.array_join("s", ", ").alias("signals"))


@query(f"SELECT seq, name FROM (SELECT seq, {Q.index_name('title')} AS name FROM {H} h) WHERE name <> ''")
def filter_import_titles(spark, sf):
    return hits(spark, sf).select("seq", hosts.name_from_import_title("title").alias("name")).filter("name <> ''")


REV = Q.revenue("organization_revenue", "organization_revenue_printed")


@query(f"SELECT seq, r AS revenue FROM (SELECT seq, {REV} AS r FROM {O} o) WHERE r IS NULL OR r BETWEEN 5000000 AND 500000000")
def filter_revenue_range(spark, sf):
    orgs = D(spark, sf, I.ORGANISATIONS).select("seq", text.revenue("organization_revenue", "organization_revenue_printed").alias("revenue"))
    return orgs.filter(channels.revenue_in_range(F.col("revenue"), SETTINGS))


@query(f"SELECT seq, phone FROM {O} o WHERE NOT (starts_with(phone, '+') AND NOT starts_with(phone, '+1'))")
def filter_foreign_phone(spark, sf):
    return D(spark, sf, I.ORGANISATIONS).filter(~channels.is_foreign_phone(F.col("phone"))).select("seq", "phone")


@query(f"SELECT seq, primary_domain FROM {O} o WHERE NOT {Q.blocked('primary_domain', CLEAN_USER)}")
def filter_organisation_domain(spark, sf):
    return D(spark, sf, I.ORGANISATIONS).filter(~hosts.is_blocked("primary_domain", USER_BLOCKED)).select("seq", "primary_domain")


@query(f"SELECT seq, {Q.WANTED} AND NOT {Q.blocked('website')} AS is_candidate FROM {S} s")
def filter_contact_candidates(spark, sf):
    return sightings(spark, sf).select("seq", contacts.is_searchable().alias("is_candidate"))


@query(f"SELECT {ALL_STATE} FROM {T} t WHERE status = 'QUEUED' {ORDER}")
def filter_by_status(spark, sf):
    return reports.with_status(state(spark, sf), "QUEUED")


@query(f"SELECT {ALL_STATE} FROM {T} t WHERE first_seen = DATE '2024-03-01' {ORDER}")
def filter_new_this_run(spark, sf):
    return reports.new_on(state(spark, sf), RUN_DAY)


NEEDS = "contact_email <> '' AND coalesce(email_verified, '') = '' AND tier IN ('HOT', 'WARM')"


@query(f"SELECT id, contact_email, score FROM {T} t WHERE {NEEDS}")
def filter_needs_verification(spark, sf):
    return reports.needs_verification(state(spark, sf), ["HOT", "WARM"]).select("id", "contact_email", "score")


def term_sql(term: str) -> str:
    folded = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return "(" + " OR ".join(f"{folded.format(c)} LIKE '%{term.lower()}%'" for c in V.SEARCH_COLUMNS) + ")"


@query(f"SELECT {ALL_STATE} FROM {T} t WHERE {term_sql('FOOD')} AND {term_sql('tx')} {ORDER}")
def filter_keyword_search(spark, sf):
    return reports.by_score(upsert.search(state(spark, sf), " FOOD  tx "))


SEARCHES = {"common": " FOOD  tx ", "long": "Hunter pattern", "wild": "kw_, f%d", "short": "y x 2", "none": "zq!zq"}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS search, id, normalized_name FROM {T} t WHERE {' AND '.join(term_sql(term) for term in terms.split())}" for name, terms in SEARCHES.items()))
def filter_keyword_postings(spark, sf):
    """Searches answered from postings that two versions of the state were listed in."""
    now, listed = cut(state(spark, sf), "state"), postings.Postings(spark, f"{work_folder(spark)}/postings-{uuid.uuid4().hex}")
    I.drop_shared()
    before = now.filter("id % 2 = 1").withColumn("notes", F.when(F.col("id") % 3 == 0, F.lit("zq!zq")).otherwise(F.col("notes")))
    listed.extend(before, 1)
    listed.extend(now, 2, before)
    found = [listed.search(now, terms, 2).select(F.lit(name).alias("search"), "id", "normalized_name") for name, terms in SEARCHES.items()]
    return reduce(DataFrame.unionByName, found)


@query(f"SELECT id, normalized_name FROM {T} t WHERE lower(normalized_name) LIKE '%the%'")
def filter_name_contains(spark, sf):
    return state(spark, sf).filter(upsert.name_contains("the")).select("id", "normalized_name")


@query(f"SELECT seq, CASE WHEN state = '' AND notes <> '' THEN {Q.state_of('notes')} ELSE state END AS state FROM {S} s")
def filter_state_from_notes(spark, sf):
    return runs.with_states(sightings(spark, sf)).select("seq", "state")


# ------------------------------------------------------------------ joins ----
@query(f"SELECT domain, min(seq) AS head, count(*) AS n FROM (SELECT seq, {Q.host('website')} AS domain FROM {S} s) WHERE domain <> '' GROUP BY domain")
def join_domain_heads(spark, sf):
    keyed = sightings(spark, sf).select("seq", hosts.host("website").alias("domain")).filter("domain <> ''")
    return keyed.groupBy("domain").agg(F.min("seq").alias("head"), F.count(F.lit(1)).alias("n"))


def name_keys(spark, sf) -> DataFrame:
    keyed = sightings(spark, sf).select("seq", names.sorted_tokens(names.company_key("company_name")).alias("name_key"))
    return keyed.filter("name_key <> ''").groupBy("name_key").agg(F.min("seq").alias("ord"))


@query(f"""WITH k AS MATERIALIZED (SELECT {Q.tokens(Q.company_key('company_name'))} AS key, min(seq) AS ord FROM {S} s GROUP BY 1),
  near AS MATERIALIZED (SELECT x.ord AS a, y.ord AS b, x.key AS ka, y.key AS kb FROM k x JOIN k y
    ON x.ord < y.ord AND x.key <> '' AND y.key <> '' AND {Q.NEAR.format(a='x.key', b='y.key')})
  SELECT a, b FROM near WHERE {Q.match('ka', 'kb')}""")
def join_fuzzy_names(spark, sf):
    keys = cut(name_keys(spark, sf), "keys")
    number = keys.count()
    prepared = cut(fuzzy.prepared(keys, float(number) ** 2), "keys")
    return fuzzy.matching_self(prepared, fuzzy.signature_width(number), small=number <= fuzzy.SMALL_SET)


@query(f"""WITH RECURSIVE k AS MATERIALIZED (SELECT {Q.tokens(Q.company_key('company_name'))} AS key, min(seq) AS ord FROM {S} s GROUP BY 1 HAVING key <> ''),
  near AS MATERIALIZED (SELECT x.ord AS a, y.ord AS b, x.key AS ka, y.key AS kb FROM k x JOIN k y
    ON x.ord < y.ord AND {Q.NEAR.format(a='x.key', b='y.key')}),
  adj AS MATERIALIZED (SELECT b, list(a ORDER BY a) AS nb, row_number() OVER (ORDER BY b) AS n FROM near WHERE {Q.match('ka', 'kb')} GROUP BY b),
  walk(n, b, lead, gone) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[])
    UNION ALL SELECT adj.n, adj.b, list_filter(adj.nb, lambda a: NOT list_contains(walk.gone, a))[1],
      CASE WHEN len(list_filter(adj.nb, lambda a: NOT list_contains(walk.gone, a))) > 0 THEN list_append(walk.gone, adj.b) ELSE walk.gone END
    FROM walk JOIN adj ON adj.n = walk.n + 1)
  SELECT ord, key AS name_key, coalesce(lead, ord) AS leader, count(*) OVER (PARTITION BY coalesce(lead, ord)) AS members FROM k LEFT JOIN walk ON k.ord = walk.b""")
def join_fuzzy_groups(spark, sf):
    """The matches of all names as groups: one row a name, whatever the size of a crowd."""
    return resolve.name_groups(cut(name_keys(spark, sf), "keys"))


def keyed_batch(spark, sf) -> DataFrame:
    return D(spark, sf, I.BATCH).select(
        "seq", hosts.host("website").alias("domain"), names.sorted_tokens(names.company_key("company_name")).alias("name_key"))


@query(f"""SELECT b.seq, min(t.id) AS target FROM (SELECT seq, {Q.host('website')} AS domain FROM {Q.rec(I.BATCH)} q) b
  JOIN {Q.rec(I.OLD_STATE)} t ON b.domain = t.domain AND b.domain <> '' GROUP BY b.seq""")
def join_state_by_domain(spark, sf):
    return upsert.domain_matches(keyed_batch(spark, sf), D(spark, sf, I.OLD_STATE))


@query(f"""WITH b AS MATERIALIZED (SELECT seq, {Q.tokens(Q.company_key('company_name'))} AS ka FROM {Q.rec(I.BATCH)} q),
  t AS MATERIALIZED (SELECT id, {Q.tokens('normalized_name')} AS kb FROM {Q.rec(I.OLD_STATE)} q),
  near AS MATERIALIZED (SELECT seq, id, ka, kb FROM b JOIN t ON ka <> '' AND kb <> '' AND {Q.NEAR.format(a='ka', b='kb')})
  SELECT seq, min(id) AS target FROM near WHERE {Q.match('ka', 'kb')} GROUP BY seq""")
def join_state_by_name(spark, sf):
    return upsert.name_matches(keyed_batch(spark, sf), D(spark, sf, I.OLD_STATE))


@query(f"""SELECT o.seq, o.org_id, coalesce(b.contact_name, '') AS contact_name, coalesce(b.contact_title, '') AS contact_title,
  coalesce(b.contact_source, '') AS contact_source FROM {O} o LEFT JOIN ({Q.BEST_PERSON}) b ON o.org_id = b.org_id""")
def join_organisation_people(spark, sf):
    orgs, best = D(spark, sf, I.ORGANISATIONS), contacts.best_people(D(spark, sf, I.PEOPLE))
    return orgs.join(best, "org_id", "left").select(
        "seq", "org_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("contact_name", "contact_title", "contact_source")])


@query(f"""SELECT h.seq, h.host FROM (SELECT seq, {Q.host('link')} AS host FROM {H} q) h WHERE h.host <> '' AND NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT {Q.host('url')} AS entry FROM pages WHERE page_id % 5 = 0) b
  WHERE h.host = b.entry OR ends_with(h.host, '.' || b.entry))""")
def join_block_list_anti(spark, sf):
    listed = D(spark, sf, "SELECT url, page_id FROM pages").filter("page_id % 5 = 0").select(hosts.host("url").alias("entry"))
    rows = hits(spark, sf).select("seq", hosts.host("link").alias("host")).filter("host <> ''")
    return hosts.not_listed(rows, "host", "seq", listed).select("seq", "host")


CANDIDATES = f"(SELECT seq, {Q.host('website')} AS domain FROM {S} s WHERE {Q.WANTED} AND NOT {Q.blocked('website')})"


@query(f"""SELECT c.seq, c.domain, b.value AS contact_email, b.confidence AS email_confidence, p.pattern FROM {CANDIDATES} c
  LEFT JOIN ({Q.BEST_BOX}) b ON c.domain = b.domain LEFT JOIN ({Q.PATTERNS}) p ON c.domain = p.domain""")
def join_domain_contacts(spark, sf):
    rows = sightings(spark, sf).filter(contacts.is_searchable()).select("seq", hosts.host("website").alias("domain"))
    best = contacts.best_mailboxes(D(spark, sf, I.MAILBOXES))
    return rows.join(best, "domain", "left").select("seq", "domain", "best.contact_email", "best.email_confidence", "pattern")


@query(f"""SELECT t.id, coalesce(v.verified, t.email_verified) AS email_verified FROM {T} t LEFT JOIN (
  SELECT id, coalesce(a.verified, 'unknown') AS verified FROM {T} q LEFT JOIN ({VERIFIED}) a ON q.contact_email = a.email
  WHERE {NEEDS}) v ON t.id = v.id""")
def join_verification_update(spark, sf):
    rows = state(spark, sf)
    open_rows = reports.needs_verification(rows, ["HOT", "WARM"])
    results = open_rows.join(answer_table(spark, sf), F.col("contact_email") == F.col("email"), "left").select(
        "id", F.coalesce("verified", F.lit("unknown")).alias("verified"))
    return upsert.set_verified(rows, results).select("id", "email_verified")


@query(f"SELECT seq, {Q.BEST_MULT} AS multiplier FROM {S} s")
def join_vertical_multiplier(spark, sf):
    return sightings(spark, sf).select("seq", scoring.best_vertical(SETTINGS)["multiplier"].alias("multiplier"))


# ------------------------------------------------- duplicates and merging ----
@query(f"""SELECT seq, channel, host FROM (SELECT *, row_number() OVER (PARTITION BY channel, host ORDER BY seq) AS rn FROM {USABLE} u) WHERE rn = 1""")
def dedupe_first_per_channel(spark, sf):
    usable = channels.usable_hits(hits(spark, sf), USER_BLOCKED).select("seq", "channel", "host")
    return firsthit.first_per(usable, "channel", "host")


IMPORT_ROWS = f"""(SELECT seq, '' AS host, {Q.index_name('title')} AS name, keyword, snippet FROM {H} h
    WHERE channel = 'import_search' AND from_index AND {Q.index_name('title')} <> ''
  UNION ALL SELECT seq, host, {Q.name_from_title('title', 'host')}, keyword, snippet FROM {USABLE} u
    WHERE channel = 'import_search' AND NOT from_index)"""
IMPORT_FIRST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN host <> '' THEN host ELSE lower(name) END ORDER BY seq)
  AS rn FROM {IMPORT_ROWS} i) WHERE rn = 1"""


@query(f"SELECT seq, host AS website, name AS company_name FROM ({IMPORT_FIRST})")
def dedupe_import_first(spark, sf):
    rows = hits(spark, sf).filter("channel = 'import_search'")
    return channels.import_channel(rows, SETTINGS).select("seq", "website", "company_name")


@query(f"WITH RECURSIVE {Q.leader_ctes(I.SIGHTINGS)} SELECT seq, leader FROM placed")
def dedupe_resolve_leaders(spark, sf):
    return resolve.assign_leaders(sightings(spark, sf)).select("seq", "leader")


@query(f"WITH RECURSIVE {Q.leader_ctes(I.SIGHTINGS)} SELECT seq, leader FROM placed")
def dedupe_revised_leaders(spark, sf):
    """Leaders revised from a run that lacked a quarter of the sightings and had some that are gone: as if decided at once."""
    rows = sightings(spark, sf)
    before = rows.filter("seq % 4 <> 1").unionByName(rows.filter("seq % 16 = 3").withColumns({
        "seq": F.col("seq") + 2**40, "company_name": F.concat("company_name", F.lit(" of old")), "website": F.lit("")}))
    return resolve.assign_leaders(rows, decided=cut(resolve.decided_names(before), "decided")).select("seq", "leader")


DOMAIN_GROUPS = f"(SELECT *, min(seq) OVER (PARTITION BY {Q.host('website')}) AS leader FROM {S} s WHERE website <> '')"


def domain_groups(spark, sf) -> DataFrame:
    """Sightings with the first sighting of their domain as leader."""
    rows = sightings(spark, sf).withColumn("domain", hosts.host("website")).filter("domain <> ''")
    heads = rows.groupBy("domain").agg(F.min("seq").alias("leader"))
    return rows.join(heads, "domain")


@query("SELECT leader, " + ", ".join(f"{Q.union_text(c)} AS {c}" for c in LIST_COLUMNS) + f" FROM {DOMAIN_GROUPS} d GROUP BY leader")
def dedupe_unite_lists(spark, sf):
    return merge.united_lists(domain_groups(spark, sf), "leader")


@query("SELECT leader, " + ", ".join(f"{Q.first_filled(c)} AS {c}" for c in FILL_COLUMNS) + f" FROM {DOMAIN_GROUPS} d GROUP BY leader")
def dedupe_first_filled(spark, sf):
    return merge.first_values(domain_groups(spark, sf), "leader", FILL_COLUMNS)


@query(f"WITH d AS (SELECT * FROM {DOMAIN_GROUPS} q), {Q.merged_cte('d')} SELECT seq, {', '.join(CONTACT_COLUMNS)} FROM merged")
def dedupe_contact_priority(spark, sf):
    return merge.merge_companies(domain_groups(spark, sf)).select("seq", *CONTACT_COLUMNS)


@query(f"WITH RECURSIVE {Q.leader_ctes(I.SIGHTINGS)} SELECT count(*) AS raw_count, count(DISTINCT leader) AS dedup_count FROM placed")
def dedupe_counts(spark, sf):
    placed = resolve.assign_leaders(sightings(spark, sf))
    return placed.agg(F.count(F.lit(1)).alias("raw_count"), F.count_if(F.col("seq") == F.col("leader")).alias("dedup_count"))


@query(f"WITH RECURSIVE {Q.leader_ctes(I.SIGHTINGS)}, {Q.merged_cte()} SELECT seq, {ALL_SIGHTING} FROM merged")
def dedupe_merged_companies(spark, sf):
    return runs.resolve(sightings(spark, sf))


# --------------------------------------------------------------- contacts ----
@query(f"SELECT domain, trim(first_name || ' ' || last_name) AS contact_name, position AS contact_title, value AS contact_email, confidence AS email_confidence FROM ({Q.BEST_BOX})")
def contact_best_mailbox(spark, sf):
    return contacts.best_mailboxes(D(spark, sf, I.MAILBOXES)).filter("best IS NOT NULL").select("domain", "best.*")


@query(Q.BEST_PERSON)
def contact_best_person(spark, sf):
    return contacts.best_people(D(spark, sf, I.PEOPLE))


@query(f"""SELECT s.seq, CASE WHEN s.notes = '' THEN '' ELSE s.notes || chr(10) END || 'Hunter email pattern: ' || p.pattern || '@' || s.domain AS notes
  FROM (SELECT *, {Q.host('website')} AS domain FROM {S} q) s JOIN ({Q.PATTERNS}) p ON s.domain = p.domain""")
def contact_pattern_note(spark, sf):
    rows = sightings(spark, sf).withColumn("domain", hosts.host("website"))
    known = contacts.best_mailboxes(D(spark, sf, I.MAILBOXES)).select("domain", "pattern")
    return contacts.with_patterns(rows, known).select("seq", contacts.pattern_note(F.col("notes"), F.col("pattern"), F.col("domain")).alias("notes"))


@query(f"SELECT title, CAST({Q.choice('title')} AS INT) AS choice, count(*) AS people FROM {P} p GROUP BY title")
def contact_title_choice(spark, sf):
    return D(spark, sf, I.PEOPLE).groupBy("title", contacts.title_choice("title").alias("choice")).agg(F.count(F.lit(1)).alias("people"))


@query(f"SELECT DISTINCT first_name, last_name, trim(first_name || ' ' || last_name) AS full_name FROM {P} p")
def contact_full_name(spark, sf):
    return D(spark, sf, I.PEOPLE).select("first_name", "last_name").distinct().withColumn("full_name", text.full_name("first_name", "last_name"))


@query(f"WITH s AS (SELECT * FROM {S} q), {Q.enriched_cte('s', QUOTA, CLEAN_USER)} SELECT seq, {ALL_SIGHTING} FROM enriched")
def contact_enrich(spark, sf):
    return contacts.enrich(sightings(spark, sf), D(spark, sf, I.MAILBOXES), QUOTA, USER_BLOCKED)


VERIFY_TOP = f"(SELECT id, contact_email FROM {T} t WHERE {NEEDS} {ORDER} LIMIT 50)"
VERIFY_RESULTS = f"SELECT v.id, v.contact_email, coalesce(a.verified, 'unknown') AS verified FROM {VERIFY_TOP} v LEFT JOIN ({VERIFIED}) a ON v.contact_email = a.email"


@query(VERIFY_RESULTS)
def contact_verify_batch(spark, sf):
    return runs.verification_batch(state(spark, sf), answer_table(spark, sf), ["HOT", "WARM"], 50)


# ---------------------------------------------------------------- scoring ----
@query(f"SELECT seq, CAST({Q.SIGNAL_POINTS} AS INT) AS points FROM {S} s")
def score_channels(spark, sf):
    return sightings(spark, sf).select("seq", scoring.channel_points(SETTINGS).alias("points"))


@query(f"SELECT seq, CAST({Q.COMPLIANCE_POINTS} AS INT) AS points FROM {S} s")
def score_compliance(spark, sf):
    return sightings(spark, sf).select("seq", scoring.signal_points(SETTINGS).alias("points"))


@query(f"SELECT seq, CAST({Q.geo_points(STATES)} AS INT) AS points FROM {S} s")
def score_geography(spark, sf):
    return sightings(spark, sf).select("seq", scoring.state_points(SETTINGS, STATES).alias("points"))


@query(f"SELECT seq, CAST({Q.ENRICH_POINTS} AS INT) AS points FROM {S} s")
def score_contact_quality(spark, sf):
    return sightings(spark, sf).select("seq", scoring.contact_points(SETTINGS).alias("points"))


@query(f"SELECT seq, {Q.IS_LOGISTICS} AS is_logistics FROM {S} s")
def score_logistics_title(spark, sf):
    return sightings(spark, sf).select("seq", scoring.is_logistics_title("contact_title").alias("is_logistics"))


@query(f"SELECT seq, {Q.BEST_MULT} AS multiplier FROM {S} s")
def score_multiplier(spark, sf):
    return sightings(spark, sf).select("seq", scoring.best_vertical(SETTINGS).getField("multiplier").alias("multiplier"))


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(l_linenumber * l_quantity * 0.65, 0) AS INT) AS rounded FROM lineitem")
def score_half_even_rounding(spark, sf):
    lines = I.table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.rint(F.col("l_linenumber") * F.col("l_quantity") * F.lit(0.65)).cast("int").alias("rounded"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 140 >= 70 THEN 'HOT' WHEN o_custkey % 140 >= 45 THEN 'WARM'
  WHEN o_custkey % 140 >= 25 THEN 'NURTURE' ELSE 'PARK' END AS tier FROM orders""")
def score_tier(spark, sf):
    return I.table(spark, sf, "orders").select("o_orderkey", scoring.tier_of(F.col("o_custkey") % 140, SETTINGS).alias("tier"))


@query(f"SELECT seq, {Q.BEST_LABEL} AS label FROM {S} s")
def score_best_vertical(spark, sf):
    return sightings(spark, sf).select("seq", scoring.best_vertical(SETTINGS)["label"].alias("label"))


SCORED = f"WITH s AS MATERIALIZED (SELECT * FROM {S} q), {Q.scored_cte('s', STATES)}"


@query(f"{SCORED} SELECT seq, score_breakdown FROM scored")
def score_breakdown(spark, sf):
    return scoring.score_companies(sightings(spark, sf), SETTINGS, STATES).select("seq", "score_breakdown")


@query(f"{SCORED} SELECT seq, {ALL_SIGHTING} FROM scored")
def score_batch(spark, sf):
    return scoring.score_companies(sightings(spark, sf), SETTINGS, STATES)


# ------------------------------------------------------------ state table ----
RESOLVED_BATCH = f"{Q.leader_ctes(I.BATCH)}, {Q.merged_cte()}, {Q.match_ctes('merged')}"


def resolved_batch(spark, sf) -> DataFrame:
    return cut(runs.resolve(D(spark, sf, I.BATCH)), "batch")


@query(f"WITH RECURSIVE {RESOLVED_BATCH} SELECT seq, target FROM hits")
def state_match(spark, sf):
    return upsert.match_state(resolved_batch(spark, sf), D(spark, sf, I.OLD_STATE))


@query(f"WITH RECURSIVE {RESOLVED_BATCH}, {Q.upsert_ctes()} SELECT {ALL_STATE} FROM next_state")
def state_upsert(spark, sf):
    return upsert.upsert(D(spark, sf, I.OLD_STATE), resolved_batch(spark, sf), TODAY, resolved=True)[0]


FIRST_PART, SECOND_PART = (f"SELECT * FROM ({I.BATCH}) b WHERE seq % 4 = {r}" for r in (0, 2))


def _after(part: str, old: str) -> str:
    """The state after a resolved part of the batch, as a recipe of its own."""
    return (f"(WITH RECURSIVE {Q.leader_ctes(part)}, {Q.merged_cte()}, {Q.match_ctes('merged', old)}, {Q.upsert_ctes()} "
            f"SELECT {ALL_STATE} FROM next_state)")


@query(f"SELECT {ALL_STATE}, id > (SELECT max(id) FROM {Q.rec(I.OLD_STATE)} o) AS inserted FROM {_after(SECOND_PART, _after(FIRST_PART, I.OLD_STATE))} s")
def state_upsert_stored(spark, sf):
    """Two upserts from the stored state and name index: the second reads the names that the first added."""
    home = f"{work_folder(spark)}/stored-{uuid.uuid4().hex}"
    tables.write_state(D(spark, sf, I.OLD_STATE), f"{home}/state")
    for part in (FIRST_PART, SECOND_PART):
        upsert.stored_upsert(spark, home, cut(runs.resolve(D(spark, sf, part)), "batch"), TODAY, resolved=True)
    rows = tables.read_state(spark, f"{home}/state")
    first = tables.read_state(spark, f"{home}/state", 1).agg(F.max("id")).first()[0]
    return rows.withColumn("inserted", F.col("id") > first)


SCORED_STATE = Q.scored_cte(f"(SELECT id AS seq, '' AS scraped_date, {', '.join(c for c in SIGHTING_COLUMNS if c != 'scraped_date')} FROM next_state WHERE id IN (SELECT target FROM hits))", STATES)


@query(f"""WITH RECURSIVE {RESOLVED_BATCH}, {Q.upsert_ctes()}, {SCORED_STATE}
  SELECT {', '.join(f'coalesce(s.{c}, n.{c}) AS {c}' if c in ('score', 'score_breakdown', 'tier') else f'n.{c}' for c in STATE_COLUMNS)}
  FROM next_state n LEFT JOIN scored s ON s.seq = n.id""")
def state_upsert_rescored(spark, sf):
    """Returning companies are scored anew from their merged row."""
    again = upsert.Rescore(SETTINGS, STATES)
    return upsert.upsert(D(spark, sf, I.OLD_STATE), resolved_batch(spark, sf), TODAY, resolved=True, rescore=again)[0]


@query(f"""WITH RECURSIVE {Q.placed_ctes(I.BATCH)}, {Q.upsert_ctes()}
  SELECT {ALL_STATE}, (SELECT count(*) FROM fresh) AS new_count, (SELECT count(*) FROM hits) AS updated_count FROM old_rows""")
def state_upsert_unresolved(spark, sf):
    """The batch as it comes, with repeated domains and names; the order of rows decides."""
    result, counts = upsert.upsert(D(spark, sf, I.OLD_STATE), D(spark, sf, I.BATCH), TODAY)
    return result.select("*", *[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])


# A batch with one row per odd or even document: target is the state row of the odd document before it.
PLACED = f"SELECT *, CASE WHEN seq % 3 = 0 THEN NULL ELSE seq + 1 - (seq % 4) END AS target FROM ({I.BATCH}) b"
PLACED_CTES = f"""b AS MATERIALIZED (SELECT *, {Q.host('website')} AS domain, {Q.company_key('company_name')} AS normalized_name
    FROM {Q.rec(I.BATCH)} q), t AS MATERIALIZED (SELECT * FROM {Q.rec(I.OLD_STATE)} q),
  hits AS (SELECT seq, seq + 1 - (seq % 4) AS target FROM b WHERE seq % 3 <> 0)"""


def placed_rows(spark, sf) -> DataFrame:
    return D(spark, sf, PLACED).withColumn("domain", hosts.host("website"))


@query(f"WITH {PLACED_CTES}, {Q.upsert_ctes()} SELECT {ALL_STATE} FROM old_rows")
def state_update_branch(spark, sf):
    return upsert.updated_rows(D(spark, sf, I.OLD_STATE), placed_rows(spark, sf).filter("target IS NOT NULL"), TODAY)


@query(f"WITH {PLACED_CTES}, {Q.upsert_ctes()} SELECT {ALL_STATE} FROM new_rows")
def state_insert_branch(spark, sf):
    old = D(spark, sf, I.OLD_STATE)
    fresh = placed_rows(spark, sf).filter("target IS NULL").drop("target", "domain")
    return upsert.new_rows(row_order(fresh, "seq", "id", old.agg(F.max("id")).first()[0]), TODAY)


PROTECTED = "id, company_name, normalized_name, status, first_seen, status_notes, status_updated"


@query(f"SELECT {PROTECTED} FROM {Q.rec(I.OLD_STATE)} t")
def state_protected_columns(spark, sf):
    rows = upsert.updated_rows(D(spark, sf, I.OLD_STATE), placed_rows(spark, sf).filter("target IS NOT NULL"), TODAY)
    return rows.select(*PROTECTED.split(", "))


@query(f"""SELECT id, CASE WHEN hit THEN 'CONTACTED' ELSE status END AS status, CASE WHEN hit THEN TIMESTAMP '2024-04-01 12:00:00' END AS status_updated,
  CASE WHEN hit THEN 'called' ELSE status_notes END AS status_notes, count(*) FILTER (WHERE hit) OVER () AS changed FROM (SELECT *, lower(normalized_name) LIKE '%the%' AS hit FROM {T} t)""")
def state_set_status(spark, sf):
    changed, number = upsert.set_status(state(spark, sf), "The, Inc.", "CONTACTED", NOW, "called")
    return changed.select("id", "status", "status_updated", "status_notes", F.lit(number).cast("bigint").alias("changed"))


@query(f"SELECT t.id, coalesce(v.verified, t.email_verified) AS email_verified FROM {T} t LEFT JOIN ({VERIFY_RESULTS}) v ON t.id = v.id")
def state_set_verified(spark, sf):
    rows = state(spark, sf)
    results = runs.verification_batch(rows, answer_table(spark, sf), ["HOT", "WARM"], 50)
    return upsert.set_verified(rows, results).select("id", "email_verified")


@query(f"""WITH RECURSIVE {RESOLVED_BATCH} SELECT (SELECT count(*) FROM b) - (SELECT count(*) FROM hits) AS new_count,
  (SELECT count(*) FROM hits) AS updated_count""")
def state_upsert_counts(spark, sf):
    batch = resolved_batch(spark, sf)
    counts = upsert.upsert(D(spark, sf, I.OLD_STATE), batch, TODAY, resolved=True)[1]
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])


# ----------------------------------------------------------- aggregations ----
@query(f"SELECT status, count(*) AS cnt FROM {T} t GROUP BY status")
def report_status_counts(spark, sf):
    return reports.status_counts(state(spark, sf))


@query(f"SELECT tier, count(*) AS cnt FROM {T} t GROUP BY tier")
def report_tier_counts(spark, sf):
    return reports.tier_counts(state(spark, sf))


@query(f"SELECT count(*) AS total, avg(score) AS avg_score FROM {T} t")
def report_score_summary(spark, sf):
    return reports.score_summary(state(spark, sf))


@query(f"{SCORED} SELECT " + ", ".join(f"count(*) FILTER (WHERE tier = '{t}') AS {t.lower()}_count" for t in ("HOT", "WARM", "NURTURE", "PARK")) + " FROM scored")
def report_run_tiers(spark, sf):
    return reports.run_tiers(scoring.score_companies(sightings(spark, sf), SETTINGS, STATES))


@query(f"{SCORED} SELECT coalesce(avg(nullif(score, 0)), 0.0) AS avg_score FROM scored")
def report_run_average(spark, sf):
    return reports.run_average(scoring.score_companies(sightings(spark, sf), SETTINGS, STATES))


@query(f"SELECT count(*) FILTER (WHERE first_seen = DATE '2024-03-01') AS new_count, count(*) FILTER (WHERE first_seen <> DATE '2024-03-01') AS returning_count, count(*) AS total FROM {T} t")
def report_new_and_returning(spark, sf):
    return reports.new_and_returning(state(spark, sf), RUN_DAY)


@query(f"SELECT verified, count(*) AS cnt FROM ({VERIFY_RESULTS}) GROUP BY verified ORDER BY verified")
def report_verification_results(spark, sf):
    return reports.result_counts(runs.verification_batch(state(spark, sf), answer_table(spark, sf), ["HOT", "WARM"], 50))


@query(f"SELECT count(*) AS extracted FROM {S} s WHERE state = '' AND notes <> '' AND {Q.state_of('notes')} <> ''")
def report_states_extracted(spark, sf):
    rows = sightings(spark, sf)
    return rows.agg(F.count_if((F.col("state") == "") & (F.col("notes") != "") & (text.extract_state("notes") != "")).alias("extracted"))


@query(f"""WITH s AS (SELECT * FROM {S} q), {Q.enriched_cte('s', QUOTA, ('thethe.com',))} SELECT
  (SELECT count(*) FROM enriched WHERE contact_source = 'hunter' AND seq < 2305843009213693952) AS enriched,
  (SELECT count(*) FROM s WHERE {Q.WANTED} AND {Q.blocked('website', ('thethe.com',))}) AS skipped_noise""")
def report_enriched_and_skipped(spark, sf):
    user = ["thethe.com"]
    rows = sightings(spark, sf)
    done = contacts.enrich(rows, D(spark, sf, I.MAILBOXES), QUOTA, user).filter(
        (F.col("contact_source") == "hunter") & (F.col("seq") < contacts.NOT_SEARCHED_OFFSET))
    skipped = rows.filter(contacts.is_wanting() & hosts.is_blocked("website", user))
    marked = done.select(F.lit(True).alias("hit")).unionByName(skipped.select(F.lit(False).alias("hit")))
    return marked.agg(F.count_if(F.col("hit")).alias("enriched"), F.count_if(~F.col("hit")).alias("skipped_noise"))


@query(f"SELECT provider, count(*) FILTER (WHERE provider = 'search' OR ok) AS calls FROM {Q.rec(I.CALLS)} c GROUP BY provider")
def report_calls_used(spark, sf):
    return reports.calls_used(D(spark, sf, I.CALLS))


# ----------------------------------------------------- sorts, tops, unions ---
@query(f"SELECT id, score FROM {T} t {ORDER}")
def sort_by_score(spark, sf):
    return reports.by_score(state(spark, sf)).select("id", "score")


@query(f"SELECT id, run_date FROM {Q.rec(I.RUNS)} r ORDER BY run_date DESC, id DESC")
def sort_run_history(spark, sf):
    return tables.latest_first(D(spark, sf, I.RUNS)).select("id", "run_date")


@query(f"SELECT {', '.join(V.TOP_NEW_COLUMNS)} FROM {T} t WHERE first_seen = DATE '2024-03-01' {ORDER} LIMIT 10")
def top_new_companies(spark, sf):
    return reports.top_new(state(spark, sf), RUN_DAY)


@query(f"SELECT id, contact_email, score FROM {T} t WHERE {NEEDS} {ORDER} LIMIT 50")
def top_for_verification(spark, sf):
    return reports.needs_verification(state(spark, sf), ["HOT", "WARM"], 50).select("id", "contact_email", "score")


@query(f"""SELECT seq, wanted AND row_number() OVER (PARTITION BY wanted ORDER BY seq) <= {QUOTA} AS searched FROM (
  SELECT seq, {Q.WANTED} AND NOT {Q.blocked('website', CLEAN_USER)} AS wanted FROM {S} s)""")
def top_within_quota(spark, sf):
    return contacts.within_quota(sightings(spark, sf), contacts.is_searchable(USER_BLOCKED), QUOTA).select("seq", "searched")


@query(f"SELECT vertical, vpos, kpos, keyword FROM {K} k QUALIFY row_number() OVER (PARTITION BY vertical ORDER BY kpos) <= 3")
def top_first_keywords(spark, sf):
    return requests.first_of(keyword_rows(spark, sf), 3)


SPAN = channels.CHANNEL_SPAN


@query(" UNION ALL ".join(f"SELECT seq + {i * SPAN} AS seq, company_name, source_channel FROM {S} s WHERE trim(split_part(source_channel, ',', 1)) = '{c}'"
                         for i, c in enumerate(("web_search", "sqep", "import", "apollo"))))
def union_channels(spark, sf):
    """Every sighting, in the part of the first channel it names."""
    rows = sightings(spark, sf)
    names_of = {"web_search": "web_search", "sqep": "sqep", "import_search": "import", "apollo": "apollo"}
    parts = {n: rows.filter(F.trim(F.substring_index("source_channel", ",", 1)) == c) for n, c in reversed(names_of.items())}
    return channels.all_channels(parts).select("seq", "company_name", "source_channel")


@query(f"WITH s AS (SELECT * FROM {S} q), {Q.enriched_cte('s', QUOTA, CLEAN_USER)} SELECT seq, row_number() OVER (ORDER BY seq) AS place FROM enriched")
def union_searched_and_rest(spark, sf):
    rows = contacts.enrich(sightings(spark, sf), D(spark, sf, I.MAILBOXES), QUOTA, USER_BLOCKED).select("seq")
    return row_order(rows, "seq", "place")


@query(f"SELECT DISTINCT state FROM {S} s WHERE state IN ({Q.quoted(list(dict.fromkeys(requests.resolve_states(SETTINGS, 'northeast,northeast,south_central'))))})")
def union_state_lists(spark, sf):
    both = requests.resolve_states(SETTINGS, "northeast,northeast,south_central")
    return sightings(spark, sf).filter(F.col("state").isin(both)).select("state").distinct()


@query(f"SELECT '01' AS stage_no, seq, company_name FROM {S} s WHERE seq % 2 = 0 UNION ALL SELECT '05', seq, company_name FROM {S} s WHERE seq % 2 = 1")
def union_stage_snapshots(spark, sf):
    folder = f"{work_folder(spark)}/run-{uuid.uuid4().hex}"
    rows = sightings(spark, sf)
    tables.write_stage(rows.filter("seq % 2 = 1"), folder, "dedup")
    tables.write_stage(rows.filter("seq % 2 = 0"), folder, "web_search")
    return tables.read_all_stages(spark, folder).select("stage_no", "seq", "company_name")


# -------------------------------------------------------- scalar functions ---
@query(f"SELECT seq, {Q.host('link')} AS domain FROM {H} h")
def text_normalize_domain(spark, sf):
    return hits(spark, sf).select("seq", hosts.host("link").alias("domain"))


@query(f"""SELECT seq, lower(regexp_replace(CASE WHEN name <> '' THEN name ELSE w END, '^www[.]', '')) AS domain FROM (
  SELECT seq, w, lower(regexp_extract(regexp_replace(regexp_extract(w, '^https?://([^/?#]*)', 1), '^.*@', ''), '^([^:]*)', 1)) AS name FROM (
    SELECT seq, CASE WHEN starts_with(link, 'http://') OR starts_with(link, 'https://') THEN link ELSE 'http://' || link END AS w FROM {H} h))""")
def text_website_domain(spark, sf):
    return hits(spark, sf).select("seq", hosts.website_host("link").alias("domain"))


@query(f"SELECT seq, {Q.company_key('company_name')} AS normalized_name FROM {S} s")
def text_normalize_company(spark, sf):
    return sightings(spark, sf).select("seq", names.company_key("company_name").alias("normalized_name"))


@query(f"""WITH s AS MATERIALIZED (SELECT seq, {Q.tokens('company_name')} AS a FROM {S} q),
  p AS MATERIALIZED (SELECT x.seq, x.a, y.a AS b FROM s x JOIN s y ON y.seq = x.seq + 1 WHERE x.a <> '' AND y.a <> '')
  SELECT seq, lcs, CAST(round_even(200.0 * lcs / (len(a) + len(b)), 0) AS INT) AS ratio FROM (SELECT seq, a, b, CAST({Q.lcs('a', 'b')} AS INT) AS lcs FROM p)""")
def text_name_similarity(spark, sf):
    rows = sightings(spark, sf).select("seq", names.sorted_tokens("company_name").alias("a")).filter("a <> ''")
    nxt = rows.select((F.col("seq") - 1).alias("seq"), F.col("a").alias("b"))
    found = rows.join(nxt, "seq").select("seq", "a", "b", names.lcs_length("a", "b").alias("lcs"))
    return found.select("seq", "lcs", names.ratio(F.col("lcs"), F.length("a") + F.length("b")).alias("ratio"))


@query(f"SELECT seq, {Q.name_from_host(Q.host('link'))} AS name FROM {H} h")
def text_name_from_host(spark, sf):
    return hits(spark, sf).select("seq", hosts.name_from_host(hosts.host("link")).alias("name"))


@query(f"SELECT seq, {Q.name_from_title('title', 'host')} AS name FROM (SELECT seq, title, {Q.host('link')} AS host FROM {H} h)")
def text_name_from_title(spark, sf):
    return hits(spark, sf).select("seq", hosts.name_from_title("title", hosts.host("link")).alias("name"))


@query(f"SELECT seq, {Q.index_name('title')} AS name FROM {H} h")
def text_name_from_import_title(spark, sf):
    return hits(spark, sf).select("seq", hosts.name_from_import_title("title").alias("name"))


@query(f"SELECT seq, {Q.state_of('snippet')} AS state FROM {H} h")
def text_extract_state(spark, sf):
    return hits(spark, sf).select("seq", text.extract_state("snippet").alias("state"))


@query(f"SELECT seq, {Q.signal_text('title', 'snippet')} AS signals FROM {H} h")
def text_detect_signals(spark, sf):
    return hits(spark, sf).select("seq", F.array_join(text.detect_signals("title", "snippet"), ", ").alias("signals"))


@query(f"SELECT seq, {Q.amount('organization_revenue_printed')} AS amount FROM {O} o")
def text_parse_amount(spark, sf):
    return D(spark, sf, I.ORGANISATIONS).select("seq", text.parse_amount("organization_revenue_printed").alias("amount"))


@query(f"SELECT seq, {REV} AS revenue FROM {O} o")
def text_revenue(spark, sf):
    return D(spark, sf, I.ORGANISATIONS).select("seq", text.revenue("organization_revenue", "organization_revenue_printed").alias("revenue"))


@query(f"SELECT seq, coalesce(nullif(phone, ''), sanitized_phone) AS phone, coalesce(nullif(name, ''), {Q.host('primary_domain')}) AS company_name FROM {O} o")
def text_phone_and_name(spark, sf):
    return D(spark, sf, I.ORGANISATIONS).select(
        "seq", F.coalesce(text.blank_to_null("phone"), "sanitized_phone").alias("phone"),
        F.coalesce(text.blank_to_null("name"), hosts.host("primary_domain")).alias("company_name"))


@query(f"SELECT seq, CASE WHEN seq % 5 = 0 THEN '' ELSE product_keywords END AS product_keywords FROM {O} o")
def text_keyword_list(spark, sf):
    listed = F.when(F.col("seq") % 5 != 0, F.split("product_keywords", ", "))
    return D(spark, sf, I.ORGANISATIONS).select("seq", text.keyword_text(listed).alias("product_keywords"))


# ------------------------------------------------------- channels and runs ---
DAY = "'2024-04-01'"
day = lambda: F.lit("2024-04-01")


def sighting_sql(source: str, **values: str) -> str:
    """Projection onto the sighting columns; those not given are blank."""
    blank = {"string": "''", "bigint": "CAST(NULL AS BIGINT)", "int": "CAST(NULL AS INT)"}
    cols = {n: blank[Q.TYPES[n]] for n in SIGHTING_COLUMNS} | {"score": "CAST(0 AS INT)", "scraped_date": DAY} | values
    return "SELECT seq, " + ", ".join(f"{v} AS {n}" for n, v in cols.items()) + f" FROM {source}"


def first_hit_sql(condition: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY seq) AS rn FROM {USABLE} u WHERE {condition}) WHERE rn = 1)"


WEB_SQL = sighting_sql(
    first_hit_sql("channel = 'web_search'"), company_name=Q.name_from_title("title", "host"), website="host", vertical="vertical",
    source_channel="'web_search'", compliance_signals=Q.signal_text("title", "snippet"), notes="snippet")
SIGNAL_SQL = sighting_sql(
    first_hit_sql(f"channel = 'sqep' AND {Q.signal_text('title', 'snippet')} <> ''"), company_name=Q.name_from_title("title", "host"),
    website="host", source_channel="'sqep'", compliance_signals=Q.signal_text("title", "snippet"), notes="snippet")
IMPORT_SQL = sighting_sql(
    f"({IMPORT_FIRST})", company_name="name", website="host", source_channel="'import'", import_products="keyword", notes="snippet")
ORG_SQL = sighting_sql(
    f"""(SELECT o.*, b.contact_name AS cn, b.contact_title AS ct, b.contact_email AS ce, b.contact_source AS cs, {Q.host('primary_domain')} AS host,
      {REV} AS r, coalesce(nullif(phone, ''), sanitized_phone) AS ph FROM {O} o LEFT JOIN ({Q.BEST_PERSON}) b ON o.org_id = b.org_id
      WHERE NOT {Q.blocked('primary_domain', CLEAN_USER)}) WHERE (r IS NULL OR r BETWEEN 5000000 AND 500000000)
      AND NOT (starts_with(ph, '+') AND NOT starts_with(ph, '+1'))""",
    company_name="coalesce(nullif(name, ''), host)", phone="ph", website="host", vertical="vertical", source_channel="'apollo'",
    estimated_revenue="r", product_keywords="product_keywords", contact_name="coalesce(cn, '')", contact_title="coalesce(ct, '')",
    contact_email="coalesce(ce, '')", contact_source="coalesce(cs, '')")


def web_part(spark, sf):
    return channels.web_channel(hits(spark, sf).filter("channel = 'web_search'"), SETTINGS, day())


def signal_part(spark, sf):
    return channels.signal_channel(hits(spark, sf).filter("channel = 'sqep'"), SETTINGS, day())


def import_part(spark, sf):
    return channels.import_channel(hits(spark, sf).filter("channel = 'import_search'"), SETTINGS, day())


@query(WEB_SQL)
def channel_web(spark, sf):
    return web_part(spark, sf)


@query(SIGNAL_SQL)
def channel_signal(spark, sf):
    return signal_part(spark, sf)


@query(IMPORT_SQL)
def channel_import(spark, sf):
    return import_part(spark, sf)


def organisation_part(spark, sf):
    return channels.organisation_channel(D(spark, sf, I.ORGANISATIONS), D(spark, sf, I.PEOPLE), SETTINGS, day())


@query(ORG_SQL)
def channel_organisation(spark, sf):
    return organisation_part(spark, sf)


@query(sighting_sql(f"{USABLE} u WHERE vertical = 'food'", company_name="host", website="host", source_channel="'own'"))
def channel_extension(spark, sf):
    @channels.channel("own")
    def own_channel(rows: DataFrame) -> DataFrame:
        return channels.as_sightings(rows, day(), company_name=F.col("host"), website=F.col("host"), source_channel=F.lit("own"))

    built = channels.CHANNELS.pop("own")
    return built(channels.usable_hits(hits(spark, sf), USER_BLOCKED).filter("vertical = 'food'"))


FLAGSHIP = f"WITH s AS MATERIALIZED ({WEB_SQL}), {Q.scored_cte('s', STATES)} SELECT company_name, website, vertical, compliance_signals, score, tier, score_breakdown FROM scored"


@query(FLAGSHIP)
def scored_web_leads(spark, sf):
    """Hits to hosts, block lists, names, signals, first per host, scored, best first."""
    rows = scoring.score_companies(web_part(spark, sf), SETTINGS, STATES)
    return rows.orderBy(F.col("score").desc(), "seq").select(
        "company_name", "website", "vertical", "compliance_signals", "score", "tier", "score_breakdown")


RUN_CTES = f"""WITH RECURSIVE all_hits AS MATERIALIZED ({WEB_SQL} UNION ALL SELECT seq + {SPAN}, * EXCLUDE (seq) FROM ({SIGNAL_SQL})
    UNION ALL SELECT seq + {2 * SPAN}, * EXCLUDE (seq) FROM ({IMPORT_SQL})
    UNION ALL SELECT seq + {3 * SPAN}, * EXCLUDE (seq) FROM ({ORG_SQL})),
  """


def run_sql() -> str:
    ctes = Q.leader_ctes("SELECT * FROM all_hits")
    stated = ", ".join(f"CASE WHEN state = '' AND notes <> '' THEN {Q.state_of('notes')} ELSE state END AS state" if c == "state" else c
                       for c in ["seq", *SIGHTING_COLUMNS])
    return (f"{RUN_CTES}{ctes}, {Q.merged_cte()}, stated AS MATERIALIZED (SELECT {stated} FROM merged), "
            f"{Q.enriched_cte('stated', 100, CLEAN_USER)}, {Q.scored_cte('enriched', STATES)}, {Q.match_ctes('scored')}, {Q.upsert_ctes()} "
            f"SELECT {ALL_STATE} FROM next_state")


@query(run_sql())
def full_run(spark, sf):
    """Four channels, resolution, states, contacts, scores and the next state table."""
    home = f"{work_folder(spark)}/home-{uuid.uuid4().hex}"
    tables.write_state(D(spark, sf, I.OLD_STATE), f"{home}/state")
    parts = {"web_search": web_part(spark, sf), "sqep": signal_part(spark, sf), "import_search": import_part(spark, sf), "apollo": organisation_part(spark, sf)}
    result = runs.full_run(spark, home, parts, D(spark, sf, I.MAILBOXES), SETTINGS, STATES, TODAY)
    return tables.read_state(spark, f"{home}/state", result.version).select(*STATE_COLUMNS)


@query(f"SELECT t.id, t.contact_email, coalesce(v.verified, t.email_verified) AS email_verified FROM {T} t LEFT JOIN ({VERIFY_RESULTS}) v ON t.id = v.id")
def verification_run(spark, sf):
    updated, _ = runs.verify_emails(state(spark, sf), answer_table(spark, sf), SETTINGS)
    return updated.select("id", "contact_email", "email_verified")
