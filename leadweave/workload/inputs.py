"""Lead tables derived from the given tables, as SQL both engines read.

The given tables hold no leads; these recipes derive hits, organisations, people, mailboxes, sightings and
a state table from whole tables. `{all}` stands for the replace-all flag of `regexp_replace`.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import cut, discard

# Five words of every document, drawn by hash from all words of its whole text (letters and digits, lower case), and a
# site name of the first three. Copies draw the same words, near copies nearly the same: names that are alike.
WORDS = r"""
SELECT doc_id, n_chars, text, words,
       regexp_replace(regexp_extract(words, '^[^ ]+(?: [^ ]+)?(?: [^ ]+)?', 0), ' ', ''{all}) AS site
FROM (SELECT doc_id, n_chars, text,
             {join}({map}({slice}({sort}({map}({distinct}(regexp_extract_all(lower(text), '[\p{L}\p{N}]+', 0)),
               {w} concat(md5(w), w))), 1, 5), {w} substr(w, 33)), ' ') AS words
      FROM documents) w
"""

# Text of a page: everything outside scripts, styles and tags.
PAGE_TEXT = r"""regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' '{all}), '<[^>]*>', ' '{all})"""

SIGHTINGS = rf"""
SELECT doc_id AS seq,
       CASE WHEN doc_id % 7 = 0 THEN substr(words, 1, 1) || substr(words, 3) ELSE words END
         || CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN ' Inc' WHEN 2 THEN ' LLC' WHEN 3 THEN ' Co.'
                            WHEN 4 THEN ' Holdings' ELSE ' Group, Inc.' END AS company_name,
       CASE WHEN doc_id % 8 = 0 THEN CAST(doc_id AS STRING) || ' Main St' ELSE '' END AS address,
       CASE WHEN doc_id % 9 = 0 THEN 'Dallas' ELSE '' END AS city,
       CASE doc_id % 10 WHEN 0 THEN 'TX' WHEN 1 THEN 'NY' WHEN 2 THEN 'tx' ELSE '' END AS state,
       '' AS zip_code,
       CASE WHEN doc_id % 4 = 0 THEN '+1555' || CAST(doc_id AS STRING) ELSE '' END AS phone,
       CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'https://www.' || site || '.com/about'
                       ELSE 'http://' || site || '.com' END AS website,
       CASE doc_id % 5 WHEN 0 THEN 'food' WHEN 1 THEN 'pharma, food' WHEN 2 THEN '' WHEN 3 THEN 'Fragrance'
                       ELSE 'flavor,other,flavor' END AS vertical,
       CASE doc_id % 7 WHEN 0 THEN 'web_search' WHEN 1 THEN 'sqep' WHEN 2 THEN 'import' WHEN 3 THEN 'apollo'
                       WHEN 4 THEN 'web_search, apollo' WHEN 5 THEN 'web_search,sqep, import,sqep'
                       ELSE 'apollo,import,sqep,web_search' END AS source_channel,
       CAST(CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE doc_id END AS BIGINT) AS estimated_employees,
       CAST(CASE WHEN doc_id % 4 = 0 THEN NULL ELSE n_chars * 1000 END AS BIGINT) AS estimated_revenue,
       CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'kw' || CAST(doc_id % 5 AS STRING) || ', kw' || CAST(doc_id % 3 AS STRING)
       END AS product_keywords,
       CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'walmart_supplier' WHEN 2 THEN 'sqep_mentioned, otif_mentioned'
                       WHEN 3 THEN 'COMPLIANCE_PAIN' WHEN 4 THEN 'walmart_supplier,sqep_mentioned,other'
                       ELSE 'otif_mentioned, compliance_pain, walmart_supplier' END AS compliance_signals,
       CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Person ' || CAST(doc_id % 50 AS STRING) END AS contact_name,
       CASE doc_id % 8 WHEN 0 THEN 'Director of Logistics' WHEN 1 THEN 'CEO' WHEN 2 THEN 'Plant Manager'
                       WHEN 3 THEN 'Project Coordinator' WHEN 4 THEN 'Buyer' ELSE '' END AS contact_title,
       CASE WHEN doc_id % 4 = 1 THEN 'p' || CAST(doc_id AS STRING) || '@x.com' ELSE '' END AS contact_email,
       CASE doc_id % 5 WHEN 0 THEN 'apollo' WHEN 1 THEN 'hunter' WHEN 2 THEN 'form' ELSE '' END AS contact_source,
       CASE WHEN doc_id % 8 = 1 THEN 'valid' ELSE '' END AS email_verified,
       CAST(CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 101 END AS INT) AS email_confidence,
       CASE WHEN doc_id % 11 = 0 THEN 'R' || CAST(doc_id AS STRING) ELSE '' END AS registration_id,
       CASE WHEN doc_id % 6 = 5 THEN 'flavor extract' ELSE '' END AS import_products,
       CASE doc_id % 8 WHEN 1 THEN 'Based in Austin, TX. ' || text WHEN 2 THEN text || ' Offices in West Virginia'
                       WHEN 3 THEN text || chr(10) || 'Hunter email pattern: f.last@' || site || '.com' WHEN 4 THEN text || ' Made in Ohio and Texas'
                       WHEN 5 THEN 'Somewhere, XX near new york ' || text ELSE text END AS notes,
       CAST(0 AS INT) AS score, '' AS score_breakdown, '' AS tier,
       '2024-01-' || CAST(10 + doc_id % 20 AS STRING) AS scraped_date
FROM ({WORDS}) d
WHERE words <> ''
"""

PHRASE = """CASE {k} % 6 WHEN 0 THEN ' Walmart supplier OTIF penalty, Austin, TX' WHEN 1 THEN ' SQEP vendor in Ohio'
  WHEN 2 THEN ' refined goods' WHEN 3 THEN ' Walmart store' ELSE '' END"""
HIT_VERTICAL = "CASE {k} % 4 WHEN 0 THEN 'food' WHEN 1 THEN 'pharma' WHEN 2 THEN 'flavor' ELSE 'fragrance' END"

# Hits of pages (even seq) and documents (odd seq); whole page and document texts are searched.
HITS = rf"""
SELECT 2 * page_id AS seq,
       CASE page_id % 3 WHEN 0 THEN 'web_search' WHEN 1 THEN 'sqep' ELSE 'import_search' END AS channel,
       {HIT_VERTICAL.replace('{k}', 'page_id')} AS vertical,
       'keyword ' || CAST(page_id % 5 AS STRING) AS keyword,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
       CASE page_id % 8 WHEN 0 THEN 'https://marketplace.walmart.com/i/' || CAST(page_id AS STRING)
                        WHEN 1 THEN 'http://www.shop' || CAST(page_id % 40 AS STRING) || '.co.uk/x' ELSE url END AS link,
       {PAGE_TEXT} || {PHRASE.replace('{k}', 'page_id')} AS snippet,
       page_id % 2 = 0 AS from_index
FROM pages
UNION ALL
SELECT 2 * d.doc_id + 1,
       CASE d.doc_id % 3 WHEN 0 THEN 'web_search' WHEN 1 THEN 'sqep' ELSE 'import_search' END,
       {HIT_VERTICAL.replace('{k}', 'd.doc_id')},
       'keyword ' || CAST(d.doc_id % 5 AS STRING),
       CASE d.doc_id % 11 WHEN 0 THEN 'Top ' WHEN 1 THEN '9 ' ELSE '' END || w.words
         || CASE d.doc_id % 7 WHEN 0 THEN ' | Leading Manufacturer' WHEN 1 THEN ' - Best in TX' WHEN 2 THEN ': services'
                              WHEN 3 THEN ' - ImportYeti' WHEN 4 THEN '...' WHEN 5 THEN '' ELSE '!?' END,
       CASE d.doc_id % 9 WHEN 0 THEN 'https://user:pw@www.' || w.site || '.com:8080/a?b=c'
                         WHEN 1 THEN 'news.' || w.site || '.net'
                         WHEN 2 THEN 'https://finance.yahoo.com/' || w.site
                         ELSE 'HTTPS://' || w.site || '.org/path' END,
       d.text || {PHRASE.replace('{k}', 'd.doc_id')},
       d.doc_id % 2 = 0
FROM documents d JOIN ({WORDS}) w ON d.doc_id = w.doc_id
"""

# One organisation per order.
ORGANISATIONS = """
SELECT o_orderkey AS seq,
       CASE o_custkey % 4 WHEN 0 THEN 'food' WHEN 1 THEN 'pharma' WHEN 2 THEN 'flavor' ELSE 'fragrance' END AS vertical,
       o_orderpriority AS keyword,
       CAST(o_orderkey AS STRING) AS org_id,
       CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'Company ' || CAST(o_custkey AS STRING) END AS name,
       CASE o_orderkey % 5 WHEN 0 THEN '+44 20 1' WHEN 1 THEN '+1 555 2' WHEN 2 THEN '555 3' ELSE '' END AS phone,
       CASE o_orderkey % 3 WHEN 0 THEN '+1 555 9' WHEN 1 THEN '+49 30 9' ELSE '' END AS sanitized_phone,
       CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'shop.c' || CAST(o_custkey AS STRING) || '.de'
                           ELSE 'www.c' || CAST(o_custkey AS STRING) || '.com' END AS primary_domain,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice * 100 END AS DOUBLE) AS organization_revenue,
       CASE o_orderkey % 6 WHEN 0 THEN '$10M-$50M' WHEN 1 THEN '$1.5b' WHEN 2 THEN 'unknown' WHEN 3 THEN NULL
                           WHEN 4 THEN '$500K' ELSE '8M' END AS organization_revenue_printed,
       o_orderpriority || ', ' || o_orderstatus AS product_keywords
FROM orders
"""

# One person per order line.
PEOPLE = """
SELECT CAST(l_orderkey AS STRING) AS org_id, l_linenumber * 1000000000000000 + l_partkey * 1000000 + l_suppkey AS pos,
       'First' || CAST(l_partkey % 100 AS STRING) AS first_name,
       CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE 'Last' || CAST(l_suppkey AS STRING) END AS last_name,
       CASE l_partkey % 9 WHEN 0 THEN 'Logistics Lead' WHEN 1 THEN 'VP Operations' WHEN 2 THEN 'COO' WHEN 3 THEN 'Buyer'
                          WHEN 4 THEN 'Head of Supply Chain' ELSE 'Engineer' END AS title,
       'm' || CAST(l_partkey AS STRING) || '@y.com' AS email
FROM lineitem
"""

# Two mailboxes per document site (sites repeat); every fourth document only has an address pattern.
MAILBOX = rf"""
SELECT site || '.com' AS domain,
       CASE WHEN doc_id % 2 = 0 THEN 'f.last' ELSE NULL END AS pattern,
       CAST(CASE WHEN doc_id % 4 = 3 THEN NULL ELSE 2 * doc_id + <k> END AS BIGINT) AS pos,
       CASE WHEN doc_id % 4 = 3 THEN '' ELSE 'b' || CAST(doc_id AS STRING) || '@' || site || '.com' END AS value,
       CASE WHEN doc_id % 4 = 3 OR <k> = 1 THEN '' ELSE 'Ann' END AS first_name,
       CASE WHEN doc_id % 4 = 3 THEN '' ELSE 'B' || CAST(doc_id % 30 AS STRING) END AS last_name,
       CASE WHEN doc_id % 4 = 3 THEN '' WHEN (doc_id + <k>) % 5 = 0 THEN 'Director of Logistics'
            WHEN (doc_id + <k>) % 5 = 1 THEN 'Operations Manager' ELSE 'Accountant' END AS position,
       CAST(CASE WHEN doc_id % 4 = 3 OR (doc_id + <k>) % 6 = 0 THEN NULL ELSE (doc_id * 7 + <k>) % 100 END AS INT) AS confidence
FROM ({WORDS}) d WHERE words <> '' AND (<k> = 0 OR doc_id % 4 <> 3)
"""
MAILBOXES = MAILBOX.replace("<k>", "0") + " UNION ALL " + MAILBOX.replace("<k>", "1")

LEGAL = r"(?:[\s,]+(?:inc|llc|ltd|corp|company|co)\.?|[\s,])+$"
DESCRIPTIVE = r"(?:[\s,]+(?:international|group|holdings|enterprises)\.?|[\s,])+$"

# State: the sightings of odd documents, scored by a simple rule.
STATE = rf"""
SELECT seq AS id, company_name,
       regexp_replace(regexp_replace(lower(company_name), '{LEGAL}', ''), '{DESCRIPTIVE}', '') AS normalized_name,
       CASE WHEN website = '' THEN '' ELSE regexp_extract(website, '//(?:www[.])?([^/]*)', 1) END AS domain,
       address, city, state, zip_code, phone, website, vertical, source_channel, estimated_employees, estimated_revenue,
       product_keywords, compliance_signals, contact_name, contact_title, contact_email, contact_source, email_verified,
       email_confidence, registration_id, import_products, notes,
       CAST(seq % 97 AS INT) AS score,
       CASE WHEN seq % 9 = 0 THEN '' ELSE 'kept' END AS score_breakdown,
       CASE WHEN seq % 97 >= 70 THEN 'HOT' WHEN seq % 97 >= 45 THEN 'WARM' WHEN seq % 97 >= 25 THEN 'NURTURE' ELSE 'PARK' END
         AS tier,
       CASE seq % 8 WHEN 0 THEN 'NEW' WHEN 1 THEN 'QUEUED' WHEN 2 THEN 'CONTACTED' WHEN 3 THEN 'ENGAGED' WHEN 4 THEN 'QUOTED'
                    WHEN 5 THEN 'WON' WHEN 6 THEN 'LOST' ELSE 'PARKED' END AS status,
       CASE WHEN seq % 13 = 0 THEN DATE '2024-03-01' ELSE DATE '2024-01-15' END AS first_seen,
       DATE '2024-03-01' AS last_seen,
       CAST(1 + seq % 4 AS INT) AS run_count,
       CAST(NULL AS TIMESTAMP) AS status_updated,
       CASE WHEN seq % 10 = 0 THEN 'call back' ELSE '' END AS status_notes
FROM ({SIGHTINGS}) s
"""
OLD_STATE = f"SELECT * FROM ({STATE}) t WHERE id % 2 = 1"
BATCH = f"SELECT * FROM ({SIGHTINGS}) t WHERE seq % 2 = 0"

# One run per day of events: counts stand for the run figures.
RUNS = """
SELECT first_event AS id, CAST(day AS TIMESTAMP) AS run_date,
       'TX, LA' AS states_used, 'food' AS verticals_used, 'web_search' AS channels_used,
       raw_count, dedup_count, new_count, updated_count, hot_count, warm_count, nurture_count, park_count, avg_score,
       duration_seconds, serpapi_credits, apollo_credits, hunter_search_credits, hunter_verify_credits
FROM (SELECT CAST(ts AS DATE) AS day, MIN(event_id) AS first_event, COUNT(*) AS raw_count, COUNT(DISTINCT user_id) AS dedup_count,
             COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS new_count,
             COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS updated_count,
             COUNT(CASE WHEN value >= 70 THEN 1 END) AS hot_count, COUNT(CASE WHEN value >= 45 AND value < 70 THEN 1 END) AS warm_count,
             COUNT(CASE WHEN value >= 25 AND value < 45 THEN 1 END) AS nurture_count, COUNT(CASE WHEN value < 25 THEN 1 END) AS park_count,
             CAST(MAX(value) AS DOUBLE) AS avg_score, CAST(0 AS BIGINT) AS duration_seconds,
             COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS serpapi_credits, CAST(0 AS BIGINT) AS apollo_credits,
             CAST(0 AS BIGINT) AS hunter_search_credits, CAST(0 AS BIGINT) AS hunter_verify_credits
      FROM events GROUP BY CAST(ts AS DATE)) d
"""

# Request log: one call per event.
CALLS = """
SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'organisation' WHEN 2 THEN 'contact' ELSE 'verification' END
         AS provider, event_type <> 'error' AS ok
FROM events
"""

# Keywords per vertical: the distinct part names of every brand, in the order of their first part.
KEYWORDS = """
SELECT p_brand AS vertical, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS vpos, p_name AS keyword, CAST(MIN(p_partkey) AS INT) AS kpos
FROM part GROUP BY p_brand, p_name
"""

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


# Names that differ between the engines.
DUCKDB = {"{w}": "lambda w:", "{all}": ", 'g'", "{join}": "array_to_string", "{map}": "list_transform", "{slice}": "list_slice", "{sort}": "list_sort", "{distinct}": "list_distinct"}
SPARK = {"{w}": "w ->", "{all}": "", "{join}": "array_join", "{map}": "transform", "{slice}": "slice", "{sort}": "array_sort", "{distinct}": "array_distinct"}


def _named(sql: str, names: dict[str, str]) -> str:
    for mark, name in names.items():
        sql = sql.replace(mark, name)
    return sql


def for_duckdb(sql: str) -> str:
    return _named(sql, DUCKDB)


def for_spark(sql: str) -> str:
    return _named(sql, SPARK).replace("\\", "\\\\")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Tables that the recipes of the running query share, by folder and recipe.
_shared: ContextVar[dict[tuple[str, str], DataFrame] | None] = ContextVar("shared", default=None)
# Recipes inside recipes that are worth a table when a query uses them, and the names they go by then.
COMMON = {"lead_words": WORDS}


def deriving_once(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with the words of the documents derived once, as a table, however often its recipes use them."""

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        token = _shared.set({})
        try:
            return build(spark, folder)
        finally:
            _shared.reset(token)

    return run


def drop_shared() -> None:
    """Deletes the shared tables of the running query: for queries that have written all that they derive from them."""
    shared = _shared.get()
    if shared:
        discard(*shared.values())
        shared.clear()


def derive(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Runs a recipe over the tables of a folder; tables are passed by reference, no view is left behind."""
    named, shared = {}, _shared.get()
    for name, recipe in COMMON.items():
        if shared is not None and sql != recipe and f"({recipe})" in sql:
            if (folder, name) not in shared:
                shared[folder, name] = cut(derive(spark, folder, recipe), name)
            named[name] = shared[folder, name]
            sql = sql.replace(f"({recipe})", "{" + name + "}")
    text = for_spark(sql)
    for name in TABLES:
        for word in (f"FROM {name}", f"JOIN {name}"):
            for end in ("\n", " ", ")"):
                if word + end in text + "\n":
                    named[name] = table(spark, folder, name)
                    text = (text + "\n").replace(word + end, word.replace(name, "{" + name + "}") + end)
    # Braces of regular expressions must survive the formatter.
    text = text.replace("{", "{{").replace("}", "}}")
    for name in named:
        text = text.replace("{{" + name + "}}", "{" + name + "}")
    return spark.sql(text, **named)
