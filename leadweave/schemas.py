"""Explicit schemas. Blank text is '' everywhere, never null."""

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# (name, type) of one company sighting, in output order.
SIGHTING_FIELDS = [
    ("company_name", S), ("address", S), ("city", S), ("state", S), ("zip_code", S), ("phone", S), ("website", S),
    ("vertical", S), ("source_channel", S), ("estimated_employees", L), ("estimated_revenue", L),
    ("product_keywords", S), ("compliance_signals", S), ("contact_name", S), ("contact_title", S),
    ("contact_email", S), ("contact_source", S), ("email_verified", S), ("email_confidence", I),
    ("registration_id", S), ("import_products", S), ("notes", S), ("score", I), ("score_breakdown", S),
    ("tier", S), ("scraped_date", S),
]
SIGHTING_COLUMNS = [n for n, _ in SIGHTING_FIELDS]
SIGHTING_SCHEMA = T.StructType(
    [T.StructField("seq", L, False)] + [T.StructField(n, t) for n, t in SIGHTING_FIELDS]
)

LIST_COLUMNS = ["source_channel", "vertical", "product_keywords", "compliance_signals"]
CONTACT_COLUMNS = [
    "contact_name", "contact_title", "contact_email", "contact_source", "email_verified", "email_confidence",
]
# Filled by the first non-blank value when sightings are merged.
FILL_COLUMNS = [
    n for n, _ in SIGHTING_FIELDS
    if n not in LIST_COLUMNS and n not in CONTACT_COLUMNS and n not in ("company_name", "scraped_date")
]

STATE_COLUMNS = (
    ["id", "company_name", "normalized_name", "domain"]
    + [n for n in SIGHTING_COLUMNS if n not in ("company_name", "scraped_date")]
    + ["status", "first_seen", "last_seen", "run_count", "status_updated", "status_notes"]
)
STATE_TYPES = dict(SIGHTING_FIELDS) | {
    "id": L, "normalized_name": S, "domain": S, "status": S, "first_seen": T.DateType(), "last_seen": T.DateType(),
    "run_count": I, "status_updated": T.TimestampType(), "status_notes": S,
}
STATE_SCHEMA = T.StructType([T.StructField(n, STATE_TYPES[n]) for n in STATE_COLUMNS])

RUN_SCHEMA = T.StructType(
    [T.StructField("id", L), T.StructField("run_date", T.TimestampType())]
    + [T.StructField(n, S) for n in ("states_used", "verticals_used", "channels_used")]
    + [T.StructField(n, L) for n in (
        "raw_count", "dedup_count", "new_count", "updated_count",
        "hot_count", "warm_count", "nurture_count", "park_count")]
    + [T.StructField("avg_score", D)]
    + [T.StructField(n, L) for n in (
        "duration_seconds", "serpapi_credits", "apollo_credits", "hunter_search_credits", "hunter_verify_credits")]
)

HIT = T.ArrayType(T.StructType([T.StructField(n, S) for n in ("title", "link", "snippet")]))
LINEAGE = [T.StructField("query_seq", L), T.StructField("channel", S), T.StructField("vertical", S),
           T.StructField("keyword", S)]
SEARCH_RESPONSE = T.StructType(
    LINEAGE + [T.StructField("organic_results", HIT), T.StructField("organic", HIT)]
)
ORGANISATION = T.StructType([
    T.StructField("id", S), T.StructField("name", S), T.StructField("phone", S), T.StructField("sanitized_phone", S),
    T.StructField("primary_domain", S), T.StructField("organization_revenue", D),
    T.StructField("organization_revenue_printed", S), T.StructField("keywords", T.ArrayType(S)),
])
ORGANISATION_RESPONSE = T.StructType(LINEAGE + [T.StructField("organizations", T.ArrayType(ORGANISATION))])
PERSON = T.StructType([T.StructField(n, S) for n in ("first_name", "last_name", "title", "email")])
PEOPLE_RESPONSE = T.StructType([T.StructField("org_id", S), T.StructField("people", T.ArrayType(PERSON))])
MAILBOX = T.StructType(
    [T.StructField(n, S) for n in ("value", "first_name", "last_name", "position")]
    + [T.StructField("confidence", I)]
)
DOMAIN_RESPONSE = T.StructType([
    T.StructField("domain", S),
    T.StructField("data", T.StructType([T.StructField("pattern", S), T.StructField("emails", T.ArrayType(MAILBOX))])),
])
VERIFICATION_RESPONSE = T.StructType([
    T.StructField("email", S), T.StructField("data", T.StructType([T.StructField("status", S)])),
])
