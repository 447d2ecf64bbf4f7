"""Channels: raw hits or organisations in, sightings out. New channels register a function of the same shape."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CHANNEL_ORDER
from ..functions.hosts import host, is_blocked, name_from_import_title, name_from_title
from ..functions.text import blank_to_null, detect_signals, revenue
from ..operators.contacts import NOT_SEARCHED_OFFSET, best_people
from ..operators.firsthit import first_per
from ..schemas import SIGHTING_FIELDS
from ..settings import Settings

# Sightings of channel i are numbered from i * CHANNEL_SPAN; all stay below the offset of rows that are not searched.
CHANNEL_SPAN = 1 << 54
MOST_CHANNELS = NOT_SEARCHED_OFFSET // CHANNEL_SPAN

Channel = Callable[..., DataFrame]
CHANNELS: dict[str, Channel] = {}


def channel(name: str) -> Callable[[Channel], Channel]:
    """Registers a channel function."""
    def add(build: Channel) -> Channel:
        CHANNELS[name] = build
        return build
    return add


def as_sightings(rows: DataFrame, scraped: Column | None = None, **values: Column | str) -> DataFrame:
    """Projects rows onto the sighting columns; columns not given are blank."""
    blanks = {"string": F.lit(""), "bigint": F.lit(None), "int": F.lit(None)}
    defaults = {n: blanks[t.simpleString()] for n, t in SIGHTING_FIELDS}
    defaults["score"] = F.lit(0)
    defaults["scraped_date"] = F.date_format(F.current_date(), "yyyy-MM-dd") if scraped is None else scraped
    chosen = defaults | values
    return rows.select("seq", *[F.expr(v).cast(t).alias(n) if isinstance(v, str) else v.cast(t).alias(n)
                                for (n, t), v in ((f, chosen[f[0]]) for f in SIGHTING_FIELDS)])


def usable_hits(hits: DataFrame, user_blocked=()) -> DataFrame:
    """Hits on a host that is not blocked, with `host` added."""
    return hits.withColumn("host", host("link")).filter(~is_blocked("host", user_blocked))


@channel("web_search")
def web_channel(hits: DataFrame, settings: Settings = Settings(), scraped: Column | None = None) -> DataFrame:
    """First hit per host, with vertical and inline signals."""
    firsts = first_per(usable_hits(hits, settings.user_blocked), "host")
    return as_sightings(
        firsts, scraped, company_name=name_from_title("title", "host"), website=F.col("host"),
        vertical=F.col("vertical"), source_channel=F.lit("web_search"),
        compliance_signals=F.array_join(detect_signals("title", "snippet"), ", "), notes=F.col("snippet"),
    )


@channel("sqep")
def signal_channel(hits: DataFrame, settings: Settings = Settings(), scraped: Column | None = None) -> DataFrame:
    """First hit per host among those naming a compliance signal; no vertical."""
    found = usable_hits(hits, settings.user_blocked).withColumn("signals", detect_signals("title", "snippet"))
    firsts = first_per(found.filter(F.size("signals") > 0), "host")
    return as_sightings(
        firsts, scraped, company_name=name_from_title("title", "host"), website=F.col("host"),
        source_channel=F.lit("sqep"), compliance_signals=F.array_join("signals", ", "), notes=F.col("snippet"),
    )


@channel("import_search")
def import_channel(
    hits: DataFrame, settings: Settings = Settings(), scraped: Column | None = None, from_index: Column | None = None
) -> DataFrame:
    """Import-index hits (name only) and open-web hits (host), first one per host, else per name.

    `from_index` tells index hits; by default the column `from_index`.
    """
    index_hit = F.col("from_index") if from_index is None else from_index
    marked = hits.withColumn("_index", index_hit).withColumn("host", host("link"))
    named = marked.filter("_index").withColumns({"name": name_from_import_title("title"), "host": F.lit("")}).filter("name <> ''")
    general = marked.filter("NOT _index").filter(~is_blocked("host", settings.user_blocked)).withColumn(
        "name", name_from_title("title", "host"))
    keyed = named.unionByName(general).withColumn("_key", F.coalesce(blank_to_null("host"), F.lower("name")))
    return as_sightings(
        first_per(keyed, "_key"), scraped, company_name=F.col("name"), website=F.col("host"),
        source_channel=F.lit("import"), import_products=F.col("keyword"), notes=F.col("snippet"),
    )


def revenue_in_range(amount: Column, settings: Settings) -> Column:
    """Unknown revenue passes; each bound is inclusive and optional."""
    test = F.lit(True)
    if settings.revenue_min is not None:
        test = test & (amount >= settings.revenue_min)
    if settings.revenue_max is not None:
        test = test & (amount <= settings.revenue_max)
    return amount.isNull() | test


def is_foreign_phone(phone: Column) -> Column:
    return phone.startswith("+") & ~phone.startswith("+1")


def usable_organisations(orgs: DataFrame, settings: Settings) -> DataFrame:
    """Organisations with an unblocked domain, fitting revenue and a domestic or unknown phone."""
    return (
        orgs.filter(~is_blocked("primary_domain", settings.user_blocked))
        .withColumn("revenue", revenue("organization_revenue", "organization_revenue_printed"))
        .filter(revenue_in_range(F.col("revenue"), settings))
        .withColumn("phone", F.coalesce(blank_to_null("phone"), F.col("sanitized_phone")))
        .filter(~is_foreign_phone(F.col("phone")))
    )


@channel("apollo")
def organisation_channel(
    orgs: DataFrame, people: DataFrame, settings: Settings = Settings(), scraped: Column | None = None
) -> DataFrame:
    """Organisations within the profile with their best person; repeats stay for the resolution."""
    kept = usable_organisations(orgs, settings).withColumn("host", host("primary_domain"))
    contacts = best_people(people)
    joined = kept.join(contacts, "org_id", "left")
    picked = {c: F.coalesce(c, F.lit("")) for c in ("contact_name", "contact_title", "contact_email", "contact_source")}
    return as_sightings(
        joined, scraped, company_name=F.coalesce(blank_to_null("name"), F.col("host")), phone=F.col("phone"),
        website=F.col("host"), vertical=F.col("vertical"), source_channel=F.lit("apollo"),
        estimated_revenue=F.col("revenue"), product_keywords=F.col("product_keywords"), **picked,
    )


def all_channels(parts: dict[str, DataFrame]) -> DataFrame:
    """Sightings of all channels, numbered in channel order."""
    known = [n for n in CHANNEL_ORDER if n in parts] + [n for n in parts if n not in CHANNEL_ORDER]
    if len(known) > MOST_CHANNELS:
        raise ValueError(f"at most {MOST_CHANNELS} channels, not {len(known)}")
    numbered = [
        parts[name].withColumn("seq", F.col("seq") + F.lit(i * CHANNEL_SPAN)) for i, name in enumerate(known)
    ]
    return reduce(DataFrame.unionByName, numbered)
