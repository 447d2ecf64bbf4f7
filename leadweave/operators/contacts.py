"""Choosing contacts: from people lists, from domain mailboxes, and applying them to companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import FIRST_CHOICE_TITLES, PATTERN_NOTE, SECOND_CHOICE_TITLES
from ..functions.hosts import is_blocked, website_host
from ..functions.text import any_of, full_name, strip, text_or_blank
from ..session import cut, lookup

# What was found for at most so many searched rows is broadcast.
BROADCAST_ROWS = 100_000
# Rows that were not searched follow the searched ones in output order.
NOT_SEARCHED_OFFSET = 1 << 61


def title_choice(title: Column | str) -> Column:
    """1 for a logistics title, 2 for an operations title, else null."""
    low = F.lower(text_or_blank(title))
    return F.when(low.rlike(any_of(FIRST_CHOICE_TITLES)), 1).when(low.rlike(any_of(SECOND_CHOICE_TITLES)), 2)


def best_people(people: DataFrame) -> DataFrame:
    """First person of the best title class per organisation.

    `people`: (org_id, pos, first_name, last_name, title, email).
    """
    # Class and place in one number: the smallest one per organisation is a hash aggregate over two columns.
    ranked = people.withColumn("_choice", title_choice("title")).filter("_choice IS NOT NULL").withColumn(
        "_rank", F.col("_choice") * F.lit(1 << 60) + F.col("pos"))
    first = ranked.groupBy("org_id").agg(F.min("_rank").alias("_rank"))
    return ranked.join(first, ["org_id", "_rank"], "left_semi").select(
        "org_id", full_name("first_name", "last_name").alias("contact_name"), text_or_blank("title").alias("contact_title"),
        text_or_blank("email").alias("contact_email"), F.lit("apollo").alias("contact_source"),
    ).dropDuplicates(["org_id"])


def best_mailboxes(mailboxes: DataFrame) -> DataFrame:
    """Most trusted mailbox of the best title class per domain, and the domain's address pattern.

    `mailboxes`: (domain, pattern, pos, value, first_name, last_name, position, confidence), one row per
    mailbox; a domain without mailboxes has one row with null `pos`.
    """
    choice = title_choice("position")
    mailbox = F.struct(
        full_name("first_name", "last_name").alias("contact_name"),
        text_or_blank("position").alias("contact_title"),
        text_or_blank("value").alias("contact_email"),
        F.col("confidence").alias("email_confidence"),
    )
    order = F.struct(-choice, F.coalesce("confidence", F.lit(0)), -F.col("pos"))
    return mailboxes.groupBy("domain").agg(
        F.max_by(mailbox, F.when(choice.isNotNull() & F.col("pos").isNotNull(), order)).alias("best"),
        F.max(F.nullif("pattern", F.lit(""))).alias("pattern"),
    )


def is_searchable(user_blocked=()) -> Column:
    """Rows worth a contact search: website, no e-mail yet, not from the people source, not blocked."""
    return is_wanting() & ~is_blocked("website", user_blocked)


def is_wanting() -> Column:
    return (F.col("website") != "") & (F.col("contact_email") == "") & (F.col("contact_source") != "apollo")


def within_quota(rows: DataFrame, condition: Column, quota: int) -> DataFrame:
    """Adds `searched`: the first `quota` rows by `seq` among those meeting the condition."""
    flagged = rows.withColumn("_wanted", condition)
    chosen = flagged.filter("_wanted").select("seq").orderBy("seq").limit(quota)
    return (
        flagged.join(chosen.withColumn("searched", F.lit(True)), "seq", "left")
        .withColumn("searched", F.coalesce("searched", F.lit(False)))
    )


def pattern_note(notes: Column, pattern: Column, domain: Column) -> Column:
    """Notes with the address pattern of the domain on a line of its own."""
    note = F.concat(F.lit(f"{PATTERN_NOTE}: "), pattern, F.lit("@"), domain)
    return F.when(notes == "", note).otherwise(strip(F.concat(notes, F.lit("\n"), note)))


def with_patterns(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose domain has an address pattern, with it. `known`: (domain, pattern), one row per domain.

    Very many rows may share a domain, or have none: such keys are told apart by their counts.
    """
    rows = rows.filter("domain IS NOT NULL")
    counts = cut(rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")), "domains")
    told = lookup(rows, known.filter("pattern IS NOT NULL"), "domain", counts, counts.agg(F.sum("n")).first()[0] or 0, plain=0)
    return told.filter("pattern IS NOT NULL")


def enrich(rows: DataFrame, mailboxes: DataFrame, quota: int, user_blocked=()) -> DataFrame:
    """Fills contacts of searchable rows within the quota; searched rows come first in `seq`."""
    columns = rows.columns
    flagged = within_quota(rows, is_searchable(user_blocked), quota).withColumn(
        "_host", F.when(F.col("searched"), website_host("website"))
    )
    found = best_mailboxes(mailboxes).withColumnRenamed("domain", "_host")
    if quota <= BROADCAST_ROWS:
        # Few hosts are searched: what was found for them goes to the rows, and the texts of all rows stay where they are.
        asked = flagged.filter("searched").select("_host").distinct()
        joined = flagged.join(F.broadcast(found.join(asked, "_host", "left_semi")), "_host", "left")
    else:
        # Rows that are not searched have no host: they are dealt by number, or one task would get them all.
        spread = F.coalesce("_host", F.concat(F.lit("\u0000"), F.coalesce(F.col("seq").cast("string"), F.lit(""))))
        joined = flagged.withColumn("_dealt", spread).join(found.withColumnRenamed("_host", "_dealt"), "_dealt", "left")
    hit = F.col("best").isNotNull()
    noted = ~hit & F.col("pattern").isNotNull()
    updates = {
        c: F.when(hit, F.col(f"best.{c}")).otherwise(F.col(c))
        for c in ("contact_name", "contact_title", "contact_email", "email_confidence")
    }
    updates["contact_source"] = F.when(hit, F.lit("hunter")).otherwise(F.col("contact_source"))
    updates["notes"] = F.when(noted, pattern_note(text_or_blank("notes"), F.col("pattern"), F.col("_host"))).otherwise(
        F.col("notes"))
    updates["seq"] = F.when(F.col("_wanted"), F.col("seq")).otherwise(F.col("seq") + F.lit(NOT_SEARCHED_OFFSET))
    return joined.withColumns(updates).select(*columns)
