"""Saved raw responses (JSON) as tables. Missing keys read as null and become '' here, once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import keyword_text, text_or_blank

# Search position inside one response: seq = query_seq * POSITIONS + position.
POSITIONS = 1 << 16


def read_responses(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines files with an explicit schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def parse_responses(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Responses kept as text in a column."""
    return lines.select(F.from_json(column, schema).alias("r")).select("r.*")


def sorted_out(lines: DataFrame, schema: T.StructType, needs: list[str], column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(responses, quarantine) of responses kept as text; every line is in one of them.

    A line is put aside, with a reason and its text, if it is blank, is no JSON object, holds a value of another type than the
    schema's, or lacks one of the fields it `needs`. The other columns of `lines` stay beside quarantined lines. Both results read
    `lines` anew; cut it first if it is costly.
    """
    corrupt = T.StructType([*schema, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(column, corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    blank = F.coalesce(F.trim(F.col(column)) == "", F.lit(True))
    lacking = reduce(lambda a, b: a | b, [F.col(f"r.{name}").isNull() for name in needs], F.lit(False))
    reason = (
        F.when(blank, "blank")
        .when(~F.coalesce(F.ltrim(F.col(column)).startswith("{"), F.lit(False)), "no object")
        .when(F.col("r").isNull() | (F.col("r._corrupt").isNotNull() & F.get_json_object(column, "$").isNull()), "broken")
        .when(F.col("r._corrupt").isNotNull(), "wrong type")
        .when(lacking, "lacks a field")
    )
    told = lines.withColumn("r", parsed).withColumn("reason", reason)
    return told.filter("reason IS NULL").select("r.*").drop("_corrupt"), told.filter("reason IS NOT NULL").drop("r")


def search_hits(responses: DataFrame, provider: str | None = None) -> DataFrame:
    """One row per search hit: (seq, channel, vertical, keyword, title, link, snippet).

    `provider` picks the response shape; without one either shape is taken, an unknown one has no hits.
    """
    shapes = {"serpapi": F.col("organic_results"), "serper": F.col("organic")}
    if provider is None:
        hits = F.coalesce(*shapes.values())
    else:
        hits = shapes.get(provider, F.lit(None).cast(responses.schema["organic"].dataType))
    return responses.select("query_seq", "channel", "vertical", "keyword", F.posexplode(hits).alias("pos", "hit")).select(
        (F.col("query_seq") * POSITIONS + F.col("pos")).alias("seq"),
        *[text_or_blank(c).alias(c) for c in ("channel", "vertical", "keyword")],
        *[text_or_blank(f"hit.{c}").alias(c) for c in ("title", "link", "snippet")],
    )


def organisations(responses: DataFrame) -> DataFrame:
    """One row per organisation: (seq, vertical, keyword, org_id, name, phones, domain, revenue, keywords)."""
    return responses.select("query_seq", "vertical", "keyword", F.posexplode("organizations").alias("pos", "org")).select(
        (F.col("query_seq") * POSITIONS + F.col("pos")).alias("seq"),
        *[text_or_blank(c).alias(c) for c in ("vertical", "keyword")],
        text_or_blank("org.id").alias("org_id"),
        *[text_or_blank(f"org.{c}").alias(c) for c in ("name", "phone", "sanitized_phone", "primary_domain")],
        F.col("org.organization_revenue").alias("organization_revenue"),
        F.col("org.organization_revenue_printed").alias("organization_revenue_printed"),
        keyword_text(F.col("org.keywords")).alias("product_keywords"),
    )


def people(responses: DataFrame) -> DataFrame:
    """One row per person of an organisation, list position kept."""
    return responses.select("org_id", F.posexplode("people").alias("pos", "p")).select(
        "org_id", "pos", *[text_or_blank(f"p.{c}").alias(c) for c in ("first_name", "last_name", "title", "email")]
    )


def mailboxes(responses: DataFrame) -> DataFrame:
    """One row per mailbox of a domain; a domain without mailboxes keeps one row with null position."""
    return responses.select("domain", F.col("data.pattern").alias("pattern"), F.posexplode_outer("data.emails").alias("pos", "m")).select(
        "domain", "pattern", "pos",
        *[text_or_blank(f"m.{c}").alias(c) for c in ("value", "first_name", "last_name", "position")],
        F.col("m.confidence").alias("confidence"),
    )


def verifications(responses: DataFrame) -> DataFrame:
    """(email, verified); a failed check reads 'unknown'. Several answers for an e-mail: the least one."""
    return responses.groupBy("email").agg(
        F.min(F.coalesce("data.status", F.lit("unknown"))).alias("verified")
    )
