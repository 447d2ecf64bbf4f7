"""Requests a run would send, as tables keyed like the saved responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fixed_values import US_STATES
from ..settings import Settings


KEYWORD_ROW = "vertical string, vpos int, kpos int, keyword string"


def vertical_keywords(spark: SparkSession, settings: Settings) -> DataFrame:
    """(vertical, vpos, kpos, keyword), one row per keyword."""
    rows = [(v, i, j, k) for i, (v, words) in enumerate(settings.vertical_keywords.items()) for j, k in enumerate(words)]
    return spark.createDataFrame(rows, KEYWORD_ROW)


def import_keywords(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [(v, i, j, k) for i, v in enumerate(settings.vertical_keywords) for j, k in enumerate(settings.import_keywords.get(v, []))]
    return spark.createDataFrame(rows, KEYWORD_ROW)


def only_verticals(rows: DataFrame, wanted: list[str] | None) -> DataFrame:
    """Rows of the wanted verticals; an empty wish means all."""
    return rows.filter(F.col("vertical").isin(list(wanted))) if wanted else rows


def only_channels(rows: DataFrame, wanted: list[str] | None, available: list[str]) -> DataFrame:
    return rows.filter(F.col("channel").isin(list(wanted or available)))


def resolve_states(settings: Settings, names: str | None = None, nationwide: bool = False) -> list[str]:
    """Target states: all, the named lists in order without repeats, or the default list."""
    if nationwide:
        return [code for _, code in US_STATES]
    if names:
        wanted = [n.strip() for n in names.split(",")]
        unknown = [n for n in wanted if n not in settings.state_lists]
        if unknown:
            raise ValueError(f"unknown state list {unknown[0]!r}; known: {', '.join(settings.state_lists)}")
        return list(dict.fromkeys(s for n in wanted for s in settings.state_lists[n]))
    if settings.default_state_list:
        return list(settings.state_lists[settings.default_state_list])
    raise ValueError("name a state list: there is no default")


def web_requests(keywords: DataFrame, states: list[str]) -> DataFrame:
    """Every keyword with every target state, in vertical, keyword, state order.

    `keywords`: (vertical, vpos, kpos, keyword). The at most 50 states are an array literal, so the
    product is an explode and needs no join.
    """
    return (
        keywords.select("vertical", "vpos", "kpos", "keyword", F.posexplode(F.array(*[F.lit(s) for s in states])).alias("spos", "state"))
        .select("vertical", "vpos", "kpos", "spos", "keyword", "state", F.concat_ws(" ", "keyword", "state").alias("query"))
    )


def signal_requests(terms: DataFrame) -> DataFrame:
    """Configured terms as they are: (pos, query)."""
    return terms.select("pos", F.col("term").alias("query"))


def import_requests(keywords: DataFrame) -> DataFrame:
    """Two queries per import keyword: the import index first, then the open web."""
    both = F.array(
        F.format_string('site:importyeti.com "%s"', "keyword"),
        F.format_string('"%s" manufacturer importer USA', "keyword"),
    )
    return keywords.select("vertical", "vpos", "kpos", "keyword", F.posexplode(both).alias("qpos", "query"))


def first_of(keywords: DataFrame, number: int) -> DataFrame:
    """The first keywords of every vertical. A rank below a bound: each task passes on at most `number` rows per vertical."""
    place = F.row_number().over(Window.partitionBy("vertical").orderBy("kpos"))
    return keywords.select("vertical", "vpos", "kpos", "keyword").withColumn("_place", place).filter(F.col("_place") <= number).drop("_place")


def organisation_requests(keywords: DataFrame, max_pages: int, first_keywords: int = 3) -> DataFrame:
    """First keywords of every vertical, each with its result pages."""
    return first_of(keywords, first_keywords).select("*", F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("page"))


def request_counts(keywords: DataFrame, terms: DataFrame, imports: DataFrame, states: list[str]) -> DataFrame:
    """(channel, calls): search calls per channel."""
    web = keywords.agg((F.count(F.lit(1)) * len(states)).alias("calls"))
    signal = terms.agg(F.count(F.lit(1)).alias("calls"))
    imported = imports.agg((F.count(F.lit(1)) * 2).alias("calls"))
    named = [(web, "web_search"), (signal, "sqep"), (imported, "import_search")]
    out = [df.select(F.lit(name).alias("channel"), F.col("calls").cast("bigint").alias("calls")) for df, name in named]
    return out[0].unionByName(out[1]).unionByName(out[2])
