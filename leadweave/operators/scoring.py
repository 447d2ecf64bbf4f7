"""Four-part lead score with vertical multiplier and tier, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LOGISTICS_TITLES, PATTERN_NOTE
from ..functions.text import any_of, list_items, strip, text_or_blank
from ..settings import BOTTOM_TIER, Settings


def channel_points(settings: Settings) -> Column:
    """Points by number of distinct channels."""
    count = F.size(F.array_distinct(list_items("source_channel")))
    points = F.lit(0)
    for least, value in sorted(settings.channel_points.items()):
        points = F.when(count >= least, value).otherwise(points)
    return points


def signal_points(settings: Settings) -> Column:
    """Sum of the points of all known compliance signals."""
    signals = list_items(F.lower("compliance_signals"))
    total = F.lit(0)
    for name, value in settings.signal_points.items():
        total = total + F.when(F.array_contains(signals, name), value).otherwise(0)
    return total


def state_points(settings: Settings, states: list[str]) -> Column:
    inside = (F.col("state") != "") & F.col("state").isin(list(states))
    return F.when(inside, settings.state_points["in_target_state"]).otherwise(settings.state_points["other"])


def is_logistics_title(title: Column | str) -> Column:
    return F.lower(text_or_blank(title)).rlike(any_of(LOGISTICS_TITLES))


def contact_points(settings: Settings) -> Column:
    """Points for the quality of the contact on the row."""
    points = settings.contact_points
    has = {c: strip(text_or_blank(f"contact_{c}")) != "" for c in ("email", "title", "name")}
    return (
        F.when(has["email"] & has["title"] & is_logistics_title("contact_title"), points["email_and_logistics_title"])
        .when(has["email"], points["email"])
        .when(text_or_blank("notes").contains(PATTERN_NOTE), points["pattern"])
        .when(has["name"], points["name_only"])
        .otherwise(points["website_only"])
    )


def best_vertical(settings: Settings) -> Column:
    """struct(multiplier, label): highest multiplier over the verticals, the first of equals."""
    known = F.create_map(*[F.lit(x) for pair in settings.vertical_multipliers.items() for x in pair])
    names = list_items(F.lower(text_or_blank("vertical")))
    rated = F.transform(
        names,
        lambda v, i: F.struct(
            F.coalesce(F.element_at(known, v), F.lit(settings.unknown_multiplier)).alias("multiplier"),
            (-i).alias("rank"),
            v.alias("label"),
        ),
    )
    nothing = F.struct(
        F.lit(settings.unknown_multiplier).alias("multiplier"), F.lit(0).alias("rank"), F.lit("unknown").alias("label")
    )
    return F.coalesce(F.array_max(rated), nothing)


def tier_of(score: Column, settings: Settings) -> Column:
    tier = F.lit(BOTTOM_TIER)
    for name, floor in sorted(settings.tier_floors.items(), key=lambda x: x[1]):
        tier = F.when(score >= floor, name).otherwise(tier)
    return tier


def score_companies(rows: DataFrame, settings: Settings, states: list[str]) -> DataFrame:
    """Fills score, score_breakdown and tier of every row; no shuffle, no UDF."""
    parts = rows.withColumns({
        "_signal": channel_points(settings),
        "_compliance": signal_points(settings),
        "_geo": state_points(settings, states),
        "_enrich": contact_points(settings),
        "_best": best_vertical(settings),
    })
    subtotal = F.col("_signal") + F.col("_compliance") + F.col("_geo") + F.col("_enrich")
    scored = parts.withColumn("_sub", subtotal).withColumn(
        # rint rounds halves to even on doubles
        "score", F.rint(F.col("_sub").cast("double") * F.col("_best.multiplier")).cast("int")
    )
    text = F.concat(
        F.lit("Signal:"), F.col("_signal"), F.lit(" + Compliance:"), F.col("_compliance"),
        F.lit(" + Geo:"), F.col("_geo"), F.lit(" + Enrich:"), F.col("_enrich"),
        F.lit(" = "), F.col("_sub"), F.lit(" x "), F.col("_best.multiplier").cast("string"),
        F.lit("("), F.col("_best.label"), F.lit(") = "), F.col("score"), F.lit(" -> "), F.col("tier"),
    )
    return (
        scored.withColumn("tier", tier_of(F.col("score"), settings))
        .withColumn("score_breakdown", text)
        .select(*rows.columns)
    )
