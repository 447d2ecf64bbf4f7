"""Merging all sightings of a company into one row.

Closed forms of the pairwise merge in `seq` order. Which row gives which value is decided first, by aggregates over numbers
that combine on the map side: a company seen in a third of all rows costs each task one row. Then the chosen rows, at most
one a column, are fetched by one join; texts of the other rows are never grouped or sorted by group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CONTACT_SOURCE_RANK
from ..functions.text import list_items, list_text
from ..schemas import CONTACT_COLUMNS, FILL_COLUMNS, LIST_COLUMNS, SIGHTING_COLUMNS, SIGHTING_FIELDS
from ..session import cut, lookup

_TYPES = {name: kind.simpleString() for name, kind in SIGHTING_FIELDS}


def filled(name: str, zero_is_blank: bool = True) -> Column:
    """Condition: the column holds a value ('' and null are blank, 0 by choice)."""
    if _TYPES[name] == "string":
        return F.col(name) != ""
    return (F.col(name) != 0) if zero_is_blank else F.col(name).isNotNull()


def first_place(name: str, order: str = "seq", zero_is_blank: bool = True) -> Column:
    """`order` of the earliest row where the column is not blank, null if there is none."""
    return F.min(F.when(filled(name, zero_is_blank), F.col(order)))


def with_chosen(rows: DataFrame, picks: DataFrame, group: str, columns: list[str], places: list[str], order: str = "seq") -> DataFrame:
    """`picks` with `_rows`: the rows of each group whose `order` stands in one of the columns `places`.

    `picks`: one row a group, with its number of rows `_n`. The chosen rows of groups that hold a large share of all rows are
    found by a broadcast of these groups' picks.
    """
    wanted = F.array_compact(F.array(*places)).alias("_wanted")
    told = lookup(rows.select(group, order, *columns), picks.select(group, wanted), group, picks.select(group, F.col("_n").alias("n")), picks.agg(F.sum("_n")).first()[0] or 0)
    chosen = told.filter(F.array_contains("_wanted", F.col(order))).groupBy(group).agg(F.collect_list(F.struct(order, *columns)).alias("_rows"))
    return picks.join(chosen, group, "left")


def chosen(place: str, name: str, order: str = "seq") -> Column:
    """A column of the row that stands at `place`, null without one."""
    return F.get(F.filter("_rows", lambda r: r[order] == F.col(place)), F.lit(0))[name]


def first_values(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, columns): value of the earliest row of the group where the column is not blank, null if there is none."""
    places = [first_place(c).alias(f"_f_{c}") for c in columns]
    picks = cut(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), *places), "picks")
    found = with_chosen(rows, picks, group, columns, [f"_f_{c}" for c in columns])
    return found.select(group, *[chosen(f"_f_{c}", c).alias(c) for c in columns])


def united_lists(rows: DataFrame, group: str, columns: list[str] = LIST_COLUMNS) -> DataFrame:
    """(group, one sorted comma list per column): union of the items of all rows of a group.

    Items are made distinct before they meet in a group, so a group only ever holds its result.
    """
    items = rows.select(
        group,
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("slot"), list_items(c).alias("items")) for i, c in enumerate(columns)
        ])),
    )
    distinct = items.select(group, "slot", F.explode("items").alias("item")).distinct()
    return distinct.groupBy(group).agg(
        *[list_text(F.collect_set(F.when(F.col("slot") == i, F.col("item")))).alias(c) for i, c in enumerate(columns)]
    )


def merge_companies(sightings: DataFrame, leader: str = "leader") -> DataFrame:
    """One row per leader: (seq, sighting columns).

    List columns are united (a lone sighting keeps its text), contact columns come from the best
    source, the leader keeps its name and date, every other column takes its first filled value.
    """
    by_rank = sorted({points for points in CONTACT_SOURCE_RANK.values()}, reverse=True)
    of_rank = {points: [s for s, p in CONTACT_SOURCE_RANK.items() if p == points] for points in by_rank}
    picks = sightings.groupBy(leader).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("seq").alias("_lead"),
        *[F.min(F.when(F.col("contact_source").isin(of_rank[points]), F.col("seq"))).alias(f"_b_{points}") for points in by_rank],
        *[first_place(c, zero_is_blank=False).alias(f"_c_{c}") for c in CONTACT_COLUMNS],
        *[first_place(c).alias(f"_f_{c}") for c in FILL_COLUMNS],
    )
    best = F.coalesce(*[f"_b_{points}" for points in by_rank])  # the first row of the best ranked source
    picks = cut(picks.withColumn("_best", best).drop(*[f"_b_{points}" for points in by_rank]), "picks")
    places = ["_lead", "_best", *[f"_c_{c}" for c in CONTACT_COLUMNS], *[f"_f_{c}" for c in FILL_COLUMNS]]
    joined = with_chosen(sightings, picks, leader, list(SIGHTING_COLUMNS), places)
    lists = united_lists(sightings, leader).select(leader, F.struct(*LIST_COLUMNS).alias("_lists"))
    joined = joined.join(lists, leader, "left")
    value = {c: chosen("_lead", c) for c in ("company_name", "scraped_date")}
    for c in LIST_COLUMNS:
        value[c] = F.when(F.col("_n") > 1, F.coalesce(F.col(f"_lists.{c}"), F.lit(""))).otherwise(chosen("_lead", c))
    for c in CONTACT_COLUMNS:
        loose = chosen(f"_c_{c}", c)
        loose = F.coalesce(loose, F.lit("")) if _TYPES[c] == "string" else loose
        value[c] = F.when(F.col("_best").isNotNull(), chosen("_best", c)).otherwise(loose)
    for c in FILL_COLUMNS:
        fallback = F.lit("") if _TYPES[c] == "string" else chosen("_lead", c)
        value[c] = F.coalesce(chosen(f"_f_{c}", c), fallback)
    return joined.select(F.col(leader).alias("seq"), *[value[c].cast(_TYPES[c]).alias(c) for c in SIGHTING_COLUMNS])
