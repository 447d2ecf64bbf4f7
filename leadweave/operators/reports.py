"""Reporting queries over the state table and a run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import SHEET_COLUMNS, TOP_NEW_COLUMNS


def by_score(rows: DataFrame) -> DataFrame:
    """Highest score first; a missing score counts as 0, ties by id."""
    return rows.orderBy(F.coalesce("score", F.lit(0)).desc(), "id")


def status_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("cnt"))


def tier_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("tier").agg(F.count(F.lit(1)).alias("cnt"))


def score_summary(state: DataFrame) -> DataFrame:
    """Rows and average score over all rows (null for an empty table)."""
    return state.agg(F.count(F.lit(1)).alias("total"), F.avg("score").alias("avg_score"))


def run_tiers(rows: DataFrame) -> DataFrame:
    """One row: companies per known tier, any case; a blank tier counts as PARK."""
    tier = F.when(F.col("tier") == "", "PARK").otherwise(F.upper("tier"))
    return rows.agg(*[F.count_if(tier == t).alias(f"{t.lower()}_count") for t in ("HOT", "WARM", "NURTURE", "PARK")])


def run_average(rows: DataFrame) -> DataFrame:
    """Average of the non-zero scores, 0.0 if there are none."""
    return rows.agg(F.coalesce(F.avg(F.nullif("score", F.lit(0))), F.lit(0.0)).alias("avg_score"))


def with_status(state: DataFrame, status: str) -> DataFrame:
    return by_score(state.filter(F.col("status") == status))


def new_on(state: DataFrame, day: dt.date) -> DataFrame:
    return by_score(state.filter(F.col("first_seen") == F.lit(day)))


def sheet(rows: DataFrame) -> DataFrame:
    return by_score(rows).select(*SHEET_COLUMNS)


def top_new(state: DataFrame, day: dt.date, n: int = 10) -> DataFrame:
    return new_on(state, day).limit(n).select(*TOP_NEW_COLUMNS)


def new_and_returning(state: DataFrame, day: dt.date) -> DataFrame:
    fresh = F.col("first_seen") == F.lit(day)
    return state.agg(
        F.count_if(fresh).alias("new_count"),
        F.count_if(~fresh).alias("returning_count"),
        F.count(F.lit(1)).alias("total"),
    )


def needs_verification(state: DataFrame, tiers: list[str], limit: int | None = None) -> DataFrame:
    """Rows with an unverified e-mail in the tiers, best score first."""
    open_mail = (F.col("contact_email") != "") & (F.coalesce("email_verified", F.lit("")) == "")
    rows = by_score(state.filter(open_mail & F.col("tier").isin(list(tiers))))
    return rows if limit is None else rows.limit(limit)


def result_counts(results: DataFrame) -> DataFrame:
    """Verification results per status."""
    return results.groupBy("verified").agg(F.count(F.lit(1)).alias("cnt")).orderBy("verified")


def dashboard(state: DataFrame, day: dt.date) -> DataFrame:
    """Long form (section, pos, key, value) of the dashboard: counts, summary and the best new rows."""
    from pyspark.sql import Window

    def ranked(counts: DataFrame, key: str, section: str, n: int) -> DataFrame:
        top = counts.orderBy(key).limit(n)  # at most n rows reach the numbering
        pos = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key))
        return top.select(
            F.lit(section).alias("section"), pos.alias("pos"), F.col(key).alias("key"), F.col("cnt").cast("string").alias("value"))

    summary = new_and_returning(state, day).select(
        F.lit("Run Summary").alias("section"),
        F.expr("stack(3, 1, 'New', new_count, 2, 'Returning', returning_count, 3, 'Total', total) AS (pos, key, value)"),
    ).withColumn("value", F.col("value").cast("string"))
    best = new_on(state, day).limit(10)
    pos = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.coalesce("score", F.lit(0)).desc(), "id"))
    top = best.withColumn("pos", pos).select(
        F.lit("Top New Prospects").alias("section"), "pos", F.col("company_name").alias("key"),
        F.concat_ws(" | ", *[F.col(c).cast("string") for c in TOP_NEW_COLUMNS[1:]]).alias("value"),
    )
    parts = [
        ranked(status_counts(state), "status", "Status Breakdown", 8),
        ranked(tier_counts(state), "tier", "Tier Distribution", 5),
        summary, top,
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def calls_used(log: DataFrame) -> DataFrame:
    """Calls per provider: every search call counts, other calls only when they succeeded."""
    counts = F.when(F.col("provider") == "search", F.lit(True)).otherwise(F.col("ok"))
    return log.groupBy("provider").agg(F.count_if(counts).alias("calls"))
