"""Whole runs: collect, resolve, enrich, score, store and report; and e-mail verification."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extract_state
from ..operators.contacts import enrich
from ..operators.merge import merge_companies
from ..operators.reports import dashboard, needs_verification, new_on, result_counts, run_average, run_tiers, sheet
from ..operators.resolve import assign_leaders
from ..operators.scoring import score_companies
from ..operators.upsert import Rescore, set_verified, stored_upsert
from ..session import cut, temporary_tables
from ..settings import Settings
from ..sources.tables import append_run, read_runs, read_stage, read_state, write_report, write_stage
from .channels import all_channels


def with_states(rows: DataFrame) -> DataFrame:
    """Fills a blank state from the notes."""
    wanted = (F.col("state") == "") & (F.col("notes") != "")
    return rows.withColumn("state", F.when(wanted, extract_state("notes")).otherwise(F.col("state")))


def resolve(sightings: DataFrame, **limits) -> DataFrame:
    """One merged row per company."""
    return merge_companies(assign_leaders(sightings, **limits))


def prepare(
    sightings: DataFrame, mailboxes: DataFrame | None, settings: Settings, states: list[str], scoring: bool = True
) -> DataFrame:
    """Resolved companies with states, contacts and scores."""
    rows = with_states(resolve(sightings))
    if mailboxes is not None:
        rows = enrich(rows, mailboxes, settings.max_contact_searches, settings.user_blocked)
    return score_companies(rows, settings, states) if scoring else rows


@dataclass
class RunResult:
    raw_count: int
    dedup_count: int
    new_count: int
    updated_count: int
    version: int


def full_run(
    spark: SparkSession,
    home: str,
    channels: dict[str, DataFrame],
    mailboxes: DataFrame | None,
    settings: Settings,
    states: list[str],
    today: dt.date,
    calls: dict[str, int] | None = None,
    scoring: bool = True,
    run_id: str = "run",
    stages: bool = True,
    indexed: bool = False,
    rescore: bool = False,
) -> RunResult:
    """Runs all steps on the given channel sightings; tables live under `home`.

    Every stage is a table of the run folder, so later steps read files, not recomputed plans. `indexed`: the state's names
    are looked up in a stored index. `rescore`: returning companies are scored anew from their merged row.
    """
    started = time.time()
    folder = f"{home}/runs/{run_id}"
    def kept(rows: DataFrame, stage: str) -> DataFrame:
        """The rows as a table, read back: a stage of the run, or an intermediate table."""
        if not stages:
            return cut(rows, stage)
        write_stage(rows, folder, stage)
        return read_stage(spark, folder, stage)

    with temporary_tables(spark):
        sightings = all_channels({name: kept(rows, name) for name, rows in channels.items()})
        companies = kept(resolve(sightings), "dedup")
        rows = with_states(companies)
        if mailboxes is not None:
            rows = kept(enrich(rows, mailboxes, settings.max_contact_searches, settings.user_blocked), "hunter")
        if scoring:
            rows = score_companies(rows, settings, states)
        rows = cut(rows, "scored")
        again = Rescore(settings, states) if rescore and scoring else None
        version, counts = stored_upsert(spark, home, rows, today, resolved=True, indexed=indexed, rescore=again)
        raw, dedup = sightings.count(), rows.count()
        tiers = run_tiers(rows).first().asDict()
        append_run(
            spark, f"{home}/history",
            states_used=", ".join(states), verticals_used=", ".join(settings.vertical_keywords),
            channels_used=", ".join(channels), raw_count=raw, dedup_count=dedup, **counts, **tiers,
            avg_score=run_average(rows).first()[0], duration_seconds=int(time.time() - started), **(calls or {}),
        )
        publish(spark, home, today)
        return RunResult(raw, dedup, counts["new_count"], counts["updated_count"], version)


def publish(spark: SparkSession, home: str, today: dt.date) -> None:
    """Report files of the current state: full CSV, the two sheets, the dashboard and the run log."""
    state = read_state(spark, f"{home}/state")
    write_report(state, f"{home}/reports/{today}/all")
    for name, rows in {
        "new_this_run": sheet(new_on(state, today)),
        "full": sheet(state),
        "dashboard": dashboard(state, today),
        "run_log": read_runs(spark, f"{home}/history"),
    }.items():
        rows.write.mode("overwrite").parquet(f"{home}/reports/{today}/{name}")


def verification_batch(state: DataFrame, answers: DataFrame, tiers: list[str], limit: int) -> DataFrame:
    """(id, contact_email, verified) for the best unverified e-mails; no answer reads 'unknown'."""
    batch = needs_verification(state, tiers, limit).select("id", "contact_email")
    return batch.join(answers, F.col("contact_email") == F.col("email"), "left").select(
        "id", "contact_email", F.coalesce("verified", F.lit("unknown")).alias("verified"))


def verify_emails(
    state: DataFrame, answers: DataFrame, settings: Settings, tiers: tuple[str, ...] = ("HOT", "WARM")
) -> tuple[DataFrame, DataFrame]:
    """State with the results of one verification run, and the counts per result."""
    results = cut(verification_batch(state, answers, list(tiers), settings.max_verifications), "verified")
    return set_verified(state, results), result_counts(results)
