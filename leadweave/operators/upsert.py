"""State table: matching a batch against it, and the next snapshot.

Rows of a batch see the rows before them: a company inserted or given a domain by one row is found by later rows. A
batch that is resolved (its companies neither share a domain nor match by name) can skip that part.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import SEARCH_COLUMNS
from ..functions.hosts import host
from ..functions.names import company_key, sorted_tokens
from ..functions.text import blank_to_null, matches_terms
from ..schemas import LIST_COLUMNS, SIGHTING_COLUMNS, STATE_COLUMNS, STATE_SCHEMA, STATE_TYPES
from ..session import cut, lookup, row_order, temporary_tables
from ..settings import Settings
from ..sources.tables import VersionConflict, finished_versions, read_state, write_state
from .fuzzy import PAIR_BUDGET, first_match
from .name_index import NameIndex
from .merge import chosen, filled, first_place, united_lists, with_chosen
from .resolve import key_leaders, revise_leaders
from .scoring import score_companies


@dataclass
class StoredNames:
    """The stored index of the state's names, and the state version it is read at."""

    names: NameIndex
    version: int


@dataclass
class Rescore:
    """What updated rows are scored by."""

    settings: Settings
    states: list[str]


SCORE_COLUMNS = ["score", "score_breakdown", "tier"]
# Columns an update may fill when they are blank in the state.
UPDATABLE = [c for c in SIGHTING_COLUMNS if c not in LIST_COLUMNS and c not in ("company_name", "scraped_date")]


def domain_matches(batch: DataFrame, state: DataFrame) -> DataFrame:
    """(seq, target): batch rows whose domain the state knows, with the lowest id."""
    known = state.filter("domain <> ''").groupBy("domain").agg(F.min("id").alias("target"))
    rows = batch.filter("domain <> ''").select("seq", "domain")
    return rows.join(known, "domain").select("seq", "target")


def name_matches(batch: DataFrame, state: DataFrame, budget: int = PAIR_BUDGET, first_chunk: int = 200_000, index: StoredNames | None = None) -> DataFrame:
    """(seq, target): lowest state id whose name matches. Works on distinct names on both sides, those of the state from an index if given."""
    named = batch.select("seq", "name_key").filter("name_key <> ''")
    probe = cut(
        named.groupBy("name_key").agg(F.min("seq").alias("ord"), F.count(F.lit(1)).alias("n")), "batch-names"
    )
    if index is not None:
        hits = index.names.first_match(probe.select("ord", "name_key"), index.version, budget)
    else:
        keyed = state.select("id", sorted_tokens("normalized_name").alias("name_key")).filter("name_key <> ''")
        known = cut(keyed.groupBy("name_key").agg(F.min("id").alias("ord")), "state-names")
        hits = first_match(probe.select("ord", "name_key"), known, budget, first_chunk)
    by_name = cut(probe.join(hits, "ord").select("name_key", F.col("match").alias("target"), "n"), "name-hits")
    total = by_name.agg(F.sum("n")).first()[0] or 0
    found = lookup(named, by_name.select("name_key", "target"), "name_key", by_name.select("name_key", "n"), total)
    return found.filter("target IS NOT NULL").select("seq", "target")


def match_state(batch: DataFrame, state: DataFrame, **limits) -> DataFrame:
    """(seq, target) for every batch row that hits a state row: by domain, else by name."""
    keyed = batch.select(
        "seq", host("website").alias("domain"), company_key("company_name").alias("normalized_name")
    ).withColumn("name_key", sorted_tokens("normalized_name"))
    by_domain = cut(domain_matches(keyed, state), "domain-hits")
    rest = keyed.join(by_domain, "seq", "left_anti")
    return by_domain.unionByName(name_matches(rest, state, **limits))


def place(batch: DataFrame, state: DataFrame, **limits) -> DataFrame:
    """(seq, is_new, company) for every batch row: the state id, or the `seq` of the row that founds its company.

    Rule of each row, given the rows before it: the company that owns its domain, else the earliest company with a
    matching name (state rows by id, then founders), else it founds one. A company owns one domain: its first one.
    The rule of a row only looks back, so an assignment that satisfies the rule of every row is the sequential one. It
    is found by repetition: guess when each domain is owned, let all rows before that take the name test, derive the
    owners from the outcome, and stop when the rows that take the test stay the same. From the second round on, only the
    names that a change reaches are tested again (`revise_leaders`).

    The rounds end: let s be the first row whose test status a round changes. Rows before s stand for good, so the next
    round finds the status of s for good, and its first change comes later. There are at most as many rounds as rows that
    are not the first of their domain, and in fact as many as a domain decides a name that decides a domain in turn.
    """
    keyed = cut(batch.select("seq", host("website").alias("domain"), sorted_tokens(company_key("company_name")).alias("name_key")), "keyed")
    at_once = domain_matches(keyed, state).select("seq", F.lit(False).alias("is_new"), F.col("target").alias("company"))
    rest = keyed.join(at_once.select("seq"), "seq", "left_anti")
    rest = cut(rest.join(name_matches(rest, state, **limits), "seq", "left"), "rest")
    with_domain = F.col("domain") != ""
    bare = state.filter("domain = ''").select(F.col("id").alias("company"), F.lit(False).alias("is_new"), F.lit(True).alias("bare"))
    domains = cut(rest.filter(with_domain).groupBy("domain").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")), "domains")
    owners = domains.select("domain", F.col("first").alias("since"), F.lit(True).alias("owner_new"), F.col("first").alias("owner"))
    rows = domains.agg(F.sum("n")).first()[0] or 0
    first, decided, before = None, None, rest.select(*rest.columns, F.lit(False).alias("tested"))
    while True:
        owned = lookup(rest.filter(with_domain), owners, "domain", domains.select("domain", "n"), rows)
        seen = owned.unionByName(rest.filter(~with_domain), allowMissingColumns=True)
        test = ~with_domain | F.col("since").isNull() | (F.col("seq") <= F.col("since"))
        seen = cut(seen.withColumn("tested", test).join(before.select("seq", F.col("tested").alias("_was")), "seq"), "seen")
        if decided is not None:
            change = seen.filter("tested <> _was").agg(F.min("seq")).first()[0]
            if change is None:
                break
            if first is not None and change <= first:
                raise RuntimeError("the first change must move on")  # see above: cannot happen
            first = change
        before = seen
        tested = seen.filter("tested").select(*rest.columns)
        keys = cut(tested.filter("target IS NULL AND name_key <> ''").groupBy("name_key").agg(F.min("seq").alias("ord"), F.count(F.lit(1)).alias("n")), "names")
        names = keys.select("ord", "name_key")
        decided = revise_leaders(decided, names) if decided is not None else cut(names.join(key_leaders(names), "ord"), "decided")
        named = lookup(tested, decided.select("name_key", "leader"), "name_key", keys.select("name_key", "n"), keys.agg(F.sum("n")).first()[0] or 0)
        named = cut(named.select("seq", "domain", F.col("target").isNull().alias("is_new"), F.coalesce("target", "leader", "seq").alias("company")), "named")
        founded = named.filter(F.col("is_new") & (F.col("seq") == F.col("company")))
        blank = bare.unionByName(founded.filter(~with_domain).select("company", "is_new", F.lit(True).alias("bare")))
        given = named.filter(with_domain).join(blank, ["company", "is_new"], "left_semi").groupBy("company", "is_new").agg(
            F.min(F.struct("seq", "domain")).alias("first")).select("first.domain", "first.seq", "is_new", "company")
        own = founded.filter(with_domain).select("domain", "seq", "is_new", "company").unionByName(given)
        least = own.groupBy("domain").agg(F.min(F.struct("seq", "is_new", "company")).alias("o"))
        owners = cut(least.select("domain", F.col("o.seq").alias("since"), F.col("o.is_new").alias("owner_new"), F.col("o.company").alias("owner")), "owners")
    later = seen.filter(with_domain & (F.col("seq") > F.col("since"))).select("seq", F.col("owner_new").alias("is_new"), F.col("owner").alias("company"))
    return at_once.unionByName(named.select("seq", "is_new", "company")).unionByName(later)


def fold_batch(rows: DataFrame, target: str = "target") -> DataFrame:
    """Batch rows per state row: first filled value per column, first domain, number of rows."""
    picks = cut(rows.groupBy(target).agg(
        F.count(F.lit(1)).alias("_n"),
        *[first_place(c).alias(f"_p_{c}") for c in UPDATABLE],
        F.min(F.when(F.col("domain") != "", F.col("seq"))).alias("_p_domain"),
    ), "picks")
    columns = [*UPDATABLE, "domain"]
    found = with_chosen(rows, picks, target, columns, [f"_p_{c}" for c in columns])
    return found.select(target, *[chosen(f"_p_{c}", c).alias(f"_n_{c}") for c in columns], F.col("_n").alias("_rows"))


def updated_rows(state: DataFrame, matched: DataFrame, today: dt.date, rescore: Rescore | None = None) -> DataFrame:
    """State after the update branch: lists united, blanks filled, protected columns untouched.

    A score is filled only where it is 0, and the tier stays. With `rescore`, rows that the batch meets are scored anew from
    their merged values, tier and breakdown included.
    """
    folded = fold_batch(matched)
    touched = state.join(matched.select(F.col("target").alias("id")).distinct(), "id", "left_semi")
    items = touched.select("id", *LIST_COLUMNS).unionByName(
        matched.select(F.col("target").alias("id"), *LIST_COLUMNS))
    lists = united_lists(items, "id").select("id", F.struct(*LIST_COLUMNS).alias("_lists"))
    joined = state.join(folded.withColumnRenamed("target", "id"), "id", "left").join(lists, "id", "left")
    hit = F.col("_rows").isNotNull()
    changes = {
        c: F.when(hit, F.coalesce(F.col(f"_lists.{c}"), F.lit(""))).otherwise(F.col(c)) for c in LIST_COLUMNS
    }
    for c in UPDATABLE:
        changes[c] = F.coalesce(F.when(filled(c), F.col(c)), F.col(f"_n_{c}"), F.col(c))
    changes["domain"] = F.coalesce(blank_to_null("domain"), F.col("_n_domain"), F.col("domain"))
    changes["last_seen"] = F.when(hit, F.lit(today)).otherwise(F.col("last_seen"))
    changes["run_count"] = (F.col("run_count") + F.coalesce("_rows", F.lit(0))).cast("int")
    rows = joined.withColumns(changes)
    if rescore is None:
        return rows.select(*STATE_COLUMNS)
    kept = {f"_old_{c}": F.col(c) for c in SCORE_COLUMNS}
    scored = score_companies(rows.withColumns(kept), rescore.settings, rescore.states)
    return scored.withColumns({c: F.when(hit, F.col(c)).otherwise(F.col(f"_old_{c}")) for c in SCORE_COLUMNS}).select(*STATE_COLUMNS)


def new_rows(numbered: DataFrame, today: dt.date) -> DataFrame:
    """Founding batch rows, with their `id`, as state rows."""
    values = {
        "normalized_name": company_key("company_name"),
        "domain": host("website"),
        "tier": F.when(F.col("tier") == "", "PARK").otherwise(F.col("tier")),
        "status": F.lit("NEW"),
        "first_seen": F.lit(today),
        "last_seen": F.lit(today),
        "run_count": F.lit(1),
        "status_updated": F.lit(None).cast("timestamp"),
        "status_notes": F.lit(""),
    }
    full = numbered.withColumns(values)
    return full.select(*[F.col(c).cast(STATE_TYPES[c]).alias(c) for c in STATE_COLUMNS])


def upsert_counts(placed: DataFrame) -> dict:
    """Rows that found a company and rows that update one, of rows with `target`: null for a founder."""
    return placed.agg(F.count_if(F.col("target").isNull()).alias("new_count"), F.count_if(F.col("target").isNotNull()).alias("updated_count")).first().asDict()


def upsert(state: DataFrame, batch: DataFrame, today: dt.date, resolved: bool = False, rescore: Rescore | None = None, **limits) -> tuple[DataFrame, dict]:
    """Next state snapshot and the counts of new and updated rows.

    The given state is never overwritten; write the result as a new snapshot. `resolved`: the rows of the batch are
    different companies, so only the state is searched. `rescore`: score the rows that are updated anew.
    """
    if resolved:
        hits = match_state(batch, state, **limits).select("seq", F.lit(False).alias("is_new"), F.col("target").alias("company"))
    else:
        hits = place(batch, state, **limits)
    rows = batch.withColumn("domain", host("website")).join(cut(hits, "hits"), "seq", "left")
    founds = F.col("company").isNull() | (F.col("is_new") & (F.col("company") == F.col("seq")))
    max_id = state.agg(F.max("id")).first()[0] or 0
    fresh = cut(row_order(rows.filter(founds).drop("domain", "is_new", "company"), "seq", "id", max_id), "fresh")
    known = state.unionByName(new_rows(fresh, today))
    ids = fresh.select(F.lit(True).alias("is_new"), F.col("seq").alias("company"), F.col("id").alias("new_id"))
    matched = rows.filter(~founds).join(ids, ["is_new", "company"], "left").withColumn("target", F.coalesce("new_id", "company")).drop("is_new", "company", "new_id")
    counts = upsert_counts(rows.select(F.when(~founds, F.col("company")).alias("target")))
    return updated_rows(known, matched, today, rescore), counts


def stored_upsert(
    spark: SparkSession, home: str, batch: DataFrame, today: dt.date, resolved: bool = False, indexed: bool = True, attempts: int = 10,
    rescore: Rescore | None = None, **limits,
) -> tuple[int, dict]:
    """Upserts into the state stored under `home`/state: (new version, counts).

    If another writer commits a version in between, the batch is upserted anew into that one, so that no update is lost.

    `indexed`: names are looked up in an index under `home`/names. It is made with the first state that has names beside
    it; later runs read only the buckets their names fall in and add the names of the rows they insert. The index version is
    written after the state's: a run that fails in between leaves a state whose newest names the index lacks, so an index
    older than the state is made up for first.
    """
    root = f"{home}/state"
    for _ in range(attempts):
        with temporary_tables(spark):
            base = max(finished_versions(spark, root), default=0)
            state = read_state(spark, root, base or None)
            names = _names_up_to(spark, home, base) if indexed and base else None
            stored = StoredNames(names, base) if names else None
            rows, counts = upsert(state, batch, today, resolved, index=stored, rescore=rescore, **limits)
            try:
                version = write_state(rows, root, base)
            except VersionConflict:
                continue
            if indexed:
                _names_up_to(spark, home, version)
            return version, counts
    raise VersionConflict(f"{attempts} attempts met other writers")


def _names_up_to(spark: SparkSession, home: str, version: int) -> NameIndex:
    """The name index, with the names of all state versions up to the given one."""
    root, names_root = f"{home}/state", f"{home}/names"
    done = finished_versions(spark, f"{names_root}/rows")
    if not done:
        return NameIndex.create(read_state(spark, root, version), names_root, version)
    names = NameIndex.open(spark, names_root)
    for late in [v for v in finished_versions(spark, root) if max(done) < v <= version]:
        names.extend(state_rows_since(spark, root, late), late)
    return names


def state_rows_since(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Rows of a state version whose id is above those of the version before."""
    before = [v for v in finished_versions(spark, root) if v < version]
    top = read_state(spark, root, before[-1]).agg(F.max("id")).first()[0] if before else None
    return read_state(spark, root, version).filter(F.col("id") > (top or 0))


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def name_contains(key: str):
    """Condition on normalised names; `%` and `_` in the key keep their LIKE meaning."""
    return F.lower("normalized_name").like("%" + key.replace("\\", "\\\\") + "%")


def set_status(state: DataFrame, name: str, status: str, at: dt.datetime, note: str = "") -> tuple[DataFrame, int]:
    """State with a new status, note and time on every row whose name contains the given one, and the number of these rows."""
    key = state.sparkSession.range(1).select(company_key(F.lit(name))).first()[0]
    hit = name_contains(key)
    changed = state.withColumns({
        "status": F.when(hit, F.lit(status)).otherwise(F.col("status")),
        "status_updated": F.when(hit, F.lit(at)).otherwise(F.col("status_updated")),
        "status_notes": F.when(hit, F.lit(note)).otherwise(F.col("status_notes")),
    })
    return changed, state.filter(hit).count()


def set_verified(state: DataFrame, results: DataFrame) -> DataFrame:
    """State with the verification results (id, verified) filled in."""
    return (
        state.join(results.select("id", "verified"), "id", "left")
        .withColumn("email_verified", F.coalesce("verified", "email_verified"))
        .select(*state.columns)
    )


def search(state: DataFrame, query: str) -> DataFrame:
    return state.filter(matches_terms(query, SEARCH_COLUMNS))
