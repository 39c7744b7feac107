"""Listing lifecycle over successive runs, derived in closed form from the observation log.

A listing's state depends only on the positions of the runs in which it was seen, so nothing steps
run by run. The run table is reduced first (one row per source and run); for every run it is known
which later run would mark a listing last seen there as missing, retired or pruned. One window per
listing (bounded by the number of runs) then places the transitions. Absence needs no
listing x run grid: only runs where a state changes are produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.numbers import elapsed_days, elapsed_seconds, micros
from marketlens.session import small_side

SOURCE = ["vehicle_key", "source"]
LISTING = [*SOURCE, "canonical_listing_id"]
RETIRE_AFTER_MISSES = 3
RETIRE_AFTER_DAYS = 14
RETIRED_MAX_AGE_DAYS = 365
DAY_MICROS = 86_400_000_000
STATES = ("active", "reappeared", "missing", "retired")


def run_calendar(runs: DataFrame, *, misses: int = RETIRE_AFTER_MISSES,
                 days: int = RETIRE_AFTER_DAYS, max_age_days: int = RETIRED_MAX_AGE_DAYS) -> DataFrame:
    """Successful runs per source in order, each with the runs where a listing last seen in it
    turns missing, retired and pruned.

    ``runs``: vehicle_key, source, run_id, run_ts, optional successful. One row per run, so the
    windows below are as long as a source has runs, whatever the number of listings.
    """
    if "successful" in runs.columns:
        runs = runs.where("successful")
    distinct = runs.groupBy(*SOURCE, "run_id").agg(F.max("run_ts").alias("run_ts"))
    order = Window.partitionBy(*SOURCE).orderBy("run_ts", "run_id")
    later = Window.partitionBy(*SOURCE).orderBy("_us")
    placed = distinct.select(
        *SOURCE, "run_id", "run_ts", F.row_number().over(order).alias("r"),
        micros(F.col("run_ts")).alias("_us"),
    )
    run = F.struct("r", "run_id", "run_ts")

    def first_after(us: int) -> Column:
        return F.min(run).over(later.rangeBetween(us, Window.unboundedFollowing))

    def later_of(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))

    aged = first_after((max_age_days * 86400 + 1) * 1_000_000)
    retired = later_of(F.lead(run, misses).over(order), first_after(days * DAY_MICROS))
    return placed.withColumns({
        "miss_run": F.lead(run).over(order),
        "retire_run": retired,
        "_aged": aged,
        "last_run": F.max(run).over(Window.partitionBy(*SOURCE)),
    }).withColumn("prune_run", later_of(F.col("retire_run"), F.col("_aged"))).drop("_us", "_aged")


def deduplicated_log(accepted: DataFrame, position: str = "source_record_index") -> DataFrame:
    """One observation per listing and run; replaying a run replaces it (idempotent)."""
    return accepted.groupBy(*LISTING, "run_id").agg(
        F.max_by("price_cad", position).alias("price_cad"),
    )


def sightings(log: DataFrame, calendar: DataFrame, *, small: bool = True) -> DataFrame:
    """Every observation with its state, reason and the sighting before and after it.

    The calendar is broadcast when its counted size allows, so the log is shuffled once, by listing.
    """
    seen = log.join(small_side(calendar) if small else calendar, [*SOURCE, "run_id"])
    w = Window.partitionBy(*LISTING).orderBy("r")
    before = F.lag(F.struct("r", "run_ts", "retire_run", "prune_run")).over(w)
    seen = seen.withColumn("_p", before).withColumn("next_seen_r", F.lead("r").over(w))
    gap = F.col("_p.r").isNotNull() & (F.col("r") - F.col("_p.r") > 1)
    expired = F.coalesce(F.col("_p.prune_run.r") < F.col("r"), F.lit(False))
    retired = F.coalesce(F.col("_p.retire_run.r") < F.col("r"), F.lit(False))
    seen = seen.withColumn("_gap", gap & ~expired).withColumn(
        "_first", F.col("_p").isNull() | F.col("_p.r").isNull() | expired
    ).withColumn("_retired", retired)
    back = F.coalesce(F.lag("_gap").over(w), F.lit(False))
    seen = seen.withColumn("_back", back)
    prior = (
        F.when(F.col("_first"), F.lit(None).cast("string"))
        .when(F.col("_gap") & F.col("_retired"), F.lit("retired"))
        .when(F.col("_gap"), F.lit("missing"))
        .when(F.col("_back"), F.lit("reappeared"))
        .otherwise(F.lit("active"))
    )
    seen = seen.withColumn("prior_state", prior)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    gaps = F.sum(F.col("_gap").cast("int")).over(upto)
    place = F.row_number().over(w)
    seen = seen.withColumn("_gaps", gaps).withColumn("_n", place)
    start = F.last(
        F.when(F.col("_first"), F.struct("_n", "_gaps", "run_ts")), ignorenulls=True
    ).over(upto)
    seen = seen.withColumn("_start", start)
    return seen.select(
        *LISTING, "run_id", "run_ts", "r", "price_cad", "prior_state",
        F.when(F.col("_gap"), F.lit("reappeared")).otherwise(F.lit("active")).alias("lifecycle_state"),
        F.when(F.col("_first"), F.lit("first_successful_observation"))
        .when(F.col("_gap"), F.concat(F.lit("observed_after_"), F.col("prior_state")))
        .when(F.col("_back"), F.lit("observed_consecutively_after_reappearance"))
        .otherwise(F.lit("observed_in_successful_source_run")).alias("lifecycle_state_reason"),
        (F.col("_gaps") - F.col("_start._gaps")).cast("bigint").alias("reappearance_count"),
        (F.col("_n") - F.col("_start._n") + 1).cast("bigint").alias("observation_count"),
        F.col("_start.run_ts").alias("first_seen_at"),
        "next_seen_r", "miss_run", "retire_run", "prune_run", "last_run",
    )


def current_state(seen: DataFrame) -> DataFrame:
    """State of every tracked listing at the last run of its source (pruned ones are gone)."""
    latest = seen.where(F.col("next_seen_r").isNull() & F.col("prune_run").isNull())
    missed = F.col("last_run.r") - F.col("r")
    retired = F.col("retire_run").isNotNull()
    since = elapsed_seconds(F.col("run_ts"), F.col("last_run.run_ts"))
    age = elapsed_seconds(F.col("first_seen_at"), F.col("run_ts"))
    return latest.select(
        *LISTING,
        F.when(missed == 0, F.col("lifecycle_state"))
        .when(retired, F.lit("retired")).otherwise(F.lit("missing")).alias("lifecycle_state"),
        F.when(missed == 0, F.col("lifecycle_state_reason"))
        .when(retired & (F.col("retire_run.r") < F.col("last_run.r")),
              F.lit("remains_unobserved_after_retirement"))
        .when(retired, F.lit("retirement_threshold_met"))
        .otherwise(F.lit("not_observed_in_successful_source_run")).alias("lifecycle_state_reason"),
        missed.cast("bigint").alias("missing_run_count"),
        "reappearance_count", "observation_count", "first_seen_at",
        F.col("run_ts").alias("last_seen_at"), F.col("run_id").alias("last_observed_run_id"),
        F.col("last_run.run_id").alias("last_evaluated_run_id"),
        F.col("last_run.run_ts").alias("last_evaluated_at"),
        age.alias("elapsed_since_first_seen_seconds"),
        elapsed_days(age).alias("elapsed_since_first_seen_days"),
        since.alias("elapsed_since_last_seen_seconds"),
        elapsed_days(since).alias("elapsed_since_last_seen_days"),
    )


def transitions(seen: DataFrame, *, with_pruned: bool = False) -> DataFrame:
    """First sights and state changes with previous state, new state, reason and run."""
    def event(run: Column, previous: Column, new: Column, reason: Column) -> Column:
        return F.struct(
            run["r"].alias("r"), run["run_id"].alias("run_id"), run["run_ts"].alias("event_at"),
            previous.alias("previous_state"), new.alias("new_state"), reason.alias("reason"))

    def before_next(run: Column) -> Column:
        return run.isNotNull() & (
            F.col("next_seen_r").isNull() | (run["r"] < F.col("next_seen_r")))

    own = F.struct("r", "run_id", "run_ts")
    state = F.col("lifecycle_state")
    events = [
        F.when(F.col("prior_state").isNull() | (F.col("prior_state") != state),
               event(own, F.col("prior_state"), state, F.col("lifecycle_state_reason"))),
        F.when(before_next(F.col("miss_run")),
               event(F.col("miss_run"), state, F.lit("missing"),
                     F.lit("not_observed_in_successful_source_run"))),
        F.when(before_next(F.col("retire_run")),
               event(F.col("retire_run"), F.lit("missing"), F.lit("retired"),
                     F.lit("retirement_threshold_met"))),
    ]
    if with_pruned:
        events.append(F.when(
            before_next(F.col("prune_run")),
            event(F.col("prune_run"), F.lit("retired"), F.lit("pruned"),
                  F.lit("retired_tombstone_age_limit_exceeded"))))
    return seen.select(*LISTING, F.explode(F.array_compact(F.array(*events))).alias("e")) \
        .select(*LISTING, "e.*")


def run_summary(seen: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per run: observed, new, reappeared, transitions and the number of listings per state.

    State counts are running sums of transition counts over the short run calendar, so no run
    looks at all listings.
    """
    moves = transitions(seen, with_pruned=True).groupBy(*SOURCE, "r").agg(
        F.count_if(F.col("new_state") != "pruned").alias("transition_event_count"),
        F.count_if(F.col("reason") == "first_successful_observation").alias("new_listing_count"),
        F.count_if(F.col("new_state") == "reappeared").alias("reappeared_listing_count"),
        F.count_if(F.col("new_state") == "pruned").alias("retired_listings_pruned_this_run"),
        *[(F.count_if(F.col("new_state") == s)
           - F.count_if(F.coalesce("previous_state", F.lit("")) == s)).alias(f"_{s}") for s in STATES],
    )
    observed = seen.groupBy(*SOURCE, "r").agg(F.count("*").alias("observed_current_count"))
    grid = calendar.select(*SOURCE, "r", "run_id") \
        .join(observed, [*SOURCE, "r"], "left").join(moves, [*SOURCE, "r"], "left").na.fill(0)
    upto = Window.partitionBy(*SOURCE).orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    named = {
        "active": "active_listing_count", "reappeared": "current_reappeared_listing_count",
        "missing": "missing_listing_count", "retired": "retired_listing_count",
    }
    counts = [F.sum(f"_{s}").over(upto).alias(named[s]) for s in STATES]
    out = grid.select(
        *SOURCE, "run_id", F.col("r").cast("bigint").alias("successful_source_run_count"),
        "observed_current_count", "new_listing_count", "reappeared_listing_count",
        "transition_event_count", "retired_listings_pruned_this_run", *counts,
    )
    return out.withColumn("tracked_listing_count", sum((F.col(n) for n in named.values()), F.lit(0)))
