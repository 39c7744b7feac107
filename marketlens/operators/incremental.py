"""Lifecycle state kept as a table and advanced by one run per source.

The batch form (``lifecycle``) recomputes from the log; this one joins the kept state with the
accepted listings of the new runs on the listing key, so a run costs one shuffle of state and run.
It also carries what a log cannot show: bounded history, compaction digest and pruning by count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.ids import ZERO_DIGEST, chain_digest
from marketlens.functions.numbers import elapsed_days, elapsed_seconds
from marketlens.operators.lifecycle import LISTING, RETIRE_AFTER_DAYS, RETIRE_AFTER_MISSES, SOURCE
from marketlens.operators.prices import KEEP_OBSERVATIONS, observation_json
from marketlens.operators.retention import MAX_RETIRED_PER_SOURCE, retired_to_prune

OBSERVATION = "struct<observed_at: timestamp, run_id: string, price_cad: bigint>"
STATE_SCHEMA = (
    "vehicle_key string, source string, canonical_listing_id string, lifecycle_state string, "
    "lifecycle_state_reason string, previous_state string, first_seen_at timestamp, last_seen_at timestamp, "
    "last_observed_run_id string, last_evaluated_at timestamp, last_evaluated_run_id string, "
    "observation_count bigint, missing_run_count bigint, reappearance_count bigint, "
    f"price_observations array<{OBSERVATION}>, compacted_price_observation_count bigint, "
    "price_observation_compaction_digest_sha256 string, first_observed_price_cad bigint, "
    "minimum_observed_price_cad bigint, maximum_observed_price_cad bigint, "
    "elapsed_since_last_seen_days double"
)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def upgrade(old: DataFrame) -> DataFrame:
    """State of the first schema: counts and digest that it lacked get their defaults."""
    have = set(old.columns)
    history = F.coalesce("price_observations", F.array().cast(f"array<{OBSERVATION}>"))

    def kept(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in have else default

    count = kept("observation_count", F.size(history).cast("bigint"))
    defaults = {
        "price_observations": history, "observation_count": count,
        "compacted_price_observation_count": kept(
            "compacted_price_observation_count", F.greatest(F.lit(0), count - F.size(history)).cast("bigint")),
        "price_observation_compaction_digest_sha256": kept(
            "price_observation_compaction_digest_sha256", F.lit(ZERO_DIGEST)),
        "missing_run_count": kept("missing_run_count", F.lit(0).cast("bigint")),
        "reappearance_count": kept("reappearance_count", F.lit(0).cast("bigint")),
    }
    columns = [f.strip().split(" ")[0] for f in STATE_SCHEMA.replace(OBSERVATION, "x").split(",")]
    types = {f.name: f.dataType for f in old.sparkSession.createDataFrame([], STATE_SCHEMA).schema.fields}
    return old.select(*[
        (defaults[c] if c in defaults else F.col(c) if c in have else F.lit(None)).cast(types[c]).alias(c)
        for c in columns])


def advance(state: DataFrame, runs: DataFrame, accepted: DataFrame) -> DataFrame:
    """State after one successful run per source; replaying the last run changes only its price.

    ``runs``: vehicle_key, source, run_id, run_ts (one row per source, possibly without listings);
    ``accepted``: vehicle_key, source, canonical_listing_id, price_cad of those runs.
    """
    now = accepted.groupBy(*LISTING).agg(F.max("price_cad").alias("_price")).withColumn("_seen", F.lit(True))
    run = runs.select(*SOURCE, F.col("run_id").alias("_run"), F.col("run_ts").alias("_at"))
    joined = state.withColumn("_old", F.lit(True)).join(now, LISTING, "full").join(run, SOURCE, "left")
    c = F.col
    old, seen, due = c("_old").isNotNull(), c("_seen").isNotNull(), c("_run").isNotNull()
    fresh = due & (~old | (c("last_evaluated_run_id") != c("_run")))
    prior = c("lifecycle_state")
    absent = prior.isin("missing", "retired")
    misses = c("missing_run_count") + 1
    days = elapsed_days(elapsed_seconds(c("last_seen_at"), c("_at")))
    due_out = (misses >= RETIRE_AFTER_MISSES) & (days >= RETIRE_AFTER_DAYS)
    new_state = (
        F.when(~fresh, prior)
        .when(seen & ~old, F.lit("active")).when(seen & absent, F.lit("reappeared")).when(seen, F.lit("active"))
        .when((prior == "retired") | due_out, F.lit("retired")).otherwise(F.lit("missing")))
    reason = (
        F.when(~fresh, c("lifecycle_state_reason"))
        .when(seen & ~old, F.lit("first_successful_observation"))
        .when(seen & absent, F.concat(F.lit("observed_after_"), prior))
        .when(seen & (prior == "reappeared"), F.lit("observed_consecutively_after_reappearance"))
        .when(seen, F.lit("observed_in_successful_source_run"))
        .when(prior == "retired", F.lit("remains_unobserved_after_retirement"))
        .when(due_out, F.lit("retirement_threshold_met"))
        .otherwise(F.lit("not_observed_in_successful_source_run")))
    zero = F.lit(0).cast("bigint")
    none = F.array().cast(f"array<{OBSERVATION}>")
    kept = F.filter(F.coalesce("price_observations", none), lambda o: o["run_id"] != c("_run"))
    entry = F.struct(c("_at").alias("observed_at"), c("_run").alias("run_id"), c("_price").alias("price_cad"))
    history = F.when(seen & due, F.array_sort(F.concat(kept, F.array(entry).cast(f"array<{OBSERVATION}>")))) \
        .otherwise(F.coalesce("price_observations", none))
    out = joined.withColumn("_history", history)
    cut = F.greatest(F.size("_history") - KEEP_OBSERVATIONS, F.lit(0))
    removed = F.transform(F.slice("_history", F.lit(1), cut),
                          lambda o: observation_json(o["run_id"], o["observed_at"], o["price_cad"]))

    def when_seen(new: Column, before: Column) -> Column:
        return F.when(seen & due, new).otherwise(before)

    out = out.select(
        *LISTING, new_state.alias("lifecycle_state"), reason.alias("lifecycle_state_reason"),
        F.when(fresh, prior).otherwise(c("previous_state")).alias("previous_state"),
        F.coalesce("first_seen_at", "_at").alias("first_seen_at"),
        when_seen(c("_at"), c("last_seen_at")).alias("last_seen_at"),
        when_seen(c("_run"), c("last_observed_run_id")).alias("last_observed_run_id"),
        F.when(fresh, c("_at")).otherwise(c("last_evaluated_at")).alias("last_evaluated_at"),
        F.when(fresh, c("_run")).otherwise(c("last_evaluated_run_id")).alias("last_evaluated_run_id"),
        (F.coalesce("observation_count", zero)
         + F.when(seen & (fresh | (c("last_observed_run_id") != c("_run"))), 1).otherwise(0)).alias("observation_count"),
        F.when(~fresh, c("missing_run_count")).when(seen, zero).otherwise(misses).alias("missing_run_count"),
        (F.coalesce("reappearance_count", zero) + F.when(fresh & seen & absent, 1).otherwise(0))
        .alias("reappearance_count"),
        F.slice("_history", cut + 1, F.lit(KEEP_OBSERVATIONS)).alias("price_observations"),
        (F.coalesce("compacted_price_observation_count", zero) + cut).alias("compacted_price_observation_count"),
        chain_digest(removed, F.coalesce("price_observation_compaction_digest_sha256", F.lit(ZERO_DIGEST)))
        .alias("price_observation_compaction_digest_sha256"),
        F.coalesce("first_observed_price_cad", "_price").alias("first_observed_price_cad"),
        F.least("minimum_observed_price_cad", "_price").alias("minimum_observed_price_cad"),
        F.greatest("maximum_observed_price_cad", "_price").alias("maximum_observed_price_cad"),
        when_seen(F.lit(0.0), F.when(fresh, days).otherwise(c("elapsed_since_last_seen_days")))
        .alias("elapsed_since_last_seen_days"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in state.schema.fields])


def is_event() -> Column:
    """Whether a state row is a first sight or a change made by the run it was evaluated at."""
    return F.col("previous_state").isNull() | (F.col("previous_state") != F.col("lifecycle_state"))


def event_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        *LISTING, F.col("last_evaluated_run_id").alias("run_id"), F.col("last_evaluated_at").alias("event_at"),
        "previous_state", F.col("lifecycle_state").alias("new_state"),
        F.col("lifecycle_state_reason").alias("reason"))


def events_of(state: DataFrame, runs: DataFrame) -> DataFrame:
    """First sights and changes made by the given runs."""
    here = runs.select(*SOURCE, F.col("run_id").alias("last_evaluated_run_id"))
    return event_columns(state.join(here, [*SOURCE, "last_evaluated_run_id"], "left_semi").where(is_event()))


def deletion_records(gone: DataFrame) -> DataFrame:
    """Records of pruned state rows that carry their ``reason``."""
    payload = F.to_json(F.struct(*sorted(c for c in gone.columns if c != "reason")), {"ignoreNullFields": "false"})
    return gone.select(
        *LISTING, "reason", "first_seen_at", "last_seen_at", "observation_count",
        F.col("lifecycle_state").alias("final_lifecycle_state"),
        F.octet_length(payload).cast("bigint").alias("listing_bytes"), F.sha2(payload, 256).alias("listing_sha256"))


def prune(state: DataFrame, keep: int = MAX_RETIRED_PER_SOURCE) -> tuple[DataFrame, DataFrame]:
    """Remaining state and the deletion records of retired listings over the age or count limit."""
    gone = retired_to_prune(state, keep=keep)
    return state.join(gone.select(*LISTING), LISTING, "left_anti"), deletion_records(gone)
