"""Price history per listing: summary, bounded history with a chained digest, log hygiene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.ids import chain_digest
from marketlens.operators.lifecycle import LISTING

KEEP_OBSERVATIONS = 13


def observation_json(run_id: Column, observed_at: Column, price: Column) -> Column:
    """Compact JSON with sorted keys, NULL written out."""
    return F.to_json(
        F.struct(
            F.date_format(observed_at, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("observed_at_utc"),
            price.alias("price_cad"), run_id.alias("run_id"),
        ),
        {"ignoreNullFields": "false"},
    )


def price_summary(seen: DataFrame) -> DataFrame:
    """First, previous, current, lowest and highest price and their differences.

    NULL prices stay NULL for current and previous; the first price is the first known one.
    """
    w = Window.partitionBy(*LISTING).orderBy("r")
    ranked = seen.withColumn("_prev", F.lag("price_cad").over(w)) \
        .withColumn("_older", F.lag("r").over(w))
    newest = F.max_by(F.struct("price_cad", "_prev", "_older"), F.col("r"))
    known = F.col("price_cad").isNotNull()
    agg = ranked.groupBy(*LISTING).agg(
        F.count("*").alias("price_observation_count"),
        F.min_by("price_cad", F.when(known, F.col("r"))).alias("first_observed_price_cad"),
        F.min("run_ts").alias("first_price_observed_at"),
        newest.alias("_new"),
        F.min("price_cad").alias("minimum_observed_price_cad"),
        F.max("price_cad").alias("maximum_observed_price_cad"),
    )
    current, previous = F.col("_new.price_cad"), F.col("_new._prev")
    return agg.select(
        *LISTING, "price_observation_count", "first_observed_price_cad", "first_price_observed_at",
        previous.alias("previous_observation_price_cad"), current.alias("current_price_cad"),
        "minimum_observed_price_cad", "maximum_observed_price_cad",
        (current - previous).alias("change_from_previous_observation_cad"),
        (current - F.col("first_observed_price_cad")).alias("change_from_first_observation_cad"),
    )


def bounded_history(seen: DataFrame, keep: int = KEEP_OBSERVATIONS) -> DataFrame:
    """Newest ``keep`` observations; older ones are folded in order into a chained digest.

    The array is bounded by the number of runs, since the log has one row per listing and run.
    """
    entry = F.struct(
        "run_ts", "run_id", "price_cad",
        observation_json(F.col("run_id"), F.col("run_ts"), F.col("price_cad")).alias("_json"),
    )
    ordered = F.array_sort(F.collect_list(entry))
    cut = F.greatest(F.size("_all") - keep, F.lit(0))
    return seen.groupBy(*LISTING).agg(ordered.alias("_all")).select(
        *LISTING,
        F.transform(F.slice("_all", cut + 1, F.lit(keep)),
                    lambda o: F.struct(o["run_id"].alias("run_id"), o["run_ts"].alias("observed_at"),
                                       o["price_cad"].alias("price_cad"))).alias("price_observations"),
        F.least(F.size("_all"), F.lit(keep)).cast("bigint").alias("retained_price_observation_count"),
        cut.cast("bigint").alias("compacted_price_observation_count"),
        chain_digest(F.transform(F.slice("_all", F.lit(1), cut), lambda o: o["_json"]))
        .alias("price_observation_compaction_digest_sha256"),
        F.when(cut > 0, F.element_at("_all", F.greatest(cut, F.lit(1)))["run_ts"])
        .alias("price_observations_compacted_through_at"),
    )


def explode_history(legacy: DataFrame, history: str = "history", keep: list[str] | None = None) -> DataFrame:
    """Legacy map {listing: [{date, price}]} to rows with their position, beside the columns to keep."""
    kept = keep or []
    return legacy.select(*kept, F.explode(history).alias("listing_id", "_records")) \
        .select(*kept, "listing_id", F.posexplode("_records").alias("position", "_o")) \
        .select(*kept, "listing_id", "position", "_o.*")


def without_date(observations: DataFrame, date: Column) -> tuple[DataFrame, DataFrame]:
    """Observations of other dates, and the removed count per listing."""
    hit = F.coalesce(F.col("date") == date, F.lit(False))
    return observations.where(~hit), observations.where(hit).groupBy("listing_id") \
        .agg(F.count("*").alias("removed"))


def last_per_date(observations: DataFrame) -> DataFrame:
    """Only the last observation of each listing and date, with the number removed.

    A partial aggregate, so a listing-date with very many copies is combined before the shuffle.
    """
    rest = [c for c in observations.columns if c not in ("listing_id", "date")]
    return observations.groupBy("listing_id", "date").agg(
        F.max_by(F.struct(*rest), F.col("position")).alias("_o"),
        (F.count("*") - 1).alias("removed"),
    ).select("listing_id", "date", "_o.*", "removed")
