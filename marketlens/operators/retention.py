"""Keep-newest plans, deletion ledgers, size limits and path scopes. Plans only, nothing is deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.ids import set_digest
from marketlens.functions.text import codes_in_order
from marketlens.operators.lifecycle import RETIRED_MAX_AGE_DAYS, SOURCE

SOURCE_ARCHIVES_TO_KEEP = 8
REVIEW_ARCHIVES_TO_KEEP = 4
MAX_RETIRED_PER_SOURCE = 500
RECENT_DELETIONS = 100
MAX_FILE_BYTES = 50 * 1024 * 1024
MAX_TOTAL_BYTES = 500 * 1024 * 1024


def oldest_kept(df: DataFrame, keys: list[str], newest: list[str], keep: int) -> DataFrame:
    """Per key with more than ``keep`` rows: the last kept row in newest-first order.

    ``row_number() <= keep`` is pruned inside every task before the shuffle (window group limit),
    so a key with very many rows ships at most ``keep`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest])
    edge = F.struct(*newest)
    return df.select(*keys, *newest).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= keep) \
        .groupBy(*keys).agg(F.min(edge).alias("_edge"), F.count("*").alias("_kept")) \
        .where(F.col("_kept") == keep).drop("_kept")


def beyond_newest(df: DataFrame, keys: list[str], newest: list[str], keep: int) -> DataFrame:
    """Rows older than the newest ``keep`` of their key (``newest`` must be unique per key)."""
    edges = oldest_kept(df, keys, newest, keep)
    return df.join(edges, keys).where(F.struct(*newest) < F.col("_edge")).drop("_edge")


def deletion_plan(inventory: DataFrame, limits: dict[str, int], legacy: dict[str, str]) -> DataFrame:
    """Snapshots beyond the kept number per (vehicle, category) and every legacy file, with reasons.

    ``inventory``: vehicle_key, category, name, path, size_bytes, sha256; ``latest`` files exempt.
    """
    keys = ["vehicle_key", "category"]
    archives = inventory.where(~F.col("name").endswith("latest.csv"))
    plans = []
    for keep in sorted(set(limits.values())):
        group = [c for c, n in limits.items() if n == keep]
        plans.append(
            beyond_newest(archives.where(F.col("category").isin(*group)), keys, ["name", "path"], keep)
            .withColumn("reason", F.lit("archive_count_limit_exceeded")))
    for category, reason in legacy.items():
        plans.append(inventory.where(F.col("category") == category).withColumn("reason", F.lit(reason)))
    out = plans[0]
    for p in plans[1:]:
        out = out.unionByName(p)
    return out


def ledger(deletions: DataFrame, keys: list[str], payload: Column, size: Column,
           previous: DataFrame | None = None) -> DataFrame:
    """Cumulative deletion count, bytes and digest per key.

    The digest covers the record set, whatever its size or order (see ``set_digest``); a previous
    ledger's digest is chained in front of the new one.
    """
    sums = deletions.groupBy(*keys).agg(
        F.count("*").alias("deleted_count_total"), F.sum(size).cast("bigint").alias("deleted_bytes_total"))
    new = sums.join(set_digest(deletions, keys, payload, "deletion_chain_sha256"), keys)
    if previous is None:
        return new
    old = previous.select(
        *keys, F.col("deleted_count_total").alias("_n"), F.col("deleted_bytes_total").alias("_b"),
        F.col("deletion_chain_sha256").alias("_d"))
    chained = F.when(F.col("deletion_chain_sha256").isNull(), F.col("_d")).when(
        F.col("_d").isNull(), F.col("deletion_chain_sha256"),
    ).otherwise(F.sha2(F.concat(F.unhex("_d"), F.encode("deletion_chain_sha256", "utf-8")), 256))
    zero = F.lit(0)
    return new.join(old, keys, "full").select(
        *keys,
        (F.coalesce("deleted_count_total", zero) + F.coalesce("_n", zero)).alias("deleted_count_total"),
        (F.coalesce("deleted_bytes_total", zero) + F.coalesce("_b", zero)).alias("deleted_bytes_total"),
        chained.alias("deletion_chain_sha256"),
    )


def recent_deletions(deletions: DataFrame, keys: list[str], newest: list[str],
                     keep: int = RECENT_DELETIONS) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest])
    return deletions.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= keep).drop("_n")


def retired_to_prune(current: DataFrame, *, keep: int = MAX_RETIRED_PER_SOURCE,
                     max_age_days: int = RETIRED_MAX_AGE_DAYS) -> DataFrame:
    """Retired listings over the age limit, or beyond the newest ``keep`` per source."""
    retired = current.where(F.col("lifecycle_state") == "retired")
    edges = oldest_kept(retired, SOURCE, ["last_seen_at", "canonical_listing_id"], keep)
    aged = F.col("elapsed_since_last_seen_days") > max_age_days
    beyond = F.lit(keep <= 0) | (F.struct("last_seen_at", "canonical_listing_id") < F.col("_edge"))
    return retired.join(edges, SOURCE, "left").withColumn(
        "reason",
        F.when(aged, F.lit("retired_tombstone_age_limit_exceeded"))
        .when(beyond, F.lit("retired_tombstone_count_limit_exceeded")),
    ).where("reason is not null").drop("_edge")


def size_metrics(inventory: DataFrame, keys: list[str], *, max_file: int = MAX_FILE_BYTES,
                 max_total: int = MAX_TOTAL_BYTES) -> DataFrame:
    """Files, bytes, largest file, files over the limit, and the resulting errors per key."""
    size = F.col("size_bytes")
    out = inventory.groupBy(*keys).agg(
        F.count("*").alias("managed_file_count"), F.sum(size).cast("bigint").alias("managed_bytes"),
        F.max(size).alias("largest_file_bytes"), F.count_if(size > max_file).alias("oversized_file_count"),
    )
    errors = codes_in_order(
        (F.col("oversized_file_count") > 0, "managed_file_size_limit_exceeded"),
        (F.col("managed_bytes") > max_total, "active_data_size_limit_exceeded"),
    )
    return out.withColumn("verification_errors", errors).withColumn(
        "verification_status", F.when(F.size("verification_errors") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def archive_limit_errors(inventory: DataFrame, limits: dict[str, int], legacy: dict[str, str]) -> DataFrame:
    """One row per category over its limit and per legacy category still present."""
    counted = inventory.where(~F.col("name").endswith("latest.csv")).groupBy("vehicle_key", "category") \
        .agg(F.count("*").alias("archive_count"))
    limit = F.lit(None).cast("bigint")
    for category, n in limits.items():
        limit = F.when(F.col("category") == category, F.lit(n)).otherwise(limit)
    error = (
        F.when(F.col("category").isin(*legacy), F.lit("legacy_file_present"))
        .when(F.col("archive_count") > limit, F.lit("archive_count_limit_exceeded"))
    )
    return counted.withColumn("error", error).where("error is not null")


def path_scope(paths: DataFrame, registry: DataFrame, root: str = "data",
               shared: tuple[str, ...] = ("run_status", "retention")) -> DataFrame:
    """Classify changed paths: allowed, outside, invalid, paused or ungoverned.

    ``registry``: vehicle_key, enabled (one row per vehicle).
    """
    path = F.replace(F.trim("path"), F.lit("\\"), F.lit("/"))
    parts = F.split(path, "/")
    scoped = paths.select(
        *[c for c in paths.columns if c != "path"], path.alias("path"),
        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("vehicle_key"),
    ).where("path <> ''")
    known = registry.select("vehicle_key", F.col("enabled").alias("_enabled"))
    scope = (
        F.when(~F.col("path").startswith(f"{root}/"), F.lit("outside_data"))
        .when(F.col("vehicle_key").isin(*shared), F.lit("allowed"))
        .when(F.col("_enabled"), F.lit("allowed"))
        .when(~F.col("_enabled"), F.lit("paused_vehicle_changed"))
        .otherwise(F.lit("ungoverned_vehicle_path"))
    )
    return scoped.join(known, "vehicle_key", "left").withColumn("path_scope", scope).drop("_enabled")


def manifest_difference(published: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    """Paths on one side only."""
    left = published.select(F.col(key), F.lit(True).alias("_l")).distinct()
    right = present.select(F.col(key), F.lit(True).alias("_r")).distinct()
    return left.join(right, key, "full").where("_l is null or _r is null").select(
        key, F.when(F.col("_r").isNull(), F.lit("published_not_present"))
        .otherwise(F.lit("present_not_published")).alias("difference"))


def change_type_counts(changes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return changes.groupBy(*(keys or []), F.substring("status", 1, 1).alias("change_type")) \
        .agg(F.count("*").alias("change_count"))
