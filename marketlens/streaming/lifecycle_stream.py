"""Lifecycle over a stream of run snapshots, with the state as a log of changes.

A run writes the rows it changed: listings it saw, listings whose state changed by it, and pruned ones. A listing
that stays unseen writes nothing: its state after any later run follows from its last row and the run calendar
(`evaluated`), so what a run writes follows the run, not the state. Every ``COMPACT_EVERY`` versions the rows that
still count are written as one base, and reading starts there.

A batch that is retried writes the same version again, so the result does not depend on failures.
Absence is evidence, so the state must be advanced per source; doing it as a keyed join spreads a
large source over all tasks, where a keyed stateful operator would hold it in one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens.functions.numbers import elapsed_days, elapsed_seconds
from marketlens.operators.incremental import STATE_SCHEMA, advance, deletion_records, empty_state, is_event, event_columns
from marketlens.operators.lifecycle import LISTING, RETIRE_AFTER_DAYS, RETIRE_AFTER_MISSES, SOURCE
from marketlens.operators.retention import MAX_RETIRED_PER_SOURCE, retired_to_prune

SNAPSHOT_SCHEMA = (
    "vehicle_key string, source string, run_id string, run_ts timestamp, "
    "canonical_listing_id string, price_cad bigint"
)
COMMIT_SCHEMA = "version bigint, base bigint, stream string, batch_id bigint, steps int, compacted boolean"
LOG_SCHEMA = STATE_SCHEMA + ", number bigint, deleted boolean, place struct<version: bigint, step: int>"
CALENDAR_SCHEMA = "vehicle_key string, source string, number bigint, run_id string, run_ts timestamp, before_ts timestamp"
COMPACT_EVERY = 20


def read_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Snapshot files as a stream. A run without listings is one row with a NULL listing id."""
    reader = spark.readStream.schema(SNAPSHOT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def _read(spark: SparkSession, schema: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


class StateLog:
    """The log below a folder, up to a committed version and the finished steps of the one in work."""

    def __init__(self, spark: SparkSession, folder: str, version: int, working: int | None = None, steps: int = 0):
        self.spark, self.folder = spark, folder
        commits = _commits(spark, folder).where(F.col("version") <= version).select("version", "steps", "compacted").distinct().collect()
        self.base = max((c["version"] for c in commits if c["compacted"]), default=-1)
        #: Paths by place in the log; their number is bounded by the versions since the last base.
        self.parts = [(c["version"], k) for c in sorted(commits, key=lambda c: c["version"]) if c["version"] > self.base for k in range(1, c["steps"] + 1)]
        if working is not None:
            self.parts += [(working, k) for k in range(1, steps + 1)]

    def _paths(self, kind: str) -> list[str]:
        paths = [f"{self.folder}/{kind}/version={v}/step={k}" for v, k in self.parts]
        return ([f"{self.folder}/{kind}/base={self.base}"] if self.base >= 0 else []) + paths

    def calendar(self) -> DataFrame:
        """Newest run per source: its number, id, time and the time of the run before."""
        runs = _read(self.spark, CALENDAR_SCHEMA, self._paths("calendar"))
        return runs.groupBy(*SOURCE).agg(F.max(F.struct("number", "run_id", "run_ts", "before_ts")).alias("_now"))

    def rows(self) -> DataFrame:
        """Last row of each listing that is not deleted, as it was written."""
        rows = _read(self.spark, LOG_SCHEMA, self._paths("log"))
        last = rows.groupBy(*LISTING).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in LISTING]), F.col("place")).alias("_row"))
        return last.select(*LISTING, "_row.*").where("not deleted")

    def state(self) -> DataFrame:
        return evaluated(self.rows(), self.calendar())


def evaluated(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """State after the newest run of each source, from rows written at an earlier one.

    Each run since then missed the listing. Misses and time only grow, so it is retired from the first run on at which both
    limits are met, and the state before follows from the run before.
    """
    joined = rows.join(calendar, SOURCE, "left")
    missed = F.greatest(F.coalesce(F.col("_now.number") - F.col("number"), F.lit(0)), F.lit(0))
    days = lambda ts: elapsed_days(elapsed_seconds(F.col("last_seen_at"), ts))

    def state_after(misses: Column, ts: Column) -> Column:
        due = (F.col("missing_run_count") + misses >= RETIRE_AFTER_MISSES) & (days(ts) >= RETIRE_AFTER_DAYS)
        return F.when(misses <= 0, F.col("lifecycle_state")).when((F.col("lifecycle_state") == "retired") | due, F.lit("retired")).otherwise(F.lit("missing"))

    now, before = state_after(missed, F.col("_now.run_ts")), state_after(missed - 1, F.col("_now.before_ts"))
    reason = F.when(before == "retired", F.lit("remains_unobserved_after_retirement")).when(
        now == "retired", F.lit("retirement_threshold_met")).otherwise(F.lit("not_observed_in_successful_source_run"))
    later = {
        "lifecycle_state": now, "lifecycle_state_reason": reason, "previous_state": before,
        "last_evaluated_at": F.col("_now.run_ts"), "last_evaluated_run_id": F.col("_now.run_id"),
        "missing_run_count": F.col("missing_run_count") + missed, "elapsed_since_last_seen_days": days(F.col("_now.run_ts"))}
    columns = [f.name for f in empty_state(rows.sparkSession).schema.fields]
    return joined.select(*[F.when(missed > 0, later[c]).otherwise(F.col(c)).alias(c) if c in later else F.col(c) for c in columns])


def state_at(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """The state after a committed version."""
    return StateLog(spark, folder, version).state()


def _commits(spark: SparkSession, folder: str) -> DataFrame:
    """One row per applied batch, below a folder that exists from the first call on."""
    spark.createDataFrame([], COMMIT_SCHEMA).write.mode("append").parquet(f"{folder}/commits")
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{folder}/commits")


def newest_version(spark: SparkSession, folder: str) -> int:
    """The newest committed version; -1 before the first one."""
    return _commits(spark, folder).agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]


def _step(log: StateLog, wave: DataFrame, accepted: DataFrame, version: int, k: int, keep: int) -> None:
    """Write what one run per source changes: rows of the log, calendar, events and deletions."""
    spark, folder, part = log.spark, log.folder, f"version={version}/step={k}"
    newest = log.calendar()
    runs = wave.join(newest, SOURCE, "left")
    replay = F.coalesce(F.col("_now.run_id") == F.col("run_id"), F.lit(False))
    numbered = runs.select(
        *SOURCE, (F.coalesce("_now.number", F.lit(0)) + F.when(replay, 0).otherwise(1)).alias("number"), "run_id",
        F.when(replay, F.col("_now.run_ts")).otherwise(F.col("run_ts")).alias("run_ts"),
        F.when(replay, F.col("_now.before_ts")).otherwise(F.col("_now.run_ts")).alias("before_ts"))
    numbered.write.mode("overwrite").parquet(f"{folder}/calendar/{part}")
    number = spark.read.schema(CALENDAR_SCHEMA).parquet(f"{folder}/calendar/{part}").select(*SOURCE, "number")
    advanced = advance(log.state(), wave, accepted)
    here = F.col("number").isNotNull()
    seen = wave.select(*SOURCE, F.col("run_id").alias("_run"))
    gone = retired_to_prune(advanced, keep=keep).select(*LISTING, "reason")
    marked = advanced.join(number, SOURCE, "left").join(seen, SOURCE, "left").join(gone, LISTING, "left")
    changed = marked.where(F.col("reason").isNotNull() | (here & ((F.col("last_observed_run_id") == F.col("_run")) | is_event())))
    older = F.coalesce("number", F.lit(0))
    changed.select(*[f.name for f in empty_state(spark).schema.fields], older.cast("bigint").alias("number"), F.col("reason").isNotNull().alias("deleted"),
                   F.struct(F.lit(version).cast("bigint").alias("version"), F.lit(k).alias("step")).alias("place"), "reason",
                   (here & is_event()).alias("event")).write.mode("overwrite").parquet(f"{folder}/log/{part}")
    written = spark.read.schema(LOG_SCHEMA + ", reason string, event boolean").parquet(f"{folder}/log/{part}")
    event_columns(written.where("event")).write.mode("overwrite").parquet(f"{folder}/events/{part}")
    deletion_records(written.where("deleted").select(*[f.name for f in empty_state(spark).schema.fields], "reason")).write.mode(
        "overwrite").parquet(f"{folder}/deletions/{part}")


def _compact(log: StateLog, version: int) -> None:
    """Write the rows that still count, and the calendar, as the base of a version."""
    log.rows().write.mode("overwrite").parquet(f"{log.folder}/log/base={version}")
    log.calendar().select(*SOURCE, "_now.*").write.mode("overwrite").parquet(f"{log.folder}/calendar/base={version}")


def apply_batch(batch: DataFrame, batch_id: int, folder: str, stream: str = "stream", keep: int = MAX_RETIRED_PER_SOURCE,
                compact_every: int = COMPACT_EVERY) -> None:
    """Advance the newest committed state by the runs of the batch, in order, and prune retired listings.

    Wave k holds the k-th run of every vehicle and source of the batch (one wave per trigger in normal
    operation), so the loop is not over data; every step starts from what is written.
    """
    spark = batch.sparkSession
    landed = f"{folder}/landed/{stream}/batch={batch_id}"
    batch.write.mode("overwrite").parquet(landed)
    rows = spark.read.schema(SNAPSHOT_SCHEMA).parquet(landed)
    numbered = rows.select(*SOURCE, "run_id", "run_ts").distinct().withColumn(
        "wave", F.row_number().over(Window.partitionBy(*SOURCE).orderBy("run_ts", "run_id")))
    numbered.write.mode("overwrite").parquet(f"{folder}/waves/{stream}/batch={batch_id}")
    runs = spark.read.schema(numbered.schema).parquet(f"{folder}/waves/{stream}/batch={batch_id}")
    waves = runs.agg(F.coalesce(F.max("wave"), F.lit(0))).first()[0]
    done = _commits(spark, folder).where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).first()
    base = done["base"] if done else newest_version(spark, folder)
    version = done["version"] if done else base + 1
    for k in range(1, waves + 1):
        wave = runs.where(F.col("wave") == k).drop("wave")
        accepted = rows.where("canonical_listing_id is not null").join(wave, wave.columns, "left_semi")
        _step(StateLog(spark, folder, base, version, k - 1), wave, accepted, version, k, keep)
    compacted = done["compacted"] if done else version % compact_every == compact_every - 1
    if compacted:
        _compact(StateLog(spark, folder, base, version, waves), version)
    if not done:
        spark.createDataFrame([(version, base, stream, batch_id, waves, compacted)], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/commits")


def start(snapshots: DataFrame, folder: str, available_now: bool = True, progress: str = "progress") -> StreamingQuery:
    """Start the stream; ``folder`` is shared storage for state, events and progress.

    Batches are known by the id that Spark gives a checkpoint, so a new checkpoint goes on with the state.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        about = batch.sparkSession.read.text(f"{folder}/{progress}/metadata").first()[0]
        apply_batch(batch, batch_id, folder, json.loads(about)["id"])

    writer = snapshots.writeStream.option("checkpointLocation", f"{folder}/{progress}").foreachBatch(apply)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
