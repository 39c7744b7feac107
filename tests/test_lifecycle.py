"""Scenarios of the lifecycle: batch, incremental and streaming agree."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlens.operators import incremental as I
from marketlens.operators import lifecycle as LC
from marketlens.operators import prices as P
from marketlens.streaming import lifecycle_stream as S

START = datetime(2026, 1, 5)
RUNS = "vehicle_key string, source string, run_id string, run_ts timestamp"
LOG = "vehicle_key string, source string, canonical_listing_id string, run_id string, price_cad bigint"


def weekly(n: int, gap: float = 7) -> list[tuple]:
    return [("v", "s", f"r{i:03d}", START + timedelta(days=gap * i)) for i in range(n)]


def log_of(seen: dict[str, dict[int, int | None]]) -> list[tuple]:
    return [("v", "s", listing, f"r{i:03d}", price) for listing, by_run in seen.items() for i, price in by_run.items()]


def batch(spark, runs, log, **limits):
    calendar = LC.run_calendar(spark.createDataFrame(runs, RUNS), **limits)
    return LC.sightings(spark.createDataFrame(log, LOG), calendar, small=False), calendar


def step_by_step(spark, runs, log):
    state = I.empty_state(spark)
    for r in runs:
        accepted = spark.createDataFrame([x for x in log if x[3] == r[2]], LOG)
        rows = I.advance(state, spark.createDataFrame([r], RUNS), accepted).collect()
        state = spark.createDataFrame(rows, I.STATE_SCHEMA)
    return state


def test_missing_three_weeks_retires_and_sight_reappears(spark):
    runs = weekly(4)
    seen, _ = batch(spark, runs, log_of({"a": {0: 100}, "b": {0: 1, 1: 1, 2: 1, 3: 1}}))
    rows = {r.canonical_listing_id: r for r in LC.current_state(seen).collect()}
    assert rows["a"].lifecycle_state == "retired"
    assert rows["a"].missing_run_count == 3
    assert rows["a"].elapsed_since_last_seen_days == 21.0
    assert rows["a"].lifecycle_state_reason == "retirement_threshold_met"
    seen, _ = batch(spark, weekly(5), log_of({"a": {0: 100, 4: 90}}))
    back = LC.current_state(seen).first()
    assert (back.lifecycle_state, back.lifecycle_state_reason, back.reappearance_count) == (
        "reappeared", "observed_after_retired", 1)
    events = [(e.previous_state, e.new_state) for e in LC.transitions(seen).orderBy("r").collect()]
    assert events == [(None, "active"), ("active", "missing"), ("missing", "retired"), ("retired", "reappeared")]


def test_runs_without_listings_count_as_absence(spark):
    runs = weekly(3, gap=8)
    seen, calendar = batch(spark, runs, log_of({"a": {0: 5}}))
    summary = {r.run_id: r for r in LC.run_summary(seen, calendar).collect()}
    assert summary["r001"].missing_listing_count == 1 and summary["r001"].observed_current_count == 0
    assert LC.current_state(seen).first().lifecycle_state == "missing"


def test_pruned_after_a_year_starts_over(spark):
    runs = [("v", "s", f"r{i:03d}", START + timedelta(days=d)) for i, d in enumerate((0, 100, 200, 300, 400, 500))]
    seen, calendar = batch(spark, runs, log_of({"a": {0: 9, 5: 7}, "b": {0: 9}}))
    rows = {r.canonical_listing_id: r for r in LC.current_state(seen).collect()}
    assert set(rows) == {"a"}
    assert rows["a"].lifecycle_state_reason == "first_successful_observation"
    assert rows["a"].observation_count == 1 and rows["a"].reappearance_count == 0
    pruned = LC.run_summary(seen, calendar).where("retired_listings_pruned_this_run > 0").collect()
    assert [(r.run_id, r.retired_listings_pruned_this_run) for r in pruned] == [("r004", 2)]


def test_price_history_of_fifteen_weeks(spark):
    prices = {i: 60000 - 100 * i for i in range(15)}
    seen, _ = batch(spark, weekly(15), log_of({"a": prices}))
    history = P.bounded_history(seen).first()
    assert history.retained_price_observation_count == 13
    assert history.compacted_price_observation_count == 2
    assert len(history.price_observations) == 13
    assert history.price_observation_compaction_digest_sha256 != "0" * 64
    s = P.price_summary(seen).first()
    assert (s.first_observed_price_cad, s.current_price_cad, s.change_from_previous_observation_cad) == (
        60000, 58600, -100)
    state = step_by_step(spark, weekly(15), log_of({"a": prices})).first()
    assert state.price_observation_compaction_digest_sha256 == history.price_observation_compaction_digest_sha256
    assert state.minimum_observed_price_cad == 58600 and state.maximum_observed_price_cad == 60000


def test_first_known_price_and_null_current(spark):
    seen, _ = batch(spark, weekly(3), log_of({"a": {0: None, 1: 500, 2: None}}))
    s = P.price_summary(seen).first()
    assert (s.first_observed_price_cad, s.previous_observation_price_cad, s.current_price_cad) == (500, 500, None)
    assert s.change_from_previous_observation_cad is None


def test_replaying_a_run_replaces_its_observation(spark):
    runs = weekly(2, gap=9.5)
    state = step_by_step(spark, runs, log_of({"a": {0: 60000, 1: 58000}}))
    again = I.advance(state, spark.createDataFrame([runs[1]], RUNS),
                      spark.createDataFrame(log_of({"a": {1: 57500}}), LOG)).first()
    assert again.observation_count == 2
    assert [o.price_cad for o in again.price_observations] == [60000, 57500]
    log = spark.createDataFrame(
        [("v", "s", "a", "r001", 58000, 0), ("v", "s", "a", "r001", 57500, 1)], LOG + ", source_record_index int")
    assert [r.price_cad for r in LC.deduplicated_log(log).collect()] == [57500]


def random_history(seed: int) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(seed)
    at, runs = START, []
    for i in range(14):
        at += timedelta(days=rng.choice([0.5, 3, 6, 9, 20]))
        runs.append(("v", "s", f"r{i:03d}", at))
    seen = {f"l{k}": {i: rng.randint(1, 9) for i in range(14) if rng.random() < rng.choice([0.2, 0.5, 0.9])}
            for k in range(25)}
    return runs, log_of({k: v for k, v in seen.items() if v})


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_equals_stepping(spark, seed):
    runs, log = random_history(seed)
    seen, _ = batch(spark, runs, log)
    columns = ["canonical_listing_id", "lifecycle_state", "lifecycle_state_reason", "missing_run_count",
               "reappearance_count", "observation_count", "last_observed_run_id"]
    a = sorted(map(tuple, LC.current_state(seen).select(columns).collect()))
    b = sorted(map(tuple, step_by_step(spark, runs, log).select(columns).collect()))
    assert a == b
    shuffled, _ = batch(spark, runs[::-1], random.Random(0).sample(log, len(log)))
    assert sorted(map(tuple, LC.current_state(shuffled).select(columns).collect())) == a


def test_stream_equals_batch(spark, tmp_path):
    runs, log = weekly(5), log_of({"a": {0: 10, 4: 12}, "b": {1: 5, 2: 6, 3: 7, 4: 8}, "c": {0: 1, 1: 1}})
    source, folder = f"{tmp_path}/in", f"{tmp_path}/out"
    for r in runs:
        rows = [(r[0], r[1], r[2], r[3], x[2], x[4]) for x in log if x[3] == r[2]] or [(*r, None, None)]
        spark.createDataFrame(rows, S.SNAPSHOT_SCHEMA).coalesce(1).write.mode("append").parquet(source)
    query = S.start(S.read_stream(spark, source, max_files=2), folder)
    query.awaitTermination()
    newest = S.newest_version(spark, folder)
    seen, _ = batch(spark, runs, log)
    columns = ["canonical_listing_id", "lifecycle_state", "lifecycle_state_reason", "missing_run_count", "observation_count"]
    a = sorted(map(tuple, LC.current_state(seen).select(columns).collect()))
    assert sorted(map(tuple, S.state_at(spark, folder, newest).select(columns).collect())) == a
    events = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/events").count()
    assert events == LC.transitions(seen).count()


def test_stream_goes_on_after_faults(spark, tmp_path):
    """An empty batch, a retried batch, a new checkpoint over old state, several sources, pruning."""
    folder = str(tmp_path)
    at = [START + timedelta(days=20 * i) for i in range(6)]
    def batch_of(*rows):
        return spark.createDataFrame(list(rows), S.SNAPSHOT_SCHEMA)
    def state():
        found = S.state_at(spark, folder, S.newest_version(spark, folder)).collect()
        return {(r.source, r.canonical_listing_id): (r.lifecycle_state, r.observation_count, r.missing_run_count) for r in found}
    S.apply_batch(batch_of(), 0, folder)
    assert state() == {}
    first = batch_of(("v", "s", "r0", at[0], "a", 1), ("v", "s", "r0", at[0], "b", 2), ("v", "t", "q0", at[0] + timedelta(hours=1), "c", 3),
                     ("v", "s", "r1", at[1], "a", 1))
    S.apply_batch(first, 1, folder)
    assert state() == {("s", "a"): ("active", 2, 0), ("s", "b"): ("missing", 1, 1), ("t", "c"): ("active", 1, 0)}
    S.apply_batch(first, 1, folder)
    assert state()[("s", "a")] == ("active", 2, 0) and S.newest_version(spark, folder) == 1
    S.apply_batch(batch_of(("v", "s", "r2", at[2], "a", 1)), 0, folder, stream="new checkpoint")
    assert state()[("s", "a")] == ("active", 3, 0) and state()[("s", "b")][2] == 2
    S.apply_batch(batch_of(*[("v", "s", f"r{i}", at[i], "a", 1) for i in (3, 4)]), 1, folder, stream="new checkpoint", keep=0)
    assert ("s", "b") not in state() and state()[("s", "a")][1] == 5
    gone = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/deletions").collect()
    assert [r.canonical_listing_id for r in gone] == ["b"]


def test_stream_log_equals_stepping_and_grows_with_runs(spark, tmp_path):
    """Runs with replays and pruning: each version equals the state that is carried whole; unseen listings write nothing."""
    from pathlib import Path
    rng, folder, at = random.Random(5), str(tmp_path), START
    state, runs = I.empty_state(spark), []
    for i in range(6):
        at += timedelta(days=rng.choice([9, 20]))
        runs.append((f"r{i:02d}", at))
    runs.insert(4, runs[3])
    runs.append(runs[-1])
    for version, (run, ts) in enumerate(runs):
        rows = [("v", "s", run, ts, f"l{k}", rng.randint(1, 9)) for k in range(12) if rng.random() < 0.35] or [("v", "s", run, ts, None, None)]
        batch = spark.createDataFrame(rows, S.SNAPSHOT_SCHEMA)
        S.apply_batch(batch, version, folder, keep=0, compact_every=4)
        wave = spark.createDataFrame([("v", "s", run, ts)], "vehicle_key string, source string, run_id string, run_ts timestamp")
        advanced = I.advance(state, wave, batch.where("canonical_listing_id is not null"))
        left = I.prune(advanced, 0)[0].collect()
        state = spark.createDataFrame(left, I.empty_state(spark).schema)
        if version in (4, 7):
            found = S.state_at(spark, folder, version).collect()
            assert sorted(map(str, found)) == sorted(map(str, left)), version
            names = {r[4] for r in rows if r[4]}
            written = spark.read.parquet(f"{folder}/log/version={version}").collect()
            assert all(r.last_observed_run_id == run or r.event or r.deleted for r in written) and names <= {r.canonical_listing_id for r in written}
    assert Path(f"{folder}/log/base=7").exists() and spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/deletions").count() > 0


def test_count_limit_prunes_the_oldest_retired(spark):
    state = spark.createDataFrame([
        ("v", "s", f"l{i}", "retired", START + timedelta(days=i), 30.0 + i) for i in range(6)
    ] + [("v", "s", "old", "retired", START - timedelta(days=400), 400.0), ("v", "s", "on", "active", START, 0.0)],
        "vehicle_key string, source string, canonical_listing_id string, lifecycle_state string, "
        "last_seen_at timestamp, elapsed_since_last_seen_days double")
    state = I.upgrade(state.withColumn("price_observations", F.lit(None).cast(f"array<{I.OBSERVATION}>")))
    left, gone = I.prune(state, keep=4)
    reasons = {r.canonical_listing_id: r.reason for r in gone.collect()}
    assert reasons == {"l0": "retired_tombstone_count_limit_exceeded", "l1": "retired_tombstone_count_limit_exceeded",
                       "old": "retired_tombstone_age_limit_exceeded"}
    assert {r.canonical_listing_id for r in left.collect()} == {"l2", "l3", "l4", "l5", "on"}


def test_first_schema_state_is_upgraded(spark):
    old = spark.createDataFrame(
        [("v", "s", "a", "active", START, [(START, "r000", 60000), (START, "r001", 59000)], 60000)],
        "vehicle_key string, source string, canonical_listing_id string, lifecycle_state string, "
        f"last_seen_at timestamp, price_observations array<{I.OBSERVATION}>, first_observed_price_cad bigint")
    new = I.upgrade(old).first()
    assert (new.observation_count, new.compacted_price_observation_count) == (2, 0)
    assert new.price_observation_compaction_digest_sha256 == "0" * 64 and new.first_observed_price_cad == 60000
