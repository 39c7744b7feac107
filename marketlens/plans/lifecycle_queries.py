"""Lifecycle, price-history and retention queries over the event observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.numbers import elapsed_days, elapsed_seconds
from marketlens.operators import lifecycle as LC
from marketlens.operators import prices as P
from marketlens.operators import retention as G
from marketlens.operators.incremental import upgrade
from marketlens.plans.bindings import OBS_SQL, seen, table
from marketlens.plans.registry import query

# Step simulation by recursion over run numbers: independent of the closed form.
STEPS_SQL = f"""
with recursive {OBS_SQL},
grid as (
  select u.vehicle_key, u.source, u.canonical_listing_id, runs.r, runs.run_id, runs.run_ts,
         o.price_cad, o.run_id is not null as seen
  from (select distinct vehicle_key, source, canonical_listing_id from obs) u
  join runs on runs.vehicle_key = u.vehicle_key and runs.source = u.source
  left join obs o on o.vehicle_key = u.vehicle_key and o.source = u.source
    and o.canonical_listing_id = u.canonical_listing_id and o.run_id = runs.run_id
),
step as (
  select vehicle_key, source, canonical_listing_id, r, run_id, run_ts, seen,
         case when seen then 'active' end as state,
         cast(null as varchar) as prior,
         case when seen then 'first_successful_observation' end as reason,
         case when seen then run_ts end as last_seen,
         case when seen then run_ts end as first_seen,
         cast(0 as bigint) as misses, cast(0 as bigint) as backs,
         cast(case when seen then 1 else 0 end as bigint) as n
  from grid where r = 1
  union all
  select g.vehicle_key, g.source, g.canonical_listing_id, g.r, g.run_id, g.run_ts, g.seen,
         case when g.seen and s.state is null then 'active'
              when g.seen and s.state in ('missing', 'retired') then 'reappeared'
              when g.seen then 'active'
              when s.state is null then null
              when s.state = 'retired' then 'retired'
              when s.misses + 1 >= 3 and epoch(g.run_ts) - epoch(s.last_seen) >= 14 * 86400 then 'retired'
              else 'missing' end,
         s.state,
         case when g.seen and s.state is null then 'first_successful_observation'
              when g.seen and s.state in ('missing', 'retired') then 'observed_after_' || s.state
              when g.seen and s.state = 'reappeared' then 'observed_consecutively_after_reappearance'
              when g.seen then 'observed_in_successful_source_run'
              when s.state is null then null
              when s.state = 'retired' then 'remains_unobserved_after_retirement'
              when s.misses + 1 >= 3 and epoch(g.run_ts) - epoch(s.last_seen) >= 14 * 86400 then 'retirement_threshold_met'
              else 'not_observed_in_successful_source_run' end,
         case when g.seen then g.run_ts else s.last_seen end,
         coalesce(s.first_seen, case when g.seen then g.run_ts end),
         case when g.seen or s.state is null then 0 else s.misses + 1 end,
         s.backs + case when g.seen and s.state in ('missing', 'retired') then 1 else 0 end,
         s.n + case when g.seen then 1 else 0 end
  from step s join grid g on g.vehicle_key = s.vehicle_key and g.source = s.source
    and g.canonical_listing_id = s.canonical_listing_id and g.r = s.r + 1
)
"""


@query("lifecycle_current_state", STEPS_SQL + """
select vehicle_key, source, canonical_listing_id, state as lifecycle_state,
       reason as lifecycle_state_reason, misses as missing_run_count, backs as reappearance_count,
       n as observation_count, cast(cast(first_seen as date) as varchar) as first_seen_run,
       cast(cast(last_seen as date) as varchar) as last_seen_run,
       cast(epoch(run_ts) - epoch(last_seen) as bigint) as elapsed_since_last_seen_seconds,
       round_even((epoch(run_ts) - epoch(last_seen)) / 86400, 6) as elapsed_since_last_seen_days
from step s where r = (select max(r) from runs where runs.source = s.source) and state is not null
""")
def lifecycle_current_state(spark: SparkSession, d: str) -> DataFrame:
    sightings, _ = seen(spark, d)
    return LC.current_state(sightings).select(
        *LC.LISTING, "lifecycle_state", "lifecycle_state_reason", "missing_run_count",
        "reappearance_count", "observation_count",
        F.to_date("first_seen_at").cast("string").alias("first_seen_run"),
        F.col("last_observed_run_id").alias("last_seen_run"),
        "elapsed_since_last_seen_seconds", "elapsed_since_last_seen_days")


@query("lifecycle_state_counts", STEPS_SQL + """
select source, state as lifecycle_state, count(*) as listing_count
from step s where r = (select max(r) from runs where runs.source = s.source) and state is not null
group by all
""")
def lifecycle_state_counts(spark: SparkSession, d: str) -> DataFrame:
    sightings, _ = seen(spark, d)
    return LC.current_state(sightings).groupBy("source", "lifecycle_state") \
        .agg(F.count("*").alias("listing_count"))


@query("lifecycle_events", STEPS_SQL + """
select vehicle_key, source, canonical_listing_id, run_id, prior as previous_state,
       state as new_state, reason
from step where state is not null and state is distinct from prior
""")
def lifecycle_events(spark: SparkSession, d: str) -> DataFrame:
    sightings, _ = seen(spark, d)
    return LC.transitions(sightings).select(
        *LC.LISTING, "run_id", "previous_state", "new_state", "reason")


@query("lifecycle_sightings", STEPS_SQL + """
select vehicle_key, source, canonical_listing_id, run_id, state as lifecycle_state,
       reason as lifecycle_state_reason, backs as reappearance_count, n as observation_count
from step where seen
""")
def lifecycle_sightings(spark: SparkSession, d: str) -> DataFrame:
    sightings, _ = seen(spark, d)
    return sightings.select(*LC.LISTING, "run_id", "lifecycle_state", "lifecycle_state_reason",
                            "reappearance_count", "observation_count")


@query("lifecycle_run_summary", STEPS_SQL + """
select vehicle_key, source, run_id, r as successful_source_run_count,
       count(*) filter (seen) as observed_current_count,
       count(*) filter (reason = 'first_successful_observation') as new_listing_count,
       count(*) filter (seen and state = 'reappeared') as reappeared_listing_count,
       count(*) filter (state is not null and state is distinct from prior) as transition_event_count,
       count(*) filter (state = 'active') as active_listing_count,
       count(*) filter (state = 'reappeared') as current_reappeared_listing_count,
       count(*) filter (state = 'missing') as missing_listing_count,
       count(*) filter (state = 'retired') as retired_listing_count,
       count(state) as tracked_listing_count
from step group by all
""")
def lifecycle_run_summary(spark: SparkSession, d: str) -> DataFrame:
    sightings, calendar = seen(spark, d)
    return LC.run_summary(sightings, calendar).drop("retired_listings_pruned_this_run")


@query("current_projection", f"""
with {OBS_SQL}, last_run as (select source, max(run_id) as run_id from runs group by source)
select vehicle_key, source, canonical_listing_id, run_id, price_cad
from obs join last_run using (source, run_id)
""")
def current_projection(spark: SparkSession, d: str) -> DataFrame:
    """Listings observed in the last run of their source, without history."""
    sightings, _ = seen(spark, d)
    return sightings.where(F.col("run_id") == F.col("last_run.run_id")) \
        .select(*LC.LISTING, "run_id", "price_cad")


@query("price_summary", f"""
with {OBS_SQL}
select vehicle_key, source, canonical_listing_id, count(*) as price_observation_count,
       arg_min(price_cad, run_ts) as first_observed_price_cad,
       arg_max(price_cad, run_ts) as current_price_cad, any_value(prev) as previous_observation_price_cad,
       min(price_cad) as minimum_observed_price_cad, max(price_cad) as maximum_observed_price_cad,
       arg_max(price_cad, run_ts) - any_value(prev) as change_from_previous_observation_cad,
       arg_max(price_cad, run_ts) - arg_min(price_cad, run_ts) as change_from_first_observation_cad
from (select *, nth_value(price_cad, 2) over (
        partition by vehicle_key, source, canonical_listing_id order by run_ts desc
        rows between unbounded preceding and unbounded following) as prev from obs)
group by all
""")
def price_summary(spark: SparkSession, d: str) -> DataFrame:
    sightings, _ = seen(spark, d)
    return P.price_summary(sightings).drop("first_price_observed_at")


@query("bounded_price_history", f"""
with {OBS_SQL},
h as (
  select vehicle_key, source, canonical_listing_id,
         list('{{"observed_at_utc":"' || run_id || 'T00:00:00+00:00","price_cad":' || price_cad
              || ',"run_id":"' || run_id || '"}}' order by run_ts) as js,
         list(run_id || '=' || price_cad order by run_ts) as entries
  from obs group by all
)
select vehicle_key, source, canonical_listing_id,
       array_to_string(entries[greatest(len(entries) - 13, 0) + 1:], ';') as retained,
       cast(least(len(entries), 13) as bigint) as retained_price_observation_count,
       cast(greatest(len(entries) - 13, 0) as bigint) as compacted_price_observation_count,
       list_reduce(js[:greatest(len(js) - 13, 0)], lambda a, x: sha256(unhex(a) || encode(x)), repeat('0', 64)) as digest
from h
""")
def bounded_price_history(spark: SparkSession, d: str) -> DataFrame:
    sightings, _ = seen(spark, d)
    return P.bounded_history(sightings).select(
        *LC.LISTING,
        F.array_join(F.transform("price_observations", lambda o: F.concat_ws(
            "=", o["run_id"], o["price_cad"].cast("string"))), ";").alias("retained"),
        "retained_price_observation_count", "compacted_price_observation_count",
        F.col("price_observation_compaction_digest_sha256").alias("digest"))


@query("history_last_per_date", """
select cast(user_id as varchar) as listing_id, cast(cast(ts as date) as varchar) as date,
       arg_max(cast(round(value * 100) as bigint), (ts, event_id)) as price, count(*) - 1 as removed
from events group by all
""")
def history_last_per_date(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("listing_id"),
        F.to_date("ts").cast("string").alias("date"),
        F.struct("ts", "event_id").alias("position"),
        F.round(F.col("value") * 100).cast("bigint").alias("price"))
    return P.last_per_date(rows).select("listing_id", "date", "price", "removed")


@query("deduplicated_log", """
select 'market' as vehicle_key, event_type as source, cast(user_id as varchar) as canonical_listing_id, cast(cast(ts as date) as varchar) as run_id,
       arg_max(cast(round(value * 100) as bigint), event_id) as price_cad
from events group by all
""")
def deduplicated_log(spark: SparkSession, d: str) -> DataFrame:
    """Repeated observations of a listing in a run; the last one counts."""
    return LC.deduplicated_log(table(spark, d, "events").select(
        F.lit("market").alias("vehicle_key"), F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("canonical_listing_id"),
        F.to_date("ts").cast("string").alias("run_id"), F.col("event_id").alias("source_record_index"),
        F.round(F.col("value") * 100).cast("bigint").alias("price_cad")))


@query("upgraded_state", """
select cast(event_id as varchar) as canonical_listing_id, event_type as source, cast(case when event_id % 3 = 0 then 0 else 1 + event_id % 2 end as bigint) as observation_count,
       cast(0 as bigint) as compacted, repeat('0', 64) as digest, cast(0 as bigint) as missing_run_count, cast(round(value * 100) as bigint) as first_price
from events
""")
def upgraded_state(spark: SparkSession, d: str) -> DataFrame:
    """Events as state rows of the first schema, with none, one or two stored observations."""
    price = F.round(F.col("value") * 100).cast("bigint")
    seen_at = F.struct(F.col("ts").cast("timestamp").alias("observed_at"), F.to_date("ts").cast("string").alias("run_id"), price.alias("price_cad"))
    stored = F.when(F.col("event_id") % 3 == 0, F.lit(None)).when(F.col("event_id") % 2 == 0, F.array(seen_at)).otherwise(F.array(seen_at, seen_at))
    old = table(spark, d, "events").select(
        F.lit("market").alias("vehicle_key"), F.col("event_type").alias("source"), F.col("event_id").cast("string").alias("canonical_listing_id"),
        F.lit("active").alias("lifecycle_state"), F.col("ts").cast("timestamp").alias("last_seen_at"), stored.alias("price_observations"),
        price.alias("first_observed_price_cad"))
    return upgrade(old).select(
        "canonical_listing_id", "source", "observation_count", F.col("compacted_price_observation_count").alias("compacted"),
        F.col("price_observation_compaction_digest_sha256").alias("digest"), "missing_run_count", F.col("first_observed_price_cad").alias("first_price"))


@query("history_without_date", """
with h as (select cast(user_id as varchar) as listing_id, event_id, cast(ts as date) as day, cast(round(value * 100) as bigint) as price from events),
o as (select listing_id, event_id, 0 as position, day, price from h union all select listing_id, event_id, 1, day + 1, price from h)
select listing_id, event_id, position, cast(strftime(day, '%Y-%m-%d') as varchar) as date, price,
       (select count(*) from o r where r.day = date '2024-01-05' and r.listing_id = o.listing_id) as removed
from o where day <> date '2024-01-05'
""")
def history_without_date(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a stored history of two dates; the kept observations, with how many their listing lost."""
    stored = table(spark, d, "events").select("event_id", F.create_map(F.col("user_id").cast("string"), F.array(*[
        F.struct(F.date_add(F.to_date("ts"), k).cast("string").alias("date"), F.round(F.col("value") * 100).cast("bigint").alias("price"))
        for k in (0, 1)])).alias("history"))
    kept, removed = P.without_date(P.explode_history(stored, keep=["event_id"]), F.lit("2024-01-05"))
    return kept.join(removed, "listing_id", "left").withColumn("removed", F.coalesce("removed", F.lit(0)))


@query("elapsed_between_sightings", """
select user_id, cast(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0) as bigint) as elapsed_seconds,
       round_even(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0) / 86400, 6) as elapsed_days
from events group by user_id
""")
def elapsed_between_sightings(spark: SparkSession, d: str) -> DataFrame:
    span = table(spark, d, "events").groupBy("user_id").agg(
        F.min("ts").alias("_a"), F.max("ts").alias("_b"))
    seconds = elapsed_seconds(F.col("_a"), F.col("_b"))
    return span.select("user_id", seconds.alias("elapsed_seconds"),
                       elapsed_days(seconds).alias("elapsed_days"))


@query("retired_pruning_plan", STEPS_SQL.replace("14 * 86400", "4 * 86400") + """
, retired as (
  select *, (epoch(run_ts) - epoch(last_seen)) / 86400 as age,
         row_number() over (partition by vehicle_key, source
                            order by last_seen desc, canonical_listing_id desc) as pos
  from step s where r = (select max(r) from runs where runs.source = s.source) and state = 'retired'
)
select vehicle_key, source, canonical_listing_id,
       case when age > 8 then 'retired_tombstone_age_limit_exceeded'
            else 'retired_tombstone_count_limit_exceeded' end as reason
from retired where age > 8 or pos > 2
""")
def retired_pruning_plan(spark: SparkSession, d: str) -> DataFrame:
    """Retirement, age and count limits scaled to the 30 days of the events table."""
    sightings, _ = seen(spark, d, days=4)
    return G.retired_to_prune(LC.current_state(sightings), keep=2, max_age_days=8).select(
        *LC.LISTING, "reason")


# --- archives: orders as snapshot files per customer ----------------------------------------------

INVENTORY_COLUMNS = (
    "cast(o_custkey as string) as vehicle_key",
    "case o_orderstatus when 'F' then 'source_archive' when 'O' then 'review_archive'"
    " else 'legacy_merged' end as category",
    "cast(cast(o_orderdate as date) as string) || '_' || lpad(cast(o_orderkey as string), 12, '0') || '.csv' as name",
    "'data/' || cast(o_custkey as string) || '/' || cast(o_orderkey as string) as path",
    "cast(round(o_totalprice * 100) as bigint) as size_bytes",
)
INVENTORY_SQL = "inventory as (select " + ", ".join(INVENTORY_COLUMNS) + " from orders)"
LIMITS = {"source_archive": 3, "review_archive": 2}
LEGACY = {"legacy_merged": "disabled_misleading_legacy_output"}


def inventory(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(*INVENTORY_COLUMNS)


PLAN_SQL = f"""
with {INVENTORY_SQL},
placed as (select *, row_number() over (partition by vehicle_key, category order by name desc, path desc) as n from inventory),
plan as (
  select vehicle_key, category, name, path, size_bytes,
         case category when 'legacy_merged' then 'disabled_misleading_legacy_output'
              else 'archive_count_limit_exceeded' end as reason
  from placed
  where category = 'legacy_merged' or (category = 'source_archive' and n > 3)
     or (category = 'review_archive' and n > 2)
)
"""


@query("archive_deletion_plan", PLAN_SQL + "select * from plan")
def archive_deletion_plan(spark: SparkSession, d: str) -> DataFrame:
    return G.deletion_plan(inventory(spark, d), LIMITS, LEGACY).select(
        "vehicle_key", "category", "name", "path", "size_bytes", "reason")


@query("deletion_ledger", PLAN_SQL + """
, hashed as (
  select vehicle_key, sha256(path || '|' || reason || '|' || size_bytes) as h, count(*) as n, sum(size_bytes) as b
  from plan group by all
),
buckets as (
  select vehicle_key, h[1:4] as bucket,
         list_reduce(list(h || ':' || n order by h), lambda a, x: sha256(unhex(a) || encode(x)), repeat('0', 64)) as dg,
         sum(n) as n, sum(b) as b
  from hashed group by all
)
select vehicle_key, cast(sum(n) as bigint) as deleted_count_total, cast(sum(b) as bigint) as deleted_bytes_total,
       list_reduce(list(dg order by bucket), lambda a, x: sha256(unhex(a) || encode(x)), repeat('0', 64)) as deletion_chain_sha256
from buckets group by all
""")
def deletion_ledger(spark: SparkSession, d: str) -> DataFrame:
    plan = G.deletion_plan(inventory(spark, d), LIMITS, LEGACY)
    payload = F.concat_ws("|", "path", "reason", F.col("size_bytes").cast("string"))
    return G.ledger(plan, ["vehicle_key"], payload, F.col("size_bytes"))


@query("recent_deletions", PLAN_SQL + """
select vehicle_key, category, path from (
  select *, row_number() over (partition by vehicle_key order by name desc, path desc) as k from plan)
where k <= 5
""")
def recent_deletions(spark: SparkSession, d: str) -> DataFrame:
    plan = G.deletion_plan(inventory(spark, d), LIMITS, LEGACY)
    return G.recent_deletions(plan, ["vehicle_key"], ["name", "path"], keep=5) \
        .select("vehicle_key", "category", "path")


@query("archive_size_metrics", f"""
with {INVENTORY_SQL}
select vehicle_key, count(*) as managed_file_count, cast(sum(size_bytes) as bigint) as managed_bytes,
       max(size_bytes) as largest_file_bytes,
       count(*) filter (size_bytes > 45000000) as oversized_file_count,
       concat_ws(';', case when max(size_bytes) > 45000000 then 'managed_file_size_limit_exceeded' end,
                 case when sum(size_bytes) > 250000000 then 'active_data_size_limit_exceeded' end) as errors,
       case when max(size_bytes) > 45000000 or sum(size_bytes) > 250000000 then 'fail' else 'pass' end as verification_status
from inventory group by vehicle_key
""")
def archive_size_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = G.size_metrics(inventory(spark, d), ["vehicle_key"], max_file=45_000_000, max_total=250_000_000)
    return out.withColumn("errors", F.array_join("verification_errors", ";")).drop("verification_errors")


@query("archive_limit_errors", f"""
with {INVENTORY_SQL}
select vehicle_key, category, count(*) as archive_count,
       case when category = 'legacy_merged' then 'legacy_file_present' else 'archive_count_limit_exceeded' end as error
from inventory group by all
having category = 'legacy_merged' or (category = 'source_archive' and count(*) > 3)
    or (category = 'review_archive' and count(*) > 2)
""")
def archive_limit_errors(spark: SparkSession, d: str) -> DataFrame:
    return G.archive_limit_errors(inventory(spark, d), LIMITS, LEGACY)


@query("path_scope_classes", """
with paths as (
  select case o_orderstatus when 'P' then '' else 'data/' end
         || case o_orderpriority when '1-URGENT' then 'retention' else cast(o_custkey as varchar) end
         || '/' || cast(o_orderkey as varchar) as path from orders
)
select path, case when not starts_with(path, 'data/') then 'outside_data'
            when split_part(path, '/', 2) in ('run_status', 'retention') then 'allowed'
            when c_mktsegment is null then 'ungoverned_vehicle_path'
            when c_mktsegment in ('BUILDING', 'MACHINERY') then 'allowed'
            else 'paused_vehicle_changed' end as path_scope
from paths left join customer on cast(c_custkey as varchar) = split_part(path, '/', 2)
  and c_mktsegment <> 'HOUSEHOLD'
""")
def path_scope_classes(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "orders").selectExpr(
        "case o_orderstatus when 'P' then '' else 'data/' end"
        " || case o_orderpriority when '1-URGENT' then 'retention' else cast(o_custkey as string) end"
        " || '/' || cast(o_orderkey as string) as path")
    registry = table(spark, d, "customer").where("c_mktsegment <> 'HOUSEHOLD'").select(
        F.col("c_custkey").cast("string").alias("vehicle_key"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("enabled"))
    return G.path_scope(paths, registry).select("path", "path_scope")


@query("manifest_difference", """
select coalesce(p, s) as path,
       case when s is null then 'published_not_present' else 'present_not_published' end as difference
from (select distinct l_orderkey || '/' || l_linestatus as p from lineitem) a
full join (select distinct o_orderkey || '/' || o_orderstatus as s from orders) b on p = s
where p is null or s is null
""")
def manifest_difference(spark: SparkSession, d: str) -> DataFrame:
    """All lines as published paths, all orders as present ones."""
    published = table(spark, d, "lineitem").select(F.concat_ws("/", F.col("l_orderkey").cast("string"), "l_linestatus").alias("path"))
    present = table(spark, d, "orders").select(F.concat_ws("/", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("path"))
    return G.manifest_difference(published, present)


@query("change_type_counts", """
select o_custkey as vehicle_key, o_orderstatus[1] as change_type, count(*) as change_count
from orders group by all
""")
def change_type_counts(spark: SparkSession, d: str) -> DataFrame:
    changes = table(spark, d, "orders").select(
        F.col("o_custkey").alias("vehicle_key"), F.col("o_orderstatus").alias("status"))
    return G.change_type_counts(changes, ["vehicle_key"])

