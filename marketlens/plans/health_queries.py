"""Run-health, anomaly, review and consistency queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import checks as V
from marketlens.operators import claims as CL
from marketlens.operators import duplicates as D
from marketlens.operators import health as H
from marketlens.operators import review as RV
from marketlens.plans.bindings import table
from marketlens.plans.market_queries import DUPLICATE_SQL, identities, linkable
from marketlens.plans.registry import query
from marketlens.session import settle

STATUS_SQL = """
st as (
  select 'market' as vehicle_key, event_type as source, cast(cast(ts as date) as varchar) as run_id,
         count(*) as fetched, count(*) filter (value > 40) as rejected, count(*) filter (value < 4) as failed,
         count(*) filter (value between 4 and 40) as accepted, count(distinct user_id) as users,
         count(*) filter (event_id % 4 = 0) as attempts, count(*) filter (value > 100) as warned
  from events group by all),
hs as (
  select *, accepted > 0 and users % 7 > 0 as healthy, users % 7 = 0 as unlucky from st)
"""


def statuses(spark: SparkSession, d: str) -> DataFrame:
    """One status per day and event type, with some failing and incomplete runs."""
    v = F.col("value")
    day = table(spark, d, "events").groupBy(
        F.lit("market").alias("vehicle_key"), F.col("event_type").alias("source"),
        F.to_date("ts").cast("string").alias("run_id"),
    ).agg(
        F.count("*").alias("fetched_record_count"), F.count_if(v > 40).alias("rejected_record_count"),
        F.count_if(v < 4).alias("parse_failure_count"), F.count_if(v.between(4, 40)).alias("accepted_record_count"),
        F.count_distinct("user_id").alias("_users"), F.count_if(F.col("event_id") % 4 == 0).alias("request_attempt_count"),
        F.count_if(v > 100).alias("quality_warning_rows"))
    bad = F.col("_users") % 7 == 0
    return day.select(
        "*", F.when(bad, F.lit("degraded")).otherwise(F.lit("success")).alias("execution_status"),
        F.lit(True).alias("output_updated_this_run"), F.lit(True).alias("schema_valid"),
        F.col("accepted_record_count").alias("current_row_count"), F.lit(0).alias("stale_row_count"),
        F.lit("reconciled").alias("evidence_reconciliation_status"),
        F.lit(1).alias("canonical_evidence_schema_version"), F.lit(2).alias("identity_lifecycle_schema_version"),
        F.lit("updated").alias("identity_lifecycle_status"),
        F.col("accepted_record_count").alias("identity_observed_current_count"),
        F.lit(True).alias("row_cap_disabled"), F.lit(True).alias("config_isolated"),
        (F.col("_users") % 7 != 1).alias("pagination_complete"),
        F.when(F.col("_users") % 7 == 2, 1).otherwise(0).alias("failed_page_count"),
        F.when(F.col("quality_warning_rows") > 0, F.lit("warnings_present")).otherwise(F.lit("clean"))
        .alias("data_quality_status"),
        F.when(bad, F.array(F.lit("pagination_incomplete"))).otherwise(F.array().cast("array<string>"))
        .alias("failure_reasons"))


@query("current_success", f"""
with {STATUS_SQL}
select source, run_id, healthy as current_success from hs
""")
def current_success(spark: SparkSession, d: str) -> DataFrame:
    return statuses(spark, d).select("source", "run_id", H.current_success(F.col("run_id")).alias("current_success"))


@query("expected_runs", """
select r_name as vehicle_key, s.source from region
cross join (values ('click', 0), ('view', 0), ('error', 1)) s(source, least)
where r_regionkey % 2 = 0 and r_regionkey >= s.least
""")
def expected_runs(spark: SparkSession, d: str) -> DataFrame:
    sources = F.when(F.col("r_regionkey") >= 1, F.array(*map(F.lit, ("click", "view", "error")))) \
        .otherwise(F.array(F.lit("click"), F.lit("view")))
    registry = table(spark, d, "region").select(
        F.col("r_name").alias("vehicle_key"), (F.col("r_regionkey") % 2 == 0).alias("enabled"),
        F.lit("weekly").alias("cadence"), sources.alias("enabled_sources"))
    return H.expected_runs(registry, scheduled=True)


@query("health_rows", f"""
with {STATUS_SQL},
plan as (select 'market' as vehicle_key, run_id as expected_run_id, source
  from (select distinct run_id from hs), (select distinct source from hs union all select 'unseen'))
select plan.source, expected_run_id, run_id = expected_run_id is true and healthy as healthy, run_id = expected_run_id is true as current_run,
       case when run_id is null then 'missing' when unlucky then 'degraded' else 'success' end as execution_status,
       case when run_id = expected_run_id then fetched else 0 end as fetched_record_count, case when run_id = expected_run_id then accepted else 0 end as accepted_record_count,
       case when run_id = expected_run_id then rejected else 0 end as rejected_record_count, case when run_id = expected_run_id then failed else 0 end as parse_failure_count,
       case when run_id is null then 'missing_status' when unlucky then 'pagination_incomplete' else '' end as failure_reasons
from plan asof left join hs on plan.vehicle_key = hs.vehicle_key and plan.source = hs.source and plan.expected_run_id >= hs.run_id
""")
def health_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every run of the calendar expects every source that ever reported, and one that never did."""
    status = settle(statuses(spark, d))
    unseen = F.struct("vehicle_key", F.lit("unseen").alias("source"))
    sources = status.select(F.explode(F.array(F.struct("vehicle_key", "source"), unseen)).alias("p")).select("p.*").distinct()
    runs = status.select("vehicle_key", F.col("run_id").alias("expected_run_id")).distinct()
    rows = H.health_rows_by_run(runs.join(sources, "vehicle_key"), status)
    return rows.select("source", "expected_run_id", "healthy", "current_run", "execution_status", *H.COUNTS,
                       F.array_join("failure_reasons", ";").alias("failure_reasons"))


def daily_health(spark: SparkSession, d: str) -> DataFrame:
    status = statuses(spark, d)
    return status.withColumn("healthy", H.current_success(F.col("run_id")))


@query("health_totals", f"""
with {STATUS_SQL}
select run_id, count(*) as expected_source_runs, count(*) filter (healthy) as healthy_source_runs,
       count(*) filter (not healthy) as unhealthy_source_runs, count(*) filter (warned > 0) as source_runs_with_quality_warnings,
       cast(sum(fetched) as bigint) as fetched_record_count, cast(sum(accepted) as bigint) as accepted_record_count,
       cast(sum(rejected) as bigint) as rejected_record_count, cast(sum(failed) as bigint) as parse_failure_count,
       case when count(*) filter (not healthy) > 0 then 'degraded' when count(*) filter (warned > 0) > 0 then 'success_with_warnings' else 'success' end as overall_status
from hs group by run_id
""")
def health_totals(spark: SparkSession, d: str) -> DataFrame:
    return H.health_totals(daily_health(spark, d), ["run_id"])


ANOMALY_SQL = f"""
with {STATUS_SQL},
b as (
  select *, failed / fetched as rate, lag(accepted) over w as oa, lag(fetched) over w as oldf, lag(attempts) over w as oat, lag(warned) over w as ow,
         lag(run_id) over w is not null as has_old, run_id > (select min(run_id) from hs) as later
  from hs window w as (partition by source order by run_id)),
f as (
  select source, run_id, unnest(list_filter([
    case when not healthy then 'critical:source_unhealthy' end,
    case when users % 7 = 1 then 'critical:pagination_incomplete' end,
    case when users % 7 = 2 then 'critical:failed_source_pages' end,
    case when failed >= 5 and rate >= 0.2 then 'critical:parse_failure_rate_critical'
         when failed >= 3 and rate >= 0.05 then 'warning:parse_failure_rate_elevated' end,
    case when later and not has_old then 'info:source_has_no_baseline' end,
    case when oa >= 10 then case when accepted / oa < 0.25 then 'critical:accepted_record_count_collapse' when accepted / oa < 0.5 then 'warning:accepted_record_count_drop'
         when accepted >= oa * 3 and accepted - oa >= 20 then 'warning:accepted_record_count_surge' end end,
    case when oldf >= 20 then case when fetched / oldf < 0.25 then 'critical:fetched_record_count_collapse' when fetched / oldf < 0.5 then 'warning:fetched_record_count_drop'
         when fetched >= oldf * 3 and fetched - oldf >= 40 then 'warning:fetched_record_count_surge' end end,
    case when oat >= 1 and attempts >= oat * 3 and attempts - oat >= 5 then 'warning:request_attempt_surge' end,
    case when has_old and warned >= greatest(5, ow * 2 + 1) then 'warning:quality_warning_growth' end], lambda x: x is not null)) as e
  from b)
"""


@query("anomalies", ANOMALY_SQL + """
select source, run_id, split_part(e, ':', 1) as severity, split_part(e, ':', 2) as code from f
""")
def anomalies(spark: SparkSession, d: str) -> DataFrame:
    rows = H.with_previous_run(daily_health(spark, d), ["run_id"])
    return H.anomalies(rows).select("source", "run_id", "severity", "code")


@query("anomaly_status", ANOMALY_SQL + """
, c as (select run_id, count(*) filter (starts_with(e, 'critical')) as k, count(*) filter (starts_with(e, 'warning')) as w,
               count(*) filter (starts_with(e, 'info')) as i from f group by all)
select run_id, coalesce(k, 0) as critical_anomaly_count, coalesce(w, 0) as warning_anomaly_count, coalesce(i, 0) as informational_anomaly_count,
       case when k > 0 then 'critical' when w > 0 then 'warning' when run_id > (select min(run_id) from hs) then 'clean' else 'no_baseline' end as anomaly_status
from (select distinct run_id from hs) left join c using (run_id)
""")
def anomaly_status(spark: SparkSession, d: str) -> DataFrame:
    rows = settle(H.with_previous_run(daily_health(spark, d), ["run_id"]))
    runs = rows.groupBy("run_id").agg(F.bool_or("baseline_available").alias("baseline_available"))
    return H.anomaly_status(H.anomalies(rows), runs, ["run_id"]).drop("baseline_available")


@query("run_outcomes", """
select o_orderkey, case when o_orderkey % 13 = 0 then 'timed_out' when o_orderkey % 11 = 0 then 'failed' when reasons <> '' then 'degraded' else 'success' end as execution_status, reasons as failure_reasons
from (select *, concat_ws(';', nullif(base, ''), case when base = '' and o_orderkey % 5 = 0 then 'identity_lifecycle_failed' end,
         case when o_orderkey % 19 = 0 then 'approved_config_mutated' end) as reasons
  from (select *, concat_ws(';', case when o_orderkey % 13 = 0 then 'collector_timed_out' when o_orderkey % 11 = 0 then 'collector_command_failed' end,
      case when o_orderstatus = 'P' then 'no_fresh_output' end,
      case when o_orderstatus = 'F' and o_custkey % 3 = 0 then 'invalid_output_schema' end,
      case when o_orderstatus in ('F', 'O') and o_orderkey % 7 = 0 then 'empty_output' end,
      case when (o_orderstatus = 'O' or (o_orderstatus = 'F' and o_custkey % 3 > 0)) and o_orderkey % 7 = 0 then 'no_accepted_records' end) as base from orders))
""")
def run_outcomes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = F.when(k % 7 == 0, 0).otherwise(10)
    facts = table(spark, d, "orders").select(
        k, (k % 13 == 0).alias("timed_out"), F.when(k % 11 == 0, 2).otherwise(0).alias("return_code"),
        (F.col("o_orderstatus") != "P").alias("fresh"),
        (~((F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 3 == 0))).alias("schema_valid"),
        rows.alias("current_rows"), F.lit(False).alias("evidence_failed"), F.lit(True).alias("reconciled"),
        F.lit(True).alias("pagination_complete"), rows.alias("accepted_records"),
        (k % 5 == 0).alias("identity_failed"), rows.alias("identity_current_count"),
        (k % 19 != 0).alias("config_isolated"))
    return H.run_outcome(facts).select(
        k, "execution_status", F.array_join("failure_reasons", ";").alias("failure_reasons"))


@query("contract_mismatches", """
select o_orderkey, field, expected, actual from (
  select o_orderkey, o_orderstatus, unnest([
    {'field': 'o_orderstatus', 'expected': 'F', 'actual': o_orderstatus, 'on': true},
    {'field': 'o_orderpriority', 'expected': '5-LOW', 'actual': o_orderpriority, 'on': o_orderstatus = 'O'}], recursive := true) from orders)
where "on" and expected is distinct from actual
""")
def contract_mismatches(spark: SparkSession, d: str) -> DataFrame:
    status = table(spark, d, "orders").withColumn("source", F.col("o_orderstatus"))
    return H.contract_mismatches(status, ["o_orderkey"], {"o_orderstatus": "F"}, {"O": {"o_orderpriority": "5-LOW"}})


# --- review ------------------------------------------------------------------------------------------

@query("manual_review", f"""
with {DUPLICATE_SQL},
excluded as (select 'Brand#3' as vehicle_key, 'O' as source),
n as (select id, count(*) as k, bool_or(confidence = 'high') as hi, bool_or(confidence = 'medium') as me
      from (select lid as id, confidence from cand union all select rid, confidence from cand) group by id)
select t.vehicle_key, t.source, t.id as canonical_listing_id, cast(t.year as varchar) as year, coalesce(t.vin, '') as vin_claim,
       cast(coalesce(k, 0) as varchar) as duplicate_candidate_count,
       case when hi then 'high' when me then 'medium' when k > 0 then 'low' else '' end as highest_duplicate_confidence,
       case when k > 0 then 'duplicate_candidate_review_required' when t.source = 'O' then 'location_verification_required'
            when t.p % 6 = 0 then 'data_quality_review_required' else 'manual_review_required' end as review_status,
       case when t.p % 6 = 0 then 'warnings_present' else 'clean' end as data_quality_status,
       'source_reported_unverified' as year_evidence_status, 'DISABLED_MANUAL_REVIEW_REQUIRED' as ranking_status
from t left join n on n.id = t.id
where not exists (select 1 from excluded e where e.vehicle_key = t.vehicle_key and e.source = t.source)
""")
def manual_review(spark: SparkSession, d: str) -> DataFrame:
    """Review rows of all sources but one whose stated count does not match (left out as a whole)."""
    found = settle(linkable(identities(spark, d), "vin_evidence_status"))
    accepted = found.select(
        "vehicle_key", "source", "canonical_listing_id", F.lit("run-1").alias("run_id"),
        F.lit("accepted").alias("record_stage"), F.lit(1).alias("evidence_schema_version"),
        *[F.lit("x").alias(c) for c in RV.RECORD_FIELDS
          if c not in ("evidence_schema_version", "vehicle_key", "source", "canonical_listing_id")],
        F.struct(*[(F.col(c) if c in found.columns else F.lit(None).cast("string")).alias(c) for c in (
            *[e[0] for e in RV.EVIDENCED], "distance_method", "days_on_market_claim")]).alias("normalized"),
        F.map_from_entries(F.array(F.struct(F.lit("year"), F.struct(
            F.col("year").cast("string").alias("raw_value"),
            F.lit("source_reported_unverified").alias("evidence_status"))))).alias("field_evidence"),
        F.when(F.col("price_cad") % 6 == 0, F.array(F.lit("mileage_unknown")))
        .otherwise(F.array().cast("array<string>")).alias("quality_warnings"),
        (F.col("source") == "O").alias("quarantined"))
    known = found.select(
        "vehicle_key", "source", "canonical_listing_id", "vin_evidence_status",
        *[(F.col(c) if c in found.columns else F.lit(None).cast("string")).alias(c) for c in RV.IDENTITY_FIELDS])
    counts = accepted.groupBy("vehicle_key", "source").agg(F.count("*").alias("n"))
    short = (F.col("vehicle_key") == "Brand#3") & (F.col("source") == "O")
    status = counts.select(
        "vehicle_key", "source", F.lit("run-1").alias("run_id"), F.lit("success").alias("execution_status"),
        F.lit("success").alias("collection_status"), F.lit("").alias("completed_at_utc"),
        F.lit(True).alias("output_updated_this_run"), F.lit(True).alias("schema_valid"),
        F.col("n").alias("current_row_count"), F.when(short, F.col("n") + 1).otherwise(F.col("n")).alias("accepted_record_count"),
        F.lit("reconciled").alias("evidence_reconciliation_status"), F.lit(1).alias("canonical_evidence_schema_version"),
        F.lit(2).alias("identity_lifecycle_schema_version"), F.lit("updated").alias("identity_lifecycle_status"),
        F.when(short, F.col("n") + 1).otherwise(F.col("n")).alias("identity_observed_current_count"),
        F.lit(True).alias("row_cap_disabled"), F.lit(True).alias("config_isolated"))
    status = settle(status)
    inclusion = RV.source_inclusion(status.select("vehicle_key", "source"), status, accepted, known, F.lit("run-1"))
    profiles = settle(D.profiles(found))
    rows = RV.manual_review(accepted, status, known, D.candidate_index(profiles, found), None, inclusion)
    return RV.in_review_order(rows).select(
        "vehicle_key", "source", "canonical_listing_id", "year", "vin_claim", "duplicate_candidate_count",
        "highest_duplicate_confidence", "review_status", "data_quality_status", "year_evidence_status", "ranking_status")


# --- consistency --------------------------------------------------------------------------------------

@query("id_set_difference", """
select coalesce(a.k, b.k) as id, coalesce(a.long, b.long) as long,
       case when b.k is null then 'not_in_underlying_evidence' else 'missing_from_output' end as violation
from (select distinct doc_id as k, quality = 1 as long from labels) a
full join (select distinct doc_id as k, n_chars > 1000 as long from documents) b on a.k = b.k and a.long = b.long where a.k is null or b.k is null
""")
def id_set_difference(spark: SparkSession, d: str) -> DataFrame:
    """All labels, read as a claim about the length of their document, against all documents."""
    out = table(spark, d, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("long"))
    base = table(spark, d, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") > 1000).alias("long"))
    return V.id_set_difference(out, base, ["id", "long"])


@query("row_contracts", """
select c_custkey, unnest(list_filter([case when c_acctbal < 0 then 'balance_negative' end,
   case when c_mktsegment not in ('BUILDING', 'MACHINERY', 'FURNITURE') then 'segment_out_of_scope' end,
   case when c_nationkey >= 20 then 'nation_mismatch' end], lambda x: x is not null)) as violation from customer
""")
def row_contracts(spark: SparkSession, d: str) -> DataFrame:
    return V.row_contracts(table(spark, d, "customer"), ["c_custkey"], [
        ("balance_negative", F.col("c_acctbal") >= 0),
        ("segment_out_of_scope", F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE")),
        ("nation_mismatch", F.col("c_nationkey") < 20)])


@query("duplicate_keys", """
select l_orderkey, l_linenumber, count(*) as occurrences from lineitem group by all having count(*) > 1
""")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return V.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("question_faults", """
with t as (select conv_id, turn, text, role from conversations)
select conv_id as record, case when role = 'assistant' then 0 end as position,
       case when role = 'assistant' then 'question_entry_invalid' else 'question_list_missing_or_empty' end as violation
from t where role in ('assistant', 'system')
""")
def question_faults(spark: SparkSession, d: str) -> DataFrame:
    """Turns read as question records: assistants left the wording blank, system turns asked nothing."""
    q = F.struct(F.lit("a").alias("category"), F.lit("high").alias("priority"),
                 F.when(F.col("role") == "assistant", F.lit(" ")).otherwise(F.lit("why?")).alias("question"),
                 F.lit("b").alias("reason"))
    rows = table(spark, d, "conversations").select(
        F.col("conv_id").alias("record"),
        F.when(F.col("role") == "system", F.filter(F.array(q), lambda x: F.lit(False)))
        .otherwise(F.array(q)).alias("questions"))
    return V.question_faults(rows, "record")


@query("count_drift", """
select c_custkey as id, cast(floor(c_acctbal / 1000) as bigint) as stated_rows, n as counted_rows
from customer full join (select o_custkey, count(*) as n from orders group by all) on o_custkey = c_custkey
where coalesce(cast(floor(c_acctbal / 1000) as bigint), 0) <> coalesce(n, 0)
""")
def count_drift(spark: SparkSession, d: str) -> DataFrame:
    stated = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.floor(F.col("c_acctbal") / 1000).alias("n"))
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("id"))
    return V.count_drift(stated, rows, ["id"], "n")


@query("index_faults", """
with g as (select l_orderkey, count(*) as record_count, count(distinct l_linenumber - 1) as n, min(l_linenumber - 1) as lo, max(l_linenumber - 1) as hi,
                  count(distinct l_linestatus) > 1 as mixed from lineitem group by all)
select l_orderkey, record_count, unnest(list_filter([case when n <> record_count then 'record_index_repeated' end,
  case when lo <> 0 or hi <> n - 1 then 'record_index_discontinuity' end, case when mixed then 'l_linestatus_mismatch' end], lambda x: x is not null)) as violation from g
""")
def index_faults(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("_index", F.col("l_linenumber") - 1)
    return V.index_faults(rows, ["l_orderkey"], "_index", ["l_linestatus"])


@query("turn_index_faults", """
select conv_id, count(*) as record_count, 'record_index_discontinuity' as violation from conversations
group by conv_id having count(*) <> max(turn) + 1
union all select conv_id, count(*), 'role_mismatch' from conversations group by conv_id having count(distinct role) > 1
""")
def turn_index_faults(spark: SparkSession, d: str) -> DataFrame:
    return V.index_faults(table(spark, d, "conversations"), ["conv_id"], "turn", ["role"])


@query("change_gate", """
with ch as (select distinct o_custkey as id from orders where o_orderstatus = 'P')
select c_custkey as id, 'balance' as "check", 'balance_negative' as violation from customer where c_acctbal < 0 and c_custkey in (select id from ch)
union all select c_custkey, 'drift', 'count_drift' from customer join (select o_custkey, count(*) as n from orders group by all) on o_custkey = c_custkey
where n > 12 and c_custkey in (select id from ch)
""")
def change_gate(spark: SparkSession, d: str) -> DataFrame:
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    changed = orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    balance = V.row_contracts(customer.withColumnRenamed("c_custkey", "id"), ["id"],
                              [("balance_negative", F.col("c_acctbal") >= 0)])
    drift = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n")).where("n > 12") \
        .select("id", F.lit("count_drift").alias("violation"))
    return V.gate_by_changes(changed, {"balance": balance, "drift": drift}, ["id"])


@query("bundle_faults", """
with a as (select event_id, event_type, cast(user_id as varchar) as u from events),
i as (select distinct event_type, cast(user_id as varchar) as u from events where value > 100),
p as (select event_id from events where event_id % 7 > 0),
x as (select event_type, count(*) as n from a group by all), y as (select event_type, count(*) as n from i group by all)
select event_type as source, cast(event_id as varchar) as detail, 'identity_record_missing' as fault from a anti join i using (event_type, u)
union all select event_type, cast(event_id as varchar), 'raw_payload_missing' from a where event_id % 7 = 0
union all select event_type, x.n || '/' || coalesce(y.n, 0), 'accepted_identity_count_mismatch' from x left join y using (event_type) where x.n is distinct from y.n
""")
def bundle_faults(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(
        F.lit("run-1").alias("run_id"), F.lit("market").alias("vehicle_key"), F.col("event_type").alias("source"),
        F.col("user_id").cast("string").alias("canonical_listing_id"),
        F.col("event_id").alias("source_record_index"), "value", "props")
    known = e.where("value > 100").select("run_id", "vehicle_key", "source", "canonical_listing_id").distinct()
    payloads = e.where("source_record_index % 7 > 0").select(
        "run_id", "vehicle_key", "source", "source_record_index", F.col("props").alias("raw_payload"))
    return CL.bundle_faults(e.drop("value", "props"), known, payloads).select("source", "detail", "fault")


@query("evidence_bundles", """
with i as (select event_type, user_id, count(*) as n from events group by all)
select event_id, event_type as source, cast(user_id as varchar) as canonical_listing_id, n as observation_count, props as raw_payload
from events join i using (event_type, user_id) where event_id % 7 > 0
""")
def evidence_bundles(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(
        F.lit("run-1").alias("run_id"), F.lit("market").alias("vehicle_key"), F.col("event_type").alias("source"),
        F.col("user_id").cast("string").alias("canonical_listing_id"),
        F.col("event_id").alias("source_record_index"), "props")
    run = ["run_id", "vehicle_key", "source"]
    known = e.groupBy(*run, "canonical_listing_id").agg(F.count("*").alias("observation_count"))
    payloads = e.where("source_record_index % 7 > 0").select(
        *run, "source_record_index", F.col("props").alias("raw_payload"))
    return CL.evidence_bundles(e.drop("props"), known, payloads).select(
        F.col("source_record_index").alias("event_id"), "source", "canonical_listing_id", "observation_count", "raw_payload")

