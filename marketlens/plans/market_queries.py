"""Price-context, duplicate and claim queries over the listing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import rules as R
from marketlens.functions.payload import vin_evidence
from marketlens.operators import claims as C
from marketlens.operators import comparables as CO
from marketlens.operators import duplicates as D
from marketlens.operators import market as M
from marketlens.operators.nodes import vin_claims
from marketlens.plans.bindings import EARLY, LISTING_SQL, TEXT_SQL, ads, ids, listings, observations, OBS_SQL, table
from marketlens.plans.registry import query
from marketlens.session import settle

KEYS = "vehicle_key, source, source_record_index, listing_id"


def priced(df: DataFrame) -> DataFrame:
    """Listings under the names the price operators use; some years and mileages are unknown."""
    return df.withColumns({
        "price_cad": F.col("price"),
        "mileage_km": F.when(F.col("mileage") % 13 > 0, F.col("mileage")),
        "year": F.when(F.col("price") % 17 > 0, F.col("year")),
    })


P_SQL = """
p as (
  select * replace (case when price % 17 > 0 then year end as year), price as price_cad,
         case when mileage % 13 > 0 then mileage end as mileage_km from listing)
"""
PRICED_SQL = f"{LISTING_SQL}, {P_SQL}"
COHORT_STEPS = """
years as (select distinct vehicle_key, year from p),
span as (
  select y.vehicle_key, y.year, l.level, p.price_cad, p.mileage_km
  from years y cross join (values (1), (2), (3), (4)) l(level)
  join p on p.vehicle_key = y.vehicle_key and p.price_cad > 0 and (
       (l.level = 1 and p.year = y.year) or (l.level = 2 and abs(p.year - y.year) <= 1)
    or (l.level = 3 and y.year between 1998 and 2000 and p.year between 1998 and 2000) or l.level = 4)),
st as (
  select vehicle_key, year, level, count(*) as n,
         quantile_cont(price_cad, 0.25) as q1, quantile_cont(price_cad, 0.5) as q2, quantile_cont(price_cad, 0.75) as q3,
         count(mileage_km) as m, count(distinct mileage_km) as dm,
         count(mileage_km) * sum(mileage_km::hugeint * mileage_km) - sum(mileage_km)::hugeint * sum(mileage_km) as cxx,
         count(mileage_km) * sum(mileage_km::hugeint * price_cad) - sum(mileage_km)::hugeint * sum(price_cad) filter (mileage_km is not null) as cxy,
         count(mileage_km) * sum(price_cad::hugeint * price_cad) filter (mileage_km is not null)
           - (sum(price_cad) filter (mileage_km is not null))::hugeint * sum(price_cad) filter (mileage_km is not null) as cyy,
         sum(mileage_km)::double as sx, (sum(price_cad) filter (mileage_km is not null))::double as sy
  from span group by all),
pick as (
  select vehicle_key, year, min(level) as level from st where level = 4 or n >= 3 group by all),
co as (
  select st.*, case when m >= 5 and dm >= 3 then cxy::double / cxx::double end as slope,
         case st.level when 1 then 'exact_model_year_' || st.year when 2 then 'model_year_' || st.year || '_plus_minus_1'
              when 3 then 'early_2020s_1998_2000' else 'all_claims' end as cohort_basis
  from st join pick on st.vehicle_key = pick.vehicle_key and st.year is not distinct from pick.year and st.level = pick.level)
"""
COHORT_SQL = f"{PRICED_SQL}, {COHORT_STEPS}"


@query("market_context", f"""
with {COHORT_SQL}
select {KEYS.replace('vehicle_key', 'p.vehicle_key')}, cohort_basis, n as comparable_count,
       cast(round_even(q1, 0) as bigint) as price_q1_cad, cast(round_even(q2, 0) as bigint) as price_median_cad,
       cast(round_even(q3, 0) as bigint) as price_q3_cad,
       case when n < 3 then 'insufficient_comparables' when price_cad < q1 then 'below_observed_interquartile_range'
            when price_cad > q3 then 'above_observed_interquartile_range' else 'within_observed_interquartile_range' end as price_position,
       case when n >= 3 then cast(round_even(price_cad - q2, 0) as bigint) end as price_difference_from_median_cad,
       case when mileage_km is not null and slope is not null then cast(round_even((sy - slope * sx) / m + slope * mileage_km, 0) as bigint) end as projected_asking_price_cad,
       case when mileage_km is not null and slope is not null then round_even(slope * 10000, 2) end as slope_cad_per_10000_km,
       case when mileage_km is not null and slope is not null then round_even(cxy::double / cxx::double * (cxy::double / cyy::double), 4) end as r_squared
from p join co on co.vehicle_key = p.vehicle_key and co.year is not distinct from p.year
""")
def market_context(spark: SparkSession, d: str) -> DataFrame:
    out = M.market_context(priced(listings(spark, d)), "all_claims", EARLY)
    return out.select(
        *ids(), "cohort_basis", "comparable_count", "price_q1_cad", "price_median_cad", "price_q3_cad",
        "price_position", "price_difference_from_median_cad", "projected_asking_price_cad",
        "slope_cad_per_10000_km", "r_squared")


@query("cohort_fallback", f"""
with {COHORT_SQL}
select vehicle_key, year, cohort_basis, n as comparable_count, cast(m as bigint) as sample_count from co
""")
def cohort_fallback(spark: SparkSession, d: str) -> DataFrame:
    return M.cohort_by_year(priced(listings(spark, d)), "all_claims", EARLY).select(
        "vehicle_key", "year", "cohort_basis", "comparable_count",
        F.coalesce("sample_count", F.lit(0)).alias("sample_count"))


@query("year_groups", f"""
with {PRICED_SQL}
select vehicle_key, year, count(*) as listing_claim_count,
       cast(round_even(quantile_cont(price_cad, 0.25), 0) as bigint) as price_q1_cad,
       cast(round_even(quantile_cont(price_cad, 0.5), 0) as bigint) as price_median_cad,
       cast(round_even(quantile_cont(price_cad, 0.75), 0) as bigint) as price_q3_cad,
       cast(round_even(quantile_cont(mileage_km, 0.25), 0) as bigint) as mileage_q1_km,
       cast(round_even(quantile_cont(mileage_km, 0.5), 0) as bigint) as mileage_median_km,
       cast(round_even(quantile_cont(mileage_km, 0.75), 0) as bigint) as mileage_q3_km
from p where year is not null group by all
""")
def year_groups(spark: SparkSession, d: str) -> DataFrame:
    return M.year_groups(priced(listings(spark, d)))


@query("price_distribution", f"""
with {LISTING_SQL}
select source, model, count(*) as count, min(price) as minimum,
       cast(round_even(quantile_cont(price, 0.25), 0) as bigint) as q1,
       cast(round_even(quantile_cont(price, 0.5), 0) as bigint) as median,
       cast(round_even(quantile_cont(price, 0.75), 0) as bigint) as q3, max(price) as maximum
from listing group by all
""")
def price_distribution(spark: SparkSession, d: str) -> DataFrame:
    return M.distribution(listings(spark, d), ["source", "model"], "price")


@query("price_direction", f"""
with {OBS_SQL},
c as (
  select source, canonical_listing_id, arg_max(price_cad, run_ts) - any_value(prev) as change
  from (select *, nth_value(price_cad, 2) over (partition by source, canonical_listing_id order by run_ts desc
          rows between unbounded preceding and unbounded following) as prev from obs) group by all)
select source, count(change) as listings_with_previous_price_observation,
       count(*) filter (change < 0) as asking_price_decrease_count,
       count(*) filter (change > 0) as asking_price_increase_count,
       count(*) filter (change = 0) as asking_price_unchanged_count,
       case when count(change) >= 3 then cast(round_even(quantile_cont(change, 0.5), 0) as bigint) end as median_change_from_previous_observation_cad,
       case when count(change) >= 3 then 'observed_asking_price_change_context_available' else 'insufficient_multi_run_history' end as status
from c group by source
""")
def price_direction(spark: SparkSession, d: str) -> DataFrame:
    from marketlens.operators.prices import price_summary

    log = observations(spark, d).withColumn("r", F.col("run_ts"))
    return M.price_direction(price_summary(log), ["source"], "change_from_previous_observation_cad")


@query("year_fit_and_usage", f"""
with {PRICED_SQL}
select {KEYS}, case when year = 2001 then 'ideal_2001' when year between 1998 and 2000 then 'early_2020s_target'
                    when year between 1995 and 1996 then 'broad_market_context' else 'unknown' end as year_fit,
       mileage_km + 25000 as projected_min_km, mileage_km + 40000 as projected_max_km
from p
""")
def year_fit_and_usage(spark: SparkSession, d: str) -> DataFrame:
    km = M.mileage_scenario(F.col("mileage_km"))
    return priced(listings(spark, d)).select(
        *ids(), M.year_fit(F.col("year"), 2001, (1998, 2000), (1995, 1996)).alias("year_fit"),
        km["projected_mileage_min_km"].alias("projected_min_km"),
        km["projected_mileage_max_km"].alias("projected_max_km"))


# --- duplicates ------------------------------------------------------------------------------------

DUPLICATE_SQL = f"""
{LISTING_SQL},
t as (
  select vehicle_key, source, listing_id || '/' || source_record_index as id, year, lower(make) as make, lower(model) as model,
         list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(trim), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: len(w) > 1))) as tok,
         price as p, mileage as m, lower(dealer) as dealer, lower(location) as location, vin_claim as vin
  from listing),
pairs as (
  select l.vehicle_key, l.source as ls, r.source as rs, l.id as lid, r.id as rid, l.vin as lv, r.vin as rv,
         coalesce(l.vin = r.vin, false) as same_vin, abs(l.p - r.p) as dp, abs(l.m - r.m) as dm,
         concat_ws(';',
           case when l.location = r.location and l.location <> '' then 'location_claim_match' end,
           case when l.tok = r.tok and l.m // 3000 = r.m // 3000 then 'loose_fingerprint_match' end,
           case when abs(l.m - r.m) <= 1000 and abs(l.p - r.p) <= 1500 then 'mileage_within_1000_km' else 'mileage_within_3000_km' end,
           case when abs(l.m - r.m) <= 1000 and abs(l.p - r.p) <= 1500 then 'price_within_1500_cad' else 'price_within_3000_cad' end,
           case when l.dealer = r.dealer then 'seller_name_match' end,
           case when l.tok = r.tok and l.m // 1000 = r.m // 1000 and l.dealer = r.dealer then 'strict_fingerprint_match' end,
           case when list_has_any(l.tok, r.tok) then 'trim_token_overlap' end, 'year_make_model_match') as banded,
         (l.location = r.location and l.location <> '') or (l.tok = r.tok and l.m // 3000 = r.m // 3000)
           or l.dealer = r.dealer or list_has_any(l.tok, r.tok) as supported,
         l.year = r.year and l.make = r.make and l.model = r.model as same_kind
  from t l join t r on l.vehicle_key = r.vehicle_key and l.source < r.source
   and ((l.year = r.year and l.make = r.make and l.model = r.model and abs(l.p - r.p) <= 3000 and abs(l.m - r.m) <= 3000)
        or l.vin = r.vin)),
cand as (
  select *, case when same_vin then 'high' when dm <= 1000 and dp <= 1500 then 'medium' else 'low' end as confidence,
         case when same_vin then 'exact_source_reported_vin_claim_match' else banded end as reasons
  from pairs where same_vin or (same_kind and supported and dp <= 3000 and dm <= 3000))
"""


def identities(spark: SparkSession, d: str) -> DataFrame:
    """Listings as identity records; the row index keeps repeated listing ids apart."""
    base = listings(spark, d).select(
        "vehicle_key", "source",
        F.concat_ws("/", "listing_id", F.col("source_record_index").cast("string")).alias("canonical_listing_id"),
        "year", "make", "model", "trim", F.col("price").alias("price_cad"),
        F.col("mileage").alias("mileage_km"), "dealer", "location", "vin_claim",
        F.when(F.col("vin_claim").isNotNull(), F.lit(D.VIN_VALID)).otherwise(F.lit("not_reported"))
        .alias("vin_evidence_status"))
    return D.with_profile(D.identity_components(base))


def linkable(found: DataFrame, *more: str) -> DataFrame:
    """The columns that matching and its results read; the others are not written."""
    return found.select("vehicle_key", "source", "canonical_listing_id", "profile_id", *D.COMPONENTS, "vin", "vin_claim", *more)


def matched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Profile pairs that bring their listings along, and the listings."""
    found = settle(linkable(identities(spark, d)))
    return D.profile_pairs(settle(D.with_listings(settle(D.profiles(found)), found))), found


@query("duplicate_candidates", f"""
with {DUPLICATE_SQL}
select vehicle_key, 'duplicate_candidate_' || sha256(concat_ws(chr(31), vehicle_key, lid, rid))[1:24] as candidate_id,
       confidence, case confidence when 'high' then 0.98 when 'medium' then 0.78 else 0.56 end::double as confidence_score,
       reasons, 'candidate_only_not_merged' as decision_status, ls as left_source, lid as left_listing_id,
       rs as right_source, rid as right_listing_id, lv as left_vin_claim, rv as right_vin_claim
from cand
""")
def duplicate_candidates(spark: SparkSession, d: str) -> DataFrame:
    pairs, found = matched(spark, d)
    return D.listing_pairs(pairs, found).withColumn("reasons", F.array_join("reasons", ";"))


@query("duplicate_index", f"""
with {DUPLICATE_SQL},
s as (select vehicle_key, ls as source, lid as canonical_listing_id, confidence, reasons from cand
      union all select vehicle_key, rs, rid, confidence, reasons from cand),
x as (select *, unnest(string_split(reasons, ';')) as reason from s),
rs as (select canonical_listing_id, string_agg(distinct reason, ';' order by reason) as duplicate_candidate_reasons from x group by all)
select vehicle_key, source, canonical_listing_id, count(*) as duplicate_candidate_count,
       case when bool_or(confidence = 'high') then 'high' when bool_or(confidence = 'medium') then 'medium' else 'low' end as highest_duplicate_confidence,
       any_value(duplicate_candidate_reasons) as duplicate_candidate_reasons
from s join rs using (canonical_listing_id) group by vehicle_key, source, canonical_listing_id
""")
def duplicate_index(spark: SparkSession, d: str) -> DataFrame:
    found = settle(linkable(identities(spark, d)))
    return D.candidate_index(settle(D.profiles(found)), found).withColumn(
        "duplicate_candidate_reasons", F.array_join("duplicate_candidate_reasons", ";"))


PROFILE_SQL = f"""
{DUPLICATE_SQL},
pf as (select *, min(id) over w as representative, count(*) over w as members from t
  window w as (partition by vehicle_key, source, year, make, model, tok, m, p, dealer, location, vin))
"""


@query("duplicate_profile_members", f"""
with {PROFILE_SQL}
select vehicle_key, source, id as canonical_listing_id, representative, members from pf
""")
def duplicate_profile_members(spark: SparkSession, d: str) -> DataFrame:
    """Membership of every listing in a profile of identical identity components."""
    return D.profile_members(identities(spark, d)).drop("profile_id")


@query("duplicate_profile_pairs", f"""
with {PROFILE_SQL}
select distinct cand.vehicle_key, confidence, case confidence when 'high' then 0.98 when 'medium' then 0.78 else 0.56 end::double as confidence_score,
       reasons, l.representative as left, r.representative as right, l.members as left_members, r.members as right_members
from cand join pf l on l.id = lid join pf r on r.id = rid
""")
def duplicate_profile_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All duplicate links as pairs of profiles; with the members, no link between listings is lost."""
    found = settle(linkable(identities(spark, d)))
    members = D.profile_members(found)
    pairs = D.profile_pairs(settle(D.with_representatives(D.profiles(found), members)))
    return D.named_pairs(pairs, members).withColumn("reasons", F.array_join("reasons", ";"))


@query("duplicate_candidate_ids", f"""
with {DUPLICATE_SQL},
i as (select vehicle_key, lid, rid, 'duplicate_candidate_' || sha256(concat_ws(chr(31), vehicle_key, lid, rid))[1:24] as c from cand),
b as (select vehicle_key, lid as id, c from i union select vehicle_key, rid, c from i)
select vehicle_key, id as canonical_listing_id, c as candidate_id, row_number() over (partition by vehicle_key, id order by c) as position from b
""")
def duplicate_candidate_ids(spark: SparkSession, d: str) -> DataFrame:
    """Sorted candidate ids of each listing, one row each."""
    pairs, found = matched(spark, d)
    return D.listing_duplicate_ids(D.listing_pairs(pairs, found))


@query("identity_fingerprints", f"""
with {DUPLICATE_SQL}
select vehicle_key, source, id as canonical_listing_id, m // 1000 as mileage_bucket_1000, m // 3000 as mileage_bucket_3000,
       p // 1000 as price_bucket_1000,
       'fingerprint_strict_' || sha256(concat_ws(chr(31), year, replace(make, '#', ' '), model, array_to_string(tok, ','), m // 1000, dealer))[1:24] as strict_print,
       'fingerprint_loose_' || sha256(concat_ws(chr(31), year, replace(make, '#', ' '), model, array_to_string(tok, ','), m // 3000))[1:24] as loose_print
from t
""")
def identity_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return identities(spark, d).select(
        "vehicle_key", "source", "canonical_listing_id", "mileage_bucket_1000", "mileage_bucket_3000",
        "price_bucket_1000", F.col("identity_fingerprint_strict").alias("strict_print"),
        F.col("identity_fingerprint_loose").alias("loose_print"))


@query("vin_claim_evidence", f"""
with {LISTING_SQL}
select {KEYS}, case when vin_claim is not null and price % 5 > 0 then vin_claim end as vin_claim,
       case when vin_claim is null and price % 3 = 0 then 'source_reported_invalid_format_unverified'
            when vin_claim is null then 'not_reported'
            when price % 5 = 0 then 'conflicting_source_reported_claims'
            else 'source_reported_format_valid_unverified' end as vin_evidence_status
from listing
""")
def vin_claim_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Explicit claims in nested payloads; ids of the same shape in other keys or texts never count."""
    other = F.when(F.col("price") % 5 == 0, F.array(F.lower("vin_claim"), F.lit("2FTAAAAAAAAAAAAAA"))) \
        .otherwise(F.array(F.lower("vin_claim")))
    payload = F.to_json(F.struct(
        F.col("listing_id").alias("id"), F.lit('the "vin": "3FTAAAAAAAAAAAAAA" is {fake}').alias("description"),
        F.struct(
            F.lit("4FTAAAAAAAAAAAAAA").alias("serial"),
            F.when(F.col("vin_claim").isNotNull(), other).alias("Vehicle Identification Number"),
            F.when(F.col("vin_claim").isNull() & (F.col("price") % 3 == 0), F.lit("SHORT-1")).alias("VIN"),
        ).alias("vehicle")))
    claimed = vin_claims(listings(spark, d).select(*ids(), payload.alias("payload")), "payload")
    return claimed.select(*ids(), vin_evidence(F.col("vin_claims")).alias("e")).select(*ids(), "e.vin_claim", "e.vin_evidence_status")


@query("closest_other_source", f"""
with {LISTING_SQL},
u as (select *, listing_id || '/' || source_record_index as record from listing),
m as (
  select b.record, o.listing_id as oid, o.url as ourl, o.price as op, o.record as orec, abs(o.price - b.price) as dp, abs(o.mileage - b.mileage) as dm,
         case when b.listing_id = o.listing_id then 0 else 1 end as tier
  from u b join u o on b.vehicle_key = o.vehicle_key and b.source = 'F' and o.source = 'O'
   and (b.listing_id = o.listing_id or (b.year = o.year and abs(o.price - b.price) <= 100 and abs(o.mileage - b.mileage) <= 1000))),
best as (select *, row_number() over (partition by record order by tier, dp, dm, oid, orec) as n from m)
select u.vehicle_key, u.record, best.record is not null as also_on_other_source, oid as other_listing_id, op as other_price,
       case when op < price then 'cheaper' when op > price then 'more expensive' end as other_price_direction,
       abs(op - price) as other_price_difference
from u left join best on best.record = u.record and best.n = 1 where u.source = 'F'
""")
def closest_other_source(spark: SparkSession, d: str) -> DataFrame:
    rows = listings(spark, d).select(
        "vehicle_key", "source", "listing_id", "year", "price", "mileage",
        F.concat_ws("/", "listing_id", F.col("source_record_index").cast("string")).alias("record"))
    rows = settle(rows)
    out = D.best_cross_source_match(rows.where("source = 'F'").drop("source"), rows.where("source = 'O'").drop("source"))
    return out.select("vehicle_key", "record", "also_on_other_source", "other_listing_id", "other_price",
                      "other_price_direction", "other_price_difference")


# --- claims -----------------------------------------------------------------------------------------

CLAIM_STEPS = """
cl as (
  select *, case mileage % 5 when 0 then 'crew_cab' when 1 then 'supercab' when 2 then 'regular_cab' when 3 then 'crew_cab' end as cab_configuration,
         case price % 4 when 0 then 'long_box_or_8ft_claim' when 1 then 'short_box_or_6_75ft_claim' when 2 then 'short_box_or_6_75ft_claim' end as box_configuration,
         case price % 3 when 0 then 'drw' when 1 then 'srw' end as rear_wheel_configuration,
         case mileage % 3 when 0 then '4wd' when 1 then '2wd' end as drivetrain,
         case when price % 5 < 3 then (mileage // 1000) * 1000 + price % 1000 end as engine_hours,
         case when price % 7 < 3 then price % 900 end as idle_hours,
         case price % 6 when 0 then 'records_not_available_claim' when 1 then 'records_available_claim' when 2 then 'records_available_claim' end as service_history,
         case price % 9 when 0 then 'no_fleet_commercial_rental_use_claim' when 1 then 'fleet_use_claim;work_truck_claim'
              when 2 then 'one_owner_claim;towing_use_claim' when 3 then 'commercial_use_claim' else '' end as prior_use,
         case price % 11 when 0 then 'Salvage/rebuilt' when 1 then 'No accidents reported' when 2 then 'Accident reported' else '' end as accident_title,
         vin_claim is not null as has_vin
  from ad)
"""
CLAIMS_SQL = f"{TEXT_SQL}, {CLAIM_STEPS}"


def claimed(spark: SparkSession, d: str) -> DataFrame:
    from marketlens.functions.listing import accident_claim

    base = priced(ads(spark, d)).withColumn("accident_claim", accident_claim(F.col("text")))
    base = base.select(
        "*", *C.configuration_claims(F.col("text"), F.col("accident_claim")),
        F.when(F.col("vin_claim").isNotNull(), F.lit(D.VIN_VALID)).otherwise(F.lit("not_reported"))
        .alias("vin_evidence_status"))
    return base


@query("configuration_claims", f"""
with {CLAIMS_SQL}
select {KEYS}, cab_configuration, box_configuration, rear_wheel_configuration, drivetrain, engine_hours, idle_hours,
       service_history, prior_use as prior_use_claims, accident_title from cl
""")
def configuration_claims(spark: SparkSession, d: str) -> DataFrame:
    return claimed(spark, d).select(
        *ids(), "cab_configuration", "box_configuration", "rear_wheel_configuration", "drivetrain",
        "engine_hours", "idle_hours", "service_history",
        F.array_join("prior_use_claims", ";").alias("prior_use_claims"), "accident_title")


@query("matched_claim_texts", f"""
with {TEXT_SQL}
select {KEYS}, case mileage % 5 when 0 then 'Crew Cab' when 1 then 'super cab' when 2 then 'Regular  cab' when 3 then 'SuperCrew' end as cab_text,
       case price % 3 when 0 then 'dually' when 1 then 'SRW' end as rear_text,
       case mileage % 3 when 0 then '4x4' when 1 then 'rear-wheel drive' end as drive_text
from ad
""")
def matched_claim_texts(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return ads(spark, d).select(
        *ids(), R.first_match(text, C.CAB_RULES).alias("cab_text"),
        R.first_match(text, C.REAR_WHEEL_RULES).alias("rear_text"),
        R.first_match(text, C.DRIVETRAIN_RULES).alias("drive_text"))


COMPLETE_STEPS = """
cm as (
  select *, concat_ws(';', case when accident_title = '' then 'accident_title' end, case when box_configuration is null then 'box_configuration' end,
      case when cab_configuration is null then 'cab_configuration' end, case when drivetrain is null then 'drivetrain' end,
      case when engine_hours is null then 'engine_hours' end, case when idle_hours is null then 'idle_hours' end,
      case when prior_use = '' then 'prior_use' end, case when rear_wheel_configuration is null then 'rear_wheel_configuration' end,
      case when service_history is null then 'service_history' end, case when not has_vin then 'vin' end) as missing
  from cl),
cn as (select *, case when missing = '' then 10 else 10 - len(string_split(missing, ';')) end as known from cm)
"""
COMPLETE_SQL = f"{CLAIMS_SQL}, {COMPLETE_STEPS}"


@query("evidence_completeness", f"""
with {COMPLETE_SQL}
select {KEYS}, missing, case when known >= 8 then 'complete' when known >= 4 then 'partial' else 'insufficient' end as evidence_completeness
from cn
""")
def evidence_completeness(spark: SparkSession, d: str) -> DataFrame:
    return C.completeness(claimed(spark, d)).select(
        *ids(), F.array_join("missing_investigation_fields", ";").alias("missing"), "evidence_completeness")


@query("claim_statuses", f"""
with {CLAIMS_SQL}
select {KEYS}, engine_hours, case when engine_hours is null then 'unknown' else 'source_text_reported_unverified' end as engine_hours_status,
       idle_hours, case when idle_hours is null then 'unknown' else 'source_text_reported_unverified' end as idle_hours_status
from cl
""")
def claim_statuses(spark: SparkSession, d: str) -> DataFrame:
    """Evidence status next to each claimed value."""
    return claimed(spark, d).select(*ids(), *[c for n in ("engine_hours", "idle_hours") for c in (
        F.col(n), C.claim_status(F.col(n)).alias(f"{n}_status"))])


@query("override_faults", """
with o as (select case when o_custkey % 7 = 0 then '' else cast(o_orderkey as varchar) end as id, o_orderstatus = 'P' as odd,
  o_orderpriority = '2-HIGH' as unsupported, o_orderpriority in ('1-URGENT', '2-HIGH') as classed, o_totalprice > 100000 as reasoned from orders)
select id as canonical_listing_id, unnest(list_filter([case when id = '' then 'missing_listing_id' end, case when odd then 'unsupported_disposition' end,
  case when unsupported then 'unsupported_classification' end, case when classed and not reasoned then 'override_reason_required' end], lambda x: x is not null)) as fault
from o
""")
def override_faults(spark: SparkSession, d: str) -> DataFrame:
    """Orders read as owner overrides, some against the contract."""
    overrides = table(spark, d, "orders").selectExpr(
        "case when o_custkey % 7 = 0 then '' else cast(o_orderkey as string) end as canonical_listing_id",
        "case o_orderstatus when 'F' then 'contacted' when 'O' then 'unreviewed' else 'odd' end as owner_disposition",
        "case o_orderpriority when '1-URGENT' then 'hold' when '2-HIGH' then 'unheard_of' end as classification_override",
        "case when o_totalprice > 100000 then 'owner decision' else ' ' end as override_reason")
    return C.override_faults(overrides)


@query("hour_context", f"""
with {CLAIMS_SQL}
select {KEYS}, case when engine_hours > 0 and mileage % 13 > 0 then round_even(mileage / engine_hours, 2) end as km_per_engine_hour,
       case when engine_hours > 0 and idle_hours <= engine_hours then round_even(idle_hours / engine_hours * 100, 2) end as idle_hour_percent,
       case when engine_hours > 0 and idle_hours > engine_hours then 'idle_hours_exceed_engine_hours' else '' end as warnings
from cl
""")
def hour_context(spark: SparkSession, d: str) -> DataFrame:
    return C.hour_context(claimed(spark, d)).select(
        *ids(), "km_per_engine_hour", "idle_hour_percent", F.array_join("hour_warnings", ";").alias("warnings"))


INVESTIGATION_SQL = f"""
with {TEXT_SQL}, {P_SQL}, {COHORT_STEPS}, {CLAIM_STEPS}, {COMPLETE_STEPS},
iv as (
  select cn.vehicle_key, cn.source, cn.source_record_index, cn.listing_id, cn.missing, cn.accident_title, cn.price, cn.mileage,
         case when cn.price % 17 = 0 then null else cn.year end as fit_year,
         case when known >= 8 then 'complete' when known >= 4 then 'partial' else 'insufficient' end as complete,
         case when n >= 3 and cn.price > q3 then true else false end as above
  from cn join co on co.vehicle_key = cn.vehicle_key
    and co.year is not distinct from case when cn.price % 17 > 0 then cn.year end),
fit as (
  select *, case when fit_year = 2001 then 'ideal_2001' when fit_year between 1998 and 2000 then 'early_2020s_target'
                 when fit_year between 1995 and 1996 then 'broad_market_context' else 'unknown' end as year_fit from iv),
cls as (
  select *, case when accident_title = 'Salvage/rebuilt' then 'concern_review' when year_fit = 'broad_market_context' then 'market_context_only'
       when year_fit = 'unknown' then 'insufficient_evidence' when above then 'investigate_price_concern'
       when complete = 'insufficient' then 'investigate_with_evidence_gaps' else 'investigate_priority' end as klass,
       case when accident_title = 'Salvage/rebuilt' then 'source_accident_or_title_concern' when year_fit = 'broad_market_context' then 'outside_early_2020s_target'
       when year_fit = 'unknown' then 'year_fit_unknown' when above then 'asking_price_above_observed_interquartile_range'
       when complete = 'insufficient' then 'multiple_investigation_fields_missing' else 'target_year_without_visible_hard_concern' end as why
  from fit)
"""


def investigated(spark: SparkSession, d: str) -> DataFrame:
    """Classified listings; of the claims, only what market context and classes read is worked out and written."""
    read = ["year", "price", "price_cad", "mileage_km", "accident_title", "evidence_completeness"]
    base = settle(C.completeness(claimed(spark, d)).select(*ids(), *read))
    out = M.market_context(base, "all_claims", EARLY)
    out = out.withColumn("year_fit", M.year_fit(F.col("year"), 2001, (1998, 2000), (1995, 1996)))
    return C.classify(out)


@query("investigation_classes", INVESTIGATION_SQL + f"""
select {KEYS}, klass as computed_classification,
       'year_fit:' || year_fit || ';evidence_completeness:' || complete || ';' || why as reasons,
       case when price % 101 = 0 then 'hold' else klass end as effective_classification,
       case when price % 101 = 0 then 'inspection_planned' else 'unreviewed' end as owner_disposition,
       price % 101 = 0 as override_applied
from cls
""")
def investigation_classes(spark: SparkSession, d: str) -> DataFrame:
    """Classes with overrides joined by listing; the override table is derived from the listings."""
    df = investigated(spark, d).withColumn(
        "canonical_listing_id", F.concat_ws("/", "listing_id", F.col("source_record_index").cast("string")))
    overrides = df.where("price % 101 = 0").select(
        "canonical_listing_id", F.lit("inspection_planned").alias("owner_disposition"),
        F.lit("call again").alias("owner_note"), F.array(F.lit("b"), F.lit("a")).alias("owner_tags"),
        F.lit("hold").alias("classification_override"), F.lit("seen in person").alias("override_reason"))
    out = C.with_overrides(df, overrides)
    return out.select(*ids(), "computed_classification",
                      F.array_join("computed_classification_reasons", ";").alias("reasons"),
                      "effective_classification", "owner_disposition", "override_applied")


@query("classification_counts", INVESTIGATION_SQL + """
select vehicle_key, klass as computed_classification, count(*) as listing_count from cls group by all
""")
def classification_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.label_counts(investigated(spark, d), ["vehicle_key"], "computed_classification")


@query("source_counts", f"""
with {LISTING_SQL}
select vehicle_key, s.source, count(listing.source) as listing_count
from (select distinct vehicle_key from listing) v cross join (values ('F'), ('O'), ('X')) s(source)
left join listing using (vehicle_key, source) group by all
""")
def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.label_counts(listings(spark, d), ["vehicle_key"], "source", ["F", "O", "X"])


@query("field_coverage", f"""
with {CLAIMS_SQL},
f as (select vehicle_key, unnest([
  {{'field': 'cab_configuration', 'k': cab_configuration is not null}}, {{'field': 'engine_hours', 'k': engine_hours is not null}},
  {{'field': 'prior_use', 'k': prior_use <> ''}}, {{'field': 'accident_title', 'k': accident_title <> ''}}]) as e from cl)
select vehicle_key, e.field as field, count(*) filter (e.k) as known_listing_count, count(*) as total_listing_count,
       round_even(count(*) filter (e.k) * 100.0 / count(*), 2)::double as coverage_percent
from f group by all
""")
def field_coverage(spark: SparkSession, d: str) -> DataFrame:
    known = {
        "cab_configuration": F.col("cab_configuration").isNotNull(),
        "engine_hours": F.col("engine_hours").isNotNull(),
        "prior_use": F.size("prior_use_claims") > 0, "accident_title": F.col("accident_title") != "",
    }
    return M.field_coverage(claimed(spark, d), known, ["vehicle_key"])


@query("seller_questions", f"""
with {COMPLETE_SQL},
q as (
  select {KEYS}, concat_ws(';', case when not has_vin then 'vin_not_source_reported' end,
    case when engine_hours is null or idle_hours is null then 'engine_or_idle_hours_missing' end,
    case when cab_configuration is null or box_configuration is null then 'cab_or_box_configuration_missing' end,
    case when rear_wheel_configuration is null then 'rear_wheel_configuration_missing' end,
    case when drivetrain is null then 'drivetrain_missing' end, case when service_history is null then 'service_history_missing' end,
    case when accident_title = '' then 'accident_title_evidence_missing' end, case when prior_use = '' then 'prior_use_evidence_missing' end,
    case when accident_title not in ('', 'No accidents reported') then 'source_accident_or_title_claim_requires_documents' end,
    'modification_state_required_for_diesel_purchase', 'independent_condition_verification_required') as reasons
  from cn)
select *, cast(len(string_split(reasons, ';')) as bigint) as seller_question_count from q
""")
def seller_questions(spark: SparkSession, d: str) -> DataFrame:
    return C.seller_questions(C.completeness(claimed(spark, d))).select(
        *ids(), F.array_join(F.transform("questions", lambda q: q["reason"]), ";").alias("reasons"),
        "seller_question_count")


# --- owned-value and family profiles -----------------------------------------------------------------

COMPARE_SQL = f"""
{TEXT_SQL},
v as (
  select *, case mileage % 3 when 0 then '4wd' when 1 then '2wd' end as drive,
         case when price % 17 > 0 then year end as y from ad),
f as (
  select *, y = 1999 as my, contains(lower(trim), 'red') as mt, fuel = 'Diesel' as mf, drive = '4wd' as md,
         contains(engine_cc || ' ' || lower(text), 'turbo') as me from v),
g as (
  select *, concat_ws(';', case when my then 'subject_match:year' end, case when mt then 'subject_match:trim' end,
     case when mf then 'subject_match:fuel' end, case when md then 'subject_match:drivetrain' end,
     case when not my then 'subject_conflict:year' end, case when not mt then 'subject_conflict:trim' end,
     case when fuel <> '' and not mf then 'subject_conflict:fuel' end, case when not md then 'subject_conflict:drivetrain' end,
     case when y is null then 'listing_evidence_missing:year' end, case when fuel = '' then 'listing_evidence_missing:fuel' end,
     case when drive is null then 'listing_evidence_missing:drivetrain' end) as r,
     coalesce(my, false)::int + mt::int + mf::int + coalesce(md, false)::int as m,
     (not coalesce(my, true))::int + (not mt)::int + (fuel <> '' and not mf)::int + (not coalesce(md, true))::int as c
  from f),
h as (
  select *, case when not my then 'broad_market_context' when my and m >= 3 and c = 0 then 'close_subject_comparable'
        when my or m >= 2 then 'partial_subject_comparable' when m > 0 then 'broad_market_context'
        else 'insufficient_configuration_evidence' end as label,
       case when not my then 'model_year_differs_from_subject' when my and m >= 3 and c = 0 then 'multiple_subject_attributes_match'
        when my or m >= 2 then 'some_subject_attributes_match' when m > 0 then 'limited_subject_attribute_match'
        else 'no_supported_subject_match' end as why from g)
"""


def compared(spark: SparkSession, d: str) -> DataFrame:
    subject = F.struct(
        F.lit("1999").alias("year"), F.lit("Red x").alias("trim"), F.lit("diesel").alias("fuel"),
        F.lit(None).cast("string").alias("engine"), F.lit("4WD").alias("drivetrain"),
        F.lit("52000").alias("current_odometer_km"), F.lit("").alias("odometer_context"))
    rows = priced(ads(spark, d)).withColumn("engine", F.col("engine_cc")).withColumn("subject", subject)
    return CO.comparability(rows)


@query("subject_comparability", f"""
with {COMPARE_SQL}
select {KEYS}, label as subject_comparability, concat_ws(';', nullif(r, ''), why) as reasons,
       'engine;odometer_context' as missing_fields,
       case when label in ('close_subject_comparable', 'partial_subject_comparable') then 'subject_context'
            when label = 'broad_market_context' then label else 'evidence_gap' end as market_role
from h
""")
def subject_comparability(spark: SparkSession, d: str) -> DataFrame:
    return compared(spark, d).select(
        *ids(), "subject_comparability", F.array_join("subject_comparability_reasons", ";").alias("reasons"),
        F.array_join("subject_profile_missing_fields", ";").alias("missing_fields"), "market_role")


@query("owned_value_summary", f"""
with {COMPARE_SQL},
k as (select *, count(*) filter (label in ('close_subject_comparable', 'partial_subject_comparable')) over (partition by vehicle_key) as near,
             count(*) over (partition by vehicle_key) as record_count from h)
select vehicle_key, record_count, case when near >= 3 then 'close_or_partial_subject_comparables' else 'all_configured_query_accepted_listings' end as cohort_basis,
       count(*) as cohort_count,
       case when near >= 3 then 'observed_asking_context_available_not_valuation' else 'insufficient_subject_comparables' end as context_status,
       cast(round_even(quantile_cont(price, 0.25), 0) as bigint) as lower_bound, cast(round_even(quantile_cont(price, 0.5), 0) as bigint) as upper_bound,
       cast(round_even(quantile_cont(case when mileage % 13 > 0 then mileage end, 0.75), 0) as bigint) as mileage_q3
from k where near < 3 or label in ('close_subject_comparable', 'partial_subject_comparable') group by vehicle_key, record_count, near
""")
def owned_value_summary(spark: SparkSession, d: str) -> DataFrame:
    out = CO.owned_summary(settle(compared(spark, d).select(
        "vehicle_key", "subject_comparability", "price_cad", "mileage_km", "subject")),
        F.col("subject.current_odometer_km").isNotNull())
    return out.select(
        "vehicle_key", "record_count", "cohort_basis", "cohort_count",
        F.col("subject_market_context_status").alias("context_status"),
        F.col("lower_observed_asking_bound_cad").alias("lower_bound"),
        F.col("upper_observed_asking_bound_cad").alias("upper_bound"), F.col("mileage.q3").alias("mileage_q3"))


FAMILY_SQL = f"""
{TEXT_SQL},
e as (
  select *, case mileage % 7 when 0 then 7 when 1 then 8 end as seats,
         case mileage % 7 when 1 then 'roof_rack_claim' when 2 then 'fold_flat_seating_claim;power_sliding_doors_claim' else '' end as cargo,
         case price % 6 when 0 then 'records_not_available_claim' when 1 then 'records_available_claim' when 2 then 'records_available_claim' end as service,
         case price % 11 when 0 then 'salvage' when 1 then 'no accidents' when 2 then 'collision' end as title,
         case when price % 17 > 0 then year end as y, case when mileage % 13 > 0 then mileage end as km,
         case price % 4 when 0 then '' when 1 then 'Private' else 'Dealer' end as seller from ad),
ok as (
  select *, concat_ws(';',
     case when price <= 60000 then 'preference_match:budget_max_cad' end, case when y >= 1997 then 'preference_match:min_year' end,
     case when y <= 2000 then 'preference_match:max_year' end, case when km <= 40000 then 'preference_match:max_mileage_km' end,
     case when seats >= 8 then 'preference_match:minimum_seating' end,
     case when seller = 'Dealer' then 'preference_match:acceptable_seller_types' end,
     case when title is not null then 'source_claim_present_unverified:accident_title_requirement' end,
     case when service is not null then 'source_claim_present_unverified:service_history_requirement' end,
     case when contains(cargo, 'fold_flat') then 'preference_match:cargo_requirements' end) as good,
   concat_ws(';',
     case when seller = 'Private' then 'acceptable_seller_types' end, case when price > 60000 then 'budget_max_cad' end,
     case when cargo <> '' and not contains(cargo, 'fold_flat') then 'cargo_requirements' end,
     case when km > 40000 then 'max_mileage_km' end, case when y > 2000 then 'max_year' end,
     case when y < 1997 then 'min_year' end, case when seats < 8 then 'minimum_seating' end) as bad,
   concat_ws(';', case when seller = '' then 'acceptable_seller_types' end, case when title is null then 'accident_title_requirement' end,
     case when cargo = '' then 'cargo_requirements' end, 'max_distance_km', case when km is null then 'max_mileage_km' end,
     case when y is null then 'max_year' end, case when y is null then 'min_year' end,
     case when seats is null then 'minimum_seating' end, case when service is null then 'service_history_requirement' end) as unk from e)
"""


def family(spark: SparkSession, d: str) -> DataFrame:
    """Preferences with everything stated but availability, which would stay unresolved anyway."""
    preferences = F.struct(
        F.lit(60000).alias("budget_max_cad"), F.lit(1997).alias("min_year"), F.lit(2000).alias("max_year"),
        F.lit(40000).alias("max_mileage_km"), F.lit(8).alias("minimum_seating"),
        F.array(F.lit("fold_flat_seating_claim")).alias("cargo_requirements"),
        F.lit(100).alias("max_distance_km"), F.lit("clean").alias("accident_title_requirement"),
        F.lit("some").alias("service_history_requirement"),
        F.array(F.lit("dealer")).alias("acceptable_seller_types"),
        F.when(F.col("vehicle_key") == "Brand#1", F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("any time"))).alias("availability_constraints"))
    seller = F.when(F.col("price") % 4 == 0, F.lit("unknown")).when(F.col("price") % 4 == 1, F.lit("Private")) \
        .otherwise(F.lit("Dealer"))
    rows = priced(ads(spark, d)).withColumns({
        "accident_claim": F.lit("unknown"), "seller_type_claim": seller,
        "distance_km": F.lit(None).cast("double"), "preferences": preferences})
    return CO.evaluate_preferences(CO.family_evidence(rows))


@query("preference_matching", f"""
with {FAMILY_SQL}
select {KEYS}, case when vehicle_key = 'Brand#1' then 'preferences_incomplete' when bad <> '' then 'outside_stated_preferences'
          else 'preference_match_unresolved_by_missing_listing_evidence' end as preference_match_status,
       concat_ws(';', nullif(good, ''), nullif(array_to_string(list_transform(list_filter(string_split(bad, ';'), lambda x: x <> ''), lambda x: 'preference_mismatch:' || x), ';'), ''),
         array_to_string(list_transform(list_sort(string_split(unk || case when vehicle_key = 'Brand#1' then '' else ';availability_constraints' end, ';')),
           lambda x: 'listing_evidence_missing:' || x), ';')) as reasons,
       case when vehicle_key = 'Brand#1' then 'candidate_pending_requirements' when bad <> '' then 'candidate_outside_stated_preferences'
          else 'candidate_with_evidence_gaps' end as candidate_classification
from ok
""")
def preference_matching(spark: SparkSession, d: str) -> DataFrame:
    return family(spark, d).select(
        *ids(), "preference_match_status", F.array_join("preference_match_reasons", ";").alias("reasons"),
        "candidate_classification")


@query("family_claims", f"""
with {FAMILY_SQL}
select {KEYS}, seats::bigint as seating_claim, cargo as cargo_feature_claims, service as service_history_claim,
       title as accident_title_claim from ok
""")
def family_claims(spark: SparkSession, d: str) -> DataFrame:
    return family(spark, d).select(
        *ids(), "seating_claim", F.array_join("cargo_feature_claims", ";").alias("cargo_feature_claims"),
        "service_history_claim", "accident_title_claim")


@query("family_questions", f"""
with {FAMILY_SQL}
select {KEYS}, concat_ws(';', 'independent_identity_verification_required',
    case when title is null then 'accident_title_evidence_missing' else 'source_accident_title_claim_unverified' end,
    case when service is null then 'service_history_evidence_missing' end, case when seats is null then 'seating_capacity_missing' end,
    'family_use_feature_verification_required', 'availability_not_proven_by_listing', 'independent_condition_verification_required') as reasons
from ok
""")
def family_questions(spark: SparkSession, d: str) -> DataFrame:
    return CO.family_questions(family(spark, d)).select(
        *ids(), F.array_join(F.transform("questions", lambda q: q["reason"]), ";").alias("reasons"))


@query("family_summary", f"""
with {FAMILY_SQL}
select vehicle_key, case when vehicle_key = 'Brand#1' then 'candidate_pending_requirements' when bad <> '' then 'candidate_outside_stated_preferences'
          else 'candidate_with_evidence_gaps' end as candidate_classification, count(*) as listing_count
from ok group by all
""")
def family_summary(spark: SparkSession, d: str) -> DataFrame:
    return CO.family_summary(family(spark, d))


@query("input_gaps", """
with s as (
  select c_custkey as vehicle_key, unnest([
    {'field': 'year', 'ok': c_nationkey % 2 = 0}, {'field': 'trim', 'ok': c_mktsegment <> 'FURNITURE'},
    {'field': 'fuel', 'ok': c_acctbal > 0}]) as e from customer)
select vehicle_key, e.field as field, 'Record current owner input for ' || e.field || '.' as action from s where not e.ok
""")
def input_gaps(spark: SparkSession, d: str) -> DataFrame:
    from marketlens.plans.bindings import table

    subjects = table(spark, d, "customer").select(
        F.col("c_custkey").alias("vehicle_key"),
        F.struct(
            F.when(F.col("c_nationkey") % 2 == 0, F.lit("2001")).alias("year"),
            F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("")).otherwise(F.lit("red")).alias("trim"),
            F.when(F.col("c_acctbal") > 0, F.lit("gas")).alias("fuel")).alias("subject"))
    return CO.input_gaps(subjects, "subject", ("year", "trim", "fuel"))
