"""Projections of the given tables to listing, observation, page and text inputs.

The column expressions are plain SQL that both engines read the same way; the operators under test
are not part of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import spread

RUN = "run-1"
CURRENT_YEAR = 2002
EARLY = (1998, 2000)
HOME = (43.65, -79.38)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- observations: one listing per (user, event type), one run per day and event type ---------

OBS_SQL = """
obs as (
  select 'market' as vehicle_key, event_type as source, cast(user_id as varchar) as canonical_listing_id,
         cast(cast(ts as date) as varchar) as run_id, cast(cast(ts as date) as timestamp) as run_ts,
         arg_max(cast(round(value * 100) as bigint), (ts, event_id)) as price_cad
  from events group by all
),
runs as (
  select vehicle_key, source, run_id, run_ts,
         cast(row_number() over (partition by vehicle_key, source order by run_ts, run_id) as bigint) as r
  from (select distinct vehicle_key, source, run_id, run_ts from obs)
)
"""


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Accepted records: the last event of the day sets the price."""
    e = table(spark, d, "events")
    day = F.to_date("ts")
    return e.groupBy(
        F.lit("market").alias("vehicle_key"), F.col("event_type").alias("source"),
        F.col("user_id").cast("string").alias("canonical_listing_id"), day.alias("_day"),
    ).agg(
        F.max_by(F.round(F.col("value") * 100).cast("bigint"), F.struct("ts", "event_id")).alias("price_cad"),
    ).select(
        "vehicle_key", "source", "canonical_listing_id", F.col("_day").cast("string").alias("run_id"),
        F.col("_day").cast("timestamp").alias("run_ts"), "price_cad")


def seen(spark: SparkSession, d: str, **limits: int) -> tuple[DataFrame, DataFrame]:
    """Sightings and run calendar of the observations."""
    from marketlens.operators import lifecycle as LC

    obs = observations(spark, d)
    runs = table(spark, d, "events").select(
        F.lit("market").alias("vehicle_key"), F.col("event_type").alias("source"),
        F.to_date("ts").alias("_day")).distinct().select(
            "vehicle_key", "source", F.col("_day").cast("string").alias("run_id"),
            F.col("_day").cast("timestamp").alias("run_ts"))
    calendar = LC.run_calendar(runs, **limits)
    return LC.sightings(obs.drop("run_ts"), calendar), calendar


# --- listings: line items with their part --------------------------------------------------------

LISTING_COLUMNS = (
    "'run-1' as run_id",
    "p_brand as vehicle_key",
    "l_linestatus as source",
    "(l_partkey * 20000 + l_suppkey) * 1000 + cast(l_quantity as bigint) as source_record_index",
    "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as listing_id",
    "'https://listings.example/v-cars-trucks/' || lower(p_type) || '/'"
    " || cast(year(l_shipdate) + case when l_tax >= 0.075 then 1 else 0 end as string) || '/'"
    " || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as url",
    "cast(year(l_shipdate) as bigint) as year",
    "p_brand as make",
    "p_type as model",
    "p_name as trim",
    "cast(round(l_extendedprice) as bigint) as price",
    "cast(l_quantity as bigint) * 1000 + l_partkey % 1000 as mileage",
    "cast(p_size * 250 as string) as engine_cc",
    "case l_returnflag when 'A' then 'Diesel' when 'N' then 'Gas' else '' end as fuel",
    "'Dealer ' || cast(l_suppkey as string) as dealer",
    "case when l_suppkey % 5 = 0 then '' else 'City ' || cast(l_suppkey % 7 as string) end as location",
    "case when l_returnflag = 'R' and l_tax >= 0.075 and l_discount >= 0.05"
    " then '1FT' || lpad(cast(l_partkey as string), 14, '0') end as vin_claim",
)
LISTING_SQL = (
    "listing as (select " + ", ".join(LISTING_COLUMNS)
    + " from lineitem join part on l_partkey = p_partkey)"
)


def listings(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "lineitem")).join(
        table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(*LISTING_COLUMNS)


# Listing wording derived from the columns, so that the claim rules have text to read.
TEXT_COLUMN = """
trim || ' ' ||
case mileage % 5 when 0 then 'Crew Cab' when 1 then 'super cab' when 2 then 'Regular  cab' when 3 then 'SuperCrew' else '' end || ' ' ||
case price % 4 when 0 then '8ft box' when 1 then 'short bed' when 2 then '6.75 ft bed' else '' end || ' ' ||
case price % 3 when 0 then 'dually' when 1 then 'SRW' else '' end || ' ' ||
case mileage % 3 when 0 then '4x4' when 1 then 'rear-wheel drive' else '' end || ', ' ||
case when price % 5 < 3 then 'engine hours: ' || cast(mileage / 1000 as bigint) || ',' || lpad(cast(price % 1000 as string), 3, '0') else '' end || ' ' ||
case when price % 7 < 3 then cast(price % 900 as string) || ' idle hrs' else '' end || '; ' ||
case price % 6 when 0 then 'no service records' when 1 then 'Full service history' when 2 then 'dealer-maintained' else '' end || '; ' ||
case price % 9 when 0 then 'never used as a rental' when 1 then 'ex fleet, work truck' when 2 then 'one owner, towing' when 3 then 'commercially used' else '' end || '; ' ||
case mileage % 7 when 0 then '7 passenger' when 1 then '8-seater, roof rack' when 2 then 'fold flat, power sliding doors' else '' end || '; ' ||
case price % 11 when 0 then 'salvage title' when 1 then 'no accidents' when 2 then 'minor collision repaired' else '' end
"""
TEXT_SQL = (
    LISTING_SQL + ", ad as (select *, "
    + TEXT_COLUMN.replace("mileage / 1000", "mileage // 1000") + " as text from listing)"
)


def ads(spark: SparkSession, d: str) -> DataFrame:
    """Listings with their wording."""
    return listings(spark, d).selectExpr(
        "*", TEXT_COLUMN.replace("cast(mileage / 1000 as bigint)", "cast(floor(mileage / 1000) as bigint)")
        + " as text")


def ids() -> list[str]:
    """Columns that identify a listing row in query results."""
    return ["vehicle_key", "source", "source_record_index", "listing_id"]
