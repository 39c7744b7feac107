"""Scalar, routing and canonical-record queries over the listing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import listing as L
from marketlens.functions import text as T
from marketlens.functions.ids import stable_id
from marketlens.functions.numbers import straight_line_distance
from marketlens.operators import canonical as C
from marketlens.operators import extract as E
from marketlens.operators import health as H
from marketlens.operators import routing as RT
from marketlens.plans.bindings import CURRENT_YEAR, LISTING_SQL, TEXT_SQL, ads, ids, listings, table
from marketlens.plans.registry import query
from marketlens.session import settle, shared_path, small_side
from marketlens.sources import snapshots as SN

KEYS = "vehicle_key, source, source_record_index, listing_id"


# --- scalars ------------------------------------------------------------------------------------

@query("scalar_numbers", r"""
select event_id, try_cast(regexp_replace(props, '[^0-9-]', '', 'g') as bigint) as digits,
       nullif(try_cast(regexp_replace(props, '[^0-9-]', '', 'g') as bigint), 99) as digits_without_sentinel,
       try_cast(regexp_replace('-' || cast(value as varchar) || case when user_id % 3 = 0 then '.5' else ' km' end,
                               '[^0-9.-]', '', 'g') as double) as loose_number,
       try_cast(regexp_replace(cast(ts as date) || '', '[^0-9-]', '', 'g') as bigint) as date_digits,
       try_cast(regexp_replace(cast(user_id as varchar) || '.00', '[^0-9-]', '', 'g') as bigint) as dot_dropped
from events
""")
def scalar_numbers(spark: SparkSession, d: str) -> DataFrame:
    props = F.col("props")
    loose = F.concat(F.lit("-"), F.col("value").cast("string"),
                     F.when(F.col("user_id") % 3 == 0, F.lit(".5")).otherwise(F.lit(" km")))
    return table(spark, d, "events").select(
        "event_id", T.digits_int(props).alias("digits"),
        T.integer_without(props, [99]).alias("digits_without_sentinel"),
        T.loose_number(loose).alias("loose_number"),
        T.digits_int(F.to_date("ts").cast("string")).alias("date_digits"),
        T.digits_int(F.concat(F.col("user_id").cast("string"), F.lit(".00"))).alias("dot_dropped"))


@query("scalar_known_text", """
select c_custkey, case when lower(trim(c_mktsegment)) not in ('household', 'machinery') then trim(c_mktsegment) end as known_segment,
       case when lower(trim(c_mktsegment)) in ('household', 'machinery') then '' else trim(c_mktsegment) end as segment_or_empty,
       concat_ws(', ', nullif(case when c_mktsegment = 'FURNITURE' then '' else c_mktsegment end, ''), 'n' || c_nationkey) as joined
from customer
""")
def scalar_known_text(spark: SparkSession, d: str) -> DataFrame:
    segment = F.concat(F.lit("\t "), F.col("c_mktsegment"), F.lit(" \n"))
    tokens = ("household", "machinery")
    shown = F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("")).otherwise(F.col("c_mktsegment"))
    return table(spark, d, "customer").select(
        "c_custkey", T.known_text(segment, tokens).alias("known_segment"),
        T.text_or_empty(segment, tokens).alias("segment_or_empty"),
        T.join_known([shown, F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))]).alias("joined"))


@query("scalar_engine_text", """
select p_partkey,
       case when p_partkey % 17 = 0 then '6.7L'
            when p_size * 250 >= 100 then cast(round_even(p_size / 4.0, 1) as varchar) || 'L' end as engine,
       p_name || ' V8' as plain
from part
""")
def scalar_engine_text(spark: SparkSession, d: str) -> DataFrame:
    cc = F.when(F.col("p_partkey") % 17 == 0, F.lit("6,700 cc")) \
        .otherwise(F.concat((F.col("p_size") * 250).cast("string"), F.lit(" cc")))
    return table(spark, d, "part").select(
        "p_partkey", T.engine_text(cc).alias("engine"),
        T.engine_text(F.concat("p_name", F.lit(" V8"))).alias("plain"))


@query("stable_ids", f"""
with {LISTING_SQL}
select {KEYS}, 'listing_' || sha256(concat_ws(chr(31), vehicle_key, source, listing_id))[1:24] as canonical_listing_id,
       'place_' || sha256(vehicle_key || chr(31) || coalesce(vin_claim, '') || chr(31) || fuel)[1:24] as null_safe_id
from listing
""")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select(
        *ids(),
        stable_id("listing", F.col("vehicle_key"), F.col("source"), F.col("listing_id"))
        .alias("canonical_listing_id"),
        stable_id("place", F.col("vehicle_key"), F.col("vin_claim"), F.col("fuel")).alias("null_safe_id"))


@query("keyword_tiers", """
select p_partkey, case when contains(p_name, 'gear') or contains(p_name, 'ring') then 3
                       when contains(p_name, 'red') then 2 else 1 end as trim_tier,
       case when contains(p_name, 'gear') then 'GEAR' when contains(p_name, 'ring') then 'Ring'
            when contains(p_name, 'red') then 'red' when contains(p_name, 'small') then 'Small' else 'Unknown' end as trim_name
from part
""")
def keyword_tiers(spark: SparkSession, d: str) -> DataFrame:
    t1, t2, t3 = (F.array(*map(F.lit, words)) for words in (["Small"], ["red"], ["GEAR", "Ring"]))
    return table(spark, d, "part").select(
        "p_partkey", L.tier_of(F.col("p_name"), t2, t3).alias("trim_tier"),
        L.tier_name(F.col("p_name"), t1, t2, t3).alias("trim_name"))


@query("accident_claims", f"""
with {TEXT_SQL}
select {KEYS}, case when contains(lower(text), 'salvage') then 'Salvage/rebuilt'
                    when contains(lower(text), 'no accident') then 'No accidents reported'
                    when contains(lower(text), 'accident') or contains(lower(text), 'collision') then 'Accident reported'
                    else 'Unknown' end as accident_claim
from ad
""")
def accident_claims(spark: SparkSession, d: str) -> DataFrame:
    return ads(spark, d).select(*ids(), L.accident_claim(F.col("text")).alias("accident_claim"))


@query("fuel_and_displacement", f"""
with {LISTING_SQL}
select {KEYS}, case when fuel <> '' then fuel when contains(lower(trim), 'hot') then 'Hybrid' else 'Unknown' end as fuel_claim,
       case when price % 2 = 0 then (mileage % 9 + 1) || '.' || (price % 10) || 'L' else 'Unknown' end as displacement
from listing
""")
def fuel_and_displacement(spark: SparkSession, d: str) -> DataFrame:
    size = F.concat((F.col("mileage") % 9 + 1).cast("string"), F.lit("."),
                    (F.col("price") % 10).cast("string"), F.lit(" Litre"))
    text = F.concat_ws(" ", F.replace("trim", F.lit("hot"), F.lit("hybrid")),
                       F.when(F.col("price") % 2 == 0, size))
    parts = F.when(F.col("fuel") != "", F.array("fuel", F.lit("V8 turbo"))).otherwise(
        F.array(F.lit("V8 turbo")))
    return listings(spark, d).select(
        *ids(), L.fuel_claim(parts, text).alias("fuel_claim"),
        L.displacement_claim(parts, text).alias("displacement"))


@query("url_region_hints", f"""
with {LISTING_SQL}
select {KEYS}, split_part(url, '/', 5) as url_region_hint from listing
""")
def url_region_hints(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select(*ids(), L.url_region(F.col("url"), "v-cars-trucks").alias("url_region_hint"))


#: geo (key, km) of geo_points (key, hlat, hlon, lat, lon): the inverse steps by recursion; numbers of the ellipsoid as in geodesic_km.
_SPHERE_SQL = """(select *, 1 - sa * sa as q, atan2(ss, cs) as sg from (select *, case when ss = 0 then 0 else cos(u1) * cos(u2) * sin(lam) / ss end as sa
      from (select *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) as ss,
                   sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) as cs from geo_steps where {0})))"""
GEODESIC_SQL = f"""
geo_ellipsoid as (select 1 / 298.257223563 as f, 6378.137 as a, 6378.137 * (1 - 1 / 298.257223563) as b),
geo_start as (select key, f, a, b, radians(lon - hlon) as l, atan((1 - f) * tan(radians(hlat))) as u1, atan((1 - f) * tan(radians(lat))) as u2
  from geo_points, geo_ellipsoid where lat is not null),
geo_steps as (
  select *, 0 as n, l as lam from geo_start
  union all
  select key, f, a, b, l, u1, u2, n + 1, l + (1 - cc) * f * sa * (sg + cc * ss * (m + cc * cs * (2 * m * m - 1)))
  from (select *, f / 16 * q * (4 + f * (4 - 3 * q)) as cc, case when q < 1e-15 then 0 else cs - 2 * sin(u1) * sin(u2) / q end as m
    from {_SPHERE_SQL.format("n < 20")})),
geo as (
  select key, b * aa * (sg - bb * ss * (m + bb / 4 * (cs * (2 * m * m - 1) - bb / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))) as km
  from (select *, uu / 1024 * (256 + uu * (uu * (74 - 47 * uu) - 128)) as bb, 1 + uu / 16384 * (4096 + uu * (uu * (320 - 175 * uu) - 768)) as aa
    from (select *, q * (a * a - b * b) / (b * b) as uu, case when q < 1e-15 then 0 else cs - 2 * sin(u1) * sin(u2) / q end as m
      from {_SPHERE_SQL.format("n = 20")})))
"""


@query("straight_line_distance", f"""
with recursive geo_points as (select c_custkey as key, 43.65 as hlat, -79.38 as hlon, case when c_nationkey % 4 > 0 then 40 + c_nationkey * 0.31 end as lat,
             case when c_nationkey % 4 > 0 then -80 + c_acctbal / 1000 end as lon from customer),
{GEODESIC_SQL}
select p.key as c_custkey, cast(round_even(km, 0) as bigint) as distance_km,
       case when p.lat is null then 'unavailable' else 'geodesic_city_center' end as method,
       case when p.lat is null then 'location_or_geocode_unavailable'
            else 'straight_line_estimate_from_source_reported_location' end as evidence_status
from geo_points p left join geo using (key)
""")
def straight_line_distances(spark: SparkSession, d: str) -> DataFrame:
    located = F.col("c_nationkey") % 4 > 0
    lat = F.when(located, 40 + F.col("c_nationkey") * 0.31)
    lon = F.when(located, -80 + F.col("c_acctbal") / 1000)
    unknown = F.lit(None).cast("double")
    return table(spark, d, "customer").select("c_custkey", straight_line_distance(
        F.lit(43.65), F.lit(-79.38), unknown, unknown, lat, lon).alias("x")).select("c_custkey", "x.*")


WARNINGS_SQL = f"""
with {LISTING_SQL},
w as (
  select *, concat_ws(';',
    case when source = 'O' then 'o_location_unknown' end,
    case when regexp_extract(url, '/((19|20)[0-9][0-9])/', 1) <> cast(year as varchar)
      -- a four-digit order number may look like a second, different year
      and not (regexp_matches(listing_id, '^(19[89][0-9]|200[0-4])-')
               and listing_id[1:4] <> regexp_extract(url, '/((19|20)[0-9][0-9])/', 1))
      then 'url_year_conflicts_with_parsed_year' end,
    case when mileage <= 1100 and year <= 2001 then 'suspiciously_low_mileage' end,
    case when mileage >= 50900 then 'mileage_unknown' end) as warnings
  from listing)
"""


def _warned(spark: SparkSession, d: str) -> DataFrame:
    """Mileage is scaled so that both mileage rules have hits."""
    km = F.when(F.col("mileage") <= 1100, F.lit(100)).when(F.col("mileage") >= 50900, F.lit(999999)) \
        .otherwise(F.col("mileage"))
    return listings(spark, d).withColumn("quality_warnings", L.quality_warnings(
        source=F.col("source"), year=F.col("year"), mileage=km,
        url=F.regexp_replace("url", r"-\d+$", ""),
        current_year=CURRENT_YEAR, location_status=F.lit(None).cast("string"),
        quarantined=F.col("source") == "O"))


@query("quality_warnings", WARNINGS_SQL
+ f"select {KEYS}, warnings from w")
def quality_warnings(spark: SparkSession, d: str) -> DataFrame:
    return _warned(spark, d).select(*ids(), F.array_join("quality_warnings", ";").alias("warnings"))


@query("quality_rollup", WARNINGS_SQL + """
select vehicle_key, source, count(*) filter (warnings <> '') as quality_warning_rows,
       cast(sum(case when warnings = '' then 0 else len(string_split(warnings, ';')) end) as bigint) as quality_warning_count,
       case when count(*) filter (warnings <> '') > 0 then 'warnings_present' else 'clean' end as data_quality_status
from w group by all
""")
def quality_rollup(spark: SparkSession, d: str) -> DataFrame:
    return H.quality_rollup(_warned(spark, d), ["vehicle_key", "source"])


@query("quality_codes", WARNINGS_SQL + """
select source, code, count(*) as warning_count
from (select source, unnest(string_split(warnings, ';')) as code from w where warnings <> '') group by all
""")
def quality_codes(spark: SparkSession, d: str) -> DataFrame:
    return H.quality_codes(_warned(spark, d), ["source"])


@query("identity_tokens", """
select p_partkey, trim(regexp_replace(lower(p_type || '/' || p_name), '[^a-z0-9]+', ' ', 'g')) as tokens,
       array_to_string(list_sort(list_distinct(list_filter(string_split(
         trim(regexp_replace(lower(p_name || ' and ' || p_type || ' X the'), '[^a-z0-9]+', ' ', 'g')), ' '),
         lambda w: len(w) > 1 and w not in ('the', 'and', 'with')))), ',') as trim_tokens
from part
""")
def identity_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        "p_partkey", T.tokens_text(F.concat_ws("/", "p_type", "p_name")).alias("tokens"),
        F.array_join(T.trim_tokens(F.concat("p_name", F.lit(" and "), "p_type", F.lit(" X the"))), ",")
        .alias("trim_tokens"))


# --- page payloads and routing --------------------------------------------------------------------

def _criteria(fuel: str = "diesel") -> Column:
    return F.struct(
        F.lit(1996).alias("min_year"), F.lit(2000).alias("max_year"),
        F.lit(90000).alias("max_price_cad"), F.lit(fuel).alias("fuel"), F.lit("").alias("engine"),
        F.lit(400).alias("max_distance_km"), F.lit(43.65).alias("home_lat"), F.lit(-79.38).alias("home_lon"))


def _dimensions(df: DataFrame) -> DataFrame:
    words = {"dim_tier1": ["small"], "dim_tier2": ["red"], "dim_tier3": ["gear", "ring"]}
    return df.withColumns({
        **{k: F.array(*map(F.lit, v)) for k, v in words.items()},
        "dim_make": F.lit("Configured make"), "dim_model": F.lit("Configured model"),
        "criteria": _criteria(),
    })


def state_pages(spark: SparkSession, d: str) -> DataFrame:
    """One page per listing with the listing in its embedded state; some payloads are broken."""
    r = ads(spark, d)
    price = F.when(F.col("price") % 50 == 0, F.lit("call")).otherwise(
        F.concat(F.lit("$"), F.format_number("price", 0)))
    vehicle = F.when(F.col("price") % 97 != 0, F.struct(
        F.col("year").cast("string").alias("modelYear"), F.col("make"), F.col("model"),
        F.col("trim").alias("modelVersionInput"),
        F.concat(F.col("mileage").cast("string"), F.lit(" km")).alias("mileageInKm"), "fuel",
        F.col("engine_cc").alias("engineDisplacementInCCM")))
    listing = F.struct(
        F.col("listing_id").alias("id"), F.col("url"), F.lit("as seen").alias("description"),
        F.struct(price.alias("priceFormatted")).alias("price"), vehicle.alias("vehicle"),
        F.array(F.struct(F.col("text").alias("data"))).alias("vehicleDetails"),
        F.struct(F.col("location").alias("city"), F.lit("ON").alias("provinceCode")).alias("location"),
        F.struct(F.col("dealer").alias("companyName")).alias("seller"))
    state = F.to_json(F.struct(F.struct(F.struct(
        F.array(listing).alias("listings"),
        F.struct((F.col("price") % 500).alias("total")).alias("pagination")).alias("pageProps")).alias("props")))
    html = F.concat(
        F.lit('<html><head><title>x</title><script>var a = {"listings": broken</script></head><body>'
              '<script id="__NEXT_DATA__" type="application/json">'), state,
        F.lit("</script></body></html>"))
    return r.select("run_id", "vehicle_key", "source", "source_record_index", html.alias("html"))


def structured_pages(spark: SparkSession, d: str) -> DataFrame:
    """One page per listing as JSON-LD (item list, graph or bare object), after a broken script."""
    r = ads(spark, d)
    shape = F.col("price") % 3
    listing = F.struct(
        F.when(shape == 0, F.lit("Car")).otherwise(F.lit("Vehicle")).alias("@type"),
        F.when(F.col("mileage") % 4 > 0, F.col("listing_id")).alias("sku"),
        F.concat("year", F.lit(" "), "make", F.lit(" "), "trim").alias("name"),
        F.col("text").alias("description"), F.col("url"),
        F.when(F.col("price") % 2 == 0, F.col("year").cast("string")).alias("vehicleModelDate"),
        F.struct(F.col("mileage").cast("string").alias("value")).alias("mileageFromOdometer"),
        F.struct(F.col("make").alias("name")).alias("manufacturer"), F.col("model"),
        F.struct(F.col("fuel").alias("fuelType")).alias("vehicleEngine"),
        F.struct(
            F.when(F.col("price") % 50 == 0, F.lit("ask")).otherwise(F.col("price").cast("string")).alias("price"),
            F.struct(F.struct(F.col("location").alias("addressLocality")).alias("address"))
            .alias("availableAtOrFrom")).alias("offers"),
        F.struct(F.col("dealer").alias("name")).alias("seller"))
    body = F.to_json(listing)
    wrapped = (
        F.when(shape == 0, body)
        .when(shape == 1, F.concat(F.lit('{"@type":"ItemList","itemListElement":[{"item":'), body, F.lit("}]}")))
        .otherwise(F.concat(F.lit('[{"@type":"WebPage","@graph":['), body, F.lit("]}]")))
    )
    html = F.concat(F.lit('<html><script type="application/ld+json">{broken</script>'
                          '<script type="application/ld+json">'), wrapped, F.lit("</script></html>"))
    return r.select("run_id", "vehicle_key", "source", "source_record_index", html.alias("html"))


def _located(parsed: DataFrame) -> DataFrame:
    """City coordinates from the city number of the parsed location."""
    n = F.regexp_extract("parsed_row.location", r"City (\d+)", 1).try_cast("double")
    none = F.lit(None).cast("double")
    return parsed.withColumn("place", F.struct(
        none.alias("address_lat"), none.alias("address_lon"),
        (43 + n * 0.5).alias("city_lat"), (-79 - n * 0.7).alias("city_lon")))


def state_routed(spark: SparkSession, d: str) -> DataFrame:
    items = E.explode_listings(E.state_payload(state_pages(spark, d)))
    parsed = _located(RT.parse_state_listing(_dimensions(items)))
    row, criteria = F.col("parsed_row"), F.col("criteria")
    distance = RT.listing_distance(criteria, F.col("place"))
    parsed = parsed.withColumn("distance_km", distance["distance_km"])
    reasons = F.when(row.isNotNull(), RT.rejection_reasons(
        row, criteria, unknown_word="", distance_km=F.col("distance_km"))) \
        .otherwise(F.array().cast("array<string>"))
    ready = parsed.select(
        *RT.RUN_KEYS, "source_record_index", "parsed_row", "parse_failure_reasons", "distance_km",
        reasons.alias("rejection_reasons"), "is_object", F.col("source_identity").alias("identity"))
    return RT.route_before_parsing(settle(ready))


def structured_routed(spark: SparkSession, d: str) -> DataFrame:
    items = E.explode_listings(E.structured_payload(structured_pages(spark, d), keep=[*RT.RUN_KEYS, "source_record_index"]))
    parsed = RT.parse_structured_listing(_dimensions(items))
    row = F.col("parsed_row")
    reasons = F.when(row.isNotNull(), RT.rejection_reasons(
        row, F.col("criteria"), unknown_word="Unknown")).otherwise(F.array().cast("array<string>"))
    ready = parsed.select(
        *RT.RUN_KEYS, "source_record_index", "parsed_row", "parse_failure_reasons",
        reasons.alias("rejection_reasons"),
        F.coalesce(F.nullif(row["listing_id"], F.lit("")), row["url"]).alias("identity"))
    return RT.route_after_parsing(settle(ready))


STATE_SQL = f"""
with recursive {TEXT_SQL},
e as (
  select *, try_cast(nullif(replace(location, 'City ', ''), '') as double) as city,
         min(source_record_index) over (partition by vehicle_key, source, listing_id) as first_index
  from ad),
geo_points as (select distinct city as key, 43.65 as hlat, -79.38 as hlon, 43 + city * 0.5 as lat, -79 - city * 0.7 as lon from e),
{GEODESIC_SQL},
f as (
  select e.*, cast(round_even(km, 0) as bigint) as distance_km,
         case when price % 97 = 0 then 'missing_vehicle_object' when price % 50 = 0 then 'invalid_price' else '' end as failure
  from e left join geo on city = key),
g as (
  select *, case when source_record_index > first_index then 'duplicate_source_listing_identity'
    when failure <> '' then '' else concat_ws(';',
    case when distance_km > 400 then 'distance_out_of_range' end,
    case when distance_km is null then 'distance_unavailable' end,
    case when fuel = 'Gas' then 'fuel_mismatch' when fuel = '' then 'fuel_unknown' end,
    case when price > 90000 or price <= 0 then 'price_out_of_range' end,
    case when year < 1996 or year > 2000 then 'year_out_of_range' end) end as rejections
  from f),
routed as (
  select *, case when source_record_index > first_index then 'rejected'
                 when failure <> '' then 'parse_failure'
                 when rejections <> '' then 'rejected' else 'accepted' end as record_stage from g)
"""


@query("page_state_rows", f"""
with {TEXT_SQL}
select vehicle_key, source, source_record_index, listing_id,
       case when price % 97 = 0 or price % 50 = 0 then null else year end as year,
       case when price % 97 = 0 or price % 50 = 0 then null else price end as price,
       case when price % 97 = 0 or price % 50 = 0 then null else mileage end as mileage,
       case when price % 97 = 0 or price % 50 = 0 then null
            else cast(round_even(cast(engine_cc as bigint) / 1000, 1) as varchar) || 'L' end as engine,
       price % 500 as reported_total,
       case when price % 97 = 0 then 'missing_vehicle_object' when price % 50 = 0 then 'invalid_price' else '' end as failures
from ad
""")
def page_state_rows(spark: SparkSession, d: str) -> DataFrame:
    items = E.explode_listings(E.state_payload(state_pages(spark, d)))
    parsed = RT.parse_state_listing(_dimensions(items))
    return parsed.select(
        "vehicle_key", "source", "source_record_index",
        F.col("source_identity").alias("listing_id"), "parsed_row.year", "parsed_row.price", "parsed_row.mileage", "parsed_row.engine",
        "reported_total", F.array_join("parse_failure_reasons", ";").alias("failures"))


@query("structured_page_rows", f"""
with {TEXT_SQL}
select vehicle_key, source, source_record_index,
       case when price % 50 > 0 then case when mileage % 4 > 0 then listing_id else split_part(url, '/', 6) end end as listing_id,
       case when price % 50 > 0 then year end as year, case when price % 50 > 0 then price end as price,
       case when price % 50 > 0 then mileage end as mileage,
       case when price % 50 > 0 then case when fuel = '' then 'Unknown' else fuel end end as fuel,
       case when price % 50 > 0 then location end as location,
       case when price % 50 > 0 then split_part(url, '/', 5) end as url_region_hint,
       'invalid_json_ld_script:0' as page_errors,
       case when price % 50 = 0 then 'invalid_price' else '' end as failures
from ad
""")
def structured_page_rows(spark: SparkSession, d: str) -> DataFrame:
    items = E.explode_listings(E.structured_payload(structured_pages(spark, d), keep=[*RT.RUN_KEYS, "source_record_index"]))
    parsed = RT.parse_structured_listing(_dimensions(items))
    return parsed.select(
        "vehicle_key", "source", "source_record_index", "parsed_row.listing_id", "parsed_row.year",
        "parsed_row.price", "parsed_row.mileage", "parsed_row.fuel", "parsed_row.location",
        "parsed_row.url_region_hint", F.array_join("page_errors", ";").alias("page_errors"),
        F.array_join("parse_failure_reasons", ";").alias("failures"))


@query("route_before_parsing", STATE_SQL + f"""
select {KEYS}, record_stage, rejections,
       case when record_stage = 'parse_failure' then failure else '' end as failures, distance_km_shown as distance_km,
       case when source_record_index > first_index then first_index end as duplicate_of
from (select *, case when failure = '' then distance_km end as distance_km_shown from routed)
""")
def route_before_parsing(spark: SparkSession, d: str) -> DataFrame:
    return state_routed(spark, d).select(
        "vehicle_key", "source", "source_record_index", F.col("identity").alias("listing_id"),
        "record_stage", F.array_join("rejection_reasons", ";").alias("rejections"),
        F.array_join("parse_failure_reasons", ";").alias("failures"), "distance_km",
        F.col("duplicate_of_source_record_index").alias("duplicate_of"))


@query("route_after_parsing", f"""
with {TEXT_SQL},
k as (select *, case when mileage % 4 > 0 then listing_id else split_part(url, '/', 6) end as identity from ad),
m as (
  select *, price % 50 = 0 as failed,
         min(case when price % 50 > 0 then source_record_index end) over (partition by vehicle_key, source, identity) as first_index
  from k)
select vehicle_key, source, source_record_index,
       case when failed then 'parse_failure' when rejections <> '' then 'rejected' else 'accepted' end as record_stage,
       rejections
from (select *, case when failed then '' else concat_ws(';',
         case when source_record_index > first_index then 'duplicate_source_listing_identity' end,
         case when fuel = 'Gas' then 'fuel_mismatch' when fuel = '' then 'fuel_unknown' end,
         case when price > 90000 or price <= 0 then 'price_out_of_range' end,
         case when year < 1996 or year > 2000 then 'year_out_of_range' end) end as rejections from m)
""")
def route_after_parsing(spark: SparkSession, d: str) -> DataFrame:
    return structured_routed(spark, d).select(
        "vehicle_key", "source", "source_record_index", "record_stage",
        F.array_join("rejection_reasons", ";").alias("rejections"))


@query("stage_counts", STATE_SQL + """
select 'run-1' as run_id, vehicle_key, source, count(*) as fetched_records,
       count(*) filter (record_stage = 'accepted') as accepted_records,
       count(*) filter (record_stage = 'rejected') as rejected_records,
       count(*) filter (record_stage = 'parse_failure') as parse_failures,
       count(*) filter (source_record_index > first_index) as duplicate_records, true as reconciled
from routed group by all
""")
def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    return RT.stage_counts(state_routed(spark, d))


@query("accepted_in_order", STATE_SQL + """
select vehicle_key, source, listing_id, year, price, mileage from routed where record_stage = 'accepted'
""")
def accepted_in_order(spark: SparkSession, d: str) -> DataFrame:
    flat = state_routed(spark, d).select("vehicle_key", "source", "record_stage", "parsed_row.*")
    return RT.accepted_in_order(flat).select("vehicle_key", "source", "listing_id", "year", "price", "mileage")


# --- canonical records ------------------------------------------------------------------------------

SNAPSHOT_FIELDS = {
    "listing_id": "case when price % 31 = 0 then ' N/A ' else listing_id end",
    "url": "case when price % 37 = 0 then '' else url end",
    "source": "''", "year": "cast(year as string)", "make": "make", "model": "model", "trim": "trim",
    "trim_tier": "'2'", "price": "'$' || cast(price as string)",
    "mileage": "case when mileage % 41 = 0 then '999999' else cast(mileage as string) || ' km' end",
    "engine": "engine_cc", "fuel": "case when fuel = '' then 'unknown' else fuel end",
    "accident_flag": "'Unknown'", "days_on_market": "''", "dealer": "dealer", "seller_type": "'Dealer'",
    "dealer_address": "location", "location": "location",
    "distance_km": "cast(price % 300 as string) || ' km'", "distance_method": "'route_api_address'",
    "url_region_hint": "model", "url_region_status": "'unavailable'", "weeks_tracked": "'3'",
    "price_first_seen": "cast(price + 100 as string)", "price_last_week": "cast(price + 50 as string)",
    "price_change_week": "'-50'", "price_change_total": "'-100'", "price_history": "'none'", "trend": "''",
}


def snapshot(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Listings as all-string snapshot rows; 'O' is a source whose geography is quarantined."""
    row = F.struct(*[F.expr(e).alias(n) for n, e in SNAPSHOT_FIELDS.items()])
    return listings(spark, d).select(
        *RT.RUN_KEYS, "source_record_index", row.alias("row"),
        (F.col("price") % 43 == 0).alias("malformed"), (F.col("source") == "O").alias("quarantined"), *more)


CANONICAL_SQL = f"""
with {LISTING_SQL},
s as (
  select *, price % 43 = 0 as malformed,
         case when price % 31 = 0 then null else listing_id end as lid,
         case when price % 37 = 0 then null else url end as u from listing),
c as (
  select *, case when malformed then null else 'listing_' || sha256(concat_ws(chr(31), vehicle_key, source,
              coalesce(lid, u, 'row-' || source_record_index)))[1:24] end as canonical_listing_id,
         case when malformed then 'parse_failure' when lid is null or u is null then 'rejected' else 'accepted' end as record_stage
  from s)
"""


@query("canonical_records", CANONICAL_SQL + """
select vehicle_key, source, source_record_index, record_stage, canonical_listing_id,
       case when not malformed then 'observation_' || sha256(concat_ws(chr(31), canonical_listing_id, 'run-1', source_record_index))[1:24] end as observation_id,
       case when not malformed then year end as year, case when not malformed then price end as price_cad,
       case when not malformed and mileage % 41 > 0 then mileage end as mileage_km,
       case when not malformed then nullif(fuel, '') end as fuel,
       case when not malformed and source = 'F' then nullif(location, '') end as location,
       case when not malformed and source = 'F' then cast(price % 300 as double) end as distance_km,
       case when malformed then '' else concat_ws(';', case when lid is null then 'missing_source_listing_id' end,
            case when u is null then 'missing_listing_url' end) end as rejections,
       case when malformed then 'malformed_column_count' else '' end as failures,
       'raw#record=' || source_record_index as raw_record_ref
from c
""")
def canonical_records(spark: SparkSession, d: str) -> DataFrame:
    shown = ["year", "price_cad", "mileage_km", "fuel", "location", "distance_km"]
    out = C.canonical_records(snapshot(spark, d), current_year=CURRENT_YEAR, fields=shown)
    return out.select(
        "vehicle_key", "source", "source_record_index", "record_stage", "canonical_listing_id", "observation_id", *shown,
        F.array_join("rejection_reasons", ";").alias("rejections"),
        F.array_join("parse_failure_reasons", ";").alias("failures"), "raw_record_ref")


@query("field_evidence", CANONICAL_SQL + """
, fields as (
  select vehicle_key, source, source_record_index, unnest([
    {'field': 'mileage_km', 'raw': case when mileage % 41 = 0 then '999999' else mileage || ' km' end,
     'norm': case when mileage % 41 > 0 then cast(mileage as varchar) end,
     'status': case when mileage % 41 > 0 then 'source_reported_unverified' else 'unknown' end},
    {'field': 'location', 'raw': location, 'norm': case when source = 'F' then nullif(location, '') end,
     'status': case when location = '' then 'unknown' when source = 'O' then 'quarantined_unverified_search_origin'
                    else 'source_reported_not_independently_verified' end},
    {'field': 'fuel', 'raw': case when fuel = '' then 'unknown' else fuel end, 'norm': nullif(fuel, ''),
     'status': case when fuel = '' then 'unknown' else 'source_reported_or_inferred_unverified' end}]) as e
  from c where not malformed)
select vehicle_key, source, source_record_index, e.field as field, e.raw as raw_value, e.norm as normalized_value,
       e.status as evidence_status from fields
""")
def field_evidence(spark: SparkSession, d: str) -> DataFrame:
    out = C.canonical_records(snapshot(spark, d), current_year=CURRENT_YEAR)
    shown = ["mileage_km", "location", "fuel"]
    # The outer form infers no test of the map, which would be moved below and build it again; parse failures have none.
    return out.select(
        "vehicle_key", "source", "source_record_index",
        F.explode_outer(F.map_filter("field_evidence", lambda k, v: k.isin(*shown))).alias("field", "e"),
    ).where("field is not null").select("vehicle_key", "source", "source_record_index", "field", "e.raw_value",
             "e.normalized_value", "e.evidence_status")


@query("canonical_reconciliation", CANONICAL_SQL + """
select 'run-1' as run_id, vehicle_key, source, count(*) as fetched_records,
       count(*) filter (record_stage <> 'parse_failure') as normalized_records,
       count(*) filter (record_stage = 'accepted') as accepted_records,
       count(*) filter (record_stage = 'rejected') as rejected_records,
       count(*) filter (record_stage = 'parse_failure') as parse_failures, true as reconciled
from c group by all
""")
def canonical_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    return C.reconcile(C.canonical_records(snapshot(spark, d), current_year=CURRENT_YEAR))


def snapshot_files(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """Snapshot rows as CSV files of the shared folder, one per vehicle and source, with line ends in quoted fields; and what each file is.

    A malformed row has a cell beyond the header.
    """
    keys = [*RT.RUN_KEYS, "quarantined"]
    rows = snapshot(spark, d, "listing_id").withColumn("row", F.col("row").withField("dealer", F.concat(F.col("row.dealer"), F.lit('\n"branch", 2\n'))))
    line = F.concat(F.to_csv("row", {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}),
                    F.when(F.col("malformed"), F.lit(",beyond")).otherwise(F.lit("")))
    named = rows.select(*keys, F.md5(F.concat_ws("/", "vehicle_key", "source").cast("binary")).alias("snapshot"), F.struct(F.col("source_record_index").cast("bigint").alias("i"), "listing_id").alias("place"), line.alias("value"))
    about = small_side(named.select("snapshot", *keys).distinct())  # reads the keys again; the texts are written once, as files
    header = about.select("snapshot", F.struct(F.lit(-1).cast("bigint").alias("i"), F.lit("").alias("listing_id")).alias("place"), F.lit(",".join(SNAPSHOT_FIELDS)).alias("value"))
    path = shared_path(spark, "snapshots")
    named.select("snapshot", "place", "value").union(header).repartition("snapshot").sortWithinPartitions("snapshot", "place").drop("place").write.partitionBy("snapshot").text(path)
    return path, about


@query("snapshot_file_stages", CANONICAL_SQL + """
, f as (select *, row_number() over (partition by vehicle_key, source order by source_record_index, listing_id) - 1 as place from c),
g as (select *, case when malformed then null else 'listing_' || sha256(concat_ws(chr(31), vehicle_key, source, coalesce(lid, u, 'row-' || place)))[1:24] end as id from f)
select vehicle_key, source, place as source_record_index, record_stage, id as canonical_listing_id,
       case when not malformed then price end as price_cad, case when malformed then 'malformed_column_count' else '' end as failures,
       'raw#record=' || place as raw_record_ref
from g
""")
def snapshot_file_stages(spark: SparkSession, d: str) -> DataFrame:
    """From snapshot files to canonical stages: records get their number in the file, reader faults are counted rows."""
    path, about = snapshot_files(spark, d)
    read = SN.read_numbered_snapshots(spark, path, list(SNAPSHOT_FIELDS)).withColumn("snapshot", F.regexp_extract("file", "snapshot=([0-9a-f]+)", 1))
    out = C.canonical_records(read.join(about, "snapshot").drop("snapshot", "file"), current_year=CURRENT_YEAR, fields=["price_cad"])
    return out.select(
        "vehicle_key", "source", "source_record_index", "record_stage", "canonical_listing_id", "price_cad",
        F.array_join("parse_failure_reasons", ";").alias("failures"), "raw_record_ref")


@query("adapter_faults", CANONICAL_SQL + """
, seen as (select vehicle_key, source, count(*) as n, count(distinct source_record_index) as k, min(source_record_index) as lo, max(source_record_index) as hi
  from c where price % 97 > 0 group by all),
told as (select vehicle_key, source, count(*) as fetched, sum(price) % 3 > 0 as balanced from c group by all having sum(price) % 5 > 0),
j as (select coalesce(s.vehicle_key, t.vehicle_key) as vehicle_key, coalesce(s.source, t.source) as source, fetched, balanced, coalesce(n, 0) as n, k, lo, hi
  from told t full join seen s on t.vehicle_key = s.vehicle_key and t.source = s.source)
select vehicle_key, source, unnest(list_filter([case when fetched is null then 'adapter_report_missing' end, case when fetched <> n then 'fetched_count_mismatch' end,
  case when k <> n or lo <> 0 or hi <> n - 1 then 'record_index_discontinuity' end,
  case when fetched is not null and not balanced then 'not_reconciled' end], lambda x: x is not null)) as fault
from j
""")
def adapter_faults(spark: SparkSession, d: str) -> DataFrame:
    """Adapter reports against records of which some are lost on the way."""
    rows = snapshot(spark, d).select(*RT.RUN_KEYS, "source_record_index", F.regexp_replace("row.price", "[$]", "").cast("bigint").alias("p"))
    total = F.sum("p")
    reports = rows.groupBy(*RT.RUN_KEYS).agg(F.count("*").alias("fetched_records"), (total % 3 > 0).alias("reconciled"), (total % 5 > 0).alias("told"))
    return C.adapter_faults(rows.where("p % 97 > 0"), reports.where("told").drop("told")).drop("run_id")


def adapter_canonical(routed: DataFrame) -> DataFrame:
    """Routed listing objects as canonical records."""
    r = F.col("parsed_row")
    km = F.col("distance_km").cast("string")
    text = {n: r[n].cast("string") for n in (
        "listing_id", "url", "year", "make", "model", "trim", "trim_tier", "price", "mileage", "engine",
        "fuel", "accident_flag", "dealer", "seller_type", "dealer_address", "location",
        "url_region_hint", "price_history")}
    blank = ("source", "days_on_market", "url_region_status", "weeks_tracked", "price_first_seen",
             "price_last_week", "price_change_week", "price_change_total", "trend",
             "location_evidence_status", "dealer_address_evidence_status")
    row = F.struct(
        *[c.alias(n) for n, c in text.items()], *[F.lit("").alias(n) for n in blank],
        km.alias("distance_km"),
        F.when(km.isNull(), F.lit("unavailable")).otherwise(F.lit("geodesic_city_center")).alias("distance_method"),
        F.when(km.isNull(), F.lit("location_or_geocode_unavailable"))
        .otherwise(F.lit("straight_line_estimate_from_source_reported_location"))
        .alias("distance_evidence_status"))
    repeat = F.col("duplicate_of_source_record_index").isNotNull()
    return C.from_adapter(routed.select(
        *RT.RUN_KEYS, "source_record_index", F.when(r.isNotNull() & ~repeat, row).alias("row"),
        "record_stage", "rejection_reasons", "parse_failure_reasons",
        F.col("identity").alias("raw_identifier"), F.lit(False).alias("listing_geography"),
    ), current_year=CURRENT_YEAR)


@query("adapter_canonical_records", STATE_SQL + f"""
select {KEYS.replace(", listing_id", "")}, record_stage,
       case when record_stage <> 'parse_failure' and source_record_index = first_index then
         'listing_' || sha256(concat_ws(chr(31), vehicle_key, source, listing_id))[1:24] end as canonical_listing_id,
       rejections,
       case when record_stage <> 'parse_failure' and source_record_index = first_index then
         case when distance_km is null then 'location_or_geocode_unavailable'
              else 'straight_line_estimate_from_source_reported_location' end end as distance_status
from routed
""")
def adapter_canonical_records(spark: SparkSession, d: str) -> DataFrame:
    return adapter_canonical(state_routed(spark, d)).select(
        "vehicle_key", "source", "source_record_index", "record_stage", "canonical_listing_id",
        F.array_join("rejection_reasons", ";").alias("rejections"),
        F.try_element_at("field_evidence", F.lit("distance_km"))["evidence_status"].alias("distance_status"))


@query("adapter_reconciliation", STATE_SQL + """
select 'run-1' as run_id, vehicle_key, source, count(*) as fetched_records,
       count(*) filter (record_stage <> 'parse_failure') as normalized_records,
       count(*) filter (record_stage = 'accepted') as accepted_records,
       count(*) filter (record_stage = 'rejected') as rejected_records,
       count(*) filter (record_stage = 'parse_failure') as parse_failures, true as reconciled
from routed group by all
""")
def adapter_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    routed = settle(state_routed(spark, d))
    return C.reconcile(adapter_canonical(routed), RT.stage_counts(routed))
