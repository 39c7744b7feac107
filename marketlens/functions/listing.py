"""Listing-level expressions: tiers, accident wording, fuel, geography, identifiers, warnings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.functions.payload import get_text
from marketlens.functions.text import (
    MILEAGE_SENTINEL, codes_in_order, contains_any, digits_int, join_known, strip,
)

# Accident and title wording, in order of precedence.
SALVAGE_TERMS = ("salvage", "rebuilt title", "structural damage")
CLEAN_TERMS = (
    "no accident", "clean carfax", "accident free", "0 accident", "zero accident",
    "no reported accident",
)
ACCIDENT_TERMS = ("accident", "collision", "damage reported")
# Structured fuel words.
FUEL_WORDS = ("gas", "gasoline", "petrol", "diesel", "hybrid", "electric")
LISTING_SPECIFIC = "source_reported_listing_specific_unverified"


def tier_of(text: Column, tier2: Column, tier3: Column) -> Column:
    """3, 2 or 1 by case-insensitive keyword substring; the higher tier wins."""
    low = F.lower(text)

    def hit(words: Column) -> Column:
        return F.coalesce(F.exists(words, lambda k: low.contains(F.lower(k))), F.lit(False))

    return F.when(hit(tier3), 3).when(hit(tier2), 2).otherwise(1)


def tier_name(text: Column, tier1: Column, tier2: Column, tier3: Column) -> Column:
    low = F.lower(text)
    words = F.concat(*[F.coalesce(t, F.array().cast("array<string>"))
                       for t in (tier3, tier2, tier1)])
    found = F.filter(words, lambda k: low.contains(F.lower(k)))
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("Unknown"))


def accident_claim(text: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(contains_any(low, SALVAGE_TERMS), F.lit("Salvage/rebuilt"))
        .when(contains_any(low, CLEAN_TERMS), F.lit("No accidents reported"))
        .when(contains_any(low, ACCIDENT_TERMS), F.lit("Accident reported"))
        .otherwise(F.lit("Unknown"))
    )


def fuel_claim(parts: Column, text: Column) -> Column:
    """Structured fuel words win over free text; hybrid > electric > diesel > gas."""
    structured = F.lower(F.array_join(
        F.filter(parts, lambda p: F.lower(p).isin(*FUEL_WORDS)), " "
    ))
    everything = F.lower(F.concat_ws(" ", text, F.array_join(parts, " ")))
    basis = F.when(structured != "", structured).otherwise(everything)
    return (
        F.when(basis.contains("hybrid"), F.lit("Hybrid"))
        .when(basis.contains("electric"), F.lit("Electric"))
        .when(basis.contains("diesel"), F.lit("Diesel"))
        .when(basis.rlike(r"\b(?:gas|gasoline|petrol|unleaded)\b"), F.lit("Gas"))
        .otherwise(F.lit("Unknown"))
    )


def displacement_claim(parts: Column, text: Column) -> Column:
    found = F.regexp_extract(
        F.concat_ws(" ", text, F.array_join(parts, " ")),
        r"(?i)\b(\d+(?:\.\d+)?)\s*(?:l|litre|liter)\b", 1,
    )
    return F.when(found != "", F.concat(found, F.lit("L"))).otherwise(F.lit("Unknown"))


ADDRESS_FIELDS = ("addressLocality", "city", "addressRegion", "province", "streetAddress", "street",
                  "postalCode", "zip")
_ADDRESS = ", ".join(f"{f}: string" for f in ADDRESS_FIELDS)
ADDRESS = f"struct<{_ADDRESS}>"
PLACE = f"struct<{_ADDRESS}, address: {ADDRESS}>"
LOCATION = f"struct<{_ADDRESS}, address: {PLACE}>"


def address_entries(*places: Column) -> Column:
    """Places in order of preference, each followed by its own nested address, as one array."""
    entries = []
    for place in places:
        for holder in (place, place["address"]):
            entries.append(F.struct(*[holder[f].alias(f) for f in ADDRESS_FIELDS]))
    return F.array(*entries)


def geography(entries: Column) -> Column:
    """First place with a locality or region: (location, address), NULL when there is none."""
    def either(p: Column, a: str, b: str) -> Column:
        first = F.trim(p[a])
        return F.when(first != "", first).otherwise(F.coalesce(F.trim(p[b]), F.lit("")))

    def shown(p: Column) -> Column:
        city, region = either(p, "addressLocality", "city"), either(p, "addressRegion", "province")
        street, postal = either(p, "streetAddress", "street"), either(p, "postalCode", "zip")
        return F.struct(join_known([city, region]).alias("location"),
                        join_known([street, city, region, postal]).alias("address"))

    return F.try_element_at(
        F.filter(F.transform(entries, shown), lambda e: e["location"] != ""), F.lit(1))


def listing_id(identifiers: list[Column], url: Column) -> Column:
    """First structured identifier (VARIANT scalar or {value} object), else the last numeric
    path segment of the URL."""
    structured = [
        F.coalesce(F.nullif(get_text(v, "$"), F.lit("")), F.nullif(get_text(v, "$.value"), F.lit("")))
        for v in identifiers
    ]
    segments = F.regexp_extract_all(url, F.lit(r"/(\d+)(?=[/?#]|$)"), F.lit(1))
    return F.coalesce(*structured, F.try_element_at(segments, F.lit(-1)), F.lit(""))


def first_offer(offers: Column, schema: str) -> Column:
    """The offer object: the object itself, or the first object of a list of offers."""
    listed = F.filter(F.try_variant_get(offers, "$", f"array<{schema}>"), lambda o: o.isNotNull())
    return F.coalesce(F.try_element_at(listed, F.lit(1)), F.try_variant_get(offers, "$", schema))


ENGINE_KEYS = ("fuelType", "name", "description", "engineDisplacement", "engineType", "configuration")


def engine_parts(engine: Column) -> Column:
    """Texts of a structured engine (VARIANT) given as object, list of objects or plain text."""
    entries = F.coalesce(
        F.try_variant_get(engine, "$", "array<variant>"), F.array_compact(F.array(engine)))

    def texts(entry: Column) -> Column:
        fields = [
            F.coalesce(*[F.nullif(get_text(entry, f"$.{k}{tail}"), F.lit(""))
                         for tail in ("", ".value", ".name")])
            for k in ENGINE_KEYS
        ]
        return F.array(*fields, get_text(entry, "$"))

    flat = F.flatten(F.transform(entries, texts))
    return F.coalesce(F.filter(flat, lambda t: t.isNotNull() & (F.trim(t) != "")),
                      F.array().cast("array<string>"))


def url_region(url: Column, marker: str) -> Column:
    """Path segment that follows ``marker``; '' when there is none."""
    parts = F.filter(F.split(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/"),
                     lambda p: p != "")
    at = F.array_position(parts, marker)
    return F.when(at > 0, F.coalesce(F.try_element_at(parts, (at + 1).cast("int")), F.lit(""))) \
        .otherwise(F.lit(""))


def url_years(url: Column, current_year: int) -> Column:
    found = F.transform(
        F.regexp_extract_all(url, F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), F.lit(1)),
        lambda y: y.cast("int"),
    )
    return F.array_distinct(F.filter(found, lambda y: y.between(1980, current_year + 2)))


def quality_warnings(
    *, source: Column, year: Column, mileage: Column, url: Column, current_year: int,
    location_status: Column, quarantined: Column,
) -> Column:
    """Ordered warning codes of one row. ``current_year`` is a parameter, never the clock."""
    y, m = digits_int(year), digits_int(mileage)
    years = url_years(F.coalesce(url, F.lit("")), current_year)
    has_year = y.isNotNull() & (y != 0)
    listed = F.coalesce(location_status, F.lit("")) == LISTING_SPECIFIC
    name = F.lower(strip(source))
    return codes_in_order(
        (quarantined & listed, F.concat(name, F.lit("_location_source_reported_unverified"))),
        (quarantined & ~listed, F.concat(name, F.lit("_location_unknown"))),
        (has_year & (F.size(years) == 1) & ~F.array_contains(years, y.cast("int")),
         "url_year_conflicts_with_parsed_year"),
        (has_year & (m <= 100) & (y <= current_year - 1), "suspiciously_low_mileage"),
        (~has_year | (y <= 0), "year_unknown"),
        (m.isNull() | (m >= MILEAGE_SENTINEL), "mileage_unknown"),
    )
