"""Owned-value and family profiles: comparability, preference matching, questions, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import rules as R
from marketlens.functions.text import codes_in_order, digits_int, text_or_empty
from marketlens.operators import claims as C
from marketlens.operators.market import distribution, label_counts

SUBJECT_FIELDS = ("year", "trim", "fuel", "engine", "drivetrain", "current_odometer_km",
                  "odometer_context")
COMPARED = ("year", "trim", "fuel", "engine", "drivetrain")
# Preference fields of the family profile.
PREFERENCE_FIELDS = (
    "budget_max_cad", "min_year", "max_year", "max_mileage_km", "minimum_seating",
    "cargo_requirements", "max_distance_km", "accident_title_requirement",
    "service_history_requirement", "acceptable_seller_types", "availability_constraints",
)
LIST_PREFERENCES = ("cargo_requirements", "acceptable_seller_types", "availability_constraints")
NUMBER_PREFERENCES = ("budget_max_cad", "min_year", "max_year", "max_mileage_km",
                      "minimum_seating", "max_distance_km")
MARKET_ROLES = {
    "close_subject_comparable": "subject_context",
    "partial_subject_comparable": "subject_context",
    "broad_market_context": "broad_market_context",
    "subject_profile_incomplete": "broad_market_context",
    "insufficient_configuration_evidence": "evidence_gap",
}
OWNED_CONTRACT = "observed_asking_price_context_not_appraisal_not_sale_probability"
FAMILY_CONTRACT = "purpose_specific_candidate_classification_not_rank_not_score"
# Questions about missing preferences.
PREFERENCE_QUESTIONS = {
    "budget_max_cad": "What is the maximum all-in purchase budget?",
    "min_year": "What is the oldest acceptable model year?",
    "max_year": "What is the newest acceptable model year?",
    "max_mileage_km": "What is the maximum acceptable odometer reading?",
    "minimum_seating": "How many usable seating positions are required?",
    "cargo_requirements": "Which cargo or seat-folding features are required?",
    "max_distance_km": "How far is the buyer willing to travel?",
    "accident_title_requirement": "What accident and title-history conditions are acceptable?",
    "service_history_requirement": "How much service-history evidence is required?",
    "acceptable_seller_types": "Are dealer, private, or both seller types acceptable?",
    "availability_constraints":
        "What timing, deposit, inspection, or availability constraints apply?",
}
# Questions to the seller of a family vehicle.
IDENTITY_QUESTION = (
    "identity", "high",
    "What is the full VIN, and can you provide clear photos of the VIN plate and current "
    "registration?",
    "independent_identity_verification_required")
TITLE_MISSING_QUESTION = (
    "history", "high",
    "Can you provide a current vehicle-history report and confirm any accidents, insurance claims, "
    "rebuilt/salvage status, or structural repairs?",
    "accident_title_evidence_missing")
TITLE_CLAIMED_QUESTION = (
    "history", "high",
    "Please provide documents supporting the listing's accident and title claims.",
    "source_accident_title_claim_unverified")
SERVICE_QUESTION = (
    "history", "high",
    "What maintenance and repair records are available, and what major work is currently due?",
    "service_history_evidence_missing")
SEATING_QUESTION = (
    "configuration", "high",
    "How many usable seating positions are installed, and can you provide photos of every seating "
    "row?",
    "seating_capacity_missing")
USE_QUESTION = (
    "family_use", "medium",
    "Do all sliding doors, seat-folding/removal mechanisms, climate controls, cameras, sensors, "
    "and child-seat anchors operate correctly?",
    "family_use_feature_verification_required")
AVAILABILITY_QUESTION = (
    "availability", "high",
    "Is the vehicle currently available, and can it be held long enough for an independent "
    "inspection and history review?",
    "availability_not_proven_by_listing")
INSPECTION_QUESTION = (
    "inspection", "high",
    "Can the vehicle undergo an independent pre-purchase inspection, diagnostic scan, and road "
    "test before any deposit or purchase?",
    "independent_condition_verification_required")


def missing_fields(entry: Column, fields: tuple[str, ...], lists: tuple[str, ...] = ()) -> Column:
    """Sorted names of inputs that are NULL, '' or an empty list."""
    return F.array_sort(codes_in_order(*[
        (entry[f].isNull() | ((F.size(entry[f]) == 0) if f in lists
                              else (entry[f].cast("string") == "")), f)
        for f in fields
    ]))


def input_gaps(dimension: DataFrame, entry: str, fields: tuple[str, ...],
               lists: tuple[str, ...] = ()) -> DataFrame:
    """One row per missing input of each vehicle with the action it needs."""
    return dimension.select(
        "vehicle_key", F.explode(missing_fields(F.col(entry), fields, lists)).alias("field"),
    ).withColumn("action", F.concat(F.lit("Record current owner input for "), F.col("field"), F.lit(".")))


def preference_questions(dimension: DataFrame, entry: str = "preferences") -> DataFrame:
    wording = F.create_map(*[F.lit(x) for kv in PREFERENCE_QUESTIONS.items() for x in kv])
    return dimension.select(
        "vehicle_key",
        F.explode(missing_fields(F.col(entry), PREFERENCE_FIELDS, LIST_PREFERENCES)).alias("field"),
    ).withColumn("question", wording[F.col("field")])


def tokens_match(subject: Column, text: Column) -> Column:
    """The first two significant subject tokens all occur in the text."""
    tokens = F.filter(
        F.regexp_extract_all(F.lower(subject), F.lit(r"([a-z0-9.]+)"), F.lit(1)),
        lambda t: (F.length(t) >= 3) | F.replace(t, F.lit("."), F.lit("")).rlike(r"^\d+$"))
    low = F.lower(text)
    return (F.size(tokens) > 0) & F.forall(F.slice(tokens, 1, 2), lambda t: F.contains(low, t))


def comparability(listings: DataFrame, subject: str = "subject") -> DataFrame:
    """Label how comparable each listing is to the subject of its vehicle, with visible reasons.

    ``listings`` carries year, trim, fuel, engine, ``text`` and the subject struct (one per vehicle,
    NULL fields mean not provided).
    """
    s, text = F.col(subject), F.col("text")
    trim, fuel = text_or_empty(F.col("trim")), text_or_empty(F.col("fuel"))
    engine = F.concat_ws(" ", F.nullif(text_or_empty(F.col("engine")), F.lit("")),
                         F.nullif(text, F.lit("")))
    drivetrain = R.first_label(text, C.DRIVETRAIN_RULES)
    values = {"year": F.col("year").cast("string"), "trim": trim, "fuel": fuel, "engine": engine,
              "drivetrain": drivetrain}
    equal = {
        "year": digits_int(s["year"]) == F.col("year").cast("bigint"),
        "trim": tokens_match(s["trim"], trim), "engine": tokens_match(s["engine"], engine),
        "fuel": F.lower(s["fuel"]) == F.lower(fuel),
        "drivetrain": F.lower(s["drivetrain"]) == F.lower(drivetrain),
    }
    flags: dict[str, list[tuple[Column, str]]] = {"match": [], "conflict": [], "unknown": []}
    for f in COMPARED:
        given = s[f].isNotNull() & (s[f].cast("string") != "")
        shown = values[f].isNotNull() & (values[f] != "")
        same = F.coalesce(equal[f], F.lit(False))
        flags["match"].append((given & shown & same, f))
        flags["conflict"].append((given & shown & ~same, f))
        flags["unknown"].append((given & ~shown, f))
    out = listings.withColumns({f"_{k}": codes_in_order(*v) for k, v in flags.items()})
    out = out.withColumn("subject_profile_missing_fields", missing_fields(s, SUBJECT_FIELDS))
    m, c = F.size("_match"), F.size("_conflict")
    year_match = F.array_contains("_match", "year")
    steps = [
        (F.size("subject_profile_missing_fields") >= 4, "subject_profile_incomplete",
         "owner_profile_requires_input"),
        (F.array_contains("_conflict", "year"), "broad_market_context",
         "model_year_differs_from_subject"),
        (year_match & (m >= 3) & (c == 0), "close_subject_comparable",
         "multiple_subject_attributes_match"),
        (year_match | (m >= 2), "partial_subject_comparable", "some_subject_attributes_match"),
        (m > 0, "broad_market_context", "limited_subject_attribute_match"),
        (F.lit(True), "insufficient_configuration_evidence", "no_supported_subject_match"),
    ]
    label, why = F.lit(None).cast("string"), F.lit(None).cast("string")
    for cond, name, reason in reversed(steps):
        label, why = F.when(cond, F.lit(name)).otherwise(label), F.when(cond, F.lit(reason)).otherwise(why)

    def prefixed(prefix: str, c: str) -> Column:
        return F.transform(c, lambda x: F.concat(F.lit(prefix), x))

    role = F.create_map(*[F.lit(x) for kv in MARKET_ROLES.items() for x in kv])
    return out.withColumn("subject_comparability", label).withColumn(
        "subject_comparability_reasons",
        F.concat(prefixed("subject_match:", "_match"), prefixed("subject_conflict:", "_conflict"),
                 prefixed("listing_evidence_missing:", "_unknown"), F.array(why)),
    ).withColumn("market_role", role[F.col("subject_comparability")]).withColumns({
        "drivetrain_claim": drivetrain, "interpretation_contract": F.lit(OWNED_CONTRACT),
    }).drop("_match", "_conflict", "_unknown")


def owned_summary(records: DataFrame, odometer_known: Column) -> DataFrame:
    """Cohort choice, price and mileage spread and asking band per vehicle.

    ``odometer_known`` is constant per vehicle. The cohort is close plus partial comparables when
    there are at least three of them, else all records; both spreads come from counted values.
    """
    key = ["vehicle_key"]
    context = F.col("subject_comparability").isin("close_subject_comparable", "partial_subject_comparable")
    counts = records.groupBy(*key).agg(
        F.count("*").alias("record_count"), F.count_if(context).alias("_context"),
        F.bool_and(odometer_known).alias("_odometer"))
    split = records.withColumn("_in", context)
    narrow = split.where("_in")

    def spread(value: str, prefix: str) -> DataFrame:
        chosen = F.struct("count", "minimum", "q1", "median", "q3", "maximum")
        a = distribution(split, key, value).select(*key, chosen.alias("_all"))
        n = distribution(narrow, key, value).select(*key, chosen.alias("_near"))
        return a.join(n, key, "full").select(
            *key, F.col("_all").alias(f"{prefix}_all"), F.col("_near").alias(f"{prefix}_near"))

    out = counts.join(spread("price_cad", "p"), key, "left").join(spread("mileage_km", "m"), key, "left")
    near = F.col("_context") >= 3
    price = F.when(near, F.col("p_near")).otherwise(F.col("p_all"))
    mileage = F.when(near, F.col("m_near")).otherwise(F.col("m_all"))
    return out.select(
        *key, "record_count",
        F.when(near, F.lit("close_or_partial_subject_comparables"))
        .otherwise(F.lit("all_configured_query_accepted_listings")).alias("cohort_basis"),
        F.when(near, F.col("_context")).otherwise(F.col("record_count")).alias("cohort_count"),
        F.when(~F.coalesce("_odometer", F.lit(False)), F.lit("unavailable_current_odometer_required"))
        .when(~near, F.lit("insufficient_subject_comparables"))
        .otherwise(F.lit("observed_asking_context_available_not_valuation"))
        .alias("subject_market_context_status"),
        price.alias("asking_price"), mileage.alias("mileage"),
        price["q1"].alias("lower_observed_asking_bound_cad"),
        price["median"].alias("upper_observed_asking_bound_cad"),
    )


def family_evidence(listings: DataFrame) -> DataFrame:
    """Seating, cargo, service and accident/title claims from the listing ``text``."""
    text = F.col("text")
    seats = F.regexp_extract(text, R.any_case(C.SEATING), 1).try_cast("bigint")
    stated = F.nullif(text_or_empty(F.col("accident_claim")), F.lit(""))
    found = F.nullif(F.regexp_extract(text, R.any_case(C.ACCIDENT_TITLE), 0), F.lit(""))
    cargo = R.labels(text, C.CARGO_RULES)
    service = R.first_label(text, C.SERVICE_RULES)
    reported, unknown = F.lit("source_text_reported_unverified"), F.lit("unknown")
    return listings.withColumns({
        "seating_claim": seats,
        "seating_evidence_status": F.when(seats.isNotNull(), reported).otherwise(unknown),
        "cargo_feature_claims": cargo,
        "cargo_feature_evidence_status": F.when(F.size(cargo) > 0, reported).otherwise(unknown),
        "service_history_claim": service,
        "service_history_evidence_status": F.when(service.isNotNull(), reported).otherwise(unknown),
        "accident_title_claim": F.coalesce(stated, found),
        "accident_title_evidence_status": F.when(stated.isNotNull(), F.lit("source_reported_unverified"))
        .when(found.isNotNull(), reported).otherwise(unknown),
    })


def evaluate_preferences(records: DataFrame, preferences: str = "preferences") -> DataFrame:
    """Preference status, reasons and candidate class per listing (preferences: one per vehicle)."""
    p = F.col(preferences)
    checks = (
        ("budget_max_cad", "price_cad", "max"), ("min_year", "year", "min"),
        ("max_year", "year", "max"), ("max_mileage_km", "mileage_km", "max"),
        ("max_distance_km", "distance_km", "max"), ("minimum_seating", "seating_claim", "min"),
    )
    match: list[tuple[Column, str]] = []
    mismatch: list[tuple[Column, str]] = []
    unknown: list[tuple[Column, str]] = []
    for field, column, relation in checks:
        given, value = p[field].isNotNull(), F.col(column)
        bad = value > p[field] if relation == "max" else value < p[field]
        unknown.append((given & value.isNull(), field))
        mismatch.append((given & bad, field))
        match.append((given & ~bad, f"preference_match:{field}"))
    kinds = p["acceptable_seller_types"]
    seller = text_or_empty(F.col("seller_type_claim"))
    listed = F.coalesce(F.size(kinds) > 0, F.lit(False))
    allowed = F.array_contains(F.transform(kinds, lambda k: F.lower(k)), F.lower(seller))
    unknown.append((listed & (seller == ""), "acceptable_seller_types"))
    mismatch.append((listed & (seller != "") & ~allowed, "acceptable_seller_types"))
    match.append((listed & (seller != "") & allowed, "preference_match:acceptable_seller_types"))
    for field, column in (("accident_title_requirement", "accident_title_claim"),
                          ("service_history_requirement", "service_history_claim")):
        given, shown = p[field].isNotNull(), F.col(column).isNotNull()
        unknown.append((given & ~shown, field))
        match.append((given & shown, f"source_claim_present_unverified:{field}"))
    wanted, cargo = p["cargo_requirements"], F.col("cargo_feature_claims")
    asked = F.coalesce(F.size(wanted) > 0, F.lit(False))
    covered = F.size(F.array_except(wanted, cargo)) == 0
    unknown.append((asked & (F.size(cargo) == 0), "cargo_requirements"))
    mismatch.append((asked & (F.size(cargo) > 0) & ~covered, "cargo_requirements"))
    match.append((asked & (F.size(cargo) > 0) & covered, "preference_match:cargo_requirements"))
    # Listings never state availability, so any availability constraint stays unresolved.
    unknown.append((F.coalesce(F.size(p["availability_constraints"]) > 0, F.lit(False)),
                    "availability_constraints"))

    out = records.withColumns({
        "_match": codes_in_order(*match),
        "_bad": F.array_sort(codes_in_order(*mismatch)),
        "_unknown": F.array_sort(codes_in_order(*unknown)),
        "missing_preference_fields": missing_fields(p, PREFERENCE_FIELDS, LIST_PREFERENCES),
    })

    def prefixed(prefix: str, c: str) -> Column:
        return F.transform(c, lambda x: F.concat(F.lit(prefix), x))

    status = (
        F.when(F.size("missing_preference_fields") > 0, F.lit("preferences_incomplete"))
        .when(F.size("_bad") > 0, F.lit("outside_stated_preferences"))
        .when(F.size("_unknown") > 0,
              F.lit("preference_match_unresolved_by_missing_listing_evidence"))
        .otherwise(F.lit("within_stated_preferences_based_on_unverified_listing_claims"))
    )
    gaps = codes_in_order(
        (F.col("seating_claim").isNull(), "seating"), (F.size("cargo_feature_claims") == 0, "cargo_features"),
        (F.col("service_history_claim").isNull(), "service_history"),
        (F.col("accident_title_claim").isNull(), "accident_title"))
    out = out.withColumn("preference_match_status", status).withColumn("_gaps", gaps).withColumn(
        "preference_match_reasons",
        F.concat("_match", prefixed("preference_mismatch:", "_bad"),
                 prefixed("listing_evidence_missing:", "_unknown")))
    state = F.col("preference_match_status")
    pending, outside = state == "preferences_incomplete", state == "outside_stated_preferences"
    gappy = (F.size("_gaps") > 0) | (state == "preference_match_unresolved_by_missing_listing_evidence")
    return out.withColumn(
        "candidate_classification",
        F.when(pending, F.lit("candidate_pending_requirements"))
        .when(outside, F.lit("candidate_outside_stated_preferences"))
        .when(gappy, F.lit("candidate_with_evidence_gaps"))
        .otherwise(F.lit("candidate_for_manual_review")),
    ).withColumn(
        "candidate_classification_reasons",
        F.when(pending, F.concat(F.array(F.lit("friend_preferences_incomplete")),
                                 prefixed("missing_preference:", "missing_preference_fields")))
        .when(outside, prefixed("preference_mismatch:", "_bad"))
        .when(gappy, F.concat(F.array(F.lit("listing_evidence_requires_confirmation")),
                              prefixed("missing_listing_evidence:", "_gaps")))
        .otherwise(F.array(F.lit("stated_preferences_match_unverified_listing_claims"),
                           F.lit("manual_inspection_still_required"))),
    ).withColumn("decision_contract", F.lit(FAMILY_CONTRACT)).drop("_match", "_bad", "_unknown", "_gaps")


def family_questions(records: DataFrame) -> DataFrame:
    no_title = F.col("accident_title_claim").isNull()
    questions = C.ask(
        (None, IDENTITY_QUESTION), (no_title, TITLE_MISSING_QUESTION), (~no_title, TITLE_CLAIMED_QUESTION),
        (F.col("service_history_claim").isNull(), SERVICE_QUESTION),
        (F.col("seating_claim").isNull(), SEATING_QUESTION), (None, USE_QUESTION),
        (None, AVAILABILITY_QUESTION), (None, INSPECTION_QUESTION))
    return records.withColumn("questions", questions) \
        .withColumn("seller_question_count", F.size("questions").cast("bigint"))


def family_summary(records: DataFrame) -> DataFrame:
    """Class counts per vehicle (one row per class)."""
    return label_counts(records, ["vehicle_key"], "candidate_classification")
