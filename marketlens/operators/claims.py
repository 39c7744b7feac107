"""Claims from listing text and the purchase investigation built on them.

Rule tables, labels and question wording are fixed values; the expressions are compiled from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import rules as R
from marketlens.functions.numbers import half_even
from marketlens.functions.text import codes_in_order, text_or_empty
from marketlens.session import small_side

# First-match rule tables (label, patterns), in order of precedence.
TRIM_RULES = (
    ("Limited", (r"\blimited\b",)),
    ("Platinum", (r"\bplatinum\b",)),
    ("King Ranch", (r"\bking\s+ranch\b",)),
    ("Lariat", (r"\blariat\b",)),
    ("XLT", (r"\bxlt\b",)),
    ("XL", (r"\bxl\b",)),
)
PACKAGE_RULES = (("Tremor", (r"\btremor\b",)), ("FX4", (r"\bfx4\b",)), ("STX", (r"\bstx\b",)))
CAB_RULES = (
    ("crew_cab", (r"\bcrew\s*cab\b", r"\bsuper\s*crew\b")),
    ("supercab", (r"\bsuper\s*cab\b", r"\bextended\s*cab\b", r"\bext\.?\s*cab\b")),
    ("regular_cab", (r"\bregular\s*cab\b", r"\breg\.?\s*cab\b", r"\bstandard\s*cab\b")),
)
BOX_RULES = (
    ("long_box_or_8ft_claim", (
        r"\blong\s+(?:box|bed)\b", r"\b8(?:\.0)?\s*(?:ft|foot|feet)\s*(?:box|bed)?\b",
        r"\b8['’]\s*(?:box|bed)?\b")),
    ("short_box_or_6_75ft_claim", (
        r"\bshort\s+(?:box|bed)\b",
        r"\b6(?:\.75|\s*3\s*/\s*4)\s*(?:ft|foot|feet)\s*(?:box|bed)?\b",
        r"\b6['’]\s*9(?:[\"”]|in(?:ch(?:es)?)?)?\s*(?:box|bed)?\b")),
)
REAR_WHEEL_RULES = (
    ("drw", (r"\bdrw\b", r"\bdually\b", r"\bdual\s+rear\s+wheel(?:s)?\b")),
    ("srw", (r"\bsrw\b", r"\bsingle\s+rear\s+wheel(?:s)?\b")),
)
DRIVETRAIN_RULES = (
    ("4wd", (r"\b4x4\b", r"\b4wd\b", r"\bfour[-\s]*wheel\s*drive\b")),
    ("2wd", (r"\b2wd\b", r"\brwd\b", r"\brear[-\s]*wheel\s*drive\b")),
)
SERVICE_RULES = (
    ("records_not_available_claim", (
        r"\b(?:no|without)\s+(?:service|maintenance)\s+records?\b",)),
    ("records_available_claim", (
        r"\bfull\s+service\s+history\b", r"\bservice\s+records?\s+(?:available|included)\b",
        r"\bmaintenance\s+records?\s+(?:available|included)\b", r"\bdealer[-\s]+maintained\b")),
)
# Multi-label rules of prior use; the first three are dropped when denied.
DENIABLE_USE_RULES = (
    ("fleet_use_claim", (r"\bfleet\b",)),
    ("commercial_use_claim", (r"\bcommercial(?:ly)?\b",)),
    ("rental_use_claim", (r"\brental\b",)),
)
OTHER_USE_RULES = (
    ("oilfield_use_claim", (r"\boil\s*field\b", r"\boilfield\b")),
    ("work_truck_claim", (r"\bwork\s+truck\b",)),
    ("highway_use_claim", (r"\bhighway\s+(?:km|kms|kilometres|miles|use)\b",)),
    ("towing_use_claim", (r"\btow(?:ed|ing)?\b",)),
    ("one_owner_claim", (r"\bone[-\s]+owner\b",)),
)
DENIED_USE = r"\b(?:never|not|no)\s+(?:used\s+)?(?:as\s+)?(?:a\s+)?(?:fleet|commercial|rental)\b"
DENIED_WORDS = ("fleet", "commercial", "rental")
DENIED_USE_LABEL = "no_fleet_commercial_rental_use_claim"
# Rules of the family profile.
SEATING = r"\b([6-9])[-\s]*(?:passenger|passengers|seat|seater)\b"
CARGO_RULES = (
    ("fold_flat_seating_claim", (r"\bfold[-\s]*flat\b",)),
    ("removable_seating_claim", (r"\bremovable\s+(?:seat|seats|seating)\b",)),
    ("power_sliding_doors_claim", (r"\bpower\s+sliding\s+doors?\b",)),
    ("rear_entertainment_claim", (r"\b(?:rear|dvd)\s+entertainment\b",)),
    ("roof_rack_claim", (r"\broof\s+rack\b",)),
    ("cargo_space_claim", (r"\bcargo\s+(?:space|area|capacity)\b",)),
)
ACCIDENT_TITLE = (
    r"\b(?:no\s+accidents?|accident|collision|rebuilt|salvage|structural\s+damage|clean\s+title)\b"
)
CONCERN_TERMS = ("salvage", "rebuilt", "structural")
HIGH_MILEAGE = 200_000

INVESTIGATION_FIELDS = (
    "vin", "cab_configuration", "box_configuration", "rear_wheel_configuration", "drivetrain",
    "engine_hours", "idle_hours", "service_history", "accident_title", "prior_use",
)
DISPOSITIONS = ("unreviewed", "contacted", "inspection_planned", "hold", "pass", "purchased")
OVERRIDE_CLASSES = ("priority_investigate", "investigate", "hold", "pass", "market_context_only")

# Seller questions as (gaps that ask for it, category, priority, question, reason).
GAP_QUESTIONS = (
    (("vin",), "identity", "high",
     "What is the full VIN, and can you provide a clear photo of the VIN plate and registration?",
     "vin_not_source_reported"),
    (("engine_hours", "idle_hours"), "usage", "high",
     "What are the total engine hours and idle hours? Please provide a current "
     "instrument-cluster photo showing both.",
     "engine_or_idle_hours_missing"),
    (("cab_configuration", "box_configuration"), "configuration", "high",
     "Please confirm the cab configuration and box length, with photos showing the full side "
     "profile and bed.",
     "cab_or_box_configuration_missing"),
    (("rear_wheel_configuration",), "configuration", "high",
     "Is the truck single-rear-wheel or dual-rear-wheel?",
     "rear_wheel_configuration_missing"),
    (("drivetrain",), "configuration", "high",
     "Is the truck four-wheel drive, and does the 4x4 system operate correctly in all modes?",
     "drivetrain_missing"),
    (("service_history",), "history", "high",
     "What maintenance and repair records are available, including engine, transmission, fuel, "
     "emissions, cooling, brakes, steering, and front-end work?",
     "service_history_missing"),
    (("accident_title",), "history", "high",
     "Can you provide a current vehicle-history report and confirm any accidents, insurance "
     "claims, rebuilt/salvage status, or structural repairs?",
     "accident_title_evidence_missing"),
    (("prior_use",), "prior_use", "medium",
     "How was the truck used previously—personal, fleet, commercial, oilfield, towing, plowing, "
     "or extended idling?",
     "prior_use_evidence_missing"),
)
DAMAGE_QUESTION = (
    "history", "high",
    "Please provide repair invoices, damage photos, inspection records, and title-status documents "
    "for the reported accident or damage history.",
    "source_accident_or_title_claim_requires_documents")
MILEAGE_QUESTION = (
    "high_mileage", "high",
    "At this mileage, what major repairs or replacements have been completed, and what known work "
    "is currently due?",
    "mileage_at_or_above_200000_km")
STANDING_QUESTIONS = (
    ("modifications", "high",
     "Are the engine, emissions, fuel, and transmission systems stock? List any tuning, deletes, "
     "aftermarket parts, or major replacements.",
     "modification_state_required_for_diesel_purchase"),
    ("inspection", "high",
     "Can the truck be viewed from a true cold start and undergo an independent pre-purchase "
     "inspection and diagnostic scan?",
     "independent_condition_verification_required"),
)


def question(category: str, priority: str, wording: str, reason: str) -> Column:
    return F.struct(F.lit(category).alias("category"), F.lit(priority).alias("priority"),
                    F.lit(wording).alias("question"), F.lit(reason).alias("reason"))


def ask(*rules: tuple[Column | None, tuple[str, str, str, str]]) -> Column:
    """Questions whose condition holds (None = always), in table order."""
    entries = [question(*q) if cond is None else F.when(cond, question(*q)) for cond, q in rules]
    return F.array_compact(F.array(*entries))


def prior_use(text: Column) -> Column:
    denied = R.holds_any(text, DENIED_WORDS) & text.rlike(R.any_case(DENIED_USE))
    none = F.array().cast("array<string>")
    return F.sort_array(F.array_distinct(F.concat(
        F.when(denied, F.array(F.lit(DENIED_USE_LABEL)))
        .otherwise(R.labels(text, DENIABLE_USE_RULES)),
        F.coalesce(R.labels(text, OTHER_USE_RULES), none),
    )))


def configuration_claims(text: Column, accident: Column) -> list[Column]:
    """Value columns of all configuration claims found in ``text``."""
    return [
        R.first_label(text, TRIM_RULES).alias("trim_claim"),
        R.labels(text, PACKAGE_RULES).alias("package_claims"),
        R.first_label(text, CAB_RULES).alias("cab_configuration"),
        R.first_label(text, BOX_RULES).alias("box_configuration"),
        R.first_label(text, REAR_WHEEL_RULES).alias("rear_wheel_configuration"),
        R.first_label(text, DRIVETRAIN_RULES).alias("drivetrain"),
        R.number_after_or_before(text, "engine").alias("engine_hours"),
        R.number_after_or_before(text, "idle").alias("idle_hours"),
        R.first_label(text, SERVICE_RULES).alias("service_history"),
        text_or_empty(accident).alias("accident_title"),
        prior_use(text).alias("prior_use_claims"),
    ]


def matched_texts(text: Column) -> list[Column]:
    """The words each first-match claim rests on."""
    tables = {
        "trim": TRIM_RULES, "cab_configuration": CAB_RULES, "box_configuration": BOX_RULES,
        "rear_wheel_configuration": REAR_WHEEL_RULES, "drivetrain": DRIVETRAIN_RULES,
    }
    return [R.first_match(text, t).alias(f"{n}_matched_text") for n, t in tables.items()]


def claim_status(value: Column) -> Column:
    return F.when(value.isNotNull(), F.lit("source_text_reported_unverified")) \
        .otherwise(F.lit("unknown"))


def known_fields() -> dict[str, Column]:
    present = {
        "vin": F.coalesce(
            F.col("vin_evidence_status") == "source_reported_format_valid_unverified", F.lit(False)),
        "accident_title": F.col("accident_title") != "",
        "prior_use": F.size("prior_use_claims") > 0,
    }
    return {n: present[n] if n in present else F.col(n).isNotNull() for n in INVESTIGATION_FIELDS}


def completeness(claims: DataFrame) -> DataFrame:
    """complete / partial / insufficient from ten fields, with the sorted missing ones."""
    known = known_fields()
    missing = codes_in_order(*[(~known[n], n) for n in sorted(known)])
    out = claims.withColumn("missing_investigation_fields", missing)
    n = len(known) - F.size("missing_investigation_fields")
    return out.withColumn(
        "evidence_completeness",
        F.when(n >= 8, F.lit("complete")).when(n >= 4, F.lit("partial")).otherwise(F.lit("insufficient")))


def hour_context(claims: DataFrame) -> DataFrame:
    """Kilometres per engine hour and idle share; an idle count above the total is a warning."""
    engine, idle, km = F.col("engine_hours"), F.col("idle_hours"), F.col("mileage_km")
    over = (engine > 0) & (idle > engine)
    return claims.withColumns({
        "km_per_engine_hour": F.when(engine > 0, half_even(km / engine, 2)),
        "idle_hour_percent": F.when((engine > 0) & (idle >= 0) & ~over, half_even(idle / engine * 100, 2)),
        "hour_warnings": codes_in_order((over, "idle_hours_exceed_engine_hours")),
    })


def classify(df: DataFrame) -> DataFrame:
    """Investigation class and its reasons; earlier conditions take precedence."""
    fit, complete = F.col("year_fit"), F.col("evidence_completeness")
    accident = F.lower("accident_title")
    concern = F.lit(False)
    for term in CONCERN_TERMS:
        concern = concern | accident.contains(term)
    steps = [
        (concern, "concern_review", "source_accident_or_title_concern"),
        (fit == "broad_market_context", "market_context_only", "outside_early_2020s_target"),
        (fit == "unknown", "insufficient_evidence", "year_fit_unknown"),
        (F.col("price_position") == "above_observed_interquartile_range", "investigate_price_concern",
         "asking_price_above_observed_interquartile_range"),
        (complete == "insufficient", "investigate_with_evidence_gaps",
         "multiple_investigation_fields_missing"),
        (F.lit(True), "investigate_priority", "target_year_without_visible_hard_concern"),
    ]
    label, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for cond, name, why in reversed(steps):
        label = F.when(cond, F.lit(name)).otherwise(label)
        reason = F.when(cond, F.lit(why)).otherwise(reason)
    return df.withColumn("computed_classification", label).withColumn(
        "computed_classification_reasons",
        F.array(F.concat(F.lit("year_fit:"), fit), F.concat(F.lit("evidence_completeness:"), complete), reason))


def seller_questions(df: DataFrame) -> DataFrame:
    gaps = F.col("missing_investigation_fields")
    accident = F.lower("accident_title")
    rules: list[tuple[Column | None, tuple[str, str, str, str]]] = [
        (F.arrays_overlap(gaps, F.array(*map(F.lit, needed))), (cat, pri, text, why))
        for needed, cat, pri, text, why in GAP_QUESTIONS
    ]
    rules += [
        ((accident != "") & (accident != "no accidents reported"), DAMAGE_QUESTION),
        (F.col("mileage_km") >= HIGH_MILEAGE, MILEAGE_QUESTION),
        *[(None, q) for q in STANDING_QUESTIONS],
    ]
    return df.withColumn("questions", ask(*rules)) \
        .withColumn("seller_question_count", F.size("questions").cast("bigint"))


def override_faults(overrides: DataFrame) -> DataFrame:
    """One row per override that breaks the contract."""
    klass = F.col("classification_override")
    faults = codes_in_order(
        (F.coalesce("canonical_listing_id", F.lit("")) == "", "missing_listing_id"),
        (~F.coalesce("owner_disposition", F.lit("unreviewed")).isin(*DISPOSITIONS), "unsupported_disposition"),
        (klass.isNotNull() & ~klass.isin(*OVERRIDE_CLASSES), "unsupported_classification"),
        (klass.isNotNull() & (text_or_empty(F.col("override_reason")) == ""), "override_reason_required"),
    )
    return overrides.select("canonical_listing_id", F.explode(faults).alias("fault"))


def with_overrides(df: DataFrame, overrides: DataFrame, *, small: bool = True) -> DataFrame:
    """Annotate by listing id. The computed class is kept; the effective one prefers the override."""
    side = small_side(overrides) if small else overrides
    klass = F.col("classification_override")
    return df.join(side, "canonical_listing_id", "left").withColumns({
        "owner_disposition": F.coalesce("owner_disposition", F.lit("unreviewed")),
        "owner_note": text_or_empty(F.col("owner_note")),
        "owner_tags": F.coalesce(F.array_sort(F.array_distinct("owner_tags")),
                                 F.array().cast("array<string>")),
        "override_reason": text_or_empty(F.col("override_reason")),
        "override_applied": klass.isNotNull(),
        "effective_classification": F.coalesce(klass, F.col("computed_classification")),
    })


def evidence_bundles(accepted: DataFrame, identities: DataFrame, payloads: DataFrame) -> DataFrame:
    """Accepted records with their identity and raw payload, joined on unique keys."""
    run = ["run_id", "vehicle_key", "source"]
    return accepted.join(identities, [*run, "canonical_listing_id"]) \
        .join(payloads, [*run, "source_record_index"])


def bundle_faults(accepted: DataFrame, identities: DataFrame, payloads: DataFrame) -> DataFrame:
    """Accepted records without identity or payload, and count mismatches per source."""
    run = ["run_id", "vehicle_key", "source"]
    no_identity = accepted.join(identities, [*run, "canonical_listing_id"], "left_anti") \
        .select(*run, F.col("source_record_index").cast("string").alias("detail"),
                F.lit("identity_record_missing").alias("fault"))
    no_payload = accepted.join(payloads, [*run, "source_record_index"], "left_anti") \
        .select(*run, F.col("source_record_index").cast("string").alias("detail"),
                F.lit("raw_payload_missing").alias("fault"))
    a = accepted.groupBy(*run).agg(F.count("*").alias("_a"))
    i = identities.groupBy(*run).agg(F.count("*").alias("_i"))
    counts = a.join(i, run, "full").where(~F.col("_a").eqNullSafe(F.col("_i"))).select(
        *run, F.concat_ws("/", F.coalesce("_a", F.lit(0)), F.coalesce("_i", F.lit(0))).alias("detail"),
        F.lit("accepted_identity_count_mismatch").alias("fault"))
    return no_identity.unionByName(no_payload).unionByName(counts)
