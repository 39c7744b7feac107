"""Cross-source duplicate candidates. Candidates are evidence for review; nothing is merged.

Listings with identical identity components are first collapsed into one *profile* with a member
count, so copies never meet each other pairwise. Profiles are matched by an equi-join on
(vehicle, year, make, model, price cell, mileage cell) or on the identification number; counts,
confidence and reasons per listing come from profile pairs. Listing pairs are produced only when a
caller asks for them. Pairs grow with the square of a cell, so they are never shuffled: what is shown of their
profiles comes along with the profiles (``with_listings``, ``with_representatives``), and reasons are bits of a number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.ids import stable_id
from marketlens.functions.text import codes_in_order, tokens_text, trim_tokens
from marketlens.session import settle, small_side

VIN_VALID = "source_reported_format_valid_unverified"
# Tolerances as (km, price) and confidence as (label, value).
MEDIUM_TOLERANCE = (1000, 1500)
LOW_TOLERANCE = (3000, 3000)
HIGH, MEDIUM, LOW = ("high", 0.98), ("medium", 0.78), ("low", 0.56)
CELL = 9000  # a few tolerances, so that few rows reach into a second cell
SPLIT = 4000  # rows of one side of a cell that one unit of work may have
LISTED = 256  # listings that one row of ``with_listings`` may hold
VIN_REASON = "exact_source_reported_vin_claim_match"
STRICT, LOOSE, SELLER, PLACE, TRIM, NEAR, WIDE, NUMBER = (1 << i for i in range(8))
# Reasons in their order with the bits that give them.
REASONS = (
    (VIN_REASON, NUMBER), ("location_claim_match", PLACE), ("loose_fingerprint_match", LOOSE),
    ("mileage_within_1000_km", NEAR), ("mileage_within_3000_km", WIDE),
    ("price_within_1500_cad", NEAR), ("price_within_3000_cad", WIDE), ("seller_name_match", SELLER),
    ("strict_fingerprint_match", STRICT), ("trim_token_overlap", TRIM), ("year_make_model_match", NEAR | WIDE),
)
CARRIED = ("listings", "representative")
COMPONENTS = ["year", "make", "model", "trim_tokens", "mileage_km", "price_cad", "dealer", "location"]


def _bucket(c: Column, width: int) -> Column:
    return F.try_divide(c, F.lit(width)).cast("bigint")


def identity_components(records: DataFrame) -> DataFrame:
    """Typed components, buckets and fingerprints next to the listing keys."""
    base = records.select(
        *[c for c in records.columns if c not in COMPONENTS and c != "trim"],
        F.col("year").cast("bigint").alias("year"),
        tokens_text(F.col("make")).alias("make"), tokens_text(F.col("model")).alias("model"),
        trim_tokens(F.col("trim")).alias("trim_tokens"),
        F.col("mileage_km").cast("bigint").alias("mileage_km"),
        F.col("price_cad").cast("bigint").alias("price_cad"),
        tokens_text(F.col("dealer")).alias("dealer"), tokens_text(F.col("location")).alias("location"),
    )
    tokens = F.array_join("trim_tokens", ",")
    by_1000, by_3000 = _bucket(F.col("mileage_km"), 1000), _bucket(F.col("mileage_km"), 3000)
    return base.select(
        "*", by_1000.alias("mileage_bucket_1000"), by_3000.alias("mileage_bucket_3000"),
        _bucket(F.col("price_cad"), 1000).alias("price_bucket_1000"),
        stable_id("fingerprint_strict", F.col("year"), F.col("make"), F.col("model"), tokens,
                  by_1000, F.col("dealer")).alias("identity_fingerprint_strict"),
        stable_id("fingerprint_loose", F.col("year"), F.col("make"), F.col("model"), tokens, by_3000)
        .alias("identity_fingerprint_loose"),
    )


def with_profile(identities: DataFrame) -> DataFrame:
    """Add the valid identification number and the profile id of each listing."""
    vin = F.when(F.col("vin_evidence_status") == VIN_VALID, F.col("vin_claim"))
    parts = [F.col("vehicle_key"), F.col("source"),
             F.to_json(F.struct(*COMPONENTS)), F.col("vin")]
    return identities.withColumn("vin", vin).withColumn("profile_id", stable_id("profile", *parts))


def profiles(listings: DataFrame) -> DataFrame:
    """One row per distinct profile with its number of listings."""
    keep = ["vehicle_key", "source", *COMPONENTS, "vin"]
    return listings.groupBy("profile_id").agg(
        *[F.first(c).alias(c) for c in keep], F.count("*").alias("members"))


def with_listings(found: DataFrame, listings: DataFrame) -> DataFrame:
    """Profiles with their listings, so that pairs are expanded where they are found; a profile of many has several rows."""
    numbered = listings.select("profile_id", "source", "canonical_listing_id", "vin_claim", F.monotonically_increasing_id().alias("_n"))
    parts = small_side(found.where(F.col("members") > LISTED).select("profile_id", F.ceil(F.col("members") / LISTED).alias("_parts")))
    dealt = numbered.join(parts, "profile_id", "left").withColumn("_part", F.pmod(F.xxhash64("_n"), F.coalesce("_parts", F.lit(1))))
    held = dealt.groupBy("profile_id", "_part").agg(F.collect_list(F.struct("source", "canonical_listing_id", "vin_claim")).alias("listings"))
    return found.join(held.drop("_part"), "profile_id")


def with_representatives(found: DataFrame, members: DataFrame) -> DataFrame:
    """Profiles with the representative of ``profile_members``."""
    return found.join(members.groupBy("profile_id").agg(F.min("representative").alias("representative")), "profile_id")


def _cells(price: Column, mileage: Column) -> list[Column]:
    return [F.floor(price / CELL), F.floor(mileage / CELL)]


def _sides(found: DataFrame) -> tuple[DataFrame, DataFrame, Column, Column]:
    left = found.select(*[F.col(c).alias(f"l_{c}") for c in found.columns])
    right = found.select(*[F.col(c).alias(f"r_{c}") for c in found.columns])
    return left, right, F.col("l_source") < F.col("r_source"), F.col("l_vehicle_key") == F.col("r_vehicle_key")


def _rating(bits: Column) -> tuple[Column, Column]:
    """Confidence of the best link among the bits, as label and value."""
    def either(i: int) -> Column:
        return F.when(bits.bitwiseAND(NUMBER) != 0, F.lit(HIGH[i])).when(bits.bitwiseAND(NEAR) != 0, F.lit(MEDIUM[i])).otherwise(F.lit(LOW[i]))

    return either(0), either(1)


def _reasons(bits: Column) -> Column:
    return codes_in_order(*[(bits.bitwiseAND(b) != 0, name) for name, b in REASONS])


def profile_pairs(found: DataFrame) -> DataFrame:
    """Matching profiles of two different sources with confidence and reasons.

    Listings or representatives that the profiles carry come along for either side.
    """
    left, right, ordered, same_vehicle = _sides(found)
    by_vin = left.join(right, same_vehicle & (F.col("l_vin") == F.col("r_vin")) & ordered).select(
        *_pair_columns(found), F.lit(HIGH[0]).alias("confidence"), F.lit(HIGH[1]).alias("confidence_score"),
        F.array(F.lit(VIN_REASON)).alias("reasons"),
    )
    return by_vin.unionByName(band_pairs(found))


def vin_matches(found: DataFrame) -> DataFrame:
    """profile_id and n, the listings of other sources with its identification number, by sums instead of pairs."""
    named = found.where("vehicle_key is not null and source is not null and vin is not null")
    own = named.groupBy("vehicle_key", "vin", "source").agg(F.sum("members").alias("own"))
    every = own.groupBy("vehicle_key", "vin").agg(F.sum("own").alias("every"))
    counts = own.join(every, ["vehicle_key", "vin"]).where("every > own")
    return named.join(counts, ["vehicle_key", "vin", "source"]).select("profile_id", (F.col("every") - F.col("own")).alias("n"))


CELL_KEYS = ["_vehicle", "_year", "_make", "_model", "_p", "_m"]


def _split_dense(near: DataFrame, around: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a part number each (``_i`` of near, ``_j`` of around), so that no cell is one unit of work.

    A histogram of the cells gives each side of a dense cell as many parts as it has times ``SPLIT`` rows; a row has the part
    of its own side and meets all parts of the other one. There are at most rows / SPLIT dense cells per side.
    """
    def parts(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*CELL_KEYS).agg(F.ceil(F.count("*") / F.lit(SPLIT)).cast("int").alias(name)).where(F.col(name) > 1)

    dense = small_side(parts(near, "_ni").join(parts(around, "_nj"), CELL_KEYS, "full"))

    def dealt(side: DataFrame, row: str, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
        every = F.sequence(F.lit(0), F.coalesce(other_parts, F.lit(1)) - 1)
        return side.join(dense, CELL_KEYS, "left").withColumn(
            own, F.pmod(F.xxhash64(row), F.coalesce(own_parts, F.lit(1))).cast("int")).withColumn(
            other, F.explode(every)).drop("_ni", "_nj")

    return dealt(near, "l_profile_id", "_i", "_ni", "_j", "_nj"), dealt(around, "r_profile_id", "_j", "_nj", "_i", "_ni")


def band_pairs(found: DataFrame) -> DataFrame:
    """Profiles of two sources that match by year, make, model, price and mileage, without a common number."""
    bits = F.col("_bits")
    label, score = _rating(bits)
    return _banded(found).select(*_pair_columns(found), label.alias("confidence"), score.alias("confidence_score"), _reasons(bits).alias("reasons"))


def _banded(found: DataFrame) -> DataFrame:
    """Both sides of the pairs of ``band_pairs`` with their reasons as ``_bits``.

    A left row is in one cell, a right row in all cells that its tolerance reaches; dense cells are split (``_split_dense``).
    Rows of a vehicle's last source are never left, of its first never right, so they are not dealt there.
    """
    ends = small_side(found.groupBy("vehicle_key").agg(F.min("source").alias("_first"), F.max("source").alias("_last")))
    placed = found.where((F.col("year") != 0) & (F.col("make") != "") & (F.col("model") != "") & F.col("price_cad").isNotNull() & F.col("mileage_km").isNotNull())
    placed = placed.join(ends, "vehicle_key")
    left = _sides(placed.where("source < _last").drop("_first", "_last"))[0]
    _, right, ordered, _ = _sides(placed.where("source > _first").drop("_first", "_last"))

    def celled(side: DataFrame, name: str) -> DataFrame:
        return side.withColumns({f"_{c}": F.col(f"{name}_{c}") for c in ("year", "make", "model")} | {"_vehicle": F.col(f"{name}_vehicle_key")})

    lp, lm = _cells(F.col("l_price_cad"), F.col("l_mileage_km"))

    def reached(value: Column, tolerance: int) -> Column:
        return F.explode(F.sequence(F.floor((value - tolerance) / CELL), F.floor((value + tolerance) / CELL)))

    near = celled(left, "l").withColumn("_p", lp).withColumn("_m", lm)
    around = celled(right, "r").withColumn("_p", reached(F.col("r_price_cad"), LOW_TOLERANCE[1])) \
        .withColumn("_m", reached(F.col("r_mileage_km"), LOW_TOLERANCE[0]))
    near, around = _split_dense(near, around)
    km = F.abs(F.col("l_mileage_km") - F.col("r_mileage_km"))
    price = F.abs(F.col("l_price_cad") - F.col("r_price_cad"))
    band = (km <= LOW_TOLERANCE[0]) & (price <= LOW_TOLERANCE[1])
    not_vin = ~F.coalesce(F.col("l_vin") == F.col("r_vin"), F.lit(False))

    same_trim = F.col("l_trim_tokens") == F.col("r_trim_tokens")
    same_dealer = F.col("l_dealer") == F.col("r_dealer")

    def same_bucket(width: int) -> Column:
        return _bucket(F.col("l_mileage_km"), width) == _bucket(F.col("r_mileage_km"), width)

    def bit(cond: Column, value: int) -> Column:
        return F.when(cond, value).otherwise(0)

    support = (
        bit(same_trim & same_dealer & same_bucket(1000), STRICT) + bit(same_trim & same_bucket(3000), LOOSE)
        + bit(same_dealer & (F.col("l_dealer") != ""), SELLER)
        + bit((F.col("l_location") == F.col("r_location")) & (F.col("l_location") != ""), PLACE)
        + bit(F.arrays_overlap("l_trim_tokens", "r_trim_tokens"), TRIM)
    )
    medium = (km <= MEDIUM_TOLERANCE[0]) & (price <= MEDIUM_TOLERANCE[1])
    # The cheap band test guards the comparison of texts, which the planner moves into the join condition.
    supported = F.when(band & ordered, support > 0)
    return near.join(around, [*CELL_KEYS, "_i", "_j"]).where(band & ordered & not_vin).where(supported).withColumn(
        "_bits", support + F.when(medium, NEAR).otherwise(WIDE)).drop(*CELL_KEYS, "_i", "_j")


def _pair_columns(found: DataFrame) -> list[Column]:
    return [
        F.col("l_vehicle_key").alias("vehicle_key"),
        F.col("l_profile_id").alias("left_profile"), F.col("r_profile_id").alias("right_profile"),
        F.col("l_members").alias("left_members"), F.col("r_members").alias("right_members"),
        *[F.col(f"{side[0]}_{c}").alias(f"{side}_{c}") for side in ("left", "right") for c in CARRIED if c in found.columns],
    ]


def profile_members(listings: DataFrame) -> DataFrame:
    """Each listing with its profile's smallest listing id: with profile pairs under the same names, all links without their expansion.

    Only the keys are written, so that the components are worked out once.
    """
    listings = settle(listings.select("vehicle_key", "source", "canonical_listing_id", "profile_id"))
    first = listings.groupBy("profile_id").agg(F.min("canonical_listing_id").alias("representative"), F.count("*").alias("members"))
    return listings.join(first, "profile_id")


def named_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Profile pairs by their representatives, which pairs of ``with_representatives`` bring along."""
    if "left_representative" in pairs.columns:
        return pairs.withColumnsRenamed({f"{side}_representative": side for side in ("left", "right")}).drop("left_profile", "right_profile")
    named = members.select("profile_id", "representative").distinct()
    for side in ("left", "right"):
        pairs = pairs.join(named.select(F.col("profile_id").alias(f"{side}_profile"), F.col("representative").alias(side)), f"{side}_profile")
    return pairs.drop("left_profile", "right_profile")


def listing_pairs(pairs: DataFrame, listings: DataFrame) -> DataFrame:
    """Expand profile pairs to listing pairs with an order-independent candidate id.

    Pairs of ``with_listings`` are expanded in place.
    """
    shown = ["source", "listing_id", "vin_claim"]

    def side(name: str) -> DataFrame:
        return listings.select(
            F.col("profile_id").alias(f"{name}_profile"), F.col("source").alias(f"{name}_source"),
            F.col("canonical_listing_id").alias(f"{name}_listing_id"),
            F.col("vin_claim").alias(f"{name}_vin_claim"))

    if "left_listings" in pairs.columns:
        expanded = pairs
        for name in ("left", "right"):
            expanded = expanded.withColumn(f"{name}_listing", F.explode(f"{name}_listings")).drop(f"{name}_listings")
        expanded = expanded.withColumns({f"{name}_{c}": F.col(f"{name}_listing")[f] for name in ("left", "right") for c, f in (
            ("source", "source"), ("listing_id", "canonical_listing_id"), ("vin_claim", "vin_claim"))})
    else:
        expanded = pairs.join(side("left"), "left_profile").join(side("right"), "right_profile")
    return expanded.select(
        "vehicle_key",
        stable_id("duplicate_candidate", F.col("vehicle_key"), F.col("left_listing_id"),
                  F.col("right_listing_id")).alias("candidate_id"),
        "confidence", "confidence_score", "reasons",
        F.lit("candidate_only_not_merged").alias("decision_status"),
        *[f"{name}_{c}" for name in ("left", "right") for c in shown],
    )


def candidate_index(found: DataFrame, listings: DataFrame) -> DataFrame:
    """Candidate count, highest confidence and distinct reasons per listing, without listing pairs.

    ``found`` holds the profiles of the listings. Common numbers are counted by sums, so a number that
    many profiles carry makes no pairs. Reasons are gathered as bits, so pairs are summed up by hash where they are found.
    """
    both = F.explode(F.array(
        F.struct(F.col("l_profile_id").alias("profile_id"), F.col("r_members").alias("n")),
        F.struct(F.col("r_profile_id").alias("profile_id"), F.col("l_members").alias("n")),
    )).alias("s")
    banded = _banded(found).select(both, "_bits").select("s.*", "_bits")
    numbered = vin_matches(found).select("profile_id", "n", F.lit(NUMBER).alias("_bits"))
    per_profile = banded.unionByName(numbered).groupBy("profile_id").agg(
        F.sum("n").alias("duplicate_candidate_count"), F.bit_or("_bits").alias("_bits"))
    return listings.select("vehicle_key", "source", "canonical_listing_id", "profile_id").join(per_profile, "profile_id").select(
        "vehicle_key", "source", "canonical_listing_id", "duplicate_candidate_count",
        _rating(F.col("_bits"))[0].alias("highest_duplicate_confidence"), _reasons(F.col("_bits")).alias("duplicate_candidate_reasons"))


def listing_duplicate_ids(candidates: DataFrame) -> DataFrame:
    """Candidate ids of each listing in order, one row each with its position, from listing pairs.

    They are dealt by listing once, and made distinct there.
    """
    both = F.explode(F.array("left_listing_id", "right_listing_id")).alias("canonical_listing_id")
    order = Window.partitionBy("vehicle_key", "canonical_listing_id").orderBy("candidate_id")
    dealt = candidates.select("vehicle_key", "candidate_id", both).repartition("vehicle_key", "canonical_listing_id")
    before, own = F.lag(F.struct("candidate_id")).over(order), F.struct("candidate_id")
    new = dealt.withColumn("_before", before).where(~F.col("_before").eqNullSafe(own)).drop("_before")
    return new.withColumn("position", F.row_number().over(order))


def best_cross_source_match(base: DataFrame, other: DataFrame, *, price: int = 100,
                            mileage: int = 1000) -> DataFrame:
    """Annotate base rows with their closest row of the other source (no merge, no ordering).

    A match has the same listing id, or the same year with price and mileage within tolerance.
    Each base row takes the nearest match instead of the first one still free. Rows without ``url`` give no ``other_url``.
    Rows in the band are found twice: first the smallest price difference of each base row, a number that is kept by hash,
    then the rows that have it, so that no other match is sorted or written.
    """
    left = base.select(*[F.col(c).alias(f"b_{c}") for c in base.columns])
    right = other.select(*[F.col(c).alias(f"o_{c}") for c in other.columns])
    dp = F.col("o_price") - F.col("b_price")
    dm = F.abs(F.col("o_mileage") - F.col("b_mileage"))
    by_id = left.join(right, (F.col("b_vehicle_key") == F.col("o_vehicle_key"))
                      & (F.col("b_listing_id") == F.col("o_listing_id")) & (F.col("b_listing_id") != "")) \
        .withColumn("_tier", F.lit(0))
    known = ["price", "mileage", "year"]
    wide_price, wide_mileage = 3 * price, 3 * mileage  # cells of a few tolerances: few rows reach into a second one

    def reached(value: Column, tolerance: int, width: int) -> Column:
        return F.explode(F.sequence(F.floor((value - tolerance) / width), F.floor((value + tolerance) / width)))

    sized = left.where(reduce(lambda a, b: a & b, [F.col(f"b_{c}").isNotNull() for c in known])
                       & (F.col("b_mileage") != 999999)) \
        .withColumn("_p", F.floor(F.col("b_price") / wide_price)) \
        .withColumn("_m", F.floor(F.col("b_mileage") / wide_mileage))
    around = right.where(reduce(lambda a, b: a & b, [F.col(f"o_{c}").isNotNull() for c in known])
                         & (F.col("o_mileage") != 999999)) \
        .withColumn("_p", reached(F.col("o_price"), price, wide_price)) \
        .withColumn("_m", reached(F.col("o_mileage"), mileage, wide_mileage))
    around = around.withColumnsRenamed({"_p": "_op", "_m": "_om"})
    in_band = ((F.col("b_vehicle_key") == F.col("o_vehicle_key")) & (F.col("b_year") == F.col("o_year"))
               & (F.col("_p") == F.col("_op")) & (F.col("_m") == F.col("_om")) & (F.abs(dp) <= price) & (dm <= mileage))
    smallest = sized.join(around, in_band).groupBy("b_record").agg(F.min(F.abs(dp)).alias("_dp"))
    by_band = sized.join(smallest, "b_record").join(around, in_band & (F.abs(dp) == F.col("_dp"))) \
        .drop("_p", "_m", "_op", "_om", "_dp").withColumn("_tier", F.lit(1))
    shown = [c for c in ("listing_id", "url", "price") if c in other.columns]
    nearest = F.min_by(
        F.struct(*[f"o_{c}" for c in shown]),
        F.struct("_tier", F.abs(dp), dm, "o_listing_id", "o_record"))
    best = by_id.unionByName(by_band).groupBy("b_record").agg(nearest.alias("_o"))
    out = base.join(best, base["record"] == best["b_record"], "left").drop("b_record")
    diff = F.col("_o.o_price") - F.col("price")
    return out.select(
        *base.columns, F.col("_o").isNotNull().alias("also_on_other_source"),
        *[F.col(f"_o.o_{c}").alias(f"other_{c}") for c in shown],
        F.when(diff < 0, F.lit("cheaper")).when(diff > 0, F.lit("more expensive"))
        .alias("other_price_direction"),
        F.abs(diff).alias("other_price_difference"),
    )
