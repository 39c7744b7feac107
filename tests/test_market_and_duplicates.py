"""Price cohorts, regression, duplicates and matching with worked values."""

from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from marketlens.functions.numbers import geodesic_km, half_even, straight_line_distance
from marketlens.operators import duplicates as D
from marketlens.operators import market as M
from marketlens.operators import quantiles as Q

ROW = "vehicle_key string, id string, year int, price_cad bigint, mileage_km bigint"


def context(spark, rows, **kw):
    df = spark.createDataFrame([("v", str(i), *r) for i, r in enumerate(rows)], ROW)
    return {r.id: r for r in M.market_context(df, "all", small=False, **kw).collect()}


def test_exact_year_cohort_and_projection(spark):
    rows = [(2023, 50000, 80000), (2023, 52000, 70000), (2023, 54000, 60000), (2023, 56000, 50000),
            (2023, 58000, 40000), (2022, 47000, 100000)]
    got = context(spark, rows)["0"]
    assert (got.cohort_basis, got.comparable_count) == ("exact_model_year_2023", 5)
    assert (got.price_q1_cad, got.price_median_cad, got.price_q3_cad) == (52000, 54000, 56000)
    assert got.price_position == "below_observed_interquartile_range"
    assert got.price_difference_from_median_cad == -4000
    assert (got.slope_cad_per_10000_km, got.r_squared, got.projected_asking_price_cad) == (-2000.0, 1.0, 50000)


def test_fallbacks(spark):
    near = context(spark, [(2010, 10, 1), (2011, 20, 2), (2011, 30, 3), (1990, 99, 4)])
    assert near["0"].cohort_basis == "model_year_2010_plus_minus_1" and near["0"].comparable_count == 3
    assert near["3"].cohort_basis == "all" and near["3"].comparable_count == 4
    early = context(spark, [(2020, 10, 1), (2022, 20, 2), (2023, 30, 3)])
    assert early["0"].cohort_basis == "early_2020s_2020_2023"
    few = context(spark, [(2000, 10, 1), (None, 20, 2)])
    assert few["0"].price_position == "insufficient_comparables"
    assert few["1"].cohort_basis == "all" and few["1"].price_difference_from_median_cad is None


def test_only_cohorts_that_something_falls_back_to_are_counted(spark, monkeypatch):
    seen, quantiles = [], M.exact_quantiles
    monkeypatch.setattr(M, "exact_quantiles", lambda hist, *a, **k: seen.append(hist) or quantiles(hist, *a, **k))
    rows = [("v", y, p, 5) for y in (2010, 2011, 2021) for p in (10, 20, 30)] + [("w", 2010, 7, None), ("w", 2014, 0, 3), (None, 2010, 5, 5)]
    out = M.cohort_by_year(spark.createDataFrame(rows, "vehicle_key string, year int, price_cad bigint, mileage_km bigint"), "all").collect()
    assert {(r.vehicle_key, r.year): (r.cohort_basis, r.comparable_count, r.sample_count) for r in out} == {
        **{("v", y): (f"exact_model_year_{y}", 3, 3) for y in (2010, 2011, 2021)}, ("w", 2010): ("all", 1, None), ("w", 2014): ("all", 1, None)}
    assert {tuple(r) for r in seen[0].select("vehicle_key", "level", "cohort_year").distinct().collect()} == {
        ("v", 1, 2010), ("v", 1, 2011), ("v", 1, 2021), ("w", 4, M.ANY_YEAR)}


def test_constant_price_has_zero_r_squared(spark):
    got = context(spark, [(2023, 500, km) for km in (1, 2, 3, 4, 5)])["0"]
    assert (got.r_squared, got.slope_cad_per_10000_km, got.projection_status) == (0.0, 0.0, "available")
    same_km = context(spark, [(2023, p, 7) for p in (1, 2, 3, 4, 5)])["0"]
    assert same_km.projection_status == "insufficient_comparables"


def test_rounding_and_distance(spark):
    row = spark.range(1).select(
        half_even(F.lit(2.5)).alias("a"), half_even(F.lit(1.035), 2).alias("b"),
        straight_line_distance(*[F.lit(x).cast("double") for x in (43.65, -79.38, None, None, 45.42, -75.69)]).alias("d"),
    ).first()
    assert (row.a, row.b) == (2.0, 1.03)
    assert abs(row.d.distance_km - 352) <= 3 and row.d.method == "geodesic_city_center"


def test_geodesic_lengths(spark):
    """Quarter meridian and equator arcs of the ellipsoid, a published pair, equal and antipodal points."""
    import math
    f = 1 / 298.257223563
    quarter = 10001.9657  # from pole to equator
    dms = lambda d, m, s: d + m / 60 + s / 3600
    rows = [(0.0, 0.0, 90.0, 0.0, quarter), (0.0, 0.0, 0.0, 1.0, 6378.137 * math.pi / 180), (10.0, 20.0, 10.0, 20.0, 0.0), (90.0, 0.0, 90.0, 77.0, 0.0),
            (-dms(37, 57, 3.7203), dms(144, 25, 29.5244), -dms(37, 39, 10.1561), dms(143, 55, 35.3839), 54.972271), (5.0, 179.5, 5.0, -179.5, None),
            (0.0, 0.0, 0.5, 179.7, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, want double")
    out = df.select("want", geodesic_km(*[F.col(x) for x in "abcd"]).alias("km")).collect()
    for r in out[:5]:
        assert r.km == pytest.approx(r.want, abs=2e-4)
    assert out[5].km == pytest.approx(110.9, abs=0.2) and out[6].km == pytest.approx(math.pi * 6371 * (1 - f), rel=0.006)


def test_quantiles_of_large_groups_are_narrowed(spark, monkeypatch):
    import random
    import statistics
    rnd = random.Random(3)
    groups = {"a": [rnd.randint(-10**9, 10**9) for _ in range(800)], "b": [5] * 50, "c": [1], None: [rnd.randint(0, 40) for _ in range(300)],
              "d": [rnd.choice((0, 10**12)) for _ in range(101)], "e": list(range(64)) + [2**40]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("a", None), ("f", None)]
    hist = spark.createDataFrame(rows, "g string, v bigint").groupBy("g", "v").agg(F.count("*").alias("n"))
    points = (0.0, 0.25, 0.5, 0.9, 1.0)

    def want(values):
        values, out = sorted(values), []
        for p in points:
            at = p * (len(values) - 1)
            low, high = int(at), -int(-at // 1)
            out.append(values[low] if low == high else values[low] * (high - at) + values[high] * (at - low))
        return out
    monkeypatch.setattr(Q, "BINS", 16)
    for few in (0, 20, 10**6):
        found = {r.g: r.q for r in Q.exact_quantiles(hist, ["g"], "v", "n", points, "q", few=few).collect()}
        assert found.keys() == groups.keys()
        for g, values in groups.items():
            assert found[g] == pytest.approx(want(values), rel=1e-12), (few, g)
    assert statistics.median(groups["a"]) == pytest.approx(found["a"][2])


LISTING = ("vehicle_key string, source string, canonical_listing_id string, year int, make string, model string, "
           "trim string, price_cad bigint, mileage_km bigint, dealer string, location string, vin_claim string, "
           "vin_evidence_status string")
VIN = "1FTAAAAAAAAAAAAA1"


def listing(source, name, price=50000, km=60000, year=2020, trim="XLT crew", dealer="", location="", vin=None):
    return ("v", source, name, year, "Make", "Model", trim, price, km, dealer, location, vin,
            D.VIN_VALID if vin else "not_reported")


def candidates(spark, rows):
    found = D.with_profile(D.identity_components(spark.createDataFrame(rows, LISTING))).cache()
    pairs = D.profile_pairs(D.profiles(found))
    out = {(r.left_listing_id, r.right_listing_id): r for r in D.listing_pairs(pairs, found).collect()}
    index = {r.canonical_listing_id: r for r in D.candidate_index(D.profiles(found), found).collect()}
    return out, index


def test_confidence_levels_and_bounds(spark):
    base = listing("A", "a")
    cases = {
        "medium": listing("B", "m", 51500, 61000), "low": listing("B", "l", 53000, 63000),
        "price_out": listing("B", "p", 53001, 60000), "km_out": listing("B", "k", 50000, 63001),
        "no_year": listing("B", "y", year=None), "same_source": listing("A", "s"),
        "no_support": listing("B", "n", 52000, 57500, trim="zz"),
    }
    out, _ = candidates(spark, [base, *cases.values()])
    got = {k[1]: v.confidence for k, v in out.items() if k[0] == "a"}
    assert got == {"m": "medium", "l": "low"}
    high, _ = candidates(spark, [listing("A", "a", vin=VIN), listing("B", "b", 1, 1, year=None, vin=VIN)])
    assert [(r.confidence, r.reasons) for r in high.values()] == [("high", ["exact_source_reported_vin_claim_match"])]


def test_pairs_equal_brute_force(spark):
    grid = list(product(("A", "B"), (50000, 51400, 52900, 55800), (58900, 60000, 61100, 63000), ("XLT", "")))
    rows = [listing(s, f"{s}{i}", p, k, trim=t, dealer="d" if i % 3 else "") for i, (s, p, k, t) in enumerate(grid)]
    wanted = {}
    for left, right in product([r for r in rows if r[1] == "A"], [r for r in rows if r[1] == "B"]):
        dp, dk = abs(left[7] - right[7]), abs(left[8] - right[8])
        same_trim, same_dealer = left[6] == right[6], left[9] == right[9]
        support = ((same_trim and left[8] // 3000 == right[8] // 3000) or (same_dealer and left[9])
                   or (same_trim and left[6]))
        if support and dp <= 3000 and dk <= 3000:
            wanted[left[2], right[2]] = "medium" if dp <= 1500 and dk <= 1000 else "low"
    out, index = candidates(spark, rows)
    assert {k: v.confidence for k, v in out.items()} == wanted
    for name in {n for pair in wanted for n in pair}:
        assert index[name].duplicate_candidate_count == sum(name in pair for pair in wanted)


def test_dense_cells_are_split(spark, monkeypatch):
    rows = [listing(s, f"{s}{i}", 50000 + 37 * i % 2900, 60000 + 53 * i % 2900, dealer="d") for s in ("A", "B", "C") for i in range(45)]
    found = D.profiles(D.with_profile(D.identity_components(spark.createDataFrame(rows, LISTING)))).cache()

    def pairs():
        return sorted((r.left_profile, r.right_profile, r.confidence, tuple(r.reasons)) for r in D.band_pairs(found).collect())
    whole = pairs()
    assert len(whole) == 3 * 45 * 45 and len(set(whole)) == len(whole)
    monkeypatch.setattr(D, "SPLIT", 4)
    assert pairs() == whole


def test_copies_meet_as_profiles(spark):
    rows = [listing("A", f"a{i}") for i in range(40)] + [listing("B", f"b{i}", 50100) for i in range(30)]
    found = D.with_profile(D.identity_components(spark.createDataFrame(rows, LISTING)))
    pairs = D.profile_pairs(D.profiles(found)).collect()
    assert [(p.left_members, p.right_members) for p in pairs] == [(40, 30)]
    _, index = candidates(spark, rows)
    assert {r.duplicate_candidate_count for k, r in index.items() if k[0] == "a"} == {30}


def test_a_number_that_many_listings_carry(spark):
    n = 50_000
    ids = spark.range(2 * n).withColumn("source", F.when(F.col("id") < n, "A").otherwise("B"))
    rows = ids.select(
        F.lit("v").alias("vehicle_key"), "source", F.concat("source", F.col("id")).alias("canonical_listing_id"),
        F.lit(None).cast("int").alias("year"), F.lit("").alias("make"), F.lit("").alias("model"), F.lit("").alias("trim"),
        F.col("id").alias("price_cad"), F.col("id").alias("mileage_km"), F.lit("").alias("dealer"), F.lit("").alias("location"),
        F.lit(VIN).alias("vin_claim"), F.lit(D.VIN_VALID).alias("vin_evidence_status"))
    found = D.with_profile(D.identity_components(rows)).cache()
    index = D.candidate_index(D.profiles(found), found)
    out = index.groupBy("source", "duplicate_candidate_count", "highest_duplicate_confidence").count().collect()
    assert sorted(map(tuple, out)) == [("A", n, "high", n), ("B", n, "high", n)]


def test_candidate_join_is_an_equi_join(spark):
    found = D.with_profile(D.identity_components(spark.createDataFrame([listing("A", "a"), listing("B", "b")], LISTING)))
    plan = D.profile_pairs(D.profiles(found))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("changes,status,median", [
    ([-5, 0, 7, None], "observed_asking_price_change_context_available", 0), ([1, None], "insufficient_multi_run_history", None)])
def test_price_direction(spark, changes, status, median):
    df = spark.createDataFrame([("v", c) for c in changes], "vehicle_key string, change bigint")
    row = M.price_direction(df, ["vehicle_key"], "change").first()
    assert (row.status, row.median_change_from_previous_observation_cad) == (status, median)
