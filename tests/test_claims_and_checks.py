"""Claims, preferences, health, retention and consistency scenarios; registry contracts."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlens.operators import checks as V
from marketlens.operators import claims as C
from marketlens.operators import comparables as CO
from marketlens.operators import health as H
from marketlens.operators import retention as G
from marketlens.plans.catalog import QUERIES, SQL

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def claims_of(spark, text, accident="unknown"):
    df = spark.createDataFrame([(text, accident)], "text string, accident string")
    return df.select(*C.configuration_claims(F.col("text"), F.col("accident"))).first()


def test_configuration_claims(spark):
    row = claims_of(spark, "Lariat Tremor FX4 SuperCrew 4x4 8' box, SRW. Total engine hours: 1,250; 250 idle hrs. "
                    "Full service history. Never used as a fleet, one-owner, towed")
    assert (row.trim_claim, row.package_claims, row.cab_configuration, row.box_configuration) == (
        "Lariat", ["FX4", "Tremor"], "crew_cab", "long_box_or_8ft_claim")
    assert (row.rear_wheel_configuration, row.drivetrain, row.engine_hours, row.idle_hours) == ("srw", "4wd", 1250, 250)
    assert row.service_history == "records_available_claim"
    assert row.prior_use_claims == ["no_fleet_commercial_rental_use_claim", "one_owner_claim", "towing_use_claim"]
    assert claims_of(spark, "no service records, full service history").service_history == "records_not_available_claim"
    assert claims_of(spark, "plain").prior_use_claims == []


def test_hours_context(spark):
    df = spark.createDataFrame([(60000, 1000, 200), (60000, 100, 200), (None, 0, 5)],
                               "mileage_km bigint, engine_hours bigint, idle_hours bigint")
    rows = C.hour_context(df).collect()
    assert (rows[0].km_per_engine_hour, rows[0].idle_hour_percent, rows[0].hour_warnings) == (60.0, 20.0, [])
    assert rows[1].hour_warnings == ["idle_hours_exceed_engine_hours"] and rows[1].idle_hour_percent is None
    assert rows[2].km_per_engine_hour is None


def test_overrides_keep_the_computed_class(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x")], "canonical_listing_id string, computed_classification string")
    over = spark.createDataFrame(
        [("a", "contacted", None, ["z", "y"], "hold", "why"), ("", "odd", None, None, "best", None)],
        "canonical_listing_id string, owner_disposition string, owner_note string, owner_tags array<string>, "
        "classification_override string, override_reason string")
    rows = {r.canonical_listing_id: r for r in C.with_overrides(df, over, small=False).collect()}
    assert (rows["a"].effective_classification, rows["a"].computed_classification, rows["a"].owner_tags) == ("hold", "x", ["y", "z"])
    assert (rows["b"].effective_classification, rows["b"].owner_disposition, rows["b"].override_applied) == ("x", "unreviewed", False)
    assert {r.fault for r in C.override_faults(over).collect()} == {
        "missing_listing_id", "unsupported_disposition", "unsupported_classification", "override_reason_required"}


PREFERENCES = ("struct<budget_max_cad: int, min_year: int, max_year: int, max_mileage_km: int, minimum_seating: int, "
               "cargo_requirements: array<string>, max_distance_km: int, accident_title_requirement: string, "
               "service_history_requirement: string, acceptable_seller_types: array<string>, availability_constraints: array<string>>")


def test_preferences(spark):
    stated = (30000, 2015, 2024, 100000, 7, ["fold_flat_seating_claim"], 100, "clean", "full", ["dealer"], ["soon"])
    empty = (None,) * 11
    text = "7-passenger fold-flat seats, full service history, clean title"
    rows = [("a", 25000, 2020, 50000, 10.0, text, "Dealer", stated), ("b", 40000, 2020, 50000, 10.0, text, "Private", stated),
            ("c", 25000, 2020, None, 10.0, "", "unknown", empty)]
    df = spark.createDataFrame(rows, "id string, price_cad int, year int, mileage_km int, distance_km double, text string, "
                               f"seller_type_claim string, preferences {PREFERENCES}").withColumn("accident_claim", F.lit("Unknown"))
    out = CO.family_questions(CO.evaluate_preferences(CO.family_evidence(df)))
    got = {r.id: r for r in out.collect()}
    assert got["a"].candidate_classification == "candidate_with_evidence_gaps"
    assert got["a"].preference_match_reasons[-1] == "listing_evidence_missing:availability_constraints"
    assert got["b"].candidate_classification_reasons == [
        "preference_mismatch:acceptable_seller_types", "preference_mismatch:budget_max_cad"]
    assert got["c"].preference_match_status == "preferences_incomplete" and len(got["c"].missing_preference_fields) == 11
    assert (got["a"].seller_question_count, got["c"].seller_question_count) == (5, 7)


def test_health_anomaly_scenarios(spark):
    fields = ("vehicle_key string, source string, run_id string, healthy boolean, execution_status string, fetched_record_count bigint, "
              "accepted_record_count bigint, parse_failure_count bigint, pagination_complete boolean, failed_page_count int, "
              "request_attempt_count bigint, quality_warning_rows bigint")
    rows = [("v", "a", "1", True, "success", 200, 40, 0, True, 0, 3, 2), ("v", "a", "2", True, "success", 30, 5, 6, True, 0, 30, 7),
            ("v", "b", "2", False, "failed", 0, 0, 0, False, 2, 0, 0)]
    found = H.anomalies(H.with_previous_run(spark.createDataFrame(rows, fields), ["run_id"])).collect()
    got = {(r.source, r.run_id): set() for r in found}
    for r in found:
        got[r.source, r.run_id].add((r.severity, r.code))
    assert got["a", "2"] == {
        ("critical", "accepted_record_count_collapse"), ("critical", "fetched_record_count_collapse"),
        ("critical", "parse_failure_rate_critical"), ("warning", "request_attempt_surge"), ("warning", "quality_warning_growth")}
    assert got["b", "2"] == {("critical", "source_unhealthy"), ("critical", "pagination_incomplete"),
                             ("critical", "failed_source_pages"), ("info", "source_has_no_baseline")}
    assert ("a", "1") not in got
    first = spark.createDataFrame([("v", "a", "1", True, "success", 50, 50, 0, True, 0, 3, 90)], fields)
    assert H.anomalies(H.with_previous_run(first, ["run_id"])).count() == 0


def test_archives_and_paths(spark):
    files = [("v", "source_archive", f"n{i:02d}.csv", f"p{i}", 10, "x") for i in range(10)] + [
        ("v", "source_archive", "n_latest.csv", "pl", 10, "x"), ("v", "old", "m.csv", "pm", 60, "x")]
    inv = spark.createDataFrame(files, "vehicle_key string, category string, name string, path string, size_bytes bigint, sha256 string")
    plan = {r.name: r.reason for r in G.deletion_plan(inv, {"source_archive": 8}, {"old": "retired"}).collect()}
    assert plan == {"n00.csv": "archive_count_limit_exceeded", "n01.csv": "archive_count_limit_exceeded", "m.csv": "retired"}
    deletions = inv.where("category = 'old'")
    first = G.ledger(deletions, ["vehicle_key"], F.col("path"), F.col("size_bytes"))
    second = G.ledger(inv.where("name = 'n00.csv'"), ["vehicle_key"], F.col("path"), F.col("size_bytes"), first).first()
    assert (second.deleted_count_total, second.deleted_bytes_total) == (2, 70)
    assert second.deletion_chain_sha256 != first.first().deletion_chain_sha256
    paths = spark.createDataFrame([("data/v/a",), ("x/v",), ("data\\off\\b",), ("data/zz/c",), ("data/retention/l",), (" ",)], "path string")
    reg = spark.createDataFrame([("v", True), ("off", False)], "vehicle_key string, enabled boolean")
    scope = {r.path: r.path_scope for r in G.path_scope(paths, reg).collect()}
    assert scope == {"data/v/a": "allowed", "x/v": "outside_data", "data/off/b": "paused_vehicle_changed",
                     "data/zz/c": "ungoverned_vehicle_path", "data/retention/l": "allowed"}


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "cast(id as string) as name")
    plan = G.oldest_kept(df, ["k"], ["name"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_faults_are_found_and_clean_data_is_clean(spark):
    good = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "k string, i int")
    assert V.index_faults(good, ["k"], "i").count() == 0
    bad = spark.createDataFrame([("a", 0), ("a", 2), ("b", 0), ("b", 0)], "k string, i int")
    assert {(r.k, r.violation) for r in V.index_faults(bad, ["k"], "i").collect()} == {
        ("a", "record_index_discontinuity"), ("b", "record_index_repeated")}
    assert V.id_set_difference(good, good, ["k"]).count() == 0
    assert {r.occurrences for r in V.duplicate_keys(bad, ["k", "i"]).collect()} == {2}


def test_registry():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"file_inventory"}


@pytest.mark.parametrize("name", ["lifecycle_state_counts", "price_distribution", "anomaly_status"])
def test_outputs_carry_no_ranking(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert not {"rank", "score"} & {c.lower() for c in df.columns}
    assert df.count() > 0
