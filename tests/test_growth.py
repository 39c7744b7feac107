"""Work that grows with the tables: expressions evaluated once, rows copied to few cells."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from marketlens.functions import rules as R
from marketlens.functions.payload import END_OF_TEXT, strict_json
from marketlens.operators import canonical as C
from marketlens.operators import claims
from marketlens.operators import duplicates as D
from marketlens.operators import extract as E
from marketlens.plans import listing_queries as LQ
from marketlens.session import spread
from marketlens.sources import snapshots as SN


def plan(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain(True)
    return shown.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_pages_are_parsed_in_one_place_of_the_plan(spark):
    pages = spark.createDataFrame([(1, "<p>")], "id int, html string").join(spark.range(3), "id")
    text = plan(E.explode_listings(E.state_payload(pages)))
    assert sum("regexp_extract_all" in line for line in text.splitlines()) == 1


def test_field_evidence_is_built_in_one_place_of_the_plan(spark, monkeypatch):
    keys = "run_id string, vehicle_key string, source string, source_record_index bigint, malformed boolean, quarantined boolean"
    rows = spark.createDataFrame([("r", "v", "s", i, i == 0, False) for i in range(2)], keys).withColumn(
        "row", F.struct(*[F.lit("7").alias(c) for c in LQ.SNAPSHOT_FIELDS]))
    monkeypatch.setattr(LQ, "snapshot", lambda *_: rows.join(spark.createDataFrame([("v",)], "vehicle_key string"), "vehicle_key"))
    out = LQ.field_evidence(spark, "")
    assert sum("map_from_entries" in line for line in plan(out).splitlines()) == 1
    assert sorted((x["source_record_index"], x["field"]) for x in out.collect()) == [(1, "fuel"), (1, "location"), (1, "mileage_km")]
    assert C.canonical_records(rows, current_year=2002).count() == 2


def test_blank_or_wrong_scripts_of_the_columns_that_are_kept(spark):
    html = ('<script type="application/ld+json"> </script><script type="application/ld+json">{x</script>'
            '<script type="application/ld+json">{"@type":"Car","name":"a"}</script>')
    out = E.structured_payload(spark.createDataFrame([(1, html)], "id int, html string"), keep=["id"])
    assert out.columns == ["id", "listings", "page_errors"]
    row = out.select(F.size("listings").alias("n"), "page_errors").first()
    assert (row["n"], row["page_errors"]) == (1, ["invalid_json_ld_script:1"])


def test_strict_json_takes_one_value_only(spark):
    texts = ['{"a":1}', ' [1] ', '1', '"x"', 'null', '', '{', '1],[2', '1,2', '{"a":1} x', f'1,"{END_OF_TEXT}"],[2', f'"{END_OF_TEXT}"',
             '1,"\\u0065ndOfTheOneValue"],[2', '"\\u0065"', 'var a = {}', '-2.5', 'true', '{"a":1},', '[1]]', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", F.to_json(strict_json(F.col("t"))).alias("v")).collect()}
    assert {i: v for i, v in got.items() if v is not None} == {
        0: '{"a":1}', 1: "[1]", 2: "1", 3: '"x"', 4: "null", 11: f'"{END_OF_TEXT}"', 13: '"e"', 15: "-2.5", 16: "true"}


def test_words_that_every_match_holds(spark):
    tables = [t for n, t in vars(claims).items() if n.endswith("_RULES")]
    assert R.plain_word(r"\bcrew\s*cab\b") == "crew" and R.plain_word(r"\bdoors?\b") == "door"
    assert R.plain_word("a|bcd") == "" and R.plain_word(r"\x41bc") == "" and R.plain_word("[0-9]{3,}") == ""
    texts = ["CREW  cab", "super\ncrew", "8' box", "6 3/4 FT", "6’9\" bed", "dual rear wheels", "Ext. Cab", "dealer maintained",
             "no records", "no service record", "one-owner", "xl xlt", "", None, "reg cab \u0130 \u212aing ranch"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    plain = [F.coalesce(*[F.when(t.rlike(R.any_case("|".join(f"(?:{p})" for p in ps))), F.lit(label)) for label, ps in rules]) for rules in tables]
    for row in df.select(F.array(*plain).alias("a"), F.array(*[R.first_label(t, r) for r in tables]).alias("b")).collect():
        assert row["a"] == row["b"]
    assert "contains" in plan(df.select(R.first_label(t, claims.CAB_RULES))).lower()


def test_a_right_row_is_copied_to_the_cells_it_reaches(spark, monkeypatch):
    kept = []
    split = D._split_dense
    monkeypatch.setattr(D, "_split_dense", lambda near, around: (kept.append(around), split(near, around))[1])
    price = [100 * i for i in range(200)]
    rows = [("v", s, 2000, "m", "k", ["a"], 50000 - p, p, "d", "l", None, f"{s}{p}", 1) for p in price for s in ("A", "B")]
    found = spark.createDataFrame(rows, "vehicle_key string, source string, year bigint, make string, model string, trim_tokens array<string>, "
                                  "mileage_km bigint, price_cad bigint, dealer string, location string, vin string, profile_id string, members bigint")
    pairs = {(r["left_profile"], r["right_profile"]) for r in D.band_pairs(found).collect()}
    assert pairs == {(f"A{p}", f"B{q}") for p in price for q in price if abs(p - q) <= 3000}
    assert kept[0].count() <= 4 * len(rows)


def test_only_fields_that_are_read_are_normalised(spark, monkeypatch):
    keys = "run_id string, vehicle_key string, source string, source_record_index bigint, malformed boolean, quarantined boolean"
    rows = spark.createDataFrame([("r", "v", "s", i, i == 0, False) for i in range(3)], keys).withColumn(
        "row", F.struct(*[F.concat(F.lit("7"), F.col("run_id")).alias(c) for c in LQ.SNAPSHOT_FIELDS]))
    monkeypatch.setattr(LQ, "snapshot", lambda *_: rows.join(spark.createDataFrame([("v",)], "vehicle_key string"), "vehicle_key"))
    counts = LQ.canonical_reconciliation(spark, "")
    assert "regexp_replace" not in plan(counts)
    assert [(r["accepted_records"], r["parse_failures"], r["reconciled"]) for r in counts.collect()] == [(2, 1, True)]
    records = LQ.canonical_records(spark, "")
    assert "weeks_tracked AS" not in plan(records) and plan(records).count("regexp_replace") < 8
    assert sorted((r["source_record_index"], r["year"], r["fuel"]) for r in records.collect()) == [(0, None, None), (1, 7, "7r"), (2, 7, "7r")]


def test_rows_of_large_scans_are_spread_to_several_tasks_a_core(spark):
    cores = spark.sparkContext.defaultParallelism
    tasks = [spread(spark.range(0, 100, 1, n)).rdd.getNumPartitions() for n in (1, cores, 4 * cores, 9 * cores)]
    assert tasks == [cores, 4 * cores, 4 * cores, 9 * cores]


def test_components_of_profile_members_are_worked_out_once(spark):
    rows = spark.createDataFrame([("v", "A", "a", "x"), ("v", "A", "b", "x"), ("v", "B", "c", None)],
                                 "vehicle_key string, source string, canonical_listing_id string, name string")
    members = D.profile_members(rows.join(spark.range(1)).withColumn("profile_id", F.sha2("name", 256)))
    assert "sha2" not in plan(members)
    assert sorted((r["canonical_listing_id"], r["representative"], r["members"]) for r in members.collect()) == [("a", "a", 2), ("b", "a", 2)]


def test_lines_of_snapshot_files_are_written_once(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('listing_id,url\na,"x\ny"\n\nb,z\n')
    settled, kept = [], SN.settle
    monkeypatch.setattr(SN, "settle", lambda df, *more: settled.append(df.columns) or kept(df, *more))
    found = SN.quoted_records(spark, str(tmp_path))
    assert [c for c in settled if "line" in c] == [["file", "at", "n", "line", "quotes", "begins", "_local"]]
    assert sorted((r["number"], r["text"], r["open"]) for r in found.collect()) == [
        (0, "listing_id,url", False), (1, 'a,"x\ny"', False), (2, "b,z", False)]


LISTING = ("vehicle_key string, source string, canonical_listing_id string, year bigint, make string, model string, trim string, price_cad bigint, "
           "mileage_km bigint, dealer string, location string, vin_claim string, vin_evidence_status string")


def identified(spark, copies=5):
    """Listings of two sources, some of them copies of one profile, one with a common number."""
    rows = [("v", s, f"{s}{p}-{i}", 2000, "m", "k", "red ring", 10000 + 1000 * p, 50000, "d", "l", "1FT00000000000001" if p == 9 else None,
             D.VIN_VALID if p == 9 else "not_reported") for s in ("A", "B") for p in (0, 1, 2, 9) for i in range(copies if p == 0 else 1)]
    return D.with_profile(D.identity_components(spark.createDataFrame(rows, LISTING))).cache()


def test_listings_and_representatives_come_with_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(D, "LISTED", 2)
    found = identified(spark)
    profiles = D.profiles(found)
    joined = D.listing_pairs(D.profile_pairs(profiles), found)
    pairs = D.profile_pairs(D.with_listings(profiles, found))
    carried = D.listing_pairs(pairs, found)
    assert plan(carried).count("Join") == plan(pairs).count("Join")
    assert sorted(map(str, carried.collect())) == sorted(map(str, joined.collect())) and carried.count() > 25
    members = D.profile_members(found)
    named = D.profile_pairs(D.with_representatives(profiles, members))
    assert plan(D.named_pairs(named, members)).count("Join") == plan(named).count("Join")
    both = [D.named_pairs(p, members).select("left", "right", "reasons").collect() for p in (named, D.profile_pairs(profiles))]
    assert sorted(both[0]) == sorted(both[1]) and both[0]


def test_pairs_are_summed_up_by_hash_and_only_sources_that_can_meet_are_dealt(spark, monkeypatch):
    dealt = []
    split = D._split_dense
    monkeypatch.setattr(D, "_split_dense", lambda near, around: (dealt.append((near, around)), split(near, around))[1])
    found = identified(spark)
    index = D.candidate_index(D.profiles(found), found)
    assert "collect_set" not in plan(index)
    assert {r[0] for r in dealt[0][0].select("l_source").collect()} == {"A"} and {r[0] for r in dealt[0][1].select("r_source").collect()} == {"B"}
    got = {r["canonical_listing_id"]: r for r in index.collect()}
    assert (got["A0-1"]["duplicate_candidate_count"], got["A0-1"]["highest_duplicate_confidence"]) == (7, "medium")
    assert (got["B9-0"]["duplicate_candidate_count"], got["B9-0"]["duplicate_candidate_reasons"]) == (1, [D.VIN_REASON])


def test_candidate_ids_are_dealt_once(spark):
    rows = spark.createDataFrame([("v", "c2", "a", "b"), ("v", "c2", "a", "b"), ("v", "c1", "a", "x"), (None, None, "a", None)],
                                 "vehicle_key string, candidate_id string, left_listing_id string, right_listing_id string")
    ids = D.listing_duplicate_ids(rows)
    assert ids._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = [tuple(r) for r in ids.select("vehicle_key", "canonical_listing_id", "candidate_id", "position").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [("v", "a", "c1", 1), ("v", "a", "c2", 2), ("v", "b", "c2", 1), ("v", "x", "c1", 1), (None, "a", None, 1), (None, None, None, 1)]))


def test_texts_are_searched_and_steps_made_no_more_than_needed(spark):
    from marketlens.functions.numbers import geodesic_km
    from marketlens.functions.text import engine_text

    df = spark.createDataFrame([("1995 cc", 43.65, -79.38, 45.0, -81.1)], "c string, a double, b double, x double, y double")
    assert plan(df.select(engine_text(F.col("c")))).count("regexp_replace") <= 2
    assert "now = " in plan(df.select(geodesic_km(*map(F.col, "abxy"))))
    assert "array_sort" not in plan(df.select(R.labels(F.col("c"), claims.OTHER_USE_RULES)))
    assert df.select(engine_text(F.col("c"))).first()[0] == "2.0L"


def test_names_of_snapshot_columns_are_looked_up_once_a_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url,listing_id\nx,1\ny\nz,2,3\n")
    (tmp_path / "b.csv").write_text("listing_id\n5\n")
    rows = SN.read_numbered_snapshots(spark, str(tmp_path), ["listing_id", "url"])
    assert "array_position" not in plan(rows)
    got = sorted((r["row"]["url"] or "", r["row"]["listing_id"] or "", r["malformed"], r["source_record_index"]) for r in rows.collect())
    assert got == [("", "5", False, 0), ("x", "1", False, 0), ("y", "", False, 1), ("z", "2", True, 2)]


def test_the_closest_row_is_found_by_its_distance_first(spark):
    columns = "vehicle_key string, listing_id string, year bigint, price bigint, mileage bigint, record string"
    base = [("v", f"b{i}", 2000, 1000 + 37 * i, 5000 + 111 * i, f"b{i}") for i in range(20)]
    other = [("v", f"o{i}", 2000, 1010 + 29 * i, 5100 + 97 * i, f"o{i}") for i in range(25)] + [("v", "b3", 1990, 9, 9, "same")]
    out = D.best_cross_source_match(spark.createDataFrame(base, columns), spark.createDataFrame(other, columns))
    want = {}
    for b in base:
        near = [(0 if o[1] == b[1] else 1, abs(o[3] - b[3]), abs(o[4] - b[4]), o[1]) for o in other
                if o[1] == b[1] or (o[2] == b[2] and abs(o[3] - b[3]) <= 100 and abs(o[4] - b[4]) <= 1000)]
        want[b[5]] = min(near)[3] if near else None
    assert {r["record"]: r["other_listing_id"] for r in out.collect()} == want and want["b3"] == "b3"
    assert "other_url" not in out.columns
