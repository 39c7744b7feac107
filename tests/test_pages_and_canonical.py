"""Page payloads, routing, canonical records and file sources."""

from __future__ import annotations

import hashlib
import html
import json
from html.entities import html5

from pyspark.sql import functions as F

from marketlens.functions import listing as L
from marketlens.functions.payload import source_text, vin_evidence
from marketlens.functions.text import html_unescape
from marketlens.operators import canonical as C
from marketlens.operators import extract as E
from marketlens.operators import nodes as N
from marketlens.operators import routing as RT
from marketlens.sources import files as FS
from marketlens.sources import snapshots as SN


def dims(df):
    words = {"dim_tier1": ["xl"], "dim_tier2": ["xlt"], "dim_tier3": ["lariat"]}
    return df.withColumns({**{k: F.array(*map(F.lit, v)) for k, v in words.items()},
                           "dim_make": F.lit("Make"), "dim_model": F.lit("Model")})


def state_page(*listings, **page):
    state = {"props": {"pageProps": {"listings": list(listings), **page}}}
    return f'<script>x = "listings"</script><SCRIPT type="application/json"> {json.dumps(state)} </SCRIPT>'


def car(name="1", price="$40,000", **vehicle):
    return {"id": name, "url": f"/a/{name}", "price": {"priceFormatted": price},
            "vehicle": {"modelYear": 2020, "modelVersionInput": "XLT Lariat", "mileageInKm": "10 km",
                        "fuel": "Diesel", "engineDisplacementInCCM": "6,700 ccm", **vehicle},
            "vehicleDetails": [{"data": "no accidents"}], "location": {"city": "Town", "provinceCode": "ON"}}


def test_state_page(spark):
    broken = {**car("2"), "vehicle": "gone"}
    pages = spark.createDataFrame([
        (1, state_page(car(), broken, "text", car("3", "call"), totalResults="x", pagination={"total": "3"})),
        (2, "<script>{\"listings\": 1}</script>"), (3, state_page(car()) .replace("}}} <", "}}}} <"))], "page int, html string")
    out = {r.page: r for r in E.state_payload(pages).select(
        "page", "reported_total", "page_error", F.size("listings").alias("n")).collect()}
    assert (out[1].reported_total, out[1].n, out[1].page_error) == (3, 4, None)
    assert out[2].page_error == "listing_payload_not_found"
    assert out[3].page_error == "listing_payload_not_found"
    rows = RT.parse_state_listing(dims(E.explode_listings(E.state_payload(pages.where("page = 1"))))) \
        .orderBy("response_item_index").collect()
    assert [r.parse_failure_reasons for r in rows] == [
        [], ["missing_vehicle_object"], ["listing_payload_not_object"], ["invalid_price"]]
    first = rows[0].parsed_row
    assert (first.price, first.year, first.engine, first.trim_tier) == (40000, 2020, "6.7L", 3)
    assert (first.location, first.accident_flag, first.make) == ("Town, ON", "No accidents reported", "Make")


def ld(value):
    return f"<script type='application/ld+json'>{value if isinstance(value, str) else json.dumps(value)}</script>"


def test_structured_page(spark):
    vehicle = {"@type": ["Vehicle", "X"], "identifier": {"value": 77}, "name": "2019 thing", "url": "https://x/v/z/5",
               "offers": [{"price": "45000.00"}], "vehicleEngine": [{"fuelType": "Diesel", "name": "6.7 L turbo"}],
               "seller": {"name": "Shop", "address": {"city": "A", "province": "B", "zip": "Z"}}, "manufacturer": "M"}
    html = (ld("{bad") + ld("  ") + ld({"@type": "ItemList", "itemListElement": [{"item": vehicle}, vehicle]})
            + ld([{"@type": "Product", "name": "p", "@graph": [{"@type": "Car", "name": "c"}, {"@type": "Person"}]}])
            + ld({"@type": "ItemList", "itemListElement": "none"}) + "<script>var x</script>")
    page = E.structured_payload(spark.createDataFrame([(html,)], "html string"))
    row = page.select("page_errors", F.size("listings").alias("n")).first()
    assert (row.page_errors, row.n) == (["invalid_json_ld_script:0"], 4)
    rows = RT.parse_structured_listing(dims(E.explode_listings(page))).orderBy("response_item_index").collect()
    p = rows[0].parsed_row
    assert (p.listing_id, p.year, p.price, p.engine, p.fuel) == ("77", 2019, 4500000, "6.7L", "Diesel")
    assert (p.location, p.dealer_address, p.location_evidence_status) == ("A, B", "A, B, Z", L.LISTING_SPECIFIC)
    assert (p.dealer, p.make) == ("Shop", "M")
    assert rows[2].parse_failure_reasons == ["invalid_price", "invalid_year"]


def test_repeated_and_incomplete_queries(spark):
    log = spark.createDataFrame([("q", 1, "x", 2), ("q", 2, "x", 2), ("w", 1, "", 0), ("w", 2, "", 0)],
                                "query_id string, page int, body string, listing_count int")
    log = E.repeated_pages(log, ["query_id"], "page", F.sha2("body", 256), "listing_count", "repeated") \
        .withColumn("stop_reason", E.stop_reason_by_size(F.col("listing_count"), 2))
    got = {r.query_id: (r.final_stop_reason, r.query_complete)
           for r in E.query_completeness(log, ["query_id"], "page", 9).collect()}
    assert got == {"q": ("repeated", False), "w": ("empty_page", True)}


def test_diagnostics_find_challenge_pages(spark):
    html = ("<title>Robot  check &amp; more</title><body><script id='__NEXT_DATA__'>captcha</script><noscript>datadome</noscript>"
            "<!-- cloudflare --><p>Access <b>denied</b></p><a href='/v/1'>a</a><a class=x href=\"/v/1\">b</a></body>")
    row = E.page_diagnostics(spark.createDataFrame([(html,)], "html string"), "html", "/v/").first()
    assert row.page_title == "Robot  check & more" and row.next_data_present
    assert row.block_markers == ["access denied"]
    assert (row.listing_link_count, row.script_count) == (1, 1)


def test_first_claim_wins_per_run(spark):
    rows = [("r", "v", "s", i, True, k, f, rej) for i, (k, f, rej) in enumerate([
        ("a", ["invalid_price"], []), ("a", [], []), ("b", [], ["year_out_of_range"]), ("b", [], ["x"])])]
    df = spark.createDataFrame(rows, "run_id string, vehicle_key string, source string, source_record_index int, "
                               "is_object boolean, identity string, parse_failure_reasons array<string>, rejection_reasons array<string>")
    before = {r.source_record_index: r for r in RT.route_before_parsing(df).collect()}
    assert [before[i].record_stage for i in range(4)] == ["parse_failure", "rejected", "rejected", "rejected"]
    assert before[1].rejection_reasons == [RT.DUPLICATE] and before[1].duplicate_of_source_record_index == 0
    after = {r.source_record_index: r for r in RT.route_after_parsing(df).collect()}
    assert [after[i].record_stage for i in range(4)] == ["parse_failure", "accepted", "rejected", "rejected"]
    assert after[3].rejection_reasons == [RT.DUPLICATE, "x"]
    counts = RT.stage_counts(RT.route_after_parsing(df)).first()
    assert counts.reconciled and counts.fetched_records == 4


def test_csv_snapshots(spark, tmp_path):
    cols = ["listing_id", "url", "mileage", "note"]
    text = "﻿listing_id,url,mileage,note\nA1,http://x,999999,\"two\nlines, \"\"q\"\"\"\n,http://y,5\nA3,http://z,5,n,extra\n"
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    (tmp_path / "b.csv").write_text("listing_id,mileage\n", encoding="utf-8")
    rows = SN.read_snapshots(spark, f"{tmp_path}/a.csv", cols).collect()
    assert [r.malformed for r in rows] == [False, False, True]
    assert rows[0].row.listing_id == "A1" and rows[0].row.note == 'two\nlines, "q"'
    assert rows[1].row.note is None
    checked = {r.file.rsplit("/", 1)[1]: r for r in SN.validate_snapshots(spark, str(tmp_path), cols).collect()}
    missing = checked["b.csv"].missing_columns
    assert not checked["a.csv"].schema_valid and checked["a.csv"].row_count == 3
    assert "url" in missing and checked["b.csv"].row_count == 0


def test_canonical_stages_reconcile(spark):
    names = list(SN.SNAPSHOT_COLUMNS)

    def row(**kw):
        return tuple(kw.get(n) for n in names)

    data = [("r", "v", "s", 0, row(listing_id="A", url="u", mileage="999999", price="$5,000", location="unknown"), False, False),
            ("r", "v", "s", 1, row(listing_id=" N/A ", url="u"), False, False),
            ("r", "v", "s", 2, row(listing_id="B", url="u"), True, False),
            ("r", "v", "q", 0, row(listing_id="A", url="u", location="Town", distance_km="5 km"), False, True)]
    schema = ("run_id string, vehicle_key string, source string, source_record_index int, row struct<"
              + ", ".join(f"{n}: string" for n in names) + ">, malformed boolean, quarantined boolean")
    out = C.canonical_records(spark.createDataFrame(data, schema), current_year=2026).cache()
    got = {(r.source, r.source_record_index): r for r in out.collect()}
    assert [got["s", i].record_stage for i in range(3)] == ["accepted", "rejected", "parse_failure"]
    good = got["s", 0]
    assert good.normalized.mileage_km is None and good.normalized.price_cad == 5000
    assert good.field_evidence["mileage_km"].evidence_status == "unknown"
    assert good.field_evidence["mileage_km"].raw_value == "999999"
    hidden = got["q", 0]
    assert hidden.normalized.location is None and hidden.normalized.distance_km is None
    assert hidden.field_evidence["location"].raw_value == "Town"
    assert hidden.field_evidence["location"].evidence_status == "quarantined_unverified_search_origin"
    assert hidden.quality_warnings[0] == "q_location_unknown"
    assert all(r.reconciled for r in C.reconcile(out).collect())


def test_vin_and_source_text(spark):
    payloads = [
        {"Vehicle Identification Number": "1ftaaaaaaaaaaaaa1"}, {"a": [{"VIN": "short"}]}, {"listing": "1FTAAAAAAAAAAAAA1"},
        {"vin": ["1FTAAAAAAAAAAAAA1", "1FTAAAAAAAAAAAAA2"]}, {"text": 'x "vin": "1FTAAAAAAAAAAAAA1" y'}]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "i int, p string")
    got = [r.e.vin_evidence_status for r in N.vin_claims(df, "p").select("i", vin_evidence(F.col("vin_claims")).alias("e")).orderBy("i").collect()]
    assert got == ["source_reported_format_valid_unverified", "source_reported_invalid_format_unverified", "not_reported",
                   "conflicting_source_reported_claims", "not_reported"]
    deep = json.dumps({"a": {"b": [1, True, None, {"c": " x "}]}, "d": ""})
    text = N.payload_leaves(spark.createDataFrame([("XLT", deep)], "t string, p string"), "p").select(
        source_text([F.col("t"), F.lit("unknown")], F.col("leaves"))).first()[0]
    assert text == "XLT | a.b[0]=1 | a.b[3].c=x"


def test_sinks_and_inventory(spark, tmp_path):
    df = spark.createDataFrame([("r1", 1, "v", "s", ["a", "b"], None), ("r2", 2, "v", "s", [], "x")],
                               "run_id string, run_ts int, vehicle_key string, source string, reasons array<string>, note string")
    SN.write_csv(df, f"{tmp_path}/csv", ["note", "reasons", "absent"])
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv").collect()
    assert back[0].__fields__ == ["note", "reasons", "absent"]
    assert sorted(r.reasons for r in back) == ['["a","b"]', "[]"]
    SN.write_json_lines(df, f"{tmp_path}/json")
    SN.write_json_lines(df.where("run_id = 'r2'").withColumn("source", F.lit("t")), f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 3
    SN.write_run(df, f"{tmp_path}/runs")
    assert [r.run_id for r in SN.latest_run(spark, f"{tmp_path}/runs", ["vehicle_key"]).collect()] == ["r2"]
    (tmp_path / "one.json").write_text('{\n "run_id": "r1"\n}')
    assert SN.read_json_objects(spark, f"{tmp_path}/one.json", "run_id string").first().run_id == "r1"
    (tmp_path / "lines.jsonl").write_text('{"a":1}\n\n[1]\n{"a":1}}\n')
    faults = [r.fault for r in SN.read_json_lines(spark, f"{tmp_path}/lines.jsonl").collect()]
    assert sorted(map(str, faults)) == ["None", "invalid_json", "not_a_json_object"]
    listed = {r.name: r for r in FS.file_inventory(spark, str(tmp_path), digest=True).collect()}
    for name in ("lines.jsonl", "one.json"):
        content = (tmp_path / name).read_bytes()
        assert (listed[name].size_bytes, listed[name].sha256) == (len(content), hashlib.sha256(content).hexdigest())


def test_engine_text_rounds_the_binary_value(spark):
    from marketlens.functions.text import engine_text
    values = [6650, 1150, 1250, 2450, 3550, 100, 995, 6750, 5049, 999999]
    rows = spark.createDataFrame([(v, str(v)) for v in values], "v long, c string").withColumn("e", engine_text(F.col("c"))).collect()
    assert all(r.e == f"{round(r.v / 1000, 1)}L" for r in rows), rows


def test_vin_claims_of_any_shape(spark):
    vin = "1FTAAAAAAAAAAAAA1"
    deep: object = {"vin": vin}
    for _ in range(40):
        deep = [{"a": deep}]
    payloads = [
        json.dumps({"vin": {"vin": vin}}), json.dumps({"vin": [vin, None, 1.5, {"x": 1}]}), json.dumps({"description": "d" * 50_000, "VIN": vin}),
        '{"vin": "\\u0031FTAAAAAAAAAAAAA1"}', json.dumps(deep), '{"vin": "\\ud800"}', "no json", None, json.dumps({"vin": 12})]
    df = spark.createDataFrame(list(enumerate(payloads)), "i int, p string")
    got = [tuple(r.e)[:2] for r in N.vin_claims(df, "p").select("i", vin_evidence(F.col("vin_claims")).alias("e")).orderBy("i").collect()]
    valid, invalid, none = "source_reported_format_valid_unverified", "source_reported_invalid_format_unverified", "not_reported"
    assert got == [(None, none), (vin, valid), (vin, valid), (vin, valid), (vin, valid), (None, invalid), (None, none), (None, none), (None, invalid)]


def test_payloads_of_any_depth(spark):
    deep: object = {"vin": ["1FTAAAAAAAAAAAAA1", 7]}
    for i in range(60):
        deep = [deep] if i % 2 else {"a": deep}
    rows = [(1, json.dumps(deep)), (2, '{"vin": 5}'), (3, None), (4, "no json"), (5, '{"b": 1, "a": {"vin": "x", "vin": "y"}}'), (6, '{"vin": [[1], true, " q "]}'), (6, '{"vin": [[1], true, " q "]}')]
    df = spark.createDataFrame([(i, p, 0) for i, p in rows], "i int, p string, name int")
    claims = sorted((r.i, r.vin_claims) for r in N.vin_claims(df, "p").collect())
    assert claims == [(1, ["1FTAAAAAAAAAAAAA1", "7"]), (2, ["5"]), (3, []), (4, []), (5, ["y"]), (6, ["True", "q"]), (6, ["True", "q"])]
    leaves = {r.i: r.leaves for r in N.payload_leaves(df, "p").collect()}
    path = "[0].a" * 30 + ".vin"
    assert leaves[1] == f"{path}[0]=1FTAAAAAAAAAAAAA1 | {path}[1]=7"
    assert (leaves[2], leaves[3], leaves[4], leaves[5]) == ("vin=5", None, None, "a.vin=y | b=1")
    assert N.vin_claims(df.limit(0), "p").count() == 0
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") == "false"


def test_structured_data_of_any_depth(spark):
    deep: object = {"@type": "Car", "name": "deep"}
    for _ in range(12):
        deep = [{"@type": "WebPage", "@graph": [deep, {"@type": "Person"}]}]
    html = ld(deep) + ld({"@type": "ItemList", "itemListElement": [{"item": None}, {"item": {"name": "n"}}]}) + ld("[1,]") + ld('{"a": NaN}')
    pages = E.structured_payload(spark.createDataFrame([(1, html), (2, ""), (3, None)], "id int, html string"))
    rows = {r.id: r for r in pages.select("id", F.transform("listings", lambda v: F.to_json(v)).alias("x"), "page_errors").collect()}
    assert [json.loads(x) for x in rows[1].x] == [{"@type": "Car", "name": "deep"}, None, {"name": "n"}]
    assert rows[1].page_errors == ["invalid_json_ld_script:2", "invalid_json_ld_script:3"]
    assert rows[2].x == [] and rows[2].page_errors == [] and not rows[3].x
    assert E.explode_listings(pages).count() == 3


def test_csv_columns_go_by_header_name(spark, tmp_path):
    cols = ["listing_id", "url", "mileage"]
    (tmp_path / "a.csv").write_text("mileage,listing_id,url\n5,A1,http://x\n7,A2,http://y,more\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("\ufefflisting_id,more,url,mileage\nB1,m,http://z,9\nB2\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("listing_id,url\nC1,http://c\nC2,http://c,1\n", encoding="utf-8")
    rows = {r.row.listing_id: (r.row.url, r.row.mileage, r.malformed) for r in SN.read_snapshots(spark, str(tmp_path), cols).collect()}
    assert rows == {"A1": ("http://x", "5", False), "A2": ("http://y", "7", True), "B1": ("http://z", "9", False),
                    "B2": (None, None, False), "C1": ("http://c", None, False), "C2": ("http://c", None, True)}


def test_quoted_records_are_numbered_across_splits(spark, tmp_path):
    import csv
    import io
    import random
    rnd = random.Random(7)
    files = {}
    for name, n, cols in (("a", 400, ["listing_id", "url", "mileage"]), ("b", 90, ["url", "more", "listing_id"]), ("c", 0, ["url", "listing_id"])):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(cols)
        rows = []
        for i in range(n):
            text = rnd.choice(["plain", 'q"uote', "two\nlines", "a,b", '"\n\n"', "", "x" * rnd.randint(1, 60), "é\n" * 5])
            rows.append([f"{name}{i}" if c == "listing_id" else text if c == "url" else str(i) for c in cols])
            writer.writerow(rows[-1])
            if i % 50 == 7:
                out.write("\n")
        files[name] = [dict(zip(cols, r)) for r in rows]
        (tmp_path / f"{name}.csv").write_text(out.getvalue(), encoding="utf-8")
    (tmp_path / "d.csv").write_text('listing_id,url\nd0,x,more\nd1,"never\nclosed\n', encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        found = SN.read_numbered_snapshots(spark, str(tmp_path), ["listing_id", "url", "mileage"])
        rows = {(r.file[-5:-4], r.source_record_index): r for r in found.collect()}
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 492
    for name, want in files.items():
        for i, w in enumerate(want):
            r = rows[name, i]
            assert (r.row.listing_id, r.row.url or "", r.row.mileage, r.malformed) == (w["listing_id"], w["url"], w.get("mileage"), False)
    assert [rows["d", i].malformed for i in (0, 1)] == [True, True]


def test_large_files_are_digested_in_blocks(spark, tmp_path, monkeypatch):
    (tmp_path / "sub dir").mkdir()
    data = {"a.bin": bytes(range(256)) * 50, "sub dir/b é.bin": b"z", "c.bin": b"x" * 9}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    for whole in (0, 10, 10**6):
        listed = {r.path: (r.size_bytes, r.sha256) for r in FS.file_inventory(spark, str(tmp_path), digest=True, whole=whole).collect()}
        assert listed == {f"{tmp_path}/{n}": (len(c), hashlib.sha256(c).hexdigest()) for n, c in data.items()}
    monkeypatch.setattr(FS, "BLOCK_BYTES", 7)
    import pyarrow as pa
    path = f"file:{tmp_path}/a.bin"
    batch = pa.RecordBatch.from_arrays([pa.array([path]), pa.array([1]), pa.array([0], pa.timestamp("us"))], ["path", "length", "modificationTime"])
    assert next(FS.streamed_digests(iter([batch]))).column(3)[0].as_py() == hashlib.sha256(data["a.bin"]).hexdigest()


def test_character_references_equal_the_library(spark):
    texts = ["caf&eacute; &#8217;s &#x27;x&#X27; &copy; 1 &copy 2", "&amp;eacute; &amp;#39; &amp;amp;lt;", "&nbsp;&lt;&gt;&quot;&#39;", "&unknown; &x & && &;",
             "&notit; &notin; &copyfoo; &amp", "&#128512;&#x1F600;&#x80;&#150;&#0000065;", "&#xD800; &#x110000; &#99999999999999999999; &#xFFFFFFFFFFFFFFFFF;",
             "no reference", "", "&NotEqualTilde; &fjlig; &CounterClockwiseContourIntegral;", "&#; &#x; &#65"]
    texts += ["|".join(f"&{n} " for n in html5)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, t string").repartition(2)
    out = {r["i"]: r["u"] for r in df.select("i", html_unescape(F.col("t")).alias("u")).collect()}
    assert out == {-1: None, **{i: html.unescape(t) for i, t in enumerate(texts)}}


def test_diagnostics_decode_references_in_titles_and_text(spark):
    page = "<title>Caf&eacute; &#8211; menu</title><body><p>captch&#97; &copy; it&#x27;s</p></body>"
    row = E.page_diagnostics(spark.createDataFrame([(1, page)], "id int, html string"), "html", "/t").first()
    assert row["page_title"] == "Café – menu" and row["text_sample"] == "Café – menu captcha © it's" and row["block_markers"] == ["captcha"]
