from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

import corpus_pipeline
from marketlens.llm import cover_tree, queries, warc
from marketlens.session import shared_path

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, payload string, refers_to long"
LONG = "<p>" + "payload \r\n\r\nWARC/1.1\r\n" * 20 + "</p>"
ROWS = [(1, "http://a/1", LONG, "x", 9), (2, "http://a/2\r\nX: y", LONG, "x", 9), (3, None, None, "x", 9), (4, "u", "", "x", 9), (5, "u", "short", "x", 9),
        (6, "u", "short", "x", 9), (7, "u", "é" * 50, "x", 9), (8, "u", "é" * 50, "x", 9), (8, "u", "é" * 50, "x", 9), (None, "u", LONG, "x", 9),
        (0, "u", "z" * 200_000, "x", 9)]


def test_warc_round_trip_and_revisits(spark):
    path = shared_path(spark, "warc")
    records = warc.payloads(spark.createDataFrame(ROWS, PAGES).repartition(3))
    warc.write_archive(warc.deduplicated(records), path, per_file=2)
    read = warc.read_archive(spark, path)
    rows = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.resolved(read).collect()}
    size = lambda t: len((t or "").encode())
    want = {(p, "response", None, size(h)) for p, _, h, *_ in ROWS if p in (0, 1, 3, 4, 5, 6, 7)}
    want |= {(2, "revisit", 1, size(LONG)), (None, "revisit", 1, size(LONG)), (8, "revisit", 7, 100)}
    assert rows == want and read.count() == len(ROWS)
    for r in read.where("payload is not null").collect():
        assert hashlib.sha256(r["payload"].encode()).hexdigest() == r["payload_digest"]


def test_warc_archives_are_resolved_again(spark):
    first, second = shared_path(spark, "warc"), shared_path(spark, "warc")
    plain = warc.payloads(spark.createDataFrame(ROWS, PAGES))
    warc.write_archive(plain.selectExpr("*", "cast(null as long) refers_to"), first)
    archive = warc.read_archive(spark, first)
    assert archive.where("record_type = 'revisit'").count() == 0
    warc.write_archive(warc.deduplicated(archive.select("page_id", "url", "payload", "payload_bytes", "payload_digest")), second)
    assert warc.read_archive(spark, second).where("record_type = 'revisit'").count() == 4


def test_warc_records_come_in_blocks():
    payloads = [b"", b"\r\n", b"x\r\n\r\nWARC/1.1\r\n", b"y" * 5000, b"\r\n\r\n\r\n", "é\r".encode()]
    data = b"".join(b"WARC/1.1\r\nA: %d\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(p), p) for i, p in enumerate(payloads))
    for size in (1, 3, 7, 1000, len(data)):
        found = list(warc.parse(data[k:k + size] for k in range(0, len(data), size)))
        assert [p for _, p in found] == payloads and [f["A"] for f, _ in found] == [str(i) for i in range(len(payloads))]
    for bad in (data[:-5], data.replace(b"Content-Length: 5000", b"Content-Length: 4999"), b"HTTP/1.1\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse([bad]))


def test_warc_payloads_with_separators(spark):
    texts = ["\r\n\r\n", "a\r\n", "a\r\n\r\n", "\r", "\r\n\r\nb" * 50, "", "\n\r\n\r\n\r", "x" * 3_000_000]
    path = shared_path(spark, "warc")
    records = warc.payloads(spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts)], "page_id long, url string, html string"))
    warc.write_archive(warc.deduplicated(records), path, per_file=3)
    assert {r["page_id"]: r["payload"] for r in warc.read_archive(spark, path).collect()} == dict(enumerate(texts))


def test_warc_empty(spark):
    path = shared_path(spark, "warc")
    warc.write_archive(warc.deduplicated(warc.payloads(spark.createDataFrame([], PAGES))), path)
    assert warc.resolved(warc.read_archive(spark, path)).count() == 0


def vectors():
    rnd = np.random.default_rng(8)
    rows = [(0, None, 1), (1, [0.0] * 8, 1), (2, [math.nan] + [1.0] * 7, 1), (3, [1.0] * 7 + [None], 1), (4, [], 1), (5, [math.inf] + [1.0] * 7, 1),
            (6, [1.0] * 8, None), (7, [1.0] * 8, 2), (8, [2.0] * 8, 2), (9, [1.0] * 9, 2), (10, [1.0] * 8, 3)]
    centres = rnd.normal(size=(12, 8))
    for i in range(400):
        v = centres[i % 12] + rnd.normal(size=8) * (0.02 if i % 3 else 0.6)
        rows.append((20 + i, v.tolist(), int(i % 2)))
    rows += [(500, rows[50][1], rows[50][2]), (500, rows[50][1], rows[50][2]), (None, [1.0] * 8, 2)]
    return rows


def plain(rows):
    seen = {}
    for i, v, label in rows:
        if i is not None:
            seen[i] = (v, label)
    ok = {i: (np.array(v), label) for i, (v, label) in seen.items()
          if v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links, parent = {i: 0 for i in seen}, {i: i for i in seen}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(ok)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (v, x), (w, y) = ok[a], ok[b]
            if x == y and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[a] += 1
                links[b] += 1
                p, q = sorted((top(a), top(b)))
                parent[q] = p
    return {(i, links[i], top(i), i == top(i)) for i in seen} | {(None, 0, None, True)}


def test_cover_tree_equals_all_pairs(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as chunk", "'x' as size", "2 as n")
    for chunk in (7, 60, 2048):
        assert {tuple(r) for r in cover_tree.near_embeddings(df, chunk=chunk).collect()} == plain(rows)
    assert cover_tree.near_embeddings(df.limit(0)).count() == 0


def test_cover_tree_levels():
    x = np.random.default_rng(1).normal(size=(300, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    levels = cover_tree.build(x, 0.1)
    for k, level in enumerate(levels):
        d = np.linalg.norm(x - x[level.centre[level.node]], axis=1)
        assert (d <= 2.0 / 2 ** k + 1e-6).all() and (d <= level.radius[level.node] + 1e-6).all()
        if k:
            assert set(levels[k - 1].centre) <= set(level.centre)
            assert (level.parent[level.node] == levels[k - 1].node).all()


def test_pipeline_stages(spark):
    folder = FOLDER
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", None, 0)], docs.schema)
    before = docs.union(odd)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        if name in ("quality rules", "n-gram jaccard join"):
            assert 0 < after.count() <= before.count()
        if name == "secret scans":
            assert after.count() == before.count() and after.where("text rlike 'AKIA[A-Z0-9]{12}'").count() == 0
        before = after
    assert before.where("not round_trip").count() == 0


def test_queries_return_whole_tables(spark):
    folder = FOLDER
    for name, table in (("op2_license_scan", "documents"), ("op4_warc_revisits", "pages"), ("op6_cover_tree", "embeddings"), ("op10_secret_links", "documents")):
        assert queries.QUERIES[name](spark, folder=FOLDER).count() == spark.read.parquet(f"{folder}/{table}.parquet").count()
