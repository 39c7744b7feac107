"""Registered queries of the operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (
    context_coding, cover_tree, jaccard_join, language_codes, license_scan, piece_coding, quality_rules, repeated_passages, secret_links,
    source_mix, spelling_groups, vector_codes, warc)
from marketlens.llm.queries_sql import spelling_groups_sql, vector_codes_sql
from marketlens.session import settle, shared_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_piece_coding(spark: SparkSession, folder: str) -> DataFrame:
    return piece_coding.encode(table(spark, folder, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "round_trip", "ids_sha256")


def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "warc")
    records = warc.payloads(table(spark, folder, "pages"))
    headers = settle(records.select("page_id", "payload_bytes", "payload_digest"))
    warc.write_archive(warc.deduplicated(records, headers), path, per_file=warc.records_per_file(headers))
    return warc.resolved(warc.read_archive(spark, path, with_payload=False))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    judged = quality_rules.judge(docs.select("doc_id", "text"), quality_rules.references(docs))
    return judged.select(F.col("doc.doc_id").alias("doc_id"), "quality.*")


def op6_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_embeddings(table(spark, folder, "embeddings"))


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select(F.col("doc.doc_id").alias("doc_id"), "mix.size", "mix.source_size", "mix.target",
                        (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages.strip_repeats(table(spark, folder, "documents")).drop("kept_text")


def op9_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_codes.fit(docs.where(~language_codes.held_out("doc_id")))
    return language_codes.identify(docs, model)


def op10_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    return secret_links.scan(table(spark, folder, "documents"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op12_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups.group(table(spark, folder, "documents"))


def op13_context_coding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return context_coding.score(docs, docs.where(~context_coding.held_out("doc_id")))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_license_scan, op3_piece_coding, op4_warc_revisits, op5_quality_rules, op6_cover_tree,
    op7_source_mix, op8_repeated_passages, op9_language_codes, op10_secret_links,
    op11_vector_codes, op12_spelling_groups, op13_context_coding)}

SQL: dict[str, str] = {
    "op11_vector_codes": vector_codes_sql(),
    "op12_spelling_groups": spelling_groups_sql(),
    "op4_warc_revisits": """
with d as (select page_id, octet_length(encode(coalesce(html, ''))) as b, sha256(coalesce(html, '')) as g from pages),
f as (select g, min(page_id) as m from d where b >= 100 group by g)
select d.page_id, d.b as payload_bytes, d.g as payload_digest,
       case when f.m is not null and d.page_id <> f.m then 'revisit' else 'response' end as record_type,
       case when d.page_id <> f.m then f.m end as refers_to
from d left join f on d.g = f.g and d.b >= 100
""",
    "op7_source_mix": r"""
with w as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
t as (select source, sum(size)::double as s from w group by source),
r as (select *, row_number() over (order by source nulls last) as n from t),
k as (select *, [3.0, 1.0, 2.0][(n - 1) % 3 + 1]::double as wt, 2.0 * s as cap from r),
o as (select *, 1.5 * sum(s) over () - coalesce(sum(cap) over (order by cap / wt, n rows between unbounded preceding and 1 preceding), 0) as free,
             sum(wt) over (order by cap / wt, n rows between current row and unbounded following) as rest from k),
p as (select *, cap * rest <= free * wt as stopped from o),
q as (select source, s, case when stopped then cap else
        (1.5 * sum(s) over () - sum(case when stopped then cap else 0 end) over ()) * wt / sum(case when stopped then 0 else wt end) over () end as target from p),
c as (select w.doc_id, w.size, q.s, q.target, case when q.s > 0 then q.target / q.s else 0 end as rate,
             ('0x' || substr(md5(coalesce(w.doc_id::varchar, '')), 1, 8))::bigint / 4294967296.0::double as coin
      from w join q on w.source is not distinct from q.source)
select doc_id, size::bigint as size, s::bigint as source_size, target::double as target,
       (size * (floor(rate) + case when coin < rate - floor(rate) then 1 else 0 end))::bigint as taken from c
""",
    "op8_repeated_passages": r"""
with t as (select row_number() over () as id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select id, unnest(range(1, len(ws) - 33)) as a from t where len(ws) >= 35),
h as (select s.id, s.a, md5(array_to_string(t.ws[s.a:s.a + 34], ' ')) as g from s join t using (id)),
m as (select g from h group by g having count(*) > 1),
gone as (select distinct id, a + unnest(range(0, 35)) as i from h join m using (g)),
n as (select id, count(*) as n from gone group by id),
e as (select id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from t),
k as (select e.id, string_agg(e.word, ' ' order by e.i) as kept from e anti join gone using (id, i) group by e.id)
select t.doc_id, len(t.ws)::bigint as n_words, coalesce(n.n, 0)::bigint as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from t left join n using (id) left join k using (id)
""",
}
