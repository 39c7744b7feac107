"""Fetched-page, fetch-log, snapshot-text and claim-text queries."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import rules as R
from marketlens.functions.payload import source_text
from marketlens.functions.text import C1, REFERENCE, SHORT
from marketlens.operators import extract as E
from marketlens.operators.nodes import payload_leaves
from marketlens.plans.bindings import table
from marketlens.plans.registry import query
from marketlens.session import spread
from marketlens.sources import files as FS
from marketlens.sources import snapshots as SN

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Distinct references of the pages with the text they stand for, and all of them as one map.
REFERENCES_SQL = f"""
names(name, value) as (values {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(html5.items()))}),
refs as (select distinct unnest(regexp_extract_all(html, {_quoted(REFERENCE)})) as r from pages),
parts as (select r, substr(r, 2) as name, regexp_extract(substr(r, 2), '^(?:{SHORT})') as short,
  regexp_extract(r, '^&#[xX]?0*([0-9a-fA-F]+)', 1) as digits, regexp_matches(r, '^&#[xX]') as hexadecimal from refs),
codes as (select *, case when not starts_with(r, '&#') then null when length(digits) > 8 then 65533
  when hexadecimal then ('0x' || digits)::bigint else digits::bigint end as code from parts),
decoded as (select r, case
    when code is null then coalesce(f.value, s.value || substr(c.name, length(c.short) + 1), r)
    when code > 1114111 or code between 55296 and 57343 then chr(65533)
    else translate(chr(code::int), {_quoted("".join(C1))}, {_quoted("".join(C1.values()))}) end as t
  from codes c left join names f on f.name = c.name left join names s on s.name = c.short),
dm as (select map(list(r), list(t)) as m from decoded)
"""


def unescaped_sql(text: str) -> str:
    """The text with its references decoded once; needs dm in scope."""
    between, found = f"string_split_regex({text}, {_quoted(REFERENCE)})", f"regexp_extract_all({text}, {_quoted(REFERENCE)})"
    return f"array_to_string(list_transform(list_zip({between}, {found}), lambda p: p[1] || coalesce(m[p[2]], '')), '')"


SPACES_SQL = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
STRIPPED_SQL = f"""
{REFERENCES_SQL},
shown as (
  select page_id, url, html, m,
    array_to_string(list_filter(list_transform(string_split(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
        '(?is)<script\\b[^>]*>.*?</script\\s*>', chr(1), 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', chr(1), 'g'),
        '(?is)<noscript\\b[^>]*>.*?</noscript\\s*>', chr(1), 'g'), '(?is)<template\\b[^>]*>.*?</template\\s*>', chr(1), 'g'),
        '(?s)<!--.*?-->', chr(1), 'g'), '(?s)<[^>]*>', chr(1), 'g'), chr(1)),
      lambda n: trim({unescaped_sql("n")}, {SPACES_SQL})),
      lambda n: n <> ''), ' ') as visible
  from pages, dm)
"""


@query("page_diagnostics", f"""
with {STRIPPED_SQL}
select page_id, cast(octet_length(encode(html)) as bigint) as response_bytes, sha256(html) as response_sha256,
       trim({unescaped_sql("regexp_extract(html, '(?is)<title" + chr(92) + "b[^>]*>(.*?)</title" + chr(92) + "s*>', 1)")}, {SPACES_SQL}) as page_title,
       cast(len(regexp_extract_all(html, '(?is)<script\\b')) as bigint) as script_count,
       false as next_data_present, contains(lower(html), 'itemlistelement') as item_list_marker_present,
       cast(len(list_distinct(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda h: contains(h, '/t')))) as bigint) as listing_link_count,
       concat_ws(';', case when contains(lower(visible), 'captcha') then 'captcha' end, case when contains(lower(visible), 'cloudflare') then 'cloudflare' end) as block_markers,
       visible[1:1000] as text_sample
from shown
""")
def page_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return E.page_diagnostics(spread(table(spark, d, "pages")), "html", "/t").select(
        "page_id", "response_bytes", "response_sha256", "page_title", "script_count", "next_data_present",
        "item_list_marker_present", "listing_link_count",
        F.array_join("block_markers", ";").alias("block_markers"), "text_sample")


def fetch_log(spark: SparkSession, d: str) -> DataFrame:
    """Conversations read as result pages: one query per conversation, one page per turn."""
    c = table(spark, d, "conversations")
    n = F.length("text") % 60
    return c.select(
        F.lit("run-1").alias("run_id"), F.col("conv_id").alias("query_id"), F.col("turn").alias("page"),
        "role", F.lower("text").alias("listings"), n.cast("bigint").alias("listing_count"),
        (F.col("turn") * 50).alias("offset"),
        F.when(F.col("conv_id") % 2 == 0, F.length("text") % 300).cast("bigint").alias("reported_total"),
        F.when(F.length("text") % 11 == 0, F.lit("failed")).otherwise(F.lit("success")).alias("outcome"),
        F.sequence(F.lit(1), (F.length("text") % 3 + 1)).alias("attempts"))


LOG_SQL = """
fl as (
  select conv_id as query_id, turn as page, role, lower(text) as listings, length(text) % 60 as listing_count,
         turn * 50 as ofs, case when conv_id % 2 = 0 then length(text) % 300 end as reported_total,
         length(text) % 11 = 0 as failed, length(text) % 3 + 1 as attempts from conversations),
lg as (
  select *, case when listing_count > 0 and listings = lag(listings) over (partition by query_id order by page) then 'repeated_page_payload' end as repeat_stop_reason,
         case when reported_total is not null and ofs + listing_count >= reported_total then 'reported_total_reached'
              when listing_count < 50 then 'short_page' end as stop_reason from fl)
"""


def stopped_log(spark: SparkSession, d: str) -> DataFrame:
    log = E.repeated_pages(fetch_log(spark, d), ["run_id", "query_id"], "page", F.sha2("listings", 256),
                           "listing_count", "repeated_page_payload")
    return log.withColumn("stop_reason", E.stop_reason_by_total(
        F.col("offset"), F.col("listing_count"), F.col("reported_total"), 50))


@query("page_stop_reasons", f"""
with {LOG_SQL}
select query_id, page, repeat_stop_reason, stop_reason,
       case when listing_count = 0 then 'empty_page' when listing_count < 40 then 'short_page' end as size_stop_reason from lg
""")
def page_stop_reasons(spark: SparkSession, d: str) -> DataFrame:
    return stopped_log(spark, d).select(
        "query_id", "page", "repeat_stop_reason", "stop_reason",
        E.stop_reason_by_size(F.col("listing_count"), 40).alias("size_stop_reason"))


@query("query_completeness", f"""
with {LOG_SQL},
z as (select *, row_number() over (partition by query_id order by page desc) as k from lg)
select query_id, page as last_page, coalesce(repeat_stop_reason, stop_reason, case when page >= 5 then 'max_pages_reached' end) as final_stop_reason,
       repeat_stop_reason is null and stop_reason is not null as query_complete
from z where k = 1
""")
def query_completeness(spark: SparkSession, d: str) -> DataFrame:
    return E.query_completeness(stopped_log(spark, d), ["query_id"], "page", 5)


@query("fetch_rollup", f"""
with {LOG_SQL},
z as (select query_id, arg_max(repeat_stop_reason is null and stop_reason is not null, page) as ok from lg group by all)
select role, count(*) as page_request_count, cast(sum(attempts) as bigint) as request_attempt_count,
       count(*) filter (not failed) as successful_page_count, count(*) filter (failed) as failed_page_count,
       bool_and(ok) and count(*) filter (failed) = 0 as pagination_complete
from lg join z using (query_id) group by role
""")
def fetch_rollup(spark: SparkSession, d: str) -> DataFrame:
    log = stopped_log(spark, d)
    done = E.query_completeness(log, ["query_id"], "page", 5).select("query_id", "query_complete")
    return E.fetch_rollup(log.join(done, "query_id"), ["role"])


# --- text rules over documents ------------------------------------------------------------------------

# Patterns that occur in the documents, as a rule table.
DOCUMENT_RULES = (
    ("license_claim", (r"released under the (?:mit|apache|bsd) license", r"\blicensed under\b")),
    ("secret_claim", (r"\bapi[_-]?key\b", r"\bpassword\b", r"\bsecret\b")),
    ("contact_claim", (r"[a-z0-9.]+@[a-z0-9]+\.example\.com", r"\bphone\b")),
    ("number_claim", (r"[0-9]{3,}",)),
)


@query("text_rule_claims", """
with x as (
  select doc_id, regexp_matches(text, '(?i)released under the (mit|apache|bsd) license|licensed under') as a,
         regexp_matches(text, '(?i)api[_-]?key|password|secret') as b,
         regexp_matches(text, '(?i)[a-z0-9.]+@[a-z0-9]+\\.example\\.com|phone') as c,
         regexp_matches(text, '[0-9]{3,}') as e,
         regexp_extract(text, '(?i)released under the (mit|apache|bsd) license') as lm from documents)
select doc_id, case when a then 'license_claim' when b then 'secret_claim' when c then 'contact_claim' when e then 'number_claim' end as first_label,
       concat_ws(';', case when c then 'contact_claim' end, case when a then 'license_claim' end, case when e then 'number_claim' end, case when b then 'secret_claim' end) as labels,
       case when lm <> '' then lm end as license_text
from x
""")
def text_rule_claims(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents against a rule table: first label, all labels, matched words."""
    text = F.col("text")
    return spread(table(spark, d, "documents")).select(
        "doc_id", R.first_label(text, DOCUMENT_RULES).alias("first_label"),
        F.array_join(R.labels(text, DOCUMENT_RULES), ";").alias("labels"),
        R.first_match(text, [("license", (DOCUMENT_RULES[0][1][0],))]).alias("license_text"))


@query("payload_source_text", """
with k as (select *, replace(replace(props, '{"k": ', ''), '}', '') as k from events)
select event_id, event_type || ' | k=' || k as source_text,
       'a[0]=' || event_id || ' | a[1].t=' || event_type || ' | a[2][0].k=' || k || ' | b=x | z.k=' || k as nested_text from k
""")
def payload_source_text(spark: SparkSession, d: str) -> DataFrame:
    """Leaves of the payload as it is, and of one that holds it in objects and lists."""
    nested = F.concat(F.lit('{"z":'), "props", F.lit(',"b":" x","a":['), F.col("event_id").cast("string"), F.lit(',{"t":"'), "event_type",
                      F.lit('"},['), "props", F.lit(',true,null," ",[]]]}'))
    rows = payload_leaves(table(spark, d, "events").select("event_id", "event_type", "props", nested.alias("nested")), "props")
    return payload_leaves(rows, "nested", "nested_text").select(
        "event_id", source_text([F.col("event_type"), F.lit("N/A")], F.col("leaves")).alias("source_text"), "nested_text")


# --- snapshot lines and files -----------------------------------------------------------------------

@query("snapshot_lines", """
select c_custkey, case when c_nationkey % 5 = 0 then 'malformed_column_count' else '' end as failures,
       case when c_nationkey % 5 > 0 then c_name end as name,
       case when c_nationkey % 5 > 0 and c_nationkey % 5 <> 1 then c_mktsegment || ', "x"' end as segment
from customer
""")
def snapshot_lines(spark: SparkSession, d: str) -> DataFrame:
    """CSV lines with quoted, short and overlong rows: only overlong rows are malformed."""
    line = F.concat_ws(",", F.col("c_name"), F.when(
        F.col("c_nationkey") % 5 != 1, F.concat(F.lit('"'), "c_mktsegment", F.lit(', ""x"""'))),
        F.when(F.col("c_nationkey") % 5 == 0, F.lit("extra")))
    lines = table(spark, d, "customer").select("c_custkey", line.alias("line"))
    out = SN.parse_lines(lines, "line", ["name", "segment"])
    ok = ~F.col("malformed")
    return out.select(
        "c_custkey", F.when(ok, F.lit("")).otherwise(F.lit("malformed_column_count")).alias("failures"),
        F.when(ok, F.col("row.name")).alias("name"), F.when(ok, F.col("row.segment")).alias("segment"))


@query("json_line_objects", """
select event_id, case when user_id % 10 = 0 then 'not_a_json_object' when user_id % 10 = 1 then 'invalid_json' end as fault,
       case when user_id % 10 > 1 then cast(replace(replace(props, '{"k": ', ''), '}', '') as bigint) end as k
from events where user_id % 10 <> 2
""")
def json_line_objects(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines: blank lines are skipped, other values than objects are faults."""
    text = F.when(F.col("user_id") % 10 == 0, F.concat(F.lit("["), "props", F.lit("]"))) \
        .when(F.col("user_id") % 10 == 1, F.concat("props", F.lit("}"))) \
        .when(F.col("user_id") % 10 == 2, F.lit("  ")).otherwise(F.col("props"))
    lines = table(spark, d, "events").select("event_id", text.alias("line"))
    out = SN.parse_json_lines(lines, "line")
    return out.select("event_id", "fault", F.try_variant_get("record", "$.k", "bigint").alias("k"))


@query("required_column_gate", """
select c_custkey as file, case when c_nationkey % 3 = 0 then 'mileage;price' when c_nationkey % 3 = 1 then 'price' else '' end as missing_columns,
       c_nationkey % 3 = 2 as schema_valid
from customer
""")
def required_column_gate(spark: SparkSession, d: str) -> DataFrame:
    """Header check per snapshot; one header line per customer."""
    header = F.when(F.col("c_nationkey") % 3 == 0, F.lit("listing_id,url")) \
        .when(F.col("c_nationkey") % 3 == 1, F.lit("﻿listing_id,url,mileage")) \
        .otherwise(F.lit("url,listing_id,price,mileage,extra"))
    lines = table(spark, d, "customer").select(F.col("c_custkey").alias("file"), header.alias("header"))
    return SN.required_columns(lines, "header", ["listing_id", "url", "price", "mileage"]).select(
        "file", F.array_join("missing_columns", ";").alias("missing_columns"), "schema_valid")


@query("file_inventory")
def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The table files themselves: name, size and content digest."""
    return FS.file_inventory(spark, d, digest=True).select("name", "size_bytes", "sha256")
