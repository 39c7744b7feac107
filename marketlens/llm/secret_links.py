"""Secret scan with linking of multipart credentials, in DataFrame functions only.

Base findings are assignments, access identifiers and hexadecimal runs. Weak parts, bare tokens of the
length of a secret key and endpoints, say nothing alone: an interval join by scope (code point distance,
in buckets of that width) reports a token where an access identifier is near, and an endpoint where an
identifier and a secret are. Per bucket, complements are reduced to their smallest and largest start, so
the join is linear in the findings.

A text is scanned once. Splitting it at a pattern and extracting the matches gives the lengths between
and of the matches; their running sums are the positions. Findings go by digest of the text, so copies
are worked on once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.session import settle

# The base patterns, in the order of their kinds; group 2 of assign is the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: With their least lengths, which the longest runs keep.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

#: A bare token of 40 characters that holds no identifier and no hexadecimal run, so that nothing is its own complement.
TOKEN = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-]))"
         r"(?![A-Za-z0-9+/]{0,24}AKIA[A-Z0-9]{12})(?![A-Za-z0-9+/]{0,8}[0-9a-f]{32})[A-Za-z0-9+/]{40}")
ENDPOINT = r"\b[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20\"'<>]+"
KINDS = ("assign", "access", "hex", "linked_secret", "linked_endpoint")
SCOPE = 400
MASK = "[REDACTED]"


def _findings(text: Column, kind: str, pattern: str, test: str, value: int = 0) -> Column:
    """kind, number, length before, length and value length of each match; none without a look at arrays if test fails."""
    hits, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else hits
    rows = F.transform(F.arrays_zip(between.alias("b"), hits.alias("h"), values.alias("v")), lambda r, i: F.struct(
        F.lit(kind).alias("kind"), i.cast("int").alias("number"), F.length(r["b"]).alias("gap"), F.length(r["h"]).alias("size"),
        F.length(r["v"]).alias("value")))
    return F.when(text.rlike(test), F.filter(rows, lambda r: r["size"].isNotNull())).otherwise(
        F.array().cast("array<struct<kind:string,number:int,gap:int,size:int,value:int>>"))


def _found(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, key (digest of a text with findings, else null) and findings of each row."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    every = F.concat(
        _findings(text, "assign", ASSIGN, ASSIGN, 2), _findings(text, "access", ACCESS, ACCESS),
        _findings(text, "hex", HEX, HEX), _findings(text, "token", TOKEN, TOKEN),
        _findings(text, "endpoint", ENDPOINT, "://"))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("digest"), every.alias("parts"))
    return rows.select("doc_id", F.when(F.size("parts") > 0, F.col("digest")).alias("key"), "parts")


def _near(weak: DataFrame, complements: DataFrame, scope: int) -> DataFrame:
    """Rows of weak (key, start, ...) with a complement (key, start) within the scope in the same text."""
    bucket = lambda c: F.floor(c / F.lit(scope)).cast("long")
    ends = complements.groupBy("key", bucket(F.col("start")).alias("bucket")).agg(F.min("start").alias("low"), F.max("start").alias("high"))
    b = bucket(F.col("start"))
    reach = weak.withColumn("bucket", F.explode(F.array(b - 1, b, b + 1)))
    within = (F.col("low").between(F.col("start") - scope, F.col("start") + scope)) | (
        F.col("high").between(F.col("start") - scope, F.col("start") + scope))
    return reach.join(ends, ["key", "bucket"]).where(within).select(*weak.columns).distinct()


def _spans(found: DataFrame, scope: int) -> DataFrame:
    """key, kind, start and end of all findings that are reported."""
    parts = found.where("key is not null").select("key", F.explode("parts").alias("p")).select("key", "p.*").distinct()
    before = W.partitionBy("key", "kind").orderBy("number").rowsBetween(W.unboundedPreceding, 0)
    placed = settle(parts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before).cast("long")).withColumn(
        "start", F.col("end") - F.col("size")))
    enough = F.lit(False)
    for kind, least in LEAST.items():
        enough = enough | ((F.col("kind") == kind) & (F.col("value") >= least))
    base = placed.where(enough).select("key", "kind", "start", "end")
    tokens = placed.where("kind = 'token'").select("key", "start", "end")
    endpoints = placed.where("kind = 'endpoint'").select("key", "start", "end")
    identifiers = base.where("kind = 'access'").select("key", "start")
    linked = _near(tokens, identifiers, scope)
    secrets = base.where("kind = 'assign'").select("key", "start").union(linked.select("key", "start"))
    ends = _near(_near(endpoints, identifiers, scope), secrets, scope)
    return base.unionByName(linked.withColumn("kind", F.lit("linked_secret"))).unionByName(ends.withColumn("kind", F.lit("linked_endpoint")))


def _listed(spans: DataFrame) -> DataFrame:
    """Per key: number of base kinds, the sorted spans as text, and their bounds."""
    rank = F.lit(len(KINDS))
    for i, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind, F.lit(i)).otherwise(rank)
    row = F.struct("start", rank.alias("rank"), "end", "kind")
    grouped = spans.groupBy("key").agg(F.array_sort(F.collect_list(row)).alias("rows"), *[
        F.sum((F.col("kind") == kind).cast("long")).alias(f"n_{kind}") for kind in LEAST])
    text = lambda rows: F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["kind"], r["start"].cast("string"), r["end"].cast("string"))), ",")
    return grouped.select("key", *[f"n_{k}" for k in LEAST], text(F.filter("rows", lambda r: r["rank"] < len(LEAST))).alias("base"),
                          text(F.col("rows")).alias("spans"), F.transform("rows", lambda r: F.struct(r["start"], r["end"])).alias("bounds"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (kind:start:end by start) of each row of docs.

    Null and empty texts have no findings, the digest of an empty list and empty spans. Repeated rows give
    repeated results; a null id stays null; texts of any length are scanned whole; an empty table gives no rows;
    other columns are not looked at.
    """
    found = settle(_found(docs, id_column, text_column))
    listed = _listed(_spans(found, scope))
    none = [F.lit(0).cast("long").alias(f"n_{k}") for k in LEAST]
    digest = lambda c: F.sha2(c.cast("binary"), 256).alias("base_sha256")
    clean = found.where("key is null").select("doc_id", *none, digest(F.lit("")), F.lit("").alias("spans"))
    marked = found.where("key is not null").select("doc_id", "key").join(listed, "key", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in LEAST],
        digest(F.coalesce("base", F.lit(""))), F.coalesce("spans", F.lit("")).alias("spans"))
    return clean.union(marked)


def redact(docs: DataFrame, text_column: str = "text", scope: int = SCOPE) -> DataFrame:
    """The rows of docs with every reported span replaced by a mask; overlapping spans get one mask.

    A null text stays null; repeated rows are each masked; columns may have any names; an empty table gives no rows.
    """
    found = settle(_found(docs.select(F.lit(None).alias("doc_id"), text_column), "doc_id", text_column))
    bounds = _listed(_spans(found, scope)).select("key", "bounds")
    whole = docs.select(F.struct("*").alias("doc"))
    text = F.col("doc")[text_column].cast("string")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    step = lambda a, s: F.when(s["start"] >= a["at"], F.struct(
        F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(MASK)).alias("out"),
        s["end"].alias("at"))).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))
    cut = F.aggregate("bounds", start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    keyed = whole.withColumn("key", F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)).join(bounds, "key", "left")
    return keyed.select(*[F.when(F.col("bounds").isNotNull(), cut).otherwise(text).alias(c) if c == text_column else F.col("doc")[c].alias(c) for c in docs.columns])
