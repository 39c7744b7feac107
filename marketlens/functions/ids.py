"""Stable identifiers and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZERO_DIGEST = "0" * 64
UNIT_SEPARATOR = "\x1f"


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix_`` + 24 hex digits of SHA-256 over the parts; NULL parts count as ''."""
    values = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    digest = F.sha2(F.concat_ws(UNIT_SEPARATOR, *values), 256)
    return F.concat(F.lit(f"{prefix}_"), F.substring(digest, 1, 24))


def chain_digest(payloads: Column, seed: Column | None = None) -> Column:
    """Fold an ordered array of JSON texts into one digest: d = sha256(bytes(d) || text).

    For groups that are bounded by construction only (price history of one listing).
    """
    start = F.lit(ZERO_DIGEST) if seed is None else seed
    return F.aggregate(
        payloads, start, lambda d, x: F.sha2(F.concat(F.unhex(d), F.encode(x, "utf-8")), 256)
    )


def set_digest(df: DataFrame, keys: list[str], payload: Column, name: str) -> DataFrame:
    """Order-free digest of an unbounded record set per key, computed in two bounded levels.

    Equal payloads are counted first, digests are chained inside 65,536 hash buckets, and the
    bucket digests are chained per key, so no task ever holds a whole key.
    """
    hashed = df.select(*keys, F.sha2(payload, 256).alias("_h")).groupBy(*keys, "_h").count()
    entry = F.concat_ws(":", "_h", F.col("count").cast("string"))
    buckets = (
        hashed.groupBy(*keys, F.substring("_h", 1, 4).alias("_b"))
        .agg(chain_digest(F.array_sort(F.collect_list(entry))).alias("_d"))
    )
    return buckets.groupBy(*keys).agg(
        chain_digest(F.transform(
            F.array_sort(F.collect_list(F.struct("_b", "_d"))), lambda s: s["_d"]
        )).alias(name)
    )
