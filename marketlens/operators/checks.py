"""Cross-table consistency: id sets, row contracts, count drift, contiguity, change gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.text import codes_in_order


def id_set_difference(output: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only. Keys are made distinct before the join, so hot keys shuffle once."""
    left = output.select(*keys).distinct().withColumn("_l", F.lit(True))
    right = evidence.select(*keys).distinct().withColumn("_r", F.lit(True))
    return left.join(right, keys, "full").where("_l is null or _r is null").select(
        *keys, F.when(F.col("_r").isNull(), F.lit("not_in_underlying_evidence"))
        .otherwise(F.lit("missing_from_output")).alias("violation"))


def row_contracts(rows: DataFrame, show: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """One row per broken rule; a rule that evaluates to NULL counts as broken."""
    broken = codes_in_order(*[(~F.coalesce(ok, F.lit(False)), code) for code, ok in rules])
    return rows.select(*show, F.explode(broken).alias("violation"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or are empty (combined before the shuffle)."""
    empty = F.lit(False)
    for k in keys:
        empty = empty | F.col(k).isNull() | (F.col(k).cast("string") == "")
    return rows.groupBy(*keys).agg(F.count("*").alias("occurrences")) \
        .where(empty | (F.col("occurrences") > 1))


def question_faults(records: DataFrame, key: str) -> DataFrame:
    """Empty question lists and questions with an empty field."""
    parts = ("category", "priority", "question", "reason")
    entries = records.select(key, F.posexplode_outer("questions").alias("position", "q"))
    blank = F.lit(False)
    for p in parts:
        blank = blank | (F.coalesce(F.trim(F.col("q")[p]), F.lit("")) == "")
    fault = F.when(F.col("position").isNull(), F.lit("question_list_missing_or_empty")) \
        .when(blank, F.lit("question_entry_invalid"))
    return entries.withColumn("violation", fault).where("violation is not null").drop("q")


def count_drift(summary: DataFrame, rows: DataFrame, keys: list[str], stated: str) -> DataFrame:
    """Keys whose stated count differs from the counted rows."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("counted_rows"))
    return summary.select(*keys, F.col(stated).alias("stated_rows")).join(counted, keys, "full") \
        .where(F.coalesce("stated_rows", F.lit(0)) != F.coalesce("counted_rows", F.lit(0)))


def index_faults(records: DataFrame, keys: list[str], index: str,
                 constant: list[str] | None = None) -> DataFrame:
    """Keys whose record index is not 0..n-1 without gaps, or whose constants vary."""
    distinct = records.groupBy(*keys, index).agg(
        F.count("*").alias("_n"),
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f"_{c}") for c in constant or []])
    per_key = distinct.groupBy(*keys).agg(
        F.sum("_n").alias("record_count"), F.count("*").alias("_distinct"),
        F.min(index).alias("_lo"), F.max(index).alias("_hi"),
        *[(F.min(f"_{c}.lo") == F.max(f"_{c}.hi")).alias(f"_same_{c}") for c in constant or []])
    faults = codes_in_order(
        (F.col("_distinct") != F.col("record_count"), "record_index_repeated"),
        ((F.col("_lo") != 0) | (F.col("_hi") != F.col("_distinct") - 1), "record_index_discontinuity"),
        *[(~F.coalesce(F.col(f"_same_{c}"), F.lit(True)), f"{c}_mismatch") for c in constant or []])
    return per_key.select(*keys, "record_count", F.explode(faults).alias("violation"))


def gate_by_changes(changed: DataFrame, violations: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Violations of the given checks restricted to changed keys."""
    touched = changed.select(*keys).distinct()
    out: DataFrame | None = None
    for name, found in violations.items():
        hit = found.join(touched, keys, "left_semi").select(
            *keys, F.lit(name).alias("check"), F.col("violation"))
        out = hit if out is None else out.unionByName(hit)
    if out is None:
        raise ValueError("no checks given")
    return out
