"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.session import settle

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 of a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target and rate of each source of sizes (source, size).

    Sources in code point order, null last, take the weights in turn. A source stops at `most` times its
    size; the rest is shared among the others by weight. Ordered by that limit per weight, the stopped
    sources are the first ones, so one running sum finds them. The only window without a key reads one
    row per source.
    """
    totals = settle(sizes.groupBy("source").agg(F.sum("size").cast("double").alias("source_size")))
    turn = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(turn) - 1) % len(weights) + 1))
    ranked = totals.withColumn("rank", F.row_number().over(turn)).withColumn("weight", pick).withColumn(
        "cap", F.lit(most) * F.col("source_size"))
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = W.partitionBy(F.lit(1))
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    stopped = ranked.withColumn("wanted", F.lit(share) * F.sum("source_size").over(every)).withColumn(
        "free", F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn(
        "stopped", F.col("cap") * F.sum("weight").over(after) <= F.col("free") * F.col("weight"))
    spent = F.sum(F.when(F.col("stopped"), F.col("cap")).otherwise(0.0)).over(every)
    open_weight = F.sum(F.when(F.col("stopped"), 0.0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("stopped"), F.col("cap")).otherwise((F.col("wanted") - spent) * F.col("weight") / open_weight)
    return stopped.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def coin(identity: Column) -> Column:
    """A number in [0, 1) that depends on the identity only."""
    digits = F.substring(F.md5(F.coalesce(identity.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        **options) -> DataFrame:
    """The rows of docs with size, source_size, target and copies, under these names in a struct `mix`.

    copies is floor(rate) plus one with probability equal to the fraction, decided by a hash of the id:
    reruns agree and repeated rows are treated alike. Null texts have size 0; a source without words has
    target and copies 0; null sources are one source, the last. An empty table gives an empty result.
    Sources meet their documents in a join that the planner broadcasts below its threshold and otherwise
    splits where a source is hot.
    """
    sized = docs.select(F.col(source_column).cast("string").alias("source"), word_count(F.col(text_column)).alias("size"))
    targets = settle(source_targets(sized, **options)).select(
        F.struct("source", "source_size", "target", "rate").alias("of_source"))
    named = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))
    joined = named.join(targets, F.col(f"doc.`{source_column}`").cast("string").eqNullSafe(F.col("of_source.source")), "left")
    rate = F.coalesce(F.col("of_source.rate"), F.lit(0.0))
    copies = F.floor(rate) + (coin(F.col(f"doc.`{id_column}`")) < rate - F.floor(rate)).cast("long")
    return joined.select("doc", F.struct(
        word_count(F.col(f"doc.`{text_column}`")).alias("size"), F.col("of_source.source_size").alias("source_size"),
        F.col("of_source.target").alias("target"), copies.cast("long").alias("copies")).alias("mix"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as its copies say, with its own columns."""
    return mixed.where("mix.copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("mix.copies").cast("int")))).select("doc.*")
