"""Snapshot CSV, JSON-lines and JSON-object sources; CSV and JSON-lines sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions.payload import strict_json
from marketlens.functions.text import codes_in_order
from marketlens.session import settle, small_side

OVERFLOW = "_overflow"
# Columns a snapshot must have, and all columns it may have.
REQUIRED_COLUMNS = ("listing_id", "url", "source", "price", "mileage", "location", "distance_km")
SNAPSHOT_COLUMNS = (
    "year", "make", "model", "trim", "trim_tier", "price", "price_history", "trend", "weeks_tracked",
    "price_first_seen", "price_last_week", "price_change_week", "price_change_total", "mileage", "engine",
    "fuel", "accident_flag", "days_on_market", "dealer", "seller_type", "dealer_address", "location",
    "distance_km", "distance_method", "listing_id", "url_region_hint", "url_region_status", "url", "source",
)
CSV_OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


MOST_HEADER_TEXT = 8 << 20  # characters of all headers up to which they are sent to every task


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """First line of each file, found at the file head; no file is read on the driver."""
    text = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"))
    return text.where("_at = 0").groupBy("file").agg(F.min_by("value", "_n").alias("header"))


def header_names(header: Column) -> Column:
    """Column names of a header line, without byte-order mark, quotes and line end."""
    return F.transform(F.split(F.regexp_replace(F.rtrim(header), "^﻿", ""), ","), lambda c: F.btrim(c, F.lit('"\r ')))


def read_snapshots(spark: SparkSession, path: str, columns: Sequence[str] = SNAPSHOT_COLUMNS) -> DataFrame:
    """CSV snapshots with a header each, all columns text, plus ``malformed`` and ``file``.

    Columns go by the names in the header of the file: order does not matter, further columns are left
    out, absent ones are NULL. Rows with a filled cell beyond their header are the only malformed ones;
    short rows keep NULLs. Only the widest header's width and the amount of header
    text reach the driver.
    """
    headers = small_side(header_lines(spark, path).select("file", header_names(F.col("header")).alias("_names")))
    width, amount = headers.agg(
        F.max(F.size("_names")), F.sum(F.length("file") + F.length(F.array_join("_names", ",")))).first()
    width = width or len(columns)
    if (amount or 0) <= MOST_HEADER_TEXT:
        headers = F.broadcast(headers)
    cells = [f"_{i}" for i in range(width)]
    raw = spark.read.schema(_strings([*cells, OVERFLOW])).options(
        header="true", enforceSchema="true", **CSV_OPTIONS).csv(path)
    rows = raw.select(F.array(*cells, OVERFLOW).alias("_cells"), F.col("_metadata.file_path").alias("file"))
    named = rows.join(headers, "file")  # rows keep their order where the headers are few enough to be sent

    def cell(name: str) -> Column:
        at = F.array_position("_names", F.lit(name)).cast("int")
        return F.try_element_at("_cells", F.nullif(at, F.lit(0)))

    beyond = F.slice("_cells", F.size("_names") + 1, F.lit(width + 1))
    return named.select(
        F.struct(*[cell(c).alias(c) for c in columns]).alias("row"),
        F.exists(beyond, lambda c: c.isNotNull()).alias("malformed"), "file")


@contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Files are cut into the same splits by all scans that run here, though executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """file, number, text and open of each CSV record; quoted fields may hold line ends, and files are read by many tasks.

    Lines are read from splits of a file. A first pass counts the quotes of each split; their running parity tells whether a split
    begins within quotes. A second pass finds the lines that begin a record and numbers them within their split; only its
    lines are written, and splits count up. Only records of several lines are put together by key. Blank lines between records do
    not count. A record whose quotes never close takes the rest of the file and is marked ``open``.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))
    lines = lines.withColumn("quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))))
    files, split = Window.partitionBy("file").orderBy("at"), Window.partitionBy("file", "at").orderBy("n")
    before = files.rowsBetween(Window.unboundedPreceding, -1)
    with same_splits(spark):
        blocks = lines.groupBy("file", "at").agg(F.sum("quotes").alias("quotes"))
        blocks = small_side(blocks.select("file", "at", F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("_quotes_before")))  # a row per split
        inside = F.col("_quotes_before") + F.sum("quotes").over(split) - F.col("quotes")
        empty = (F.btrim("line", F.lit("\r ")) == "") & (F.col("quotes") == 0)
        begun = settle(lines.join(blocks, ["file", "at"]).withColumn("_outside", inside % 2 == 0).withColumn(
            "begins", F.col("_outside") & ~empty).withColumn("_local", F.sum(F.col("begins").cast("bigint")).over(split)).where(
            "begins or not _outside").drop("_quotes_before", "_outside"), "zstd")
    counts = begun.groupBy("file", "at").agg(F.count_if("begins").alias("records"))
    firsts = small_side(counts.select("file", "at", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("_first")))
    numbered = begun.join(firsts, ["file", "at"]).withColumn("number", F.col("_first") + F.col("_local") - 1)
    whole = F.col("quotes") % 2 == 0
    single = numbered.where("begins").where(whole).select("file", "number", F.col("line").alias("text"), F.lit(False).alias("open"))
    several = numbered.where(~(F.col("begins") & whole)).groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "n", "line"))), lambda x: x["line"]), "\n").alias("text"),
        (F.sum("quotes") % 2 == 1).alias("open"))
    return single.union(several).withColumn("text", F.regexp_replace("text", "\r$", ""))


def read_numbered_snapshots(spark: SparkSession, path: str, columns: Sequence[str] = SNAPSHOT_COLUMNS) -> DataFrame:
    """Rows of snapshot files with their position: row, malformed, file, source_record_index (from 0 below the header).

    A record beyond its header, or with quotes that never close, is one malformed row and counts.
    """
    records = settle(quoted_records(spark, path).withColumn("text", F.regexp_replace("text", "^\ufeff", "")), "zstd")
    most = 1 + (records.select(F.max(F.length("text") - F.length(F.replace("text", F.lit(","), F.lit(""))))).first()[0] or 0)
    cells = F.from_csv("text", ", ".join(f"_{i} STRING" for i in range(most)), {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxColumns": str(most + 1), "maxCharsPerColumn": "-1"})
    parsed = records.select("file", "number", "open", F.array(*[cells[f"_{i}"] for i in range(most)]).alias("_cells"))
    headers = parsed.where("number = 0").select("file", F.transform(F.array_compact("_cells"), lambda c: F.btrim(c, F.lit("\r "))).alias("_names"))
    places = F.array(*[F.nullif(F.array_position("_names", F.lit(c)).cast("int"), F.lit(0)) for c in columns])
    headers = small_side(headers.select("file", F.size("_names").alias("_width"), places.alias("_places")))  # names are looked up once a file
    named = parsed.where("number > 0").join(headers, "file")

    def cell(name: str) -> Column:
        return F.try_element_at("_cells", F.col("_places")[columns.index(name)])

    beyond = F.slice("_cells", F.col("_width") + 1, F.lit(most + 1))
    return named.select(
        F.struct(*[cell(c).alias(c) for c in columns]).alias("row"),
        (F.col("open") | F.exists(beyond, lambda c: c.isNotNull())).alias("malformed"), "file",
        (F.col("number") - 1).alias("source_record_index"))


def parse_lines(lines: DataFrame, line: str, columns: Sequence[str]) -> DataFrame:
    """CSV text lines held in a column, with the same overflow rule as files."""
    fields = ", ".join(f"`{c}` STRING" for c in [*columns, OVERFLOW])
    parsed = F.from_csv(line, fields, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return lines.withColumn("_r", parsed).select(
        *[c for c in lines.columns if c != line],
        F.struct(*[F.col("_r")[c].alias(c) for c in columns]).alias("row"),
        F.col("_r")[OVERFLOW].isNotNull().alias("malformed"))


def required_columns(headers: DataFrame, header: str, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Missing required columns of each header line (sorted) and whether the schema is valid."""
    found = header_names(F.col(header))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), found))
    return headers.withColumn("missing_columns", missing) \
        .withColumn("schema_valid", F.size("missing_columns") == 0)


def validate_snapshots(spark: SparkSession, path: str, columns: Sequence[str] = SNAPSHOT_COLUMNS) -> DataFrame:
    """One row per snapshot file: schema_valid, row_count, missing_columns.

    Headers come from the first line of each file (position 0 of a split starting at the file
    head), row counts from one grouped scan; no file is read on the driver.
    """
    headers = header_lines(spark, path)
    counts = read_snapshots(spark, path, columns).groupBy("file").agg(F.count("*").alias("row_count"))
    return required_columns(headers, "header").join(counts, "file", "left") \
        .select("file", "schema_valid", F.coalesce("row_count", F.lit(0)).alias("row_count"), "missing_columns")


def parse_json_lines(lines: DataFrame, line: str) -> DataFrame:
    """Text lines to VARIANT records; blank lines are skipped, non-objects carry a ``fault``."""
    parsed = lines.where(F.trim(line) != "").withColumn("record", strict_json(F.col(line)))
    is_object = F.try_variant_get("record", "$", "map<string,variant>").isNotNull()
    fault = F.when(F.col("record").isNull(), F.lit("invalid_json")).when(~is_object, F.lit("not_a_json_object"))
    return parsed.withColumn("fault", fault).drop(line)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_json_lines(spark.read.text(path).withColumn("file", F.col("_metadata.file_path")), "value")


def read_json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Many whole-file JSON objects (statuses, reports) as one row each."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_json_lines(df: DataFrame, path: str, partitions: Sequence[str] = ("vehicle_key", "source")) -> None:
    """Records with sorted keys; only the partitions present in ``df`` are replaced."""
    ordered = df.select(*sorted(df.columns))
    ordered.write.partitionBy(*partitions).mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").json(path)


def _csv_value(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def csv_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in order; nested values as compact JSON, NULL and absent as ''."""
    fields = {f.name: f for f in df.schema.fields}
    return df.select(*[
        (F.coalesce(_csv_value(fields[c]), F.lit("")) if c in fields else F.lit("")).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    csv_columns(df, columns).write.mode("overwrite").option("header", "true") \
        .option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_run(df: DataFrame, path: str, run: str = "run_id") -> None:
    """Append-only archive: one partition per run, replaced when the run is written again."""
    df.write.partitionBy(run).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def latest_run(spark: SparkSession, path: str, keys: Sequence[str], run: str = "run_id", order: str = "run_ts") -> DataFrame:
    """Rows of the newest run per key; the archive is the only copy."""
    archive = spark.read.parquet(path)
    newest = archive.groupBy(*keys).agg(F.max_by(run, F.struct(order, run)).alias(run))
    return archive.join(newest, [*keys, run], "left_semi")


def read_faults(validated: DataFrame) -> DataFrame:
    return validated.select("file", F.explode(codes_in_order(
        (~F.col("schema_valid"), "invalid_output_schema"), (F.col("row_count") == 0, "empty_output"),
    )).alias("fault"))
