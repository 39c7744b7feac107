"""Run health: current-success predicate, outcome, health roll-up, anomalies, contract checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.numbers import half_even
from marketlens.functions.text import codes_in_order

PAIR = ["vehicle_key", "source"]
COUNTS = ("fetched_record_count", "accepted_record_count", "rejected_record_count",
          "parse_failure_count")
EVIDENCE_SCHEMA, LIFECYCLE_SCHEMA = 1, 2
# Metrics compared with the baseline as (metric, least baseline value).
COMPARED_METRICS = (("accepted_record_count", 10), ("fetched_record_count", 20))


def current_success(run_id: Column) -> Column:
    """All conditions under which a source status counts as a success of the given run."""
    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    conditions = [
        F.col("run_id") == run_id,
        F.col("execution_status") == "success",
        F.col("output_updated_this_run"), F.col("schema_valid"),
        zero("current_row_count") > 0, zero("accepted_record_count") > 0,
        F.col("evidence_reconciliation_status") == "reconciled",
        F.col("canonical_evidence_schema_version") == EVIDENCE_SCHEMA,
        F.col("identity_lifecycle_schema_version") == LIFECYCLE_SCHEMA,
        F.col("identity_lifecycle_status") == "updated",
        F.coalesce("identity_observed_current_count", F.lit(-1)) == zero("accepted_record_count"),
        F.col("row_cap_disabled"), F.col("config_isolated"),
    ]
    return F.coalesce(reduce(lambda a, b: a & b, conditions), F.lit(False))


def run_outcome(facts: DataFrame) -> DataFrame:
    """timed_out > failed > degraded > success, with the ordered failure reasons.

    ``facts``: timed_out, return_code, fresh, schema_valid, current_rows, evidence_failed,
    reconciled, pagination_complete, accepted_records, identity_failed, identity_current_count,
    config_isolated.
    """
    c = F.col
    usable = c("fresh") & c("schema_valid")
    read = usable & ~c("evidence_failed")
    reasons = codes_in_order(
        (c("timed_out"), "collector_timed_out"),
        (~c("timed_out") & (c("return_code") != 0), "collector_command_failed"),
        (~c("fresh"), "no_fresh_output"),
        (c("fresh") & ~c("schema_valid"), "invalid_output_schema"),
        (c("fresh") & (c("current_rows") < 1), "empty_output"),
        (usable & c("evidence_failed"), "canonical_evidence_failed"),
        (read & ~c("reconciled"), "evidence_reconciliation_failed"),
        (read & ~c("pagination_complete"), "pagination_incomplete"),
        (read & (c("accepted_records") < 1), "no_accepted_records"),
        (read & (c("accepted_records") != c("current_rows")), "accepted_output_count_mismatch"),
    )
    clean = F.size("_reasons") == 0
    later = codes_in_order(
        (clean & read & c("identity_failed"), "identity_lifecycle_failed"),
        (clean & read & ~c("identity_failed") & (c("identity_current_count") != c("current_rows")),
         "identity_current_count_mismatch"),
        (~c("config_isolated"), "approved_config_mutated"),
    )
    out = facts.withColumn("_reasons", reasons)
    out = out.withColumn("failure_reasons", F.concat("_reasons", later)).drop("_reasons")
    return out.withColumn(
        "execution_status",
        F.when(c("timed_out"), F.lit("timed_out")).when(c("return_code") != 0, F.lit("failed"))
        .when(F.size("failure_reasons") > 0, F.lit("degraded")).otherwise(F.lit("success")))


def expected_runs(registry: DataFrame, *, scheduled: bool = False) -> DataFrame:
    """Enabled vehicles (weekly ones when scheduled), one row per enabled source."""
    active = registry.where("enabled")
    if scheduled:
        active = active.where(F.col("cadence") == "weekly")
    return active.select("vehicle_key", F.explode("enabled_sources").alias("source"))


def health_rows(plan: DataFrame, status: DataFrame, run_id: Column) -> DataFrame:
    """One row per expected run. A missing status is an unhealthy row; counts of other runs are 0."""
    found = status.withColumn("_found", F.lit(True)).withColumn("_ok", current_success(run_id))
    return _health_columns(plan.join(found, PAIR, "left"), run_id, PAIR)


def health_rows_by_run(plan: DataFrame, status: DataFrame) -> DataFrame:
    """health_rows for every ``expected_run_id`` of a plan at once, each with the status that was the latest then.

    The window per pair holds its runs only, so it is bounded by the run calendar.
    """
    latest = Window.partitionBy(*PAIR).orderBy("_run", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    stated = status.select(*PAIR, F.col("run_id").alias("_run"), F.lit(0).alias("_asked"), F.struct(*[c for c in status.columns if c not in PAIR]).alias("_status"))
    asked = plan.select(*PAIR, F.col("expected_run_id").alias("_run"), F.lit(1).alias("_asked"))
    known = stated.unionByName(asked, allowMissingColumns=True).withColumn("_status", F.last("_status", ignorenulls=True).over(latest))
    expected = F.col("expected_run_id")
    joined = known.where("_asked = 1").select(*PAIR, F.col("_run").alias("expected_run_id"), "_status.*", F.col("_status").isNotNull().alias("_found"))
    return _health_columns(joined.withColumn("_ok", current_success(expected)), expected, [*PAIR, "expected_run_id"])


def _health_columns(joined: DataFrame, run_id: Column, keys: list[str]) -> DataFrame:
    current = F.coalesce(F.col("run_id") == run_id, F.lit(False))

    def stated(name: str) -> Column:
        return F.when(F.col("_found"), F.col(name)).otherwise(F.lit("missing"))

    def counted(name: str) -> Column:
        return F.when(current, F.coalesce(F.col(name), F.lit(0))).otherwise(F.lit(0)).cast("bigint")

    return joined.select(
        *keys, F.coalesce("_ok", F.lit(False)).alias("healthy"), current.alias("current_run"),
        stated("execution_status").alias("execution_status"),
        F.when(F.col("_found"), F.coalesce("data_quality_status", F.lit("not_evaluated")))
        .otherwise(F.lit("not_evaluated")).alias("data_quality_status"),
        F.coalesce("quality_warning_rows", F.lit(0)).alias("quality_warning_rows"),
        counted("current_row_count").alias("current_row_count"),
        F.coalesce("stale_row_count", F.lit(0)).alias("stale_row_count"),
        *[counted(n).alias(n) for n in COUNTS],
        "pagination_complete", F.coalesce("failed_page_count", F.lit(0)).alias("failed_page_count"),
        F.coalesce("request_attempt_count", F.lit(0)).alias("request_attempt_count"),
        F.when(F.col("_found"), F.coalesce("failure_reasons", F.array().cast("array<string>")))
        .otherwise(F.array(F.lit("missing_status"))).alias("failure_reasons"),
    )


def health_totals(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    warned = F.col("data_quality_status") == "warnings_present"
    out = rows.groupBy(*(keys or [])).agg(
        F.count("*").alias("expected_source_runs"),
        F.count_if("healthy").alias("healthy_source_runs"),
        F.count_if(~F.col("healthy")).alias("unhealthy_source_runs"),
        F.count_if(warned).alias("source_runs_with_quality_warnings"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in COUNTS],
    )
    return out.withColumn(
        "overall_status",
        F.when(F.col("unhealthy_source_runs") > 0, F.lit("degraded"))
        .when(F.col("source_runs_with_quality_warnings") > 0, F.lit("success_with_warnings"))
        .otherwise(F.lit("success")))


def with_previous_run(rows: DataFrame, order: list[str]) -> DataFrame:
    """Each health row with the row of the source's run before it as ``baseline``.

    Health rows are one per source and run, so the window is as long as a source has runs. A
    baseline report is available for every run but the earliest (a one-row aggregate).
    """
    fields = ["run_id", *[m for m, _ in COMPARED_METRICS], "request_attempt_count", "quality_warning_rows"]
    before = F.lag(F.struct(*fields)).over(Window.partitionBy(*PAIR).orderBy(*order))
    first = rows.groupBy().agg(F.min(F.struct(*order)).alias("_first"))
    marked = rows.withColumn("baseline", before).withColumn("_order", F.struct(*order))
    return marked.join(F.broadcast(first), marked["_order"] > first["_first"], "left") \
        .withColumn("baseline_available", F.col("_first").isNotNull()).drop("_first", "_order")


def anomalies(rows: DataFrame) -> DataFrame:
    """Findings per health row as (severity, code, baseline, current, threshold) texts.

    ``rows`` carries ``baseline`` (struct or NULL) and ``baseline_available`` (some earlier report
    exists to compare with).
    """
    b, c = F.col("baseline"), F.col
    nothing = F.lit(None).cast("string")

    def finding(severity: str, code: str, old: Column, new: Column, limit: str | Column) -> Column:
        return F.struct(
            F.lit(severity).alias("severity"), F.lit(code).alias("code"),
            old.cast("string").alias("baseline_value"), new.cast("string").alias("current_value"),
            (limit if isinstance(limit, Column) else F.lit(limit)).cast("string").alias("threshold"))

    failures = F.coalesce("parse_failure_count", F.lit(0))
    rate = F.when(c("fetched_record_count") > 0, failures / c("fetched_record_count")).otherwise(F.lit(0.0))
    shown = F.concat_ws("@", failures.cast("string"), half_even(rate, 6).cast("string"))
    critical_rate = (failures >= 5) & (rate >= 0.20)
    out = [
        F.when(~c("healthy"), finding("critical", "source_unhealthy", nothing, c("execution_status"), "healthy=true")),
        F.when(c("pagination_complete") == F.lit(False),
               finding("critical", "pagination_incomplete", nothing, F.lit("false"), "true")),
        F.when(c("failed_page_count") > 0,
               finding("critical", "failed_source_pages", nothing, c("failed_page_count"), "0")),
        F.when(critical_rate, finding("critical", "parse_failure_rate_critical", nothing, shown, "5@0.2")),
        F.when(~critical_rate & (failures >= 3) & (rate >= 0.05),
               finding("warning", "parse_failure_rate_elevated", nothing, shown, "3@0.05")),
        F.when(c("baseline_available") & b.isNull(),
               finding("info", "source_has_no_baseline", nothing, nothing, nothing)),
    ]
    for metric, least in COMPARED_METRICS:
        old, new = b[metric], c(metric)
        ratio, enough = F.try_divide(new, old), old >= least
        out += [
            F.when(enough & (ratio < 0.25), finding("critical", f"{metric}_collapse", old, new, "0.25")),
            F.when(enough & (ratio >= 0.25) & (ratio < 0.5), finding("warning", f"{metric}_drop", old, new, "0.5")),
            F.when(enough & (ratio >= 0.5) & (new >= old * 3) & (new - old >= least * 2),
                   finding("warning", f"{metric}_surge", old, new, "3.0")),
        ]
    old, new = b["request_attempt_count"], c("request_attempt_count")
    out.append(F.when((old >= 1) & (new >= old * 3) & (new - old >= 5),
                      finding("warning", "request_attempt_surge", old, new, "3.0")))
    old, new = b["quality_warning_rows"], c("quality_warning_rows")
    limit = F.greatest(F.lit(5), F.coalesce(old, F.lit(0)) * 2 + 1)
    out.append(F.when(b.isNotNull() & (new >= limit),
                      finding("warning", "quality_warning_growth", old, new, limit)))
    found = F.filter(F.array(*out), lambda x: x.isNotNull())
    return rows.select(*PAIR, *(["run_id"] if "run_id" in rows.columns else []), F.explode(found).alias("f")) \
        .select("*", "f.*").drop("f")


def anomaly_status(findings: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    """critical > warning > clean or no_baseline, with counts per severity.

    ``runs``: one row per key with ``baseline_available``.
    """
    s = F.col("severity")
    counts = findings.groupBy(*keys).agg(
        F.count_if(s == "critical").alias("critical_anomaly_count"),
        F.count_if(s == "warning").alias("warning_anomaly_count"),
        F.count_if(s == "info").alias("informational_anomaly_count"))
    out = runs.join(counts, keys, "left").na.fill(
        0, ["critical_anomaly_count", "warning_anomaly_count", "informational_anomaly_count"])
    return out.withColumn(
        "anomaly_status",
        F.when(F.col("critical_anomaly_count") > 0, F.lit("critical"))
        .when(F.col("warning_anomaly_count") > 0, F.lit("warning"))
        .when(F.col("baseline_available"), F.lit("clean")).otherwise(F.lit("no_baseline")))


def contract_mismatches(status: DataFrame, keys: list[str], expected: dict[str, str],
                        by_source: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Every status field that differs from its expected value, for every row of the table."""
    def entry(field: str, value: str, when: Column | None = None) -> Column:
        s = F.struct(F.lit(field).alias("field"), F.lit(value).alias("expected"),
                     F.col(field).cast("string").alias("actual"))
        wrong = ~F.col(field).cast("string").eqNullSafe(F.lit(value))
        return F.when(wrong if when is None else wrong & when, s)

    checks = [entry(f, v) for f, v in expected.items()]
    for source, extra in (by_source or {}).items():
        checks += [entry(f, v, F.col("source") == source) for f, v in extra.items()]
    return status.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("m")).select(*keys, "m.*")


def quality_rollup(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with warnings, warnings in total, and clean / warnings_present."""
    out = rows.groupBy(*keys).agg(
        F.count_if(F.size("quality_warnings") > 0).alias("quality_warning_rows"),
        F.sum(F.size("quality_warnings")).cast("bigint").alias("quality_warning_count"))
    return out.withColumn("data_quality_status", F.when(
        F.col("quality_warning_rows") > 0, F.lit("warnings_present")).otherwise(F.lit("clean")))


def quality_codes(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys, F.explode("quality_warnings").alias("code")) \
        .groupBy(*keys, "code").agg(F.count("*").alias("warning_count"))
