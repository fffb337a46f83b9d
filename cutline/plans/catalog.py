"""Registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from pyspark.sql import functions as F

from cutline.functions import text
from cutline.operators import cleaning, lookup, marts, movement, privacy, quality, reports
from cutline.plans import layers
from cutline.plans.catalog_files import DOCUMENTS, FILES, INCREMENTAL, STUDENT
from cutline.session import scratch_dir
from cutline.sources import tables


def cleaned(spark, sf_dir):
    """The cleaning plan itself, over the written Bronze."""
    return cleaning.build_silver(layers.bronze(spark, sf_dir)).drop("_load_ts")


def cleaned_v1(spark, sf_dir):
    return cleaning.build_silver_v1(layers.bronze(spark, sf_dir)).drop("_load_ts")


def _joined_pools(mart):
    return mart.withColumn("seat_pools_available", F.array_join("seat_pools_available", ","))


def _tally(df, *columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def predict_colleges(spark, sf_dir):
    return lookup.predict(layers.gold(spark, sf_dir), **STUDENT)


def _separated(spark, sf_dir, strict_reference):
    rows = text.split_embedded_seat(cleaning.valid_rows(layers.bronze(spark, sf_dir)), strict_reference)
    return rows.select("application_id", "cap_round", "candidate_category", "seat_type", "seat_marker")


def _app(spark, sf_dir):
    return lookup.app_results(layers.gold(spark, sf_dir), **STUDENT)


def students(spark, sf_dir):
    """Every allotment row asks what its candidate could have reached elsewhere."""
    return layers.silver(spark, sf_dir).select(
        F.concat_ws(":", "application_id", "cap_round", "institute_code", "merit_no").alias("student_id"),
        F.col("clean_category").alias("category"), F.col("branch_name").alias("branch"), "gender",
        F.col("mhtcet_score").alias("score"),
    )


def _moves(spark, sf_dir):
    return movement.candidate_moves(layers.silver(spark, sf_dir), layers.facts(spark, sf_dir))


CLEAN = {
    "valid_rows": lambda spark, d: cleaning.valid_rows(layers.bronze(spark, d)).select(
        "cap_round", "institute_code", "branch_name", "application_id", "mhtcet_score",
        "candidate_category", "seat_type",
    ),
    "embedded_code": lambda spark, d: _separated(spark, d, True),
    "embedded_code_fixed": lambda spark, d: _separated(spark, d, False),
    "clean_category": lambda spark, d: _tally(cleaned(spark, d), "candidate_category", "clean_category"),
    "categorise_v1": lambda spark, d: _tally(cleaned_v1(spark, d), "candidate_category", "clean_category"),
    "marker_trim": lambda spark, d: _marker_trim(spark, d),
    "seat_gender_pool": lambda spark, d: _tally(cleaned(spark, d), "seat_type", "seat_gender", "seat_pool"),
    "seat_gender_v1": lambda spark, d: _tally(cleaned_v1(spark, d), "seat_type", "seat_gender"),
    "silver_full": cleaned,
}

MARTS = {
    "predict_colleges": predict_colleges,
    "predict_v1": lambda spark, d: lookup.predict_v1(layers.gold_v1(spark, d), **STUDENT),
    "outlook_all": lambda spark, d: lookup.with_outlook(layers.gold(spark, d), STUDENT["score"]).select(
        "institute_code", "branch_name", "clean_category", "seat_gender", "is_ews", "is_tfws",
        "likely_round", "score_gap",
    ),
    "app_results": _app,
    "display_results": lambda spark, d: lookup.display_results(_app(spark, d)),
    "lookup_batch": lambda spark, d: lookup.metrics_by_student(
        lookup.predict_batch(students(spark, d), layers.gold(spark, d))),
    "candidate_moves": _moves,
    "candidate_move_totals": lambda spark, d: movement.move_totals(_moves(spark, d)),
    "result_metrics": lambda spark, d: lookup.result_metrics(_app(spark, d)),
    "mart_main": lambda spark, d: _joined_pools(marts.main_mart(layers.silver(spark, d))),
    "mart_by_pool": lambda spark, d: marts.pool_mart(layers.silver(spark, d)),
    "mart_v1": lambda spark, d: marts.v1_mart(layers.silver_v1(spark, d)),
    "distributions": lambda spark, d: reports.distributions(
        layers.silver(spark, d), ("clean_category", "seat_pool", "seat_gender", "cap_round")
    ),
    "pool_gender_distribution": lambda spark, d: reports.distribution(layers.silver(spark, d), "seat_pool", "seat_gender"),
    "rows_per_round": lambda spark, d: reports.rows_per_round(layers.silver(spark, d)),
    "score_range": lambda spark, d: reports.score_range(layers.silver(spark, d)),
    "verify_layer": lambda spark, d: reports.verify_layer(layers.silver(spark, d)),
    "verify_layer_v1": lambda spark, d: reports.verify_layer(layers.silver_v1(spark, d), with_pool=False),
    "ingest_verify": lambda spark, d: reports.ingest_verify(layers.bronze(spark, d)),
    "baseline_compare": lambda spark, d: reports.baseline_compare(layers.bronze(spark, d)),
    "filter_values": lambda spark, d: reports.filter_values(layers.gold(spark, d)),
    "warning_summary": lambda spark, d: reports.warning_summary(layers.silver(spark, d)),
    "warned_total": lambda spark, d: reports.warned_total(layers.bronze(spark, d)),
    "cast_drops": lambda spark, d: reports.cast_drops(layers.bronze(spark, d).withColumn(
        "mhtcet_score", F.when(F.col("is_ews"), "n/a").otherwise(F.col("mhtcet_score").cast("string")))),
    "load_stamp": lambda spark, d: cleaning.build_silver(layers.bronze(spark, d)).groupBy("cap_round").agg(
        F.count(F.lit(1)).alias("rows"), F.count("_load_ts").alias("stamped_rows")),
    "warning_flags": lambda spark, d: reports.warning_flags(layers.bronze(spark, d)),
    "step_counts": lambda spark, d: reports.step_counts(layers.bronze(spark, d)),
    "seat_counts": lambda spark, d: reports.seat_counts(layers.silver(spark, d)),
}


def _metrics(spark, d, run="first", run_ts="2025-07-01 00:00:00"):
    rows = layers.bronze(spark, d)
    return quality.metrics(rows, layers.silver(spark, d), layers.gold(spark, d), run, run_ts)


def _dq_metrics(spark, d):
    return _metrics(spark, d).select("layer", "rule_name", "rows_checked", "rows_failed", "pct_failed", "status")


def _dq_trend(spark, d):
    """Two runs appended to a metrics table, read back latest first."""
    path = scratch_dir(spark, "metrics")
    for run, stamp in (("first", "2025-07-01 00:00:00"), ("second", "2025-07-02 00:00:00")):
        tables.write_path(_metrics(spark, d, run, stamp).coalesce(1), path, mode="append")
    runs = quality.trend(tables.read_path(spark, path))
    return runs.select(
        F.when(F.to_date("run_ts") == F.lit("2025-07-02").cast("date"), "second").otherwise("first").alias("run"),
        "layer", "rule_name", "rows_checked", "rows_failed", "pct_failed", "status",
    )


def _dq_trend_limit(spark, d):
    """Five runs of the rules in the history, 65 rows: the latest fifty."""
    path, once = scratch_dir(spark, "history"), scratch_dir(spark, "measured")
    _metrics(spark, d).write.parquet(once)
    for run in range(1, 6):
        stamped = spark.read.parquet(once).withColumns({
            "run_id": F.lit(f"run-{run}"), "run_ts": F.lit(f"2025-07-0{run} 00:00:00").cast("timestamp")})
        tables.write_path(stamped.coalesce(1), path, mode="append")
    return quality.trend(tables.read_path(spark, path)).select(
        F.dayofmonth("run_ts").cast("bigint").alias("run"), "layer", "rule_name", "rows_checked", "rows_failed", "pct_failed", "status")


def _marker_trim(spark, d):
    """Markers with blanks round them, empty ones and none: what is left of them beside the seat."""
    rows = layers.bronze(spark, d).withColumn(
        "seat_marker", F.when(F.col("sr_no") % 3 == 0, " ^ ").when(F.col("sr_no") % 3 == 1, ""))
    return _tally(cleaning.build_silver(rows), "seat_marker", "seat_type")


QUALITY = {
    "dq_report_v1": lambda spark, d: quality.report_v1(layers.silver_v1(spark, d)),
    "dq_trend_limit": _dq_trend_limit,
    "dq_completeness": lambda spark, d: quality.completeness(layers.silver(spark, d)).drop("notes"),
    "dq_grading": lambda spark, d: quality.grade(quality.completeness(layers.silver(spark, d)))
    .withColumn("icon", quality.report_icon(F.col("pct_failed")))
    .drop("notes", "warn_pct", "fail_pct"),
    "dq_reconcile": lambda spark, d: quality.reconcile(layers.bronze(spark, d), layers.silver(spark, d)),
    "dq_nonempty": lambda spark, d: quality.nonempty(layers.gold(spark, d)).drop("notes"),
    "dq_unique_grain": lambda spark, d: quality.unique_grain(layers.gold(spark, d)).drop("notes"),
    "dq_all_null": lambda spark, d: quality.not_all_null(layers.gold(spark, d)).drop("notes"),
    "dq_metrics": _dq_metrics,
    "dq_tally": lambda spark, d: quality.tally(_metrics(spark, d)),
    "dq_trend": _dq_trend,
}

_SHOWN = ("cap_round", "institute_code", "branch_name", "mhtcet_score", "candidate_name", "application_id", "gender")


def _mask_function(spark, d):
    layers.silver(spark, d).createOrReplaceTempView("cutline_silver")
    privacy.create_mask_function(spark, "cutline_mask")
    view = privacy.publish_masked_view(
        spark, "cutline_silver", "cutline_silver_masked", "cutline_mask", temporary=True
    )
    return view.select(*_SHOWN)


def _mask_sample(spark, d):
    view = privacy.mask_columns(layers.silver(spark, d), False).orderBy("institute_name", "mhtcet_score", "seat_gender")
    return privacy.masked_sample(view)


def _leak_check(spark, d):
    """Protected columns left in each output, and the rows whose values equal a protected one."""
    base = layers.silver(spark, d)
    parts = []
    for name, output, column in (("main_mart", layers.gold(spark, d), "institute_name"), ("silver", base, "candidate_name")):
        leaked = privacy.leaked_values(output, column, base).agg(F.count(F.lit(1)).alias("leaked_rows"))
        total = output.agg(F.count(F.lit(1)).alias("rows"))
        counts = leaked.select("leaked_rows", F.lit(None).cast("bigint").alias("rows")).unionByName(
            total.select(F.lit(None).cast("bigint").alias("leaked_rows"), "rows")
        )
        parts.append(counts.agg(F.max("leaked_rows").alias("leaked_rows"), F.max("rows").alias("rows")).select(
            F.lit(name).alias("output"), F.lit(len(privacy.leaked_columns(output))).alias("leaked_columns"),
            "leaked_rows", "rows",
        ))
    return parts[0].unionByName(parts[1])


PRIVACY = {
    "mask_reader": lambda spark, d: privacy.mask_columns(layers.silver(spark, d), False).select(*_SHOWN),
    "mask_admin": lambda spark, d: privacy.mask_columns(layers.silver(spark, d), True).select(*_SHOWN),
    "mask_function": _mask_function,
    "mask_sample": _mask_sample,
    "leak_check": _leak_check,
}


def all_queries():
    return {**CLEAN, **MARTS, **QUALITY, **PRIVACY, **FILES, **INCREMENTAL, **DOCUMENTS}
