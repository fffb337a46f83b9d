"""Reports and work lists around the conversion of documents."""

from pyspark.sql import functions as F


def _rows():
    return F.count(F.lit(1))


def file_outcomes(files, parsed, method="text", elapsed=None):
    """One log row per input file: ok with its rows and warnings, or failed when it gave no row.

    A set-based run has no time of its own for a document: `elapsed`, the seconds of the run, is divided over
    its documents by their bytes. It is NULL if the run's time or the sizes are not known.
    """
    seconds = F.lit(None).cast("double")
    if elapsed is not None and "bytes" in files.columns:
        total = files.agg(F.greatest(F.sum("bytes"), F.lit(1))).scalar()
        seconds = F.col("bytes") / total * F.lit(float(elapsed))
    counts = parsed.groupBy("file").agg(
        _rows().alias("rows"), F.count_if(F.col("_validation_warnings") != "").alias("warnings")
    )
    done = files.select("file", F.col("cap_round").alias("round"), seconds.alias("seconds")).join(counts, "file", "left")
    ok = F.coalesce(F.col("rows"), F.lit(0)) > 0
    return done.select(
        F.when(ok, "ok").otherwise("failed").alias("status"),
        "file", "round",
        F.coalesce("rows", F.lit(0)).cast("int").alias("rows"),
        F.when(ok, F.col("warnings")).cast("int").alias("warnings"),
        F.when(ok, method).alias("method"),
        F.col("seconds").alias("elapsed_s"),
        F.current_timestamp().cast("string").alias("ts"),
        F.when(~ok, "parser returned 0 rows").alias("error"),
    )


def pending(files, outputs, key="file"):
    """Inputs that have no output yet."""
    return files.join(outputs.select(key), key, "left_anti")


def retry_queue(log, files, run="run_ts"):
    """Failures of the latest run whose file still exists. The latest run is a scalar subquery."""
    latest = log.agg(F.max(run)).scalar()
    failed = log.filter((F.col("status") == "failed") & (F.col(run) == latest))
    return failed.join(files.select("file", F.col("cap_round").alias("round")), ["file", "round"], "left_semi")


def retry_outcome(queue, outcomes):
    """How many queued files the second attempt recovered."""
    tried = outcomes.join(queue.select("file"), "file", "left_semi")
    return tried.agg(
        F.count_if(F.col("status") == "ok").alias("recovered"),
        F.count_if(F.col("status") != "ok").alias("still_failing"),
    )


def log_summary(log):
    return log.groupBy("round", "status").agg(
        F.count("file").alias("files"),
        F.sum("rows").alias("total_rows"),
        F.round(F.avg("rows"), 2).alias("avg_rows"),
        F.round(F.avg("elapsed_s"), 2).alias("avg_time_s"),
    )


def method_frequency(log):
    ok = log.filter((F.col("status") == "ok") & F.col("method").isNotNull())
    return ok.groupBy("method").agg(_rows().alias("count")).orderBy(F.col("count").desc(), "method")


def top_warned(log, limit=20):
    warned = log.filter((F.col("status") == "ok") & (F.col("warnings") > 0))
    return warned.select("file", "round", "rows", "warnings").orderBy(F.col("warnings").desc(), "file").limit(limit)


def failed_files(log):
    return log.filter(F.col("status") == "failed").select("file", "round", "error")


def totals(log):
    return log.agg(
        _rows().alias("files"),
        F.count_if(F.col("status") == "ok").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("rows").alias("total_rows"),
        F.round(F.avg("elapsed_s"), 2).alias("avg_time_s"),
        F.round(F.sum("elapsed_s") / 60, 1).alias("total_time_min"),
    )


def coverage(inputs, outputs):
    """Outputs against inputs per round, percent with one decimal, 0 where a round has no input.

    Both lists are reduced to one row per round side by side, so no join is needed.
    """
    sides = inputs.select("cap_round", F.lit(1).alias("is_input"), F.lit(0).alias("is_output")).unionByName(
        outputs.select("cap_round", F.lit(0).alias("is_input"), F.lit(1).alias("is_output"))
    )
    counts = sides.groupBy("cap_round").agg(F.sum("is_output").alias("outputs"), F.sum("is_input").alias("inputs"))
    share = F.when(F.col("inputs") > 0, F.round(F.col("outputs") / F.col("inputs") * 100, 1)).otherwise(0.0)
    return counts.withColumn("pct", share)


def parse_profile(parsed, max_without_seat=10):
    """Per file: rows, vacant rows, rows without a seat, markers, and whether the parse looks right."""
    no_seat = ~F.col("is_vacant") & (F.coalesce(F.col("seat_type"), F.lit("")) == "")
    marker = F.when(F.col("seat_marker") != "", F.col("seat_marker"))
    profile = parsed.groupBy("file").agg(
        _rows().alias("rows"),
        F.count_if("is_vacant").alias("vacant"),
        F.count_if(no_seat).alias("no_seat"),
        F.sort_array(F.collect_set(marker)).alias("markers"),
    )
    return profile.withColumn("looks_ok", (F.col("rows") > 0) & (F.col("no_seat") < max_without_seat))
