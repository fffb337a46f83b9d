"""Reports over a layer: distributions, ranges, verification counts, step counts and filter values."""

from pyspark.sql import functions as F

from cutline import fixed_values as fixed
from cutline.operators.cleaning import is_valid_allotment


def distribution(df, *columns):
    """Rows per value, most frequent first; values break ties so that the order is stable."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.col("count").desc(), *columns)


def distributions(df, columns):
    """Several single-column distributions from one scan: the few combinations of values feed the counters."""
    pairs = [F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in columns]
    combined = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        combined.select("_rows", F.inline(F.array(*pairs)))
        .groupBy("attribute", "value")
        .agg(F.sum("_rows").alias("count"))
    )


def rows_per_round(df):
    counted = df.groupBy("cap_round", "cap_round_num").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy("cap_round_num", "cap_round")


def score_range(df):
    return df.agg(F.min("mhtcet_score").alias("min_score"), F.max("mhtcet_score").alias("max_score"))


def verify_layer(silver, with_pool=True):
    """Rows and score range per round, (pool,) gender and category."""
    pool = ["seat_pool"] if with_pool else []
    keys = ["cap_round", "cap_round_num", *pool, "seat_gender", "clean_category"]
    found = silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.min("mhtcet_score"), 2).alias("min_score"),
        F.round(F.max("mhtcet_score"), 2).alias("max_score"),
    )
    return found.orderBy("cap_round_num", *pool, "clean_category", "seat_gender", "cap_round")


def ingest_verify(bronze):
    """Rows and distinct files per round. The distinct step de-duplicates in each task before its shuffle."""
    return (
        bronze.groupBy("cap_round")
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("_source_file").alias("files"))
        .orderBy("cap_round")
    )


def baseline_compare(bronze, expected_rows=fixed.BASELINE_ROWS, expected_files=fixed.BASELINE_FILES):
    """Loaded rows and files against the expected numbers, in one pass."""
    found = bronze.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("_source_file").alias("files"))
    return found.select(
        "rows",
        F.lit(expected_rows).cast("bigint").alias("expected_rows"),
        (F.col("rows") == expected_rows).alias("rows_match"),
        "files",
        F.lit(expected_files).cast("bigint").alias("expected_files"),
        (F.col("files") == expected_files).alias("files_match"),
    )


def filter_values(mart, columns=("branch_name", "clean_category")):
    """Distinct non-null values for each filter column, and how many rows have none."""
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns]
    return (
        mart.select(F.inline(F.array(*pairs)))
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("field", F.col("value").asc_nulls_first())
    )


def warning_summary(df, top=10):
    """Most frequent warning texts with the number of flagged rows."""
    flagged = df.filter(F.col("_validation_warnings") != "")
    counted = flagged.groupBy("_validation_warnings").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.col("count").desc(), "_validation_warnings").limit(top)


def warned_total(df):
    """Flagged rows out of all rows."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.col("_validation_warnings"), F.lit("")) != "").alias("flagged_rows"))


def warning_flags(df):
    """Rows per single flag, with the pipe-separated text split."""
    flags = df.select(F.explode(F.split("_validation_warnings", r"\|")).alias("flag"))
    return flags.filter(F.col("flag") != "").groupBy("flag").agg(F.count(F.lit(1)).alias("count"))


def step_counts(bronze):
    """Rows before and after each filter of the cleaning, in one pass instead of one count per step."""
    valid = is_valid_allotment()
    scored = valid & F.col("mhtcet_score").isNotNull()
    return bronze.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(scored).alias("scored_rows"),
        (F.count(F.lit(1)) - F.count_if(scored)).alias("removed_rows"),
    )


def cast_drops(bronze):
    """Valid rows, those with a score text, and those lost because the text is no number. The score is text here."""
    score = F.col("mhtcet_score")
    given = is_valid_allotment() & F.coalesce(score != "", F.lit(False))
    readable = given & score.try_cast("double").isNotNull()
    return bronze.agg(
        F.count_if(is_valid_allotment()).alias("valid_rows"),
        F.count_if(given).alias("with_score"),
        F.count_if(readable).alias("readable_rows"),
        (F.count_if(given) - F.count_if(readable)).alias("dropped_after_cast"),
    )


def seat_counts(silver):
    """Rows with and without a seat type after the embedded codes were separated."""
    return silver.agg(
        F.count_if(F.col("seat_type").isNull()).alias("missing_seat_type"),
        F.count("seat_type").alias("with_seat_type"),
    )
