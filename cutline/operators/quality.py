"""Data-quality rules: every rule is one row of counts, graded against its own thresholds.

Rules on the same table share one aggregate. Results stay in Spark; nothing is counted on the driver.
"""

from functools import reduce

from pyspark.sql import functions as F

from cutline import fixed_values as fixed
from cutline.schemas import MALFORMED

RULE_COLUMNS = ("layer", "rule_name", "rows_checked", "rows_failed", "warn_pct", "fail_pct", "notes")


def _rule(layer, name, checked, failed, warn_pct, fail_pct, notes=""):
    return F.struct(
        F.lit(layer).alias("layer"),
        F.lit(name).alias("rule_name"),
        checked.cast("bigint").alias("rows_checked"),
        failed.cast("bigint").alias("rows_failed"),
        F.lit(float(warn_pct)).alias("warn_pct"),
        F.lit(float(fail_pct)).alias("fail_pct"),
        (notes if not isinstance(notes, str) else F.lit(notes)).alias("notes"),
    )


def missing(df, column):
    """NULL, or '' on text columns only (comparing a number with '' is an error under ANSI mode)."""
    is_null = F.col(column).isNull()
    return (is_null | (F.col(column) == "")) if dict(df.dtypes)[column] == "string" else is_null


def _silver_counts(df, rules):
    return df.agg(
        F.count(F.lit(1)).alias("_silver"), *[F.count_if(missing(df, name)).alias(f"_missing_{name}") for name in rules],
    )


def _completeness_rules(rules, layer):
    return [
        _rule(layer, f"not_null.{name}", F.col("_silver"), F.col(f"_missing_{name}"), warn, fail, notes)
        for name, (warn, fail, notes) in rules.items()
    ]


def completeness(df, rules=None, layer="silver"):
    """Missing values of every ruled column from one scan, turned into one row per rule."""
    rules = rules or fixed.COMPLETENESS_RULES
    return _silver_counts(df, rules).select(F.inline(F.array(*_completeness_rules(rules, layer))))


def report_v1(df, columns=fixed.REPORT_COLUMNS_V1):
    """The older report: missing values of six columns with their share, marked as soon as there is one."""
    found = completeness(df, {name: (0.0, 100.0, "") for name in columns})
    return found.select(
        F.regexp_replace("rule_name", r"^not_null\.", "").alias("field"), F.col("rows_failed").alias("missing"),
        percent_failed(F.col("rows_checked"), F.col("rows_failed")).alias("pct"),
        F.when(F.col("rows_failed") == 0, "✅").otherwise("⚠️").alias("icon"))


def _bronze_counts(df):
    malformed = F.count_if(F.col(MALFORMED).isNotNull()) if MALFORMED in df.columns else F.lit(0).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("_bronze"), malformed.alias("_malformed_rows"))


def _reconcile_rule(warn_pct, fail_pct):
    dropped = F.col("_bronze") - F.col("_silver")
    notes = F.format_string(
        "%s of %s raw rows left out (%s %%), %s cleaned",
        F.format_number(dropped, 0), F.format_number("_bronze", 0),
        F.format_string("%.2f", percent_failed(F.col("_bronze"), dropped)), F.format_number("_silver", 0),
    )
    return _rule("bronze_to_silver", "row_count_reconciliation", F.col("_bronze"), dropped, warn_pct, fail_pct, notes)


def _side_by_side(*one_row_frames):
    """One row with the columns of all of them, without a join."""
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), one_row_frames)
    return rows.agg(*[F.max(name).alias(name) for name in rows.columns])


def reconcile(bronze, silver, warn_pct=fixed.RECONCILE_WARN_PCT, fail_pct=fixed.RECONCILE_FAIL_PCT):
    """Share of rows lost between two layers."""
    counts = _side_by_side(_bronze_counts(bronze), _silver_counts(silver, ()))
    return counts.select(F.inline(F.array(_reconcile_rule(warn_pct, fail_pct))))


def well_formed(bronze):
    """Rows of input files with more or fewer fields than their header. One such row is a warning, 1 % a failure."""
    return _bronze_counts(bronze).select(F.inline(F.array(_well_formed_rule())))


def _well_formed_rule():
    return _rule("bronze", "well_formed_rows", F.col("_bronze"), F.col("_malformed_rows"), 0.0, 1.0, f"counted in {MALFORMED}")


def _nonempty_rule(layer, name, rows):
    notes = F.concat(F.lit(f"{name} has "), F.format_number(rows, 0), F.lit(" rows"))
    return _rule(layer, "not_empty", F.lit(1), (F.col(rows) == 0).cast("bigint"), 0.0, 0.0, notes)


def nonempty(df, layer="gold", name="mart"):
    """One check: does the table have a row at all?"""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"))
    return counts.select(F.inline(F.array(_nonempty_rule(layer, name, "_rows"))))


def _gold_counts(df, keys, columns=()):
    """Rows, repeated key groups and rows without a value in any of the columns, from one grouping."""
    empty = F.coalesce(F.lit(None), *[F.col(c) for c in columns]).isNull()
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.count_if(empty).alias("_none"))
    return groups.agg(
        F.coalesce(F.sum("_size"), F.lit(0)).alias("_gold"), F.count_if(F.col("_size") > 1).alias("_repeated"),
        F.coalesce(F.sum("_none"), F.lit(0)).alias("_empty"),
    )


def _grain_rule(keys, layer):
    return _rule(layer, "unique_grain", F.col("_gold"), F.col("_repeated"), 0.0, 0.0, f"grain={', '.join(keys)}")


def unique_grain(df, keys=fixed.MART_GRAIN, layer="gold"):
    """Number of key groups that occur more than once."""
    return _gold_counts(df, keys).select(F.inline(F.array(_grain_rule(keys, layer))))


def _values_rule(columns, layer, fail_pct):
    return _rule(
        layer, "not_all_cutoffs_null", F.col("_gold"), F.col("_empty"), 0.0, fail_pct, f"checked {', '.join(columns)}")


def not_all_null(df, columns=fixed.CUTOFF_COLUMNS, layer="gold", fail_pct=1.0):
    """Rows in which every one of the columns is NULL."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_gold"),
        F.count_if(F.coalesce(*[F.col(c) for c in columns]).isNull()).alias("_empty"),
    )
    return counts.select(F.inline(F.array(_values_rule(columns, layer, fail_pct))))


def percent_failed(checked, failed):
    return F.when(checked > 0, F.round(100.0 * failed / checked, 2)).otherwise(0.0)


def grade(rule_rows):
    """PASS, WARN or FAIL from the rounded percentage; a value on the threshold still passes it."""
    graded = rule_rows.withColumn("pct_failed", percent_failed(F.col("rows_checked"), F.col("rows_failed")))
    pct = F.col("pct_failed")
    status = F.when(pct > F.col("fail_pct"), "FAIL").when(pct > F.col("warn_pct"), "WARN").otherwise("PASS")
    return graded.withColumn("status", status)


def report_icon(pct):
    """The printed report's coarser scale."""
    return F.when(pct == 0, "✅").when(pct < 1, "⚠️").otherwise("❌")


def all_rules(bronze, silver, gold):
    """All rules of a run from one scan of each layer."""
    rules = fixed.COMPLETENESS_RULES
    counts = _side_by_side(
        _bronze_counts(bronze), _silver_counts(silver, rules), _gold_counts(gold, fixed.MART_GRAIN, fixed.CUTOFF_COLUMNS))
    rows = [
        *_completeness_rules(rules, "silver"), _reconcile_rule(fixed.RECONCILE_WARN_PCT, fixed.RECONCILE_FAIL_PCT),
        _nonempty_rule("gold", "mart", "_gold"), _grain_rule(fixed.MART_GRAIN, "gold"),
        _values_rule(fixed.CUTOFF_COLUMNS, "gold", 1.0), _well_formed_rule(),
    ]
    return grade(counts.select(F.inline(F.array(*rows))))


def metrics(bronze, silver, gold, run_id, run_ts):
    """The run's rule results in the layout of the append-only metrics table."""
    return all_rules(bronze, silver, gold).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        "layer", "rule_name", "rows_checked", "rows_failed", "pct_failed", "status", "notes",
    )


def tally(metric_rows):
    return metric_rows.groupBy("status").agg(F.count(F.lit(1)).alias("rules"))


def trend(metric_rows, limit=50):
    """Latest rule results first."""
    return (
        metric_rows.select("run_ts", "layer", "rule_name", "rows_checked", "rows_failed", "pct_failed", "status")
        .orderBy(F.col("run_ts").desc(), "layer", "rule_name")
        .limit(limit)
    )
