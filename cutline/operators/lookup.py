"""The lookup: which institutes can a score reach, and in which round first?"""

from pyspark.sql import functions as F

from cutline import fixed_values as fixed
from cutline.functions import rules, text

RESULT_COLUMNS = (
    "institute_name", "branch_name", "clean_category",
    *fixed.CUTOFF_COLUMNS, "likely_round", "score_gap", "total_seats_filled",
)


def eligible(mart, category, branch, gender, score, any_gender=True):
    """Groups the student may enter by the last round; all tests are typed literals that reach the scan."""
    genders = (gender, "ANY") if any_gender else (gender,)
    return mart.filter(
        (F.col("clean_category") == F.lit(category))
        & F.col("seat_gender").isin(*genders)
        & (F.col("branch_name") == F.lit(branch))
        & (F.col(fixed.CUTOFF_COLUMNS[-1]) <= F.lit(score))
    )


def with_outlook(mart, score):
    """First reachable round and distance to the first-round cutoff; the score is a value or a column."""
    return mart.withColumns({
        "likely_round": rules.likely_round(fixed.CUTOFF_COLUMNS, F.lit(score)),
        "score_gap": F.round(F.lit(score) - F.col(fixed.CUTOFF_COLUMNS[0]), 2),
    })


def _hardest_first(df):
    return df.orderBy(F.col(fixed.CUTOFF_COLUMNS[0]).desc_nulls_last(), F.col("institute_name"))


def predict(mart, category, branch, gender, score, any_gender=True):
    found = with_outlook(eligible(mart, category, branch, gender, score, any_gender), score)
    return _hardest_first(found.select(*RESULT_COLUMNS))


def predict_v1(mart, category, branch, gender, score):
    """The superseded lookup: exact gender, no score gap."""
    return predict(mart, category, branch, gender, score, any_gender=False).drop("score_gap")


def app_results(mart, category, branch, gender, score):
    """The application's form: cutoffs rounded to 2 places, sorted by the unrounded one."""
    found = _hardest_first(with_outlook(eligible(mart, category, branch, gender, score), score))
    return found.select(
        "institute_name",
        *[F.round(name, 2).alias(name) for name in fixed.CUTOFF_COLUMNS],
        "likely_round",
        "total_seats_filled",
    )


def display_results(results):
    """Readable form: two decimals as text, a dash for a missing cutoff, labelled rounds and headings."""
    shown = results.select(
        "institute_name",
        *[text.display_number(F.col(name)).alias(name) for name in fixed.CUTOFF_COLUMNS],
        text.display_round(F.col("likely_round")).alias("likely_round"),
        "total_seats_filled",
    )
    return shown.withColumnsRenamed(fixed.DISPLAY_NAMES)


SCORE_BINS = 16


def score_limits(mart, bins=SCORE_BINS):
    """At most bins - 1 rising limits that deal the groups of a mart into bins of about equal size by their last cutoff."""
    shares = [n / bins for n in range(1, bins)]
    found = mart.agg(F.percentile_approx(fixed.CUTOFF_COLUMNS[-1], shares, 10_000)).first()[0] if shares else None
    return sorted(set(found or []))


def _bin_of(value, limits, first=0):
    """Number of limits that are not above the value, found by halving."""
    if not limits:
        return F.lit(first)
    middle = len(limits) // 2
    return F.when(value < F.lit(limits[middle]), _bin_of(value, limits[:middle], first)).otherwise(
        _bin_of(value, limits[middle + 1:], first + middle + 1))


def _asked_spans(bin, levels):
    """Spans of 1, 2, 4, ... bins that make up the bins from 0 to `bin`, each of them once; a span is numbered with its level."""
    return [((bin + 1 >> n) - 1) * levels + n for n in range(levels) if bin + 1 >> n & 1]


def _spans_of(bin, levels):
    """The spans that hold a bin and that anybody asks."""
    return [(bin >> n) * levels + n for n in range(levels) if not bin >> n & 1]


def predict_batch(students, mart, limits=None):
    """The lookup for many students (student_id, category, branch, gender, score) at once: a row per student and group.

    A range-binned join: groups lie in the score bin of their last cutoff, and a student asks every bin up to that of the
    score. Bins are asked in spans of 1, 2, 4, ... of them, so that of sixteen bins a student asks four spans at most, and a
    group, of which there are few, stands under each span that holds its bin. Category, branch, gender and span are then equal,
    and only the top bin needs the comparison. A sought-after branch is spread over its spans on both sides. A student with a
    NULL in category, branch or score reaches nothing; one without a gender reaches the seats for any.
    """
    limits = score_limits(mart) if limits is None else limits
    limits = sorted((float(e) for e in limits), key=lambda e: (e != e, e))
    levels = (len(limits) + 1).bit_length()
    last = fixed.CUTOFF_COLUMNS[-1]

    def spans(value, numbers):
        by_bin = [F.array(*[F.lit(n) for n in numbers(bin, levels)]) for bin in range(len(limits) + 1)]
        return F.explode(F.element_at(F.array(*by_bin), _bin_of(value, limits) + 1))

    groups = mart.filter(F.col(last).isNotNull()).withColumn("_span", spans(F.col(last), _spans_of))
    asked = students.filter(F.col("score").isNotNull()).select(
        "student_id", F.col("category").alias("clean_category"), F.col("branch").alias("branch_name"),
        F.col("score").alias("_score"),
        F.explode(F.array_distinct(F.array("gender", F.lit("ANY")))).alias("seat_gender"),
    ).withColumn("_span", spans(F.col("_score"), _asked_spans))
    keys = ["clean_category", "branch_name", "seat_gender", "_span"]
    found = asked.join(groups, keys).filter(F.col(last) <= F.col("_score"))
    return with_outlook(found, F.col("_score")).select("student_id", F.col("_score").alias("score"), "seat_gender", *RESULT_COLUMNS)


def _metrics():
    first, second, *late = fixed.ROUND_LABELS
    label = F.col("likely_round")
    return [
        F.count(F.lit(1)).alias("colleges_found"),
        F.count(F.when(label == first, 1)).alias("likely_cap1"),
        F.count(F.when(label == second, 1)).alias("likely_cap2"),
        F.count(F.when(label.isin(*late), 1)).alias("likely_cap3_or_4"),
    ]


def result_metrics(results):
    """How many groups were found, and how many are likely in each round (the last two together)."""
    return results.agg(*_metrics())


def metrics_by_student(results):
    """The same per student of a batch, with the highest first-round cutoff in reach and the nearest one.

    The least gap is rounded once, behind the minimum: rounding keeps the order, and costs more than all else for a row.
    """
    first = F.col(fixed.CUTOFF_COLUMNS[0])
    return results.groupBy("student_id").agg(
        *_metrics(), F.max(first).alias("highest_cutoff"), F.round(F.min(F.abs(F.col("score") - first)), 2).alias("least_gap"))
