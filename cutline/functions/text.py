"""Text expressions: coercion, category clean-up, seat codes inside categories, display formats."""

from pyspark.sql import functions as F

from cutline import fixed_values as fixed


def tidy_category(column):
    """Remove disability/defence suffixes, tribe labels and footnote signs; collapse spaces."""
    for sign, suffix in zip("/(", fixed.CATEGORY_SUFFIXES):  # each begins with its sign, or with blanks before it
        column = F.when(column.contains(sign), F.regexp_replace(column, suffix, "")).otherwise(column)
    return F.trim(F.regexp_replace(F.translate(column, fixed.CATEGORY_SIGNS, ""), r"\s{2,}|[^\S ]", " "))


def blank_to_null(column):
    return F.nullif(column, F.lit(""))


def text_to_int(column):
    """'7' and '7.0' become 7, anything unreadable NULL (also under ANSI mode)."""
    return column.try_cast("double").try_cast("int")


def display_number(column):
    return F.when(column.isNotNull(), F.format_string("%.2f", column)).otherwise(fixed.DISPLAY_MISSING)


def display_round(column):
    labels = F.create_map(*[F.lit(part) for pair in fixed.ROUND_DISPLAY.items() for part in pair])
    return F.try_element_at(labels, column)


def split_embedded_seat(df, strict_reference=True):
    """Move a seat code (and marker) that sits at the end of the category into its own columns.

    One pattern with an optional marker finds marked and bare codes: a code holds no marker sign, so a
    marked code can never follow a bare one in the same text. `strict_reference=True` also strips a trailing
    code from the category of rows whose seat was known already, so the category 'EWS' becomes ''.
    With False only rows whose seat was taken from the category are stripped.
    """
    category = F.col("candidate_category")
    missing = F.coalesce(F.col("seat_type"), F.lit("")) == ""
    found = df.withColumn("_found_seat", F.when(missing, F.regexp_extract(category, fixed.ANY_SEAT_AT_END, 2)))
    has_seat = F.col("_found_seat") != ""
    marked = found.withColumn("_found_marker", F.when(has_seat, F.regexp_extract(category, fixed.MARKED_SEAT_AT_END, 1)))
    has_marker = F.col("_found_marker") != ""
    # Where a seat was looked for, a category without one, or without a marker before it, has nothing to lose.
    untouched = F.when(missing, category).otherwise(
        F.regexp_replace(category, fixed.SEAT_AT_END, "")) if strict_reference else category
    return marked.withColumns({
        "seat_type": blank_to_null(F.when(has_seat, F.col("_found_seat")).otherwise(F.col("seat_type"))),
        "seat_marker": F.trim(blank_to_null(
            F.when(has_marker, F.col("_found_marker")).otherwise(F.col("seat_marker"))
        )),
        "candidate_category": F.trim(
            F.when(has_marker, F.regexp_replace(category, fixed.MARKED_SEAT_AT_END, "")).when(has_seat, category).otherwise(untouched)
        ),
    }).drop("_found_seat", "_found_marker")
