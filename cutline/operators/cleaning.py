"""Bronze to Silver: one narrow plan, no shuffle and no action."""

from pyspark.sql import functions as F

from cutline import fixed_values as fixed
from cutline.functions import rules, text
from cutline.schemas import BOOLEAN_COLUMNS, INTEGER_COLUMNS


def is_valid_allotment():
    """Filled seat with a well-formed application id; a NULL flag or id does not count as valid."""
    return (~F.col("is_vacant")) & F.col("application_id").rlike(fixed.WHOLE_APPLICATION_ID)


def valid_rows(bronze):
    return bronze.filter(is_valid_allotment() & F.col("mhtcet_score").isNotNull())


def coerce_types(df, score_type="double"):
    """Text columns to their documented types; unreadable values become NULL."""
    kinds = dict(df.dtypes)
    casts = {}
    for name in INTEGER_COLUMNS:
        if name in kinds:
            casts[name] = text.text_to_int(F.col(name)) if kinds[name] == "string" else F.col(name).try_cast("int")
    for name in BOOLEAN_COLUMNS:
        if name in kinds:
            casts[name] = F.col(name).try_cast("boolean")
    if "mhtcet_score" in kinds:
        casts["mhtcet_score"] = F.col("mhtcet_score").try_cast(score_type)
    return df.withColumns(casts)


def with_clean_category(df):
    """Tidied category and its standard name, in stacked projections so that each regex runs once."""
    tidied = df.withColumn("candidate_category", text.tidy_category(F.col("candidate_category")))
    led = tidied.withColumn("_leading", rules.leading_category(F.col("candidate_category")))
    return led.withColumn(
        "clean_category", rules.clean_category(F.col("candidate_category"), F.col("_leading"))
    ).drop("_leading")


def with_seat_attributes(df):
    return df.withColumns({
        "seat_gender": rules.seat_gender(F.col("seat_type")),
        "seat_pool": rules.seat_pool(F.col("seat_type")),
    })


def build_silver(bronze, strict_reference=True, score_type="double"):
    """Valid rows with separated seat codes, standard categories, seat attributes and numeric types."""
    separated = text.split_embedded_seat(valid_rows(bronze), strict_reference)
    typed = coerce_types(with_seat_attributes(with_clean_category(separated)), score_type)
    return (
        typed.withColumn("cap_round_num", rules.round_number(F.col("cap_round")))
        .filter(F.col("mhtcet_score").isNotNull())
        .withColumn("_load_ts", F.current_timestamp())
    )


def build_silver_v1(bronze, score_type="double"):
    """The superseded cleaning: seat codes stay inside the category, other rule lists."""
    typed = coerce_types(valid_rows(bronze), score_type)
    return (
        typed.withColumns({
            "clean_category": rules.clean_category_v1(F.col("candidate_category")),
            "seat_gender": rules.seat_gender_v1(F.col("seat_type")),
            "cap_round_num": rules.round_number(F.col("cap_round")),
        })
        .filter(F.col("mhtcet_score").isNotNull())
        .withColumn("_load_ts", F.current_timestamp())
    )


def delete_by_file(df, pattern):
    """Rows whose source file does not match a LIKE pattern; rows without a file are kept."""
    return df.filter(~F.coalesce(F.col("_source_file").like(pattern), F.lit(False)))


def rows_of_batch(df, batch_id):
    return df.filter(F.col("_batch_id") == F.lit(batch_id))
