"""Allotment projection: the order tables read as a raw allotment list.

Joins carry no broadcast hint: Spark broadcasts a dimension only while its size is under the
session's threshold, and otherwise sorts and merges with run-time skew splitting.
"""

from pyspark.sql import functions as F

# (category, seat type) by (order key + 3 * line number) modulo the length of the list.
CATEGORY_AND_SEAT = (
    ("OPEN ^ GOPENH", None),
    ("OBC GOBCH", None),
    ("SC ^ GSCO", None),
    ("OBC ^ MI-MH", None),
    ("NT 2 (NT-C)/PH1 ^ PWDRNT2S", None),
    ("EWS", "GOPENS"),
    ("OBC$#", "LOBCS"),
    ("SC/DEF1", "DEFSCS"),
    ("VJ/DT", "GVJS"),
    ("TFWS", None),
    (None, None),
    ("NT 1 (NT-B)", None),
    ("SEBC", "EWS"),
    ("OPEN", "LOPENS"),
    ("ST", "AI"),
    ("OPEN", "MI"),
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), index)


def allotments(spark, sf_dir):
    """One raw allotment row per order line."""
    lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part")
    joined = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    number = F.col("l_linenumber")
    choice = ((F.col("l_orderkey") + 3 * number) % len(CATEGORY_AND_SEAT) + 1).cast("int")
    vacant = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    cap_round = (
        F.when(number == 1, "CAP-I").when(number == 2, "CAP-II").when(number == 3, "CAP-III")
        .when(number == 4, "CAP-IV").otherwise("CAP-V")
    )
    code = F.lpad(F.col("s_nationkey").cast("string"), 5, "0")
    score = F.when(
        F.col("l_orderkey") % 97 != 0,
        ((F.col("l_orderkey") * 7 + number * 13) % 10000) / F.lit(100.0),
    )
    seat = _pick([seat for _, seat in CATEGORY_AND_SEAT], choice)
    return joined.select(
        cap_round.alias("cap_round"),
        code.alias("institute_code"),
        F.col("n_name").alias("institute_name"),
        F.when(F.col("p_size") != 1, F.col("p_type")).alias("branch_name"),
        (F.col("l_tax") == 0.0).alias("is_ews"),
        (F.col("l_tax") == 0.01).alias("is_tfws"),
        number.alias("sr_no"),
        F.col("l_partkey").cast("int").alias("merit_no"),
        score.alias("mhtcet_score"),
        F.when(vacant, "VACANT")
        .when(F.col("l_quantity") == 1, F.concat(F.lit("X"), F.col("l_orderkey").cast("string")))
        .otherwise(F.concat(F.lit("EN"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0")))
        .alias("application_id"),
        F.concat(F.lit("CANDIDATE "), F.col("l_partkey").cast("string")).alias("candidate_name"),
        F.when(F.col("l_discount") == 0.0, None)
        .when(F.col("l_discount") > 0.05, "F").otherwise("M").alias("gender"),
        _pick([category for category, _ in CATEGORY_AND_SEAT], choice).alias("candidate_category"),
        seat.alias("seat_type"),
        F.lit(None).cast("string").alias("seat_marker"),
        vacant.alias("is_vacant"),
        F.concat_ws(
            "|",
            F.when(score.isNull(), "missing_score"),
            F.when(F.col("l_discount") == 0.0, "missing_gender"),
            F.when(seat.isNull(), "missing_seat_type"),
        ).alias("_validation_warnings"),
        F.concat_ws("/", cap_round, F.concat(code, F.lit(".csv"))).alias("_source_file"),
    )
