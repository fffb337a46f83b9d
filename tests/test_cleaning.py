import pytest
from pyspark.sql import functions as F

from cutline.functions import rules, text
from cutline.operators import cleaning

# category in, seat in, marker in -> seat, marker, category, clean name, gender, pool
GOLDEN = [
    ("OPEN ^ GOPENH", None, None, "GOPENH", "^", "OPEN", "OPEN", "M", "HomeUniv"),
    ("OBC GOBCH", None, None, "GOBCH", None, "OBC GOBCH", "OBC", "M", "HomeUniv"),
    ("SC ^ GSCO", None, None, "GSCO", "^", "SC", "SC", "M", "Other"),
    ("OBC ^ MI-MH", None, None, "MI-MH", "^", "OBC", "OBC", "ANY", "HomeUniv"),
    ("NT 2 (NT-C)/PH1 ^ PWDRNT2S", None, None, "PWDRNT2S", "^", "NT 2", "NT2", "M", "State"),
    ("EWS", "GOPENS", None, "GOPENS", None, "", "", "M", "State"),
    ("OBC$#", "LOBCS", "*", "LOBCS", "*", "OBC", "OBC", "F", "State"),
    ("SC/DEF1", "DEFSCS", None, "DEFSCS", None, "SC", "SC", "M", "State"),
    ("VJ/DT", "GVJS", None, "GVJS", None, "VJ/DT", "VJ/DT", "M", "State"),
    ("TFWS", None, None, "TFWS", None, "TFWS", "TFWS", "ANY", "State"),
    (None, None, None, None, None, None, None, "M", "Other"),
    ("NT 1 (NT-B)", None, None, None, None, "NT 1", "NT1", "M", "Other"),
    ("SEBC", "EWS", None, "EWS", None, "SEBC", "SEBC", "ANY", "State"),
    ("OPEN", "TFWS", None, "TFWS", None, "OPEN", "OPEN", "ANY", "State"),
    ("ORPHAN", "ORPHAN", None, "ORPHAN", None, "", "", "ANY", "Orphan"),
    ("MUSLIM MI", "AI", None, "AI", None, "MUSLIM", "MUSLIM", "ANY", "AllIndia"),
]


def _raw(spark, rows):
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "n int, candidate_category string, seat_type string, seat_marker string",
    )


def _derived(df):
    return cleaning.with_seat_attributes(cleaning.with_clean_category(df)).orderBy("n").select(
        "seat_type", "seat_marker", "candidate_category", "clean_category", "seat_gender", "seat_pool"
    )


def test_golden_rows(spark):
    df = _raw(spark, [row[:3] for row in GOLDEN])
    got = [tuple(r) for r in _derived(text.split_embedded_seat(df)).collect()]
    assert got == [row[3:] for row in GOLDEN]


def test_fixed_mode_keeps_a_category_that_looks_like_a_seat(spark):
    df = _raw(spark, [("EWS", "GOPENS", None), ("ORPHAN", "ORPHAN", None), ("OPEN ^ GOPENH", None, None)])
    got = [r["candidate_category"] for r in _derived(text.split_embedded_seat(df, strict_reference=False)).collect()]
    assert got == ["EWS", "ORPHAN", "OPEN"]


def test_one_pattern_finds_what_marked_then_bare_would(spark):
    """The optional marker gives the same seat and marker as trying the marked pattern first."""
    from cutline import fixed_values as fixed

    texts = [
        "OPEN ^ GOPENH", "X ^  GOPENH  ", "^ GOPENH", "^GOPENH", "A ^ B GOPENH", "~ ^ MI", "MI MI", "GOPENH ^ MI",
        "OBC*& AI", "EWSTFWS", "DEFR", "PWD O", "DEF", "", "nothing", "@ PWDRSEBCO", "X & Y ^ TFWS ",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    marked = F.regexp_extract("c", fixed.MARKED_SEAT_AT_END, 2)
    bare = F.regexp_extract("c", fixed.SEAT_AT_END, 1)
    rows = df.select(
        F.regexp_extract("c", fixed.ANY_SEAT_AT_END, 2).alias("seat"),
        F.when(marked != "", marked).otherwise(bare).alias("seat_two_steps"),
        F.regexp_extract("c", fixed.ANY_SEAT_AT_END, 1).alias("marker"),
        F.regexp_extract("c", fixed.MARKED_SEAT_AT_END, 1).alias("marker_two_steps"),
    ).collect()
    assert [(r.seat, r.marker) for r in rows] == [(r.seat_two_steps, r.marker_two_steps) for r in rows]


def test_first_rule_wins_and_null_falls_through(spark):
    df = spark.createDataFrame(
        [("SEBC",), ("obc x",), ("DT",), ("vj",), ("Xnt1",), ("NT B",), ("NT D",), ("a pwd",), ("def",), ("zzz",), (None,)],
        "c string",
    )
    led = df.withColumn("l", rules.leading_category(F.col("c")))
    got = [r[0] for r in led.select(rules.clean_category(F.col("c"), F.col("l"))).collect()]
    assert got == ["SEBC", "OBC", "VJ/DT", "VJ/DT", "NT1", "NT2", "NT3", "PWD", "DEFENCE", "zzz", None]


def test_superseded_rules(spark):
    df = spark.createDataFrame([("x SEBC",), ("NT-2",), ("A(1)$",), (None,)], "c string")
    got = [r[0] for r in df.select(rules.clean_category_v1(F.col("c"))).collect()]
    assert got == ["SBC", "NT2", "A", None]
    seats = spark.createDataFrame([("AI",), ("MI",), ("LOBCS",), ("PWDOBCS",), (None,)], "s string")
    assert [r[0] for r in seats.select(rules.seat_gender_v1(F.col("s"))).collect()] == ["AI", "MI", "F", "M", "M"]


@pytest.mark.parametrize("label,number", [("CAP-I", 1), ("CAP-IV", 4), ("CAP-V", None), (None, None)])
def test_round_number(spark, label, number):
    row = spark.createDataFrame([(label,)], "r string").select(rules.round_number(F.col("r")).alias("n")).first()
    assert row.n == number


def test_valid_rows_drop_null_flags_and_bad_ids(spark):
    rows = [
        (False, "EN12345678", 1.0), (None, "EN12345678", 1.0), (True, "EN12345678", 1.0), (False, "VACANT", 1.0),
        (False, "EN1234567", 1.0), (False, None, 1.0), (False, "EN12345678", None),
    ]
    df = spark.createDataFrame(rows, "is_vacant boolean, application_id string, mhtcet_score double")
    assert cleaning.valid_rows(df).count() == 1


def test_coercion_of_text(spark):
    df = spark.createDataFrame(
        [("7", "7.0", "98.5", "True"), ("x", "", "n/a", "False"), (None, None, None, None)],
        "sr_no string, merit_no string, mhtcet_score string, is_vacant string",
    )
    got = [tuple(r) for r in cleaning.coerce_types(df).collect()]
    assert got == [(7, 7, 98.5, True), (None, None, None, False), (None, None, None, None)]
    assert dict(cleaning.coerce_types(df, "float").dtypes)["mhtcet_score"] == "float"


def test_float_switch_moves_the_edge(spark):
    """A float cutoff of 85.3 is above the double 85.3 it came from; the double default is not."""
    df = spark.createDataFrame([("85.3",)], "mhtcet_score string")
    reached = F.col("mhtcet_score") <= F.lit(85.3)
    assert cleaning.coerce_types(df, "float").filter(reached).count() == 0
    assert cleaning.coerce_types(df).filter(reached).count() == 1


def test_delete_by_file_keeps_rows_without_a_file(spark):
    df = spark.createDataFrame([("a/copy_1.csv",), ("a/1.csv",), (None,)], "_source_file string")
    assert cleaning.delete_by_file(df, "%copy%").count() == 2


def test_patterns_run_only_where_they_can_match(spark):
    """The seat pattern is tried once a row; blanks, signs and suffixes in odd places are cleaned as by the plain patterns."""
    import re

    rows = [
        ("OPEN\t^  GOPENH \n", None, None), ("A\t\tB\n", "", " ~ "), (" X  Y ", None, ""), ("SC/DEF1/PH22 (NT-B)", "AI", None),
        ("NT 2\n(NT-C)$ #", "AI", None), ("GOPENS", None, "^"), ("^ ^ MI", None, None), ("OBC/ (NT-E)", " ", None), (None, None, "*"),
    ]
    split = text.split_embedded_seat(_raw(spark, rows))
    got = [tuple(r) for r in _derived(split).collect()]
    assert [r[:3] for r in got] == [
        ("GOPENH", "^", "OPEN"), (None, "~", "A B"), (None, None, "X Y"), ("AI", None, "SC"),
        ("AI", None, "NT 2"), ("GOPENS", "^", "GOPENS"), ("MI", "^", "^"), (" ", None, "OBC/ (NT-E)"), (None, "*", None),
    ]
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(candidate_category") == 2
    tidied = _raw(spark, rows).select(text.tidy_category(F.col("candidate_category")).alias("c"))
    for (value, *_), row in zip(rows, tidied.collect()):
        if value is not None:
            plain = re.sub(r"\s*\(NT-[ABCD]\)", "", re.sub(r"/(?:DEF|PH)\d+", "", value))
            assert row.c == re.sub(r"\s+", " ", re.sub("[$#@]", "", plain)).strip(" ")
    assert "case when contains" in tidied._jdf.queryExecution().optimizedPlan().toString().lower()
