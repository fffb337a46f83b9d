from pyspark.sql import functions as F

from cutline.operators import privacy, quality

GRADES = [
    (0, 0, 0.0, 1.0, 0.0, "PASS"),
    (1000, 50, 5.0, 10.0, 5.0, "PASS"),
    (1000, 51, 5.0, 10.0, 5.1, "WARN"),
    (1000, 101, 5.0, 10.0, 10.1, "FAIL"),
    (1, 1, 0.0, 0.0, 100.0, "FAIL"),
]


def test_all_rules_scan_each_layer_once(spark, folder):
    from cutline.plans import layers

    sf = "/root/testdata/sf0.001"
    bronze, silver, gold = layers.bronze(spark, sf), layers.silver(spark, sf), layers.gold(spark, sf)
    plan = quality.metrics(bronze, silver, gold, "r", "2025-01-01 00:00:00")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") == 3
    marked = bronze.withColumn("_malformed", F.when(F.col("sr_no") == 1, "1,2,3"))
    row = quality.well_formed(marked).first()
    assert row.rows_failed == marked.filter("_malformed is not null").count() > 0


def test_grading_golden_rows(spark):
    df = spark.createDataFrame(
        [(i, *g[:4]) for i, g in enumerate(GRADES)],
        "n int, rows_checked bigint, rows_failed bigint, warn_pct double, fail_pct double",
    )
    got = [(r.pct_failed, r.status) for r in quality.grade(df).orderBy("n").collect()]
    assert got == [g[4:] for g in GRADES]


def test_empty_tables_are_graded_without_errors(spark):
    silver = spark.createDataFrame([], "seat_type string, mhtcet_score double")
    gold = spark.createDataFrame([], "k string, cap1_cutoff double")
    rules = {"seat_type": (5.0, 10.0, ""), "mhtcet_score": (0.0, 1.0, "")}
    assert {r.status for r in quality.grade(quality.completeness(silver, rules)).collect()} == {"PASS"}
    assert quality.grade(quality.reconcile(silver, silver)).first().pct_failed == 0.0
    assert quality.grade(quality.nonempty(gold)).first().status == "FAIL"
    row = quality.grade(quality.unique_grain(gold, ("k",))).first()
    assert (row.rows_checked, row.rows_failed, row.status) == (0, 0, "PASS")


def test_blank_counts_as_missing_on_text_only(spark):
    df = spark.createDataFrame([("", 1.0), (None, None), ("x", 2.0)], "seat_type string, mhtcet_score double")
    rows = quality.completeness(df, {"seat_type": (0, 1, ""), "mhtcet_score": (0, 1, "")}).collect()
    assert {r.rule_name: r.rows_failed for r in rows} == {"not_null.seat_type": 2, "not_null.mhtcet_score": 1}


def test_completeness_reads_the_table_once(spark):
    df = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b"))
    plan = quality.completeness(df, {"a": (0, 1, ""), "b": (0, 1, "")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_unique_grain_counts_groups_not_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert quality.unique_grain(df, ("k",)).first().rows_failed == 2


def test_icons(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "p double")
    assert [r[0] for r in df.select(quality.report_icon(F.col("p"))).collect()] == ["✅", "⚠️", "❌"]


def _people(spark):
    return spark.createDataFrame(
        [("ANN", "EN00000001", "F", 1.0), (None, "EN00000002", None, 2.0)],
        "candidate_name string, application_id string, gender string, mhtcet_score double",
    )


def test_mask_for_both_roles(spark):
    people = _people(spark)
    hidden = privacy.mask_columns(people, False).collect()
    assert {tuple(r)[:3] for r in hidden} == {("***", "***", "***")}
    assert privacy.mask_columns(people, True).collect() == people.collect()
    by_row = privacy.mask_columns(people, F.col("mhtcet_score") > 1)
    assert [r.application_id for r in by_row.collect()] == ["***", "EN00000002"]


def test_published_view_and_leaks(spark):
    _people(spark).createOrReplaceTempView("people_base")
    privacy.create_mask_function(spark, "hide_people")
    view = privacy.publish_masked_view(spark, "people_base", "people_masked", "hide_people", temporary=True)
    assert {r.candidate_name for r in view.collect()} == {"***"}
    assert [r.mhtcet_score for r in view.orderBy("mhtcet_score").collect()] == [1.0, 2.0]
    assert privacy.leaked_columns(view) == ["application_id", "candidate_name", "gender"]
    assert privacy.leaked_values(view, "candidate_name", _people(spark)).count() == 0
    assert privacy.leaked_values(_people(spark), "candidate_name", _people(spark)).count() == 1
