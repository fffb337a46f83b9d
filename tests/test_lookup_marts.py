from pyspark.sql import functions as F

from cutline import fixed_values as fixed
from cutline.operators import lookup, marts

MART = (
    "institute_name string, branch_name string, clean_category string, seat_gender string, cap1_cutoff double, "
    "cap2_cutoff double, cap3_cutoff double, cap4_cutoff double, total_seats_filled bigint"
)
CUTOFFS = [
    (80.0, 79.0, 78.0, 77.0, "CAP-I", 5.5),
    (90.0, 85.5, 85.0, 84.0, "CAP-II", -4.5),
    (None, 90.0, 85.0, 84.0, "CAP-III", None),
    (95.0, None, None, 85.5, "CAP-IV", -9.5),
    (80.0, 80.0, 80.0, 85.6, None, None),
]


def _mart(spark, gender="M"):
    return spark.createDataFrame([(f"I{i}", "B", "OBC", gender, *row[:4], 1) for i, row in enumerate(CUTOFFS)], MART)


def test_golden_lookup(spark):
    got = [(r.institute_name, r.likely_round, r.score_gap) for r in lookup.predict(_mart(spark), "OBC", "B", "M", 85.5).collect()]
    assert got == [("I3", "CAP-IV", -9.5), ("I1", "CAP-II", -4.5), ("I0", "CAP-I", 5.5), ("I2", "CAP-III", None)]


def test_open_seats_match_any_gender_only_in_the_current_form(spark):
    mart = _mart(spark, "ANY")
    assert lookup.predict(mart, "OBC", "B", "F", 85.5).count() == 4
    assert lookup.predict_v1(mart, "OBC", "B", "F", 85.5).count() == 0


def test_quotes_in_values_are_literals(spark):
    assert lookup.predict(_mart(spark), "O'BC", "B' OR '1'='1", "M", 99.0).count() == 0


def test_unreachable_round_without_the_filter(spark):
    got = lookup.with_outlook(_mart(spark), 10.0).select("likely_round").distinct().collect()
    assert [r[0] for r in got] == ["Unlikely"]


def test_display_form(spark):
    shown = lookup.display_results(lookup.app_results(_mart(spark), "OBC", "B", "M", 85.5))
    assert shown.columns == list(fixed.DISPLAY_NAMES.values())
    row = shown.filter("College = 'I3'").first()
    assert (row["CAP-I Cutoff"], row["CAP-II Cutoff"], row["Likely Round"]) == ("95.00", "—", "🔴 CAP-IV")
    metrics = lookup.result_metrics(lookup.app_results(_mart(spark), "OBC", "B", "M", 85.5)).first()
    assert tuple(metrics) == (4, 1, 1, 2)


def _silver(spark):
    """One hot group with a third of all rows, some excluded pools and a group without the last round."""
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        code = "00001" if hot else f"{i % 50:05d}"
        pool = ["State", "AllIndia", "HomeUniv", "Minority"][i % 4]
        rows.append((code, f"N{code}", "B", "OBC", "M", False, False, pool, i % 5 + 1 if i % 5 < 4 else None, float(i)))
    rows.append(("99999", "only", "B", "OBC", "M", False, False, "AllIndia", 4, 1.0))
    return spark.createDataFrame(
        rows,
        "institute_code string, institute_name string, branch_name string, clean_category string, seat_gender string, "
        "is_ews boolean, is_tfws boolean, seat_pool string, cap_round_num int, mhtcet_score double",
    )


def test_main_mart_against_direct_aggregation(spark):
    silver = _silver(spark)
    kept = silver.filter(~F.col("seat_pool").isin(*fixed.POOLS_OUTSIDE_MAIN_MART))
    direct = kept.groupBy(*fixed.MAIN_MART_KEYS).agg(
        F.min(F.when(F.col("cap_round_num") == 1, F.col("mhtcet_score"))).alias("cap1_cutoff"),
        F.max(F.when(F.col("cap_round_num") == 2, F.col("mhtcet_score"))).alias("cap2_max"),
        F.min(F.when(F.col("cap_round_num") == 4, F.col("mhtcet_score"))).alias("cap4_cutoff"),
        F.count("*").alias("total_seats_filled"),
        F.count(F.when(F.col("cap_round_num") == 3, 1)).alias("cap3_seats"),
        F.sort_array(F.collect_set("seat_pool")).alias("seat_pools_available"),
    ).filter("cap4_cutoff is not null")
    mart = marts.main_mart(silver)
    assert sorted(map(str, mart.select(direct.columns).collect())) == sorted(map(str, direct.collect()))
    assert mart.filter("institute_code = '99999'").count() == 0


def test_pool_mart_refines_main_mart(spark):
    silver = _silver(spark)
    facts = marts.seat_facts(silver)
    assert sorted(map(str, marts.pool_mart(silver).collect())) == sorted(map(str, marts.pool_mart_from_facts(facts).collect()))
    assert facts.agg(F.sum("seats")).first()[0] == silver.count()


def test_facts_reduce_before_the_shuffle(spark):
    plan = marts.main_mart(_silver(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    first = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_min(mhtcet_score" in first


def _students(spark, rows):
    return spark.createDataFrame(rows, "student_id string, category string, branch string, gender string, score double")


def test_batch_lookup_like_one_by_one(spark):
    mart = _mart(spark).unionByName(_mart(spark, "ANY")).unionByName(_mart(spark, "F"))
    asked = [(f"s{n}", c, b, g, s) for n, (c, b, g, s) in enumerate(
        (c, b, g, s) for c in ("OBC", "SC", None) for b in ("B", None) for g in ("M", "F", None) for s in (10.0, 77.0, 84.0, 85.5, 99.0, None))]
    for limits in (None, [], [84.0], [77.0, 84.0, 85.5, 85.6]):
        batch = lookup.predict_batch(_students(spark, asked), mart, limits)
        got = sorted(map(str, (tuple(r) for r in batch.select("student_id", *lookup.RESULT_COLUMNS).collect())))
        want = []
        for student, category, branch, gender, score in asked:
            if category and branch and score is not None:
                found = lookup.predict(mart, category, branch, gender, score) if gender else lookup.predict(mart, category, branch, "ANY", score)
                want += [str((student, *r)) for r in found.collect()]
        assert got == sorted(want)


def test_batch_lookup_spreads_a_hot_branch_over_bins(spark):
    rows = [(f"I{i}", "HOT" if i % 3 else "B", "OBC", "M", 50.0, 40.0, 30.0, float(i % 100), 1) for i in range(3000)]
    mart = spark.createDataFrame(rows, MART)
    limits = lookup.score_limits(mart)
    assert 10 <= len(limits) <= lookup.SCORE_BINS - 1
    asked = _students(spark, [("a", "OBC", "HOT", "M", 99.5), ("b", "OBC", "HOT", "F", 99.5), ("c", "OBC", "B", "M", 10.0)])
    found = lookup.predict_batch(asked, mart)
    assert {r.student_id: r["count"] for r in found.groupBy("student_id").count().collect()} == {
        "a": sum(r[1] == "HOT" for r in rows), "c": sum(r[1] == "B" and r[7] <= 10 for r in rows)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup.predict_batch(asked, mart)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    largest = mart.filter("branch_name = 'HOT'").groupBy(
        F.size(F.filter(F.array(*[F.lit(e) for e in limits]), lambda e: e <= F.col("cap4_cutoff")))).count().agg(F.max("count")).first()[0]
    assert largest < 2000 / 8
    assert lookup.score_limits(mart.limit(0)) == [] and lookup.predict_batch(asked, mart.limit(0)).count() == 0


def test_candidate_moves(spark):
    from cutline.operators import movement

    columns = "application_id string, cap_round_num int, institute_code string, branch_name string, mhtcet_score double"
    silver = spark.createDataFrame([
        ("E1", 1, "01", "A", 50.0), ("E1", 2, "02", "A", 50.0), ("E1", 3, "02", "A", 50.0), ("E1", 4, "01", "A", 50.0),
        ("E2", 1, "02", "A", 60.0), ("E2", 1, "01", "A", 40.0), ("E2", 3, "03", None, 60.0), ("E3", 4, "04", "B", 60.0),
        ("E3", None, "01", "A", 99.0), ("E4", 1, "04", "B", 80.0), ("E4", 2, "03", None, 80.0),
    ], columns)
    facts = marts.seat_facts(silver, ("institute_code", "branch_name"))
    got = {(r.application_id, r.cap_round_num): (r.previous_round, r.change, r.left) for r in movement.candidate_moves(silver, facts).collect()}
    assert got == {
        ("E1", 1): (None, "first", False), ("E1", 2): (1, "better", False), ("E1", 3): (2, "same", False), ("E1", 4): (3, "worse", False),
        ("E2", 1): (None, "first", False), ("E2", 3): (1, "better", True), ("E3", 4): (None, "first", False),
        ("E4", 1): (None, "first", False), ("E4", 2): (1, "level", True)}
    totals = movement.move_totals(movement.candidate_moves(silver, facts))
    assert "application_id" not in totals.columns
    assert sum(r.candidates for r in totals.collect()) == 9 and sum(r.left for r in totals.collect()) == 2


def test_moves_reduce_hot_candidates_before_the_window(spark):
    from cutline.operators import movement

    rows = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('E', id)) as application_id", "cast(id % 4 + 1 as int) as cap_round_num",
        "cast(id % 7 as string) as institute_code", "'B' as branch_name", "cast(id as double) as mhtcet_score")
    facts = marts.seat_facts(rows, ("institute_code", "branch_name"))
    moves = movement.candidate_moves(rows, facts)
    assert moves.filter("application_id = 'HOT'").count() == 4
    plan = moves._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_max(struct")


def test_batch_lookup_asks_few_spans_and_rounds_once(spark):
    rows = [(f"I{i}", "HOT", "OBC", "M", 50.005 + i, 40.0, 30.0, float(i % 100), 1) for i in range(300)]
    mart = spark.createDataFrame(rows, MART)
    asked = _students(spark, [(f"s{n}", "OBC", "HOT", "M", n + 0.5) for n in range(100)])
    limits = lookup.score_limits(mart)
    bins = [sum(e <= n + 0.5 for e in limits) for n in range(100)]
    levels = (len(limits) + 1).bit_length()
    assert max(len(lookup._asked_spans(b, levels)) for b in bins) <= 4
    for size in range(1, 20):
        spans = [(set(lookup._asked_spans(b, size.bit_length())), set(lookup._spans_of(b, size.bit_length()))) for b in range(size)]
        assert all(len(spans[b][0] & spans[g][1]) == (g <= b) for b in range(size) for g in range(size))
    found = lookup.predict_batch(asked, mart)
    got = {r.student_id: r for r in lookup.metrics_by_student(found).collect()}
    for n in range(100):
        reached = [r for r in rows if r[7] <= n + 0.5]
        assert got[f"s{n}"].colleges_found == len(reached)
    least = found.groupBy("student_id").agg(F.min(F.abs("score_gap"))).collect()
    assert {r[0]: r[1] for r in least} == {k: r.least_gap for k, r in got.items()}
    plan = lookup.metrics_by_student(found)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("round(") == 1 and plan.index("round(") < plan.index("Aggregate [student_id") + 400
