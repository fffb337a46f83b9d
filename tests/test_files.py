import os

import pytest

from cutline.operators import cleaning
from cutline.plans import pipeline
from cutline.plans.allotments import allotments
from cutline.plans.catalog_files import as_raw
from cutline.schemas import INTEGER_COLUMNS, RAW_TEXT_SCHEMA
from cutline.sources import csv_tree, exports, ledger, logs, tables
from cutline.streaming import ingest

HEADER = ",".join(part.split()[0] for part in RAW_TEXT_SCHEMA.split(", "))
SF = "/root/testdata/sf0.001"


def _row(code="01002", ident="EN00000001", sr="1.0"):
    return (f"CAP-I,{code},College,0100219110,Branch,True,False,Gov,Uni,60.0,,,,,{sr},5369,98.41,{ident},"
            "A NAME,F,OBC,LOPENS,^,False,")


def _write(path, rows, header=HEADER):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig") as out:
        out.write("\n".join([header, *rows]) + "\n")


def test_csv_tree_types_and_depth(spark, folder):
    _write(f"{folder}/CAP-I/a.csv", [_row()])
    _write(f"{folder}/CAP-II/deep/b.csv", [_row(sr=""), _row(sr="x")])
    rows = csv_tree.read_csv_tree(spark, folder, "b1").collect()
    assert len(rows) == 3
    first = [r for r in rows if r._source_file.endswith("a.csv")][0]
    assert (first.cap_round, first.institute_code, first.branch_code) == ("CAP-I", "01002", "0100219110")
    assert (first.sr_no, first.sanction_intake, first.cap_seats, first.is_ews, first.mhtcet_score) == (1, 60, None, True, 98.41)
    assert first._batch_id == "b1" and first._ingest_ts is not None
    assert csv_tree.read_csv_tree(spark, folder, "b1", one_level=True).count() == 1
    inferred = csv_tree.read_csv_tree(spark, folder, "b1", infer=True).first()
    assert inferred.institute_code == 1002


def test_wrong_header_is_refused(spark, folder):
    _write(f"{folder}/CAP-I/a.csv", [_row()], HEADER.replace("cap_round,institute_code", "institute_code,cap_round"))
    with pytest.raises(Exception, match="(?i)header"):
        csv_tree.read_csv_tree(spark, folder, "b1").collect()


def test_batch_and_stream_do_not_mix(spark, folder):
    _write(f"{folder}/in/CAP-I/a.csv", [_row()])
    ingest.ingest_new_files(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/cp", "b1", schema_location=f"{folder}/schema")
    rows = ingest.read_ingested(spark, f"{folder}/bronze", f"{folder}/schema")
    with pytest.raises(ValueError, match="stream"):
        tables.write_path(rows, f"{folder}/bronze")
    tables.write_path(rows, f"{folder}/batch")
    with pytest.raises(ValueError, match="batch"):
        ingest.ingest_new_files(spark, f"{folder}/in", f"{folder}/batch", f"{folder}/cp2", "b2")


def test_stream_into_a_catalog_table(spark, folder):
    _write(f"{folder}/in/CAP-I/a.csv", [_row(), _row()])
    tables.create_namespace(spark, "space_stream", f"{folder}/space")
    ingest.ingest_new_files(spark, f"{folder}/in", "space_stream.bronze", f"{folder}/cp", "b1", as_table=True)
    assert spark.table("space_stream.bronze").count() == 2
    with pytest.raises(ValueError, match="stream"):
        tables.save_table(spark.table("space_stream.bronze"), "space_stream.bronze")


def test_three_incremental_runs_and_a_malformed_row(spark, folder):
    def run(batch):
        ingest.ingest_new_files(
            spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/cp", batch, schema_location=f"{folder}/schema",
            max_files_per_trigger=1,
        )
        found = ingest.run_counts(ingest.read_ingested(spark, f"{folder}/bronze", f"{folder}/schema"))
        return {r._batch_id: (r.new_rows, r.new_files) for r in found.collect()}

    _write(f"{folder}/in/CAP-I/a.csv", [_row(), _row()])
    _write(f"{folder}/in/CAP-II/b.csv", [_row() + ",surplus"])
    assert run("r1") == {"r1": (3, 2)}
    assert run("r2") == {"r1": (3, 2)}
    _write(f"{folder}/in/CAP-I/a_copy.csv", [_row(), _row()])
    assert run("r3") == {"r1": (3, 2), "r3": (2, 1)}
    rows = ingest.read_ingested(spark, f"{folder}/bronze", f"{folder}/schema")
    assert rows.filter(f"{ingest.MALFORMED} is not null").count() == 1
    assert cleaning.delete_by_file(rows, "%_copy%").count() == 3
    assert dict(rows.dtypes)["sr_no"] == "int"
    one_run = cleaning.rows_of_batch(rows, "r3")
    assert one_run.count() == 2
    plan = one_run._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch_id" in plan


def test_streamed_files_are_bound_by_their_header(spark, folder):
    """Other column order, a column less, a new column: values land under their names."""
    def run(batch):
        ingest.ingest_new_files(spark, f"{folder}/in", f"{folder}/b", f"{folder}/cp", batch, "a int, b string", schema_location=f"{folder}/s")

    _write(f"{folder}/in/x/1.csv", ["1,one"], "a,b")
    _write(f"{folder}/in/x/2.csv", ["two,2"], "b,a")
    _write(f"{folder}/in/x/3.csv", ["3"], "a")
    run("r1")
    _write(f"{folder}/in/x/4.csv", ["new,four,4", "new,five,5,surplus"], "c,b,a")
    run("r2")
    rows = ingest.read_ingested(spark, f"{folder}/b", f"{folder}/s")
    assert sorted((r.a, r.b, r.c, r._malformed) for r in rows.collect() if r._malformed is None) == [
        (1, "one", None, None), (2, "two", None, None), (3, None, None, None), (4, "four", "new", None)]
    assert [r._malformed for r in rows.filter("_malformed is not null").collect()] == ["new,five,5,surplus"]
    assert ingest.delete_files(spark, f"{folder}/b", "%/2.csv") == 1
    run("r3")
    assert sorted(r.a for r in ingest.read_ingested(spark, f"{folder}/b", f"{folder}/s").filter("_malformed is null").collect()) == [1, 3, 4]


def test_a_repeated_micro_batch_writes_nothing_twice(spark, folder):
    _write(f"{folder}/in/x/1.csv", ["1,one"], "a,b")
    _ingest(spark, folder, "r1")
    for name in ("0", ".0.crc"):  # as if the run had ended before it noted the micro-batch as done
        os.remove(f"{folder}/cp/commits/{name}")
    _ingest(spark, folder, "r2")
    assert _rows(spark, folder, "a", "b") == [(1, "one")]


def _ingest(spark, folder, batch, schema="a int, b string", **options):
    ingest.ingest_new_files(
        spark, f"{folder}/in", f"{folder}/b", f"{folder}/cp", batch, schema, schema_location=f"{folder}/s", **options)


def _rows(spark, folder, *columns):
    rows = ingest.read_ingested(spark, f"{folder}/b", f"{folder}/s")
    return sorted(map(tuple, rows.select(*columns).collect()), key=str)


def _rejects(spark, folder):
    found = ingest.read_rejects(spark, f"{folder}/b").orderBy("_source_file", "block", "at").collect()
    return [(r._source_file.rsplit("/", 1)[1], r.reason, r.text) for r in found]


def test_blank_lines_before_the_header(spark, folder):
    _write(f"{folder}/in/x/1.csv", ["", " \t", "a,b", "1,one", "", "2,two"], "")
    _ingest(spark, folder, "r1")
    assert _rows(spark, folder, "a", "b", "_malformed") == [(1, "one", None), (2, "two", None)]
    assert _rejects(spark, folder) == []


def test_files_without_a_usable_header_go_to_the_rejects(spark, folder):
    _write(f"{folder}/in/x/1.csv", ["1,one"], "a,b")
    _write(f"{folder}/in/x/2.csv", ["2,two"], "a,A")
    _write(f"{folder}/in/x/3.csv", ["3,three"], "x,y")
    _write(f"{folder}/in/x/4.csv", [" "], "")
    _write(f"{folder}/in/x/5.csv", ["5,five"], "a,_batch_id")
    _write(f"{folder}/in/x/6.csv", ["6,six"], "a,b")
    _ingest(spark, folder, "r1")
    assert _rows(spark, folder, "a", "b") == [(1, "one"), (6, "six")]
    assert _rejects(spark, folder) == [
        ("2.csv", "repeated column name", "a,A"), ("2.csv", "repeated column name", "2,two"),
        ("3.csv", "no known column", "x,y"), ("3.csv", "no known column", "3,three"),
        ("4.csv", "no header", ""), ("4.csv", "no header", " "),
        ("5.csv", "reserved column name", "a,_batch_id"), ("5.csv", "reserved column name", "5,five")]
    _write(f"{folder}/in/x/7.csv", ["7,seven"], "a,b")
    _ingest(spark, folder, "r2")  # an odd file does not stop later runs
    assert _rows(spark, folder, "a", "_batch_id") == [(1, "r1"), (6, "r1"), (7, "r2")]
    assert len(_rejects(spark, folder)) == 8


def test_only_rejects(spark, folder):
    _write(f"{folder}/in/x/1.csv", ["1"], "z")
    _ingest(spark, folder, "r1")
    assert len(_rejects(spark, folder)) == 2
    _write(f"{folder}/in/x/2.csv", ["1,one"], "a,b")
    _ingest(spark, folder, "r2")
    assert _rows(spark, folder, "a", "b") == [(1, "one")]


def test_names_differ_in_letter_case(spark, folder):
    _write(f"{folder}/in/x/1.csv", ["1,one"], "a,b")
    _ingest(spark, folder, "r1")
    _write(f"{folder}/in/x/2.csv", ["two,2,new"], 'B," A ",Extra')
    _ingest(spark, folder, "r2")
    _write(f"{folder}/in/x/3.csv", ["three,3"], "EXTRA,A")
    _ingest(spark, folder, "r3")
    assert _rows(spark, folder, "a", "b", "Extra") == [(1, "one", None), (2, "two", "new"), (3, None, "three")]
    assert ingest.read_ingested(spark, f"{folder}/b", f"{folder}/s").columns[:3] == ["a", "b", "Extra"]


def test_a_data_line_like_the_header_is_kept(spark, folder):
    _write(f"{folder}/in/x/1.csv", ["1,one", "b,a", "2,two"], "b,a")
    _ingest(spark, folder, "r1", schema="a string, b string")
    assert _rows(spark, folder, "b", "a") == [("1", "one"), ("2", "two"), ("b", "a")]


def test_types_widen_and_earlier_runs_are_cast(spark, folder):
    for n, (kind, value) in enumerate((("int", "1"), ("bigint", "20000000000"), ("double", "2.5"), ("int", "7"), ("string", "x"))):
        _write(f"{folder}/in/x/{n}.csv", [f"{value},r{n}", f"no,{n}"], "a,b")
        _ingest(spark, folder, f"r{n}", schema=f"a {kind}, b string")
        assert dict(ingest.read_ingested(spark, f"{folder}/b", f"{folder}/s").dtypes)["a"] == ("int", "bigint", "double", "double", "string")[n]
    rows = {b: a for b, a in _rows(spark, folder, "b", "a")}
    assert (rows["r0"], rows["r1"], rows["r2"], rows["r3"], rows["r4"]) == ("1", "20000000000", "2.5", "7.0", "x")
    assert (rows["0"], rows["4"]) == (None, "no")
    odd = _rows(spark, folder, "_malformed")
    assert sum(m is not None for m, in odd) == 4
    _write(f"{folder}/in/x/9.csv", ["1,1"], "a,b")
    with pytest.raises(Exception, match="changed"):
        _ingest(spark, folder, "r9", schema="a boolean, b string")


def test_a_target_belongs_to_one_checkpoint(spark, folder):
    _write(f"{folder}/in/x/1.csv", ["1,one"], "a,b")
    _ingest(spark, folder, "r1")
    before = _rows(spark, folder, "a", "_batch_id")
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.ingest_new_files(
            spark, f"{folder}/in", f"{folder}/b", f"{folder}/other", "r2", "a int, b string", schema_location=f"{folder}/s")
    assert _rows(spark, folder, "a", "_batch_id") == before == [(1, "r1")]


def test_a_failed_attempt_leaves_nothing_behind(spark, folder, monkeypatch):
    """The snapshot follows the rows: a run that fails between them repeats its micro-batch and is read once."""
    _write(f"{folder}/in/x/1.csv", ["1,one,n"], "a,b,c")

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "keep_snapshot", broken)
        with pytest.raises(Exception, match="lost"):
            _ingest(spark, folder, "r1")
    assert ingest.read_snapshot(spark, f"{folder}/s") == (None, -1)
    _ingest(spark, folder, "r1")
    assert _rows(spark, folder, "a", "b", "c") == [(1, "one", "n")]


def test_text_is_read_once_for_any_number_of_headers(spark, folder):
    """Five headers, one scan of text per micro-batch; all else reads the staged lines."""
    for n, header in enumerate(("a,b", "b,a", "a", "b,a,c", "c,a,b")):
        _write(f"{folder}/in/x/{n}.csv", [",".join("1" if h == "a" else "t" for h in header.split(","))], header)
    lines = spark.read.text(f"{folder}/in/x").selectExpr("_metadata.file_path as file", "_metadata.file_block_start as block", "value")
    lines.selectExpr("*", "monotonically_increasing_id() as at").write.parquet(f"{folder}/staged")
    staged = spark.read.parquet(f"{folder}/staged")
    known = spark.createDataFrame([], "a int, b string, c string").schema
    heads = ingest.file_headers(staged, known)
    rows = ingest.bound_rows(staged, heads.filter("reason is null"), [1, 2, 3], known)
    assert rows.count() == 5
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and plan.count("from_csv") == 3


def test_surplus_fields_are_kept_by_the_batch_reader(spark, folder):
    _write(f"{folder}/CAP-I/a.csv", [_row(), _row() + ",LOST"])
    rows = csv_tree.read_csv_tree(spark, folder, "b1").collect()
    assert [r._malformed is None for r in sorted(rows, key=lambda r: r._malformed or "")] == [True, False]


def test_a_batch_table_is_not_streamed_into(spark, folder):
    _write(f"{folder}/in/CAP-I/a.csv", [_row()])
    tables.create_namespace(spark, "space_mixed", f"{folder}/space")
    tables.save_table(spark.range(1), "space_mixed.t")
    with pytest.raises(ValueError, match="batch"):
        ingest.ingest_new_files(spark, f"{folder}/in", "space_mixed.t", f"{folder}/cp", "b1", as_table=True)


def test_schema_snapshots(spark, folder):
    at = f"{folder}/schema"
    assert ingest.resolve_schema(spark, at, "a int").simpleString() == "struct<a:int>"
    assert ingest.resolve_schema(spark, at, "a int").simpleString() == "struct<a:int>"
    assert ingest.resolve_schema(spark, at, "b string, a int").simpleString() == "struct<a:int,b:string>"
    assert ingest.resolve_schema(spark, at, "a int").simpleString() == "struct<a:int,b:string>"
    assert ingest.read_snapshot(spark, at)[1] == 1
    assert ingest.resolve_schema(spark, at, "A string").simpleString() == "struct<a:string,b:string>"
    with pytest.raises(ValueError, match="changed"):
        ingest.resolve_schema(spark, at, "a boolean")
    with pytest.raises(ValueError, match="twice"):
        ingest.resolve_schema(spark, at, "d int, D int")


def test_overwrite_twice_and_replace(spark, folder):
    tables.create_namespace(spark, "space_replace", f"{folder}/space")
    rows = spark.range(10).selectExpr("id", "concat('f', id % 2) as _source_file")
    assert tables.save_table(rows, "space_replace.t") == 10
    assert tables.save_table(rows.selectExpr("*", "1 as extra"), "space_replace.t") == 10
    assert "extra" in tables.read_table(spark, "space_replace.t").columns
    assert tables.replace_rows(spark, "space_replace.t", lambda t: cleaning.delete_by_file(t, "f1")) == 5
    assert tables.save_table(tables.read_table(spark, "space_replace.t").limit(0), "space_replace.u", mode="append") == 0


def test_ledger_versions(spark, folder):
    for run in ("r1", "r2"):
        ledger.record(spark, f"{folder}/l", run, [("bronze", "overwrite", 5), ("silver", "overwrite", 3)])
    got = [(r.layer, r.version, r.rows, r.run_id) for r in ledger.history(spark, f"{folder}/l").collect()]
    assert got == [("bronze", 1, 5, "r2"), ("bronze", 0, 5, "r1"), ("silver", 1, 3, "r2"), ("silver", 0, 3, "r1")]
    assert ledger.history(spark, f"{folder}/l", "silver").count() == 2


def test_filter_metadata(spark, folder):
    mart = spark.createDataFrame([("B2", "OBC"), ("B1", "SC"), (None, "SC"), ("B1", None)], "branch_name string, clean_category string")
    exports.export_filter_metadata(mart, f"{folder}/o")
    found = sorted(map(tuple, exports.read_filter_metadata(spark, f"{folder}/o").collect()))
    assert found == [("branch", "B1"), ("branch", "B2"), ("category", "OBC"), ("category", "SC")]


def test_log_round_trip(spark, folder):
    log = spark.createDataFrame([("ok", "a", "R", 1, 0, "text", 0.5, "t", None)], logs.CONVERSION_LOG_SCHEMA)
    logs.append_log(log, f"{folder}/log")
    logs.append_log(log, f"{folder}/log")
    assert logs.read_log(spark, f"{folder}/log").collect() == log.union(log).collect()


@pytest.mark.parametrize("incremental", [False, True])
def test_whole_pipeline_twice(spark, folder, incremental):
    exports.export_csv_tree(as_raw(allotments(spark, SF)), f"{folder}/in")
    first = pipeline.run(spark, f"{folder}/in", f"{folder}/out", "r1", incremental, masked_copy=True)
    second = pipeline.run(spark, f"{folder}/in", f"{folder}/out", "r2", incremental)
    assert first["rows"]["silver"] == second["rows"]["silver"] > 0
    assert second["rows"]["bronze"] == (0 if incremental else first["rows"]["bronze"])
    assert first["metrics"].count() == 13
    at = pipeline.locations(f"{folder}/out")
    metrics = spark.read.parquet(at["dq_metrics"])
    assert metrics.count() == 26 and metrics.select("run_id").distinct().count() == 2
    assert {r.candidate_name for r in pipeline.read_layer(spark, f"{folder}/out", "silver_masked").collect()} == {"***"}
    assert ledger.history(spark, at["run_ledger"], "gold_main").count() == 2
    total = pipeline.read_layer(spark, f"{folder}/out", "facts").agg({"seats": "sum"}).first()[0]
    assert total == first["rows"]["silver"]


def test_a_broken_rebuild_leaves_the_old_layers(spark, folder, monkeypatch):
    from cutline.sources import published

    out, source = f"{folder}/out", f"{folder}/in"
    rows = as_raw(allotments(spark, SF))
    exports.export_csv_tree(rows, source)
    pipeline.run(spark, source, out, "r1")
    before = {layer: pipeline.read_layer(spark, out, layer).count() for layer in ("bronze", "silver", "facts", "gold_main")}
    exports.export_csv_tree(rows.filter("cap_round = 'CAP-I'"), f"{folder}/less")

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline.marts, "pool_mart_from_facts", broken)  # Silver, facts and the main mart are written by then
        with pytest.raises(OSError):
            pipeline.run(spark, f"{folder}/less", out, "r2")
    assert {layer: pipeline.read_layer(spark, out, layer).count() for layer in before} == before
    assert len(os.listdir(f"{out}/silver")) == 2  # the published run and the broken one
    pipeline.run(spark, f"{folder}/less", out, "r2")
    after = {layer: pipeline.read_layer(spark, out, layer).count() for layer in before}
    assert all(after[layer] < before[layer] for layer in ("bronze", "silver", "facts"))
    assert pipeline.layer_path(spark, out, "silver").split("run=")[1].startswith("r2-")
    ledger_at = pipeline.locations(out)["run_ledger"]
    gone = published.retire(spark, out, ledger_at, keep=1, unpublished=True)
    assert sum(g.startswith("silver/") for g in gone) == 2
    assert {layer: pipeline.read_layer(spark, out, layer).count() for layer in before} == after
    with pytest.raises(ValueError, match="not been published"):
        pipeline.read_layer(spark, out, "silver_masked")


def test_older_runs_are_retired(spark, folder):
    from cutline.sources import published

    base, book = f"{folder}/lake", f"{folder}/lake/run_ledger"
    for n in range(4):
        new = published.new_run(base, ("a",), "same-id")
        rows = tables.write_path(spark.range(n), new["a"])
        published.publish(spark, book, "same-id", [("a", "overwrite", rows, new["a"]), ("log", "append", 1, None)])
        assert spark.read.parquet(published.current(spark, base, book)["a"]).count() == n
    assert len(published.retire(spark, base, book, keep=2)) == 2
    assert spark.read.parquet(published.current(spark, base, book)["a"]).count() == 3
    assert set(published.current(spark, base, book)) == {"a"} and published.current(spark, base, f"{folder}/none") == {}


def test_untouched_partitions_keep_their_files(spark, folder):
    at = f"{folder}/t"
    rows = spark.range(12).selectExpr("id", "concat('p', id % 3) as part", "concat('f', id) as _source_file")
    rows.unionByName(spark.sql("select 99L as id, cast(null as string) as part, 'f99' as _source_file")).write.partitionBy("part").parquet(at)

    def files(part):
        return {(n, os.stat(f"{at}/part={part}/{n}").st_mtime_ns) for n in os.listdir(f"{at}/part={part}") if n.endswith(".parquet")}

    from pyspark.sql import functions as F

    before = {p: files(p) for p in ("p0", "p1", "p2")}
    assert tables.delete_touched(spark, at, F.col("_source_file").isin("f1", "f4") | (F.col("part") == "p2"), "part") == 6
    assert files("p0") == before["p0"] and not files("p1") & before["p1"] and not os.path.exists(f"{at}/part=p2")
    assert sorted(r.id for r in spark.read.parquet(at).collect()) == [0, 3, 6, 7, 9, 10, 99]
    assert tables.delete_touched(spark, at, F.col("_source_file") == "f99", "part") == 1
    assert tables.delete_touched(spark, at, F.lit(None).cast("boolean"), "part") == 0
    assert spark.read.parquet(at).count() == 6


def test_named_tables_show_masked_rows_only(spark, folder):
    from cutline.plans import pipeline_tables

    exports.export_csv_tree(as_raw(allotments(spark, SF)), f"{folder}/in")
    for run in ("r1", "r2"):
        shown = pipeline_tables.run_tables(spark, f"{folder}/in", f"{folder}/lake", run, "own_chain", "open_chain")
    assert shown == ["open_chain.silver", "open_chain.gold_main", "open_chain.gold_pool", "open_chain.dq_metrics"]
    silver = spark.table("open_chain.silver")
    assert silver.count() == spark.table("own_chain.silver").count() > 0
    for name in ("candidate_name", "application_id", "gender"):
        assert [r[0] for r in silver.select(name).distinct().collect()] == ["***"]
    assert spark.table("open_chain.dq_metrics").count() == 26
    assert sorted(t.name for t in spark.catalog.listTables("open_chain")) == ["dq_metrics", "gold_main", "gold_pool", "silver"]


def test_integer_columns_are_documented_ones():
    assert INTEGER_COLUMNS == (
        "sanction_intake", "cap_seats", "ms_seats", "minority_seats", "ai_seats", "sr_no", "merit_no"
    )
