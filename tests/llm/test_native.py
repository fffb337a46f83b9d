"""Exact dedup and line dedup: plain versions, SQL, awkward rows, collisions, plans."""

import re

import pytest
from pyspark.sql import functions as F

from cutline.llm import catalog, exact_dedup, line_dedup
from tests.compare import duck, duck_result, spark_result
from tests.llm import plain


def got(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("name", sorted(catalog.all_sql()))
def test_query_against_sql(spark, name):
    df = catalog.all_queries()[name](spark, plain.SF)
    assert spark_result(df) == duck_result(duck(plain.SF), catalog.all_sql()[name])


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op6_line_dedup"])
def test_native_plans(spark, name):
    df = catalog.all_queries()[name](spark, plain.SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop|Python|Arrow", plan)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("key", [exact_dedup.hash_key, lambda text: F.length(text).cast("long"), lambda text: F.lit(5).cast("long")])
def test_exact_with_collisions(spark, key):
    """Texts of one key are told apart by their bytes; keys that no depth can split stay one bucket."""
    df = exact_dedup.exact_dedup(plain.frame(spark), capacity=2, key=key)
    assert got(df, *EXACT) == plain.exact([r[:2] for r in plain.ROWS])


def test_rows_are_found_through_the_directory(spark):
    """Without a bucket in the directory a row has no answer; links tell the texts of one key apart."""
    df = plain.frame(spark)
    entries, directory, chains = exact_dedup.build_index(df, capacity=2)
    assert directory.count() > 2 and entries.count() == len(plain.ROWS)
    part = directory.filter("bucket <> 0")
    depth = directory.agg(F.max("depth")).first()[0]
    left = exact_dedup.in_buckets(entries.drop("bucket"), part, depth)
    assert 0 < left.count() < len(plain.ROWS)
    assert chains.join(directory.select("bucket").distinct(), "bucket", "left_anti").count() == 0
    one = exact_dedup.exact_dedup(df, capacity=2, key=lambda text: F.lit(5).cast("long"))
    links = {(r["link"], r["text_sha256"]) for r in one.collect()}
    assert len(links) == len({sha for _, sha in links}) == max(link for link, _ in links) > 3


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    directory, depth = exact_dedup.build_directory(keys, 300)
    rows = directory.collect()
    assert sorted(r["slot"] for r in rows) == list(range(2 ** depth))
    assert all(r["keys"] <= 300 for r in rows) and len({r["bucket"] for r in rows}) > 16
    assert sum({r["bucket"]: r["keys"] for r in rows}.values()) == 5000


def test_exact_null_ids_and_empty(spark):
    df = exact_dedup.exact_dedup(plain.frame(spark, [(None, "A", "x"), (4, "a", "x"), (None, "b", "x")]))
    assert sorted((r["doc_id"] or -1, r["keep_id"], r["kept"]) for r in df.collect() if r["group_size"] == 2) == [(-1, 4, False), (4, 4, True)]
    assert [(r["keep_id"], r["kept"]) for r in df.collect() if r["group_size"] == 1] == [(None, False)]
    assert exact_dedup.exact_dedup(plain.frame(spark, [])).count() == 0


LINES = ("doc_id", "n_lines", "n_dropped", "sha")


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (4, 3)])
def test_lines_against_plain(spark, batches, fanout):
    df = line_dedup.line_dedup(plain.frame(spark), batches=batches, fanout=fanout).withColumn("sha", F.sha2("kept_text", 256))
    assert got(df, *LINES) == plain.lines([r[:2] for r in plain.ROWS])
    assert df.filter("key = 'k' and n = 3").count() == len(plain.ROWS)


def test_runs_compact_by_levels(spark, folder):
    runs = line_dedup.LineRuns(spark, folder, fanout=2)
    for batch in range(5):
        rows = [(batch, 1, n) for n in range(batch, batch + 3)]
        runs.add(spark.createDataFrame(rows, "__doc long, __h1 long, __h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted((r["__h2"], r["__first"]) for r in runs.read().collect()) == [(n, max(0, n - 2)) for n in range(7)]


def test_lines_null_id_and_empty(spark):
    df = line_dedup.line_dedup(plain.frame(spark, [(None, "a shared line\nx", "e"), (2, "a shared line", "e"), (3, "a shared line", "e")]))
    assert sorted((r["doc_id"] or -1, r["n_dropped"], r["kept_text"]) for r in df.collect()) == [
        (-1, 0, "a shared line\nx"), (2, 0, "a shared line"), (3, 1, "")]
    assert line_dedup.line_dedup(plain.frame(spark, [])).count() == 0
