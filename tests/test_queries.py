"""Every registered query against DuckDB on the smallest tables, and plan rules for all of them."""

import os
import re

import pytest

import __spark_entry__ as entry
from tests.compare import duck, duck_result, spark_result

SF = "/root/testdata/sf0.001"
# The optional language-model queries have tests of their own.
QUERIES = entry.catalog.all_queries()
SQL = entry.oracle.all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert spark_result(df) == duck_result(con, SQL[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|MapInPandas|BatchEval", plan)


def test_flagship_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "institute_name" and "likely_round" in df.columns


def test_lookup_filters_reach_the_files(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES["predict_colleges"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "clean_category" in pushed and "branch_name" in pushed and "cap4_cutoff" in pushed


def test_no_lineage_cut_on_local_disks():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for base, _, names in os.walk(os.path.join(root, "cutline")):
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(base, name)).read()
                assert "localCheckpoint" not in text and "crossJoin" not in text, name
