"""Layers of the registered queries as written tables, once per session and input folder.

Downstream plans then scan columns instead of re-evaluating the cleaning expressions, and filters on
derived columns reach the files.
"""

from cutline.operators import cleaning, marts
from cutline.plans import rendering
from cutline.plans.allotments import allotments
from cutline.session import scratch_dir, shuffles_dropped

_written = {}


def _once(spark, sf_dir, name, write):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        with shuffles_dropped(spark):
            _written[key] = write()
    return spark.read.parquet(_written[key])


def _stored(df, name):
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def bronze(spark, sf_dir):
    return _once(spark, sf_dir, "bronze", lambda: _stored(allotments(spark, sf_dir), "bronze"))


def silver(spark, sf_dir):
    return _once(spark, sf_dir, "silver", lambda: _stored(
        cleaning.build_silver(bronze(spark, sf_dir)).drop("_load_ts"), "silver"
    ))


def silver_v1(spark, sf_dir):
    return _once(spark, sf_dir, "silver_v1", lambda: _stored(
        cleaning.build_silver_v1(bronze(spark, sf_dir)).drop("_load_ts"), "silver_v1"
    ))


def facts(spark, sf_dir):
    return _once(spark, sf_dir, "facts", lambda: _stored(marts.seat_facts(silver(spark, sf_dir)), "facts"))


def gold(spark, sf_dir):
    return _once(spark, sf_dir, "gold", lambda: _stored(marts.main_mart_from_facts(facts(spark, sf_dir)), "gold"))


def gold_v1(spark, sf_dir):
    return _once(spark, sf_dir, "gold_v1", lambda: _stored(marts.v1_mart(silver_v1(spark, sf_dir)), "gold_v1"))


def lines(spark, sf_dir):
    return _once(
        spark, sf_dir, "lines", lambda: rendering.write_document_lines(bronze(spark, sf_dir))
    )
