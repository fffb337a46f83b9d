"""Times the stages of the chain: one JSON line on standard output.

Input tables come from $BENCH_SF_DIR, cores from $BENCH_CPUS. The CSV tree and the document lines
are prepared first and not timed. A pass over the smallest tables warms the JVM up.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cutline.operators import cleaning, conversion, documents, lookup, marts, privacy, quality, reports  # noqa: E402
from cutline.plans import conversion_job, layers, pipeline  # noqa: E402
from cutline.plans.allotments import allotments  # noqa: E402
from cutline.plans.catalog_files import STUDENT, as_raw, conversion_log  # noqa: E402
from cutline.session import build_session  # noqa: E402
from cutline.sources import exports, tables  # noqa: E402
from cutline.streaming import ingest  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def text_tree(lines, root):
    """The rendered lines as text files, one folder per round."""
    ordered = lines.repartition(16, "cap_round", "file").sortWithinPartitions("cap_round", "file", "seg", "pos")
    ordered.select("cap_round", "line").write.partitionBy("cap_round").text(root)


def measure(spark, sf_dir):
    """Seconds per stage."""
    base = tempfile.mkdtemp(prefix="cutline-bench-")
    cores = int(CPUS)
    source, out, grown = f"{base}/csv", f"{base}/out", f"{base}/incremental"
    exports.export_csv_tree(as_raw(allotments(spark, sf_dir)).repartition(2 * cores), source)
    lines = layers.lines(spark, sf_dir)
    at = pipeline.locations(out)
    seconds = {}

    def timed(name, action):
        start = time.time()
        action()
        seconds[name] = round(time.time() - start, 3)

    timed("bronze_ingest", lambda: pipeline.load_bronze(spark, source, out, "b1"))
    bronze = pipeline.read_layer(spark, out, "bronze")
    timed("silver_clean", lambda: tables.write_path(cleaning.build_silver(bronze), at["silver"]))
    silver = spark.read.parquet(at["silver"])
    timed("seat_facts", lambda: tables.write_path(marts.seat_facts(silver), at["facts"]))
    facts = spark.read.parquet(at["facts"])
    timed("mart_main", lambda: tables.write_path(marts.main_mart_from_facts(facts), at["gold_main"]))
    timed("mart_by_pool", lambda: tables.write_path(marts.pool_mart_from_facts(facts), at["gold_pool"]))
    gold = spark.read.parquet(at["gold_main"])
    timed("mart_main_from_silver", lambda: drain(marts.main_mart(silver)))
    timed("quality_report", lambda: pipeline.check_quality(spark, out, "b1", bronze, silver, gold))
    timed("filter_export", lambda: exports.export_filter_metadata(gold, at["filter_values"]))
    timed("lookup", lambda: lookup.predict(gold, **STUDENT).collect())
    timed("verify_layer", lambda: drain(reports.verify_layer(silver)))
    timed("distributions", lambda: drain(reports.distributions(silver, ("clean_category", "seat_pool", "seat_gender"))))
    timed("masked_copy", lambda: tables.write_path(privacy.mask_columns(silver, False), at["silver_masked"]))
    timed("incremental_first", lambda: pipeline.load_bronze(spark, source, grown, "r1", incremental=True))
    timed("incremental_rerun", lambda: pipeline.load_bronze(spark, source, grown, "r2", incremental=True))
    timed("parse_documents", lambda: drain(documents.parse_documents(lines, stage=f"{base}/classified")))
    text_tree(lines, f"{base}/documents")
    job = (spark, f"{base}/documents", f"{base}/converted", f"{base}/log")
    timed("convert_from_text", lambda: conversion_job.convert(*job))
    timed("convert_nothing_new", lambda: conversion_job.convert(*job))
    timed("convert_retry", lambda: conversion_job.retry_failed(*job))
    timed("delete_streamed_files", lambda: ingest.delete_files(spark, pipeline.locations(grown)["bronze"], "%CAP-I/%"))
    timed("conversion_report", lambda: drain(conversion.log_summary(conversion_log(spark, sf_dir))))
    timed("completeness", lambda: quality.grade(quality.completeness(silver)).collect())
    timed("flagship_from_raw", lambda: lookup.predict(
        marts.main_mart(cleaning.build_silver(bronze)), **STUDENT).collect())
    return seconds, bronze.count()


def main():
    spark = build_session("cutline-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    if os.path.isdir(small) and os.path.abspath(small) != os.path.abspath(SF_DIR):
        measure(spark, small)
    seconds, rows = measure(spark, SF_DIR)
    print(json.dumps({
        "metric": "pipeline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "rows": rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
