"""Session settings and the shared scratch folder."""

import math
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name="cutline", master=None, **conf):
    """A session with runtime re-planning on; on a cluster pass no master and let spark-submit set it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


@contextmanager
def shuffles_sized_for(spark, total_bytes):
    """At least one shuffle partition per 128 MB while the block runs.

    Run-time re-planning merges small partitions but cannot split one that a window needs whole, so
    the number has to grow with the input.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    needed = max(int(before), math.ceil((total_bytes or 0) / SHUFFLE_PARTITION_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", needed)
    try:
        yield needed
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def shuffles_dropped(spark):
    """The files of a shuffle go as soon as the step of the block that wrote them has ended.

    Otherwise they stay until the driver's JVM happens to collect their plans, and a job of many steps holds those of all steps
    on disk at once. A frame that is run twice shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


SCAN_BYTES = 16 * 1024 * 1024


@contextmanager
def small_scans(spark, scan_bytes=SCAN_BYTES):
    """Scans planned in the block give a task at most that many bytes of files.

    For steps that sort what they scan: in columns with few values a file of the usual 128 MB packs millions of rows, many
    times its size in memory, and each of its tasks would spill all of them.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, min(scan_bytes, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_dir(spark, label):
    """A new folder for intermediate tables in a place that all executors share.

    That is the folder named by spark.checkpoint.dir, else the context's checkpoint folder, else the warehouse.
    """
    shared = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
