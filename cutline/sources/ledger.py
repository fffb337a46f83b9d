"""Run ledger: an append-only list of what each run wrote, in place of a table-version log."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cutline.schemas import LEDGER_SCHEMA


def record(spark, path, run_id, entries):
    """Append (layer, operation, rows) entries, with the folder of a published layer behind them, in one commit with one time stamp."""
    rows = spark.createDataFrame(
        [(run_id, None, *entry[:3], entry[3] if len(entry) > 3 else None) for entry in entries], LEDGER_SCHEMA
    )
    rows.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def history(spark, path, layer=None):
    """Version, time, operation and rows per layer, oldest version 0. One small partition per layer."""
    entries = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    if layer:
        entries = entries.filter(F.col("layer") == layer)
    order = Window.partitionBy("layer").orderBy("ts", "run_id")
    return entries.withColumn("version", F.row_number().over(order) - 1).select(
        "layer", "version", "ts", "operation", "rows", "run_id"
    ).orderBy("layer", F.col("version").desc())
