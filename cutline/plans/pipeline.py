"""The whole chain: CSV tree -> Bronze -> Silver -> facts -> marts -> quality metrics -> masked copy.

Layers are built into new folders and published together at the end; until then readers see the last published run. Bronze of
the incremental form, the metrics and the ledger only grow and have one folder each.
"""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from cutline.operators import cleaning, marts, privacy, quality
from cutline.schemas import METRICS_SCHEMA
from cutline.sources import exports, published, tables
from cutline.sources.csv_tree import read_csv_tree
from cutline.streaming import ingest

BUILT = ("bronze", "silver", "facts", "gold_main", "gold_pool", "silver_masked", "filter_values")
GROWING = ("dq_metrics", "run_ledger", "_checkpoint", "_schema")


def locations(out):
    """The folder of each layer; published layers have a folder per run below it."""
    return {name: f"{out.rstrip('/')}/{name}" for name in (*BUILT, *GROWING)}


def layer_path(spark, out, layer):
    """The folder of a layer's current run."""
    at = locations(out)
    if layer in GROWING:
        return at[layer]
    found = published.current(spark, out.rstrip("/"), at["run_ledger"], (layer,))
    if layer not in found:
        raise ValueError(f"{layer} has not been published in {out}")
    return found[layer]


def read_layer(spark, out, layer):
    return spark.read.parquet(layer_path(spark, out, layer))


def read_bronze(spark, out, incremental=False):
    if incremental:
        at = locations(out)
        return ingest.read_ingested(spark, at["bronze"], at["_schema"])
    return read_layer(spark, out, "bronze")


def _write_bronze(spark, source, out, batch_id, incremental, rows_per_file, run):
    """Rows of the batch; the batch form writes into the run's folder, the incremental form adds new files."""
    at = locations(out)
    if incremental:
        ingest.ingest_new_files(
            spark, source, at["bronze"], at["_checkpoint"], batch_id, schema_location=at["_schema"]
        )
        return cleaning.rows_of_batch(read_bronze(spark, out, incremental), batch_id).count()
    tables.mark_fill(spark, at["bronze"], "batch")
    return tables.write_path(read_csv_tree(spark, source, batch_id), run["bronze"], rows_per_file=rows_per_file)


def load_bronze(spark, source, out, batch_id, incremental=False, rows_per_file=None):
    """Bronze alone: the whole tree, published, or the files not seen before. One mode per folder."""
    run = published.new_run(out.rstrip("/"), ("bronze",), batch_id)
    rows = _write_bronze(spark, source, out, batch_id, incremental, rows_per_file, run)
    if not incremental:
        published.publish(spark, locations(out)["run_ledger"], batch_id, [("bronze", "overwrite", rows, run["bronze"])])
    return rows


def build_layers(spark, bronze, run, strict_reference=True, rows_per_file=None):
    """Silver, facts and both marts from Bronze into the folders of a run. Silver is scanned once; the marts read the facts."""
    rows = {}
    rows["silver"] = tables.write_path(
        cleaning.build_silver(bronze, strict_reference), run["silver"], rows_per_file=rows_per_file
    )
    rows["facts"] = tables.write_path(marts.seat_facts(spark.read.parquet(run["silver"])), run["facts"])
    facts = spark.read.parquet(run["facts"])
    rows["gold_main"] = tables.write_path(marts.main_mart_from_facts(facts), run["gold_main"])
    rows["gold_pool"] = tables.write_path(marts.pool_mart_from_facts(facts), run["gold_pool"])
    return rows


def check_quality(spark, out, run_id, bronze, silver, gold, run_ts=None):
    """Append this run's rule results to the metrics history and return them."""
    at = locations(out)["dq_metrics"]
    stamp = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    rows = tables.write_path(quality.metrics(bronze, silver, gold, run_id, stamp).coalesce(1), at, mode="append")
    return rows, spark.read.schema(METRICS_SCHEMA).parquet(at).filter(F.col("run_id") == F.lit(run_id))


def run(spark, source, out, batch_id, incremental=False, strict_reference=True, masked_copy=False, rows_per_file=None, keep=2):
    """One run of the chain. Every step writes a table, so a lost executor repeats tasks of one step only.

    The last step publishes all layers of the run; the `keep` latest runs of a layer stay, older ones are deleted.
    """
    at, base = locations(out), out.rstrip("/")
    new = published.new_run(base, BUILT, batch_id)
    written = {"bronze": _write_bronze(spark, source, out, batch_id, incremental, rows_per_file, new)}
    bronze = read_bronze(spark, out, True) if incremental else spark.read.parquet(new["bronze"])
    written.update(build_layers(spark, bronze, new, strict_reference, rows_per_file))
    silver, gold = spark.read.parquet(new["silver"]), spark.read.parquet(new["gold_main"])
    exports.export_filter_metadata(gold, new["filter_values"])
    built = {"filter_values": None}
    if masked_copy:
        written["silver_masked"] = tables.write_path(privacy.mask_columns(silver, False), new["silver_masked"])
    written["dq_metrics"], metrics = check_quality(spark, out, batch_id, bronze, silver, gold)
    appended = {"dq_metrics"} | ({"bronze"} if incremental else set())
    entries = [
        (layer, "append" if layer in appended else "overwrite", rows, None if layer in appended else new[layer])
        for layer, rows in {**written, **built}.items()
    ]
    published.publish(spark, at["run_ledger"], batch_id, entries)
    published.retire(spark, base, at["run_ledger"], keep)
    return {"rows": written, "metrics": metrics}
