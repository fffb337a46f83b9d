"""Layers that are published as a whole: write, then switch.

A build writes each layer into a new folder, `<layer>/run=<id>`. One entry per layer in the run ledger, all of them in one
append that comes last, makes the new folders current; readers ask the ledger. A build that fails midway leaves folders
that nobody reads, and the layers as they were.
"""

import uuid

from pyspark.sql import functions as F

from cutline.schemas import LEDGER_SCHEMA
from cutline.sources import ledger
from cutline.sources.tables import delete_path, folders_below, path_exists


def new_run(base, layers, run_id):
    """Folders for a build, which no other build uses, even one of the same id."""
    name = f"run={run_id}-{uuid.uuid4().hex[:8]}"
    return {layer: f"{base}/{layer}/{name}" for layer in layers}


def publish(spark, ledger_path, run_id, entries):
    """The switch: entries (layer, operation, rows, folder) become current together. Folders are noted relative to their layer."""
    ledger.record(spark, ledger_path, run_id, [
        (layer, operation, rows, folder and folder.rsplit("/", 1)[1]) for layer, operation, rows, folder in entries])


def publications(spark, ledger_path):
    """(layer, folder, ts) of everything that was ever published."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).filter(F.col("folder").isNotNull()).select(
        "layer", "folder", "ts", "run_id")


def current(spark, base, ledger_path, layers=None):
    """Layer -> its current folder. One ledger entry per layer passes through the driver."""
    if not path_exists(spark, ledger_path):
        return {}
    latest = publications(spark, ledger_path).groupBy("layer").agg(F.max_by("folder", F.struct("ts", "run_id")).alias("folder"))
    found = {r["layer"]: f"{base}/{r['layer']}/{r['folder']}" for r in latest.collect()}
    return {layer: at for layer, at in found.items() if layers is None or layer in layers}


def retire(spark, base, ledger_path, keep=2, unpublished=False):
    """Deletes published folders older than the last `keep` of their layer, and on request those that no ledger entry names.

    Readers of an older folder must have finished. `unpublished` is for times when no build is running.
    """
    known, gone = {}, []
    for r in publications(spark, ledger_path).orderBy("ts", "run_id").collect():
        known.setdefault(r["layer"], []).append(r["folder"])
    for layer, folders in known.items():
        kept = set(folders[-keep:])
        for name in folders_below(spark, f"{base}/{layer}"):
            if name.startswith("run=") and name not in kept and (name in folders or unpublished):
                delete_path(spark, f"{base}/{layer}/{name}")
                gone.append(f"{layer}/{name}")
    return gone
