"""The chain in the catalog: named tables for its builders, views for its readers.

The private namespace holds a table per layer over the folders of the published run. Readers get the other namespace: the
marts and the metrics as they are, Silver through the mask function, Bronze and the facts not at all. Views are
replaced after a run is published, so a reader's name never points to a half-built layer.
"""

from cutline.operators import privacy
from cutline.plans import pipeline
from cutline.sources import tables

PRIVATE = ("bronze", "silver", "facts", "gold_main", "gold_pool", "dq_metrics")
OPEN = ("gold_main", "gold_pool", "dq_metrics")


def register(spark, out, private, readers, incremental=False):
    """(Re)places the named tables and the readers' views over the current run of the chain."""
    tables.create_namespace(spark, private)
    tables.create_namespace(spark, readers)
    for layer in PRIVATE:
        if layer == "bronze" and incremental:
            continue  # read through the schema snapshot, not as one folder
        spark.sql(f"DROP TABLE IF EXISTS {private}.{layer}")
        spark.sql(f"CREATE TABLE {private}.{layer} USING parquet LOCATION '{pipeline.layer_path(spark, out, layer)}'")
    privacy.create_mask_function(spark, f"{readers}.masked", temporary=False)
    privacy.publish_masked_view(spark, f"{private}.silver", f"{readers}.silver", f"{readers}.masked")
    for layer in OPEN:
        spark.sql(f"CREATE OR REPLACE VIEW {readers}.{layer} AS SELECT * FROM {private}.{layer}")
    return [f"{readers}.{layer}" for layer in ("silver", *OPEN)]


def run_tables(spark, source, out, batch_id, private, readers, incremental=False, **options):
    """One run of the chain, then its tables and views. Returns the readers' names."""
    pipeline.run(spark, source, out, batch_id, incremental, **options)
    return register(spark, out, private, readers, incremental)
