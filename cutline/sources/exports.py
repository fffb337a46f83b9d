"""File exports: filter metadata as JSON, results as CSV, and a CSV tree by round."""

from pyspark.sql import functions as F

from cutline.operators.reports import filter_values
from cutline.session import small_scans
from cutline.sources.tables import delete_path

FILTER_VALUES_SCHEMA = "field string, value string"


def export_filter_metadata(mart, path):
    """Write the filter values as JSON lines, one per field and value, NULL excluded; the form is the same for any size."""
    values = filter_values(mart).filter(F.col("value").isNotNull())
    field = F.when(F.col("field") == "branch_name", "branch").otherwise("category")
    values.select(field.alias("field"), "value").write.mode("overwrite").json(path)


def read_filter_metadata(spark, path):
    return spark.read.schema(FILTER_VALUES_SCHEMA).json(path)


def export_csv(df, path, **options):
    df.write.mode("overwrite").option("header", True).options(**options).csv(path)


ROWS_PER_FILE = 250_000


def _csv_writer(df, mode, compression):
    """A compressed file is read by one task from its start to its end, so its rows are bounded."""
    writer = df.write.mode(mode).option("header", True)
    return writer.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE) if compression else writer


def export_csv_tree(df, path, folder="cap_round", document=None, compression=None):
    """A CSV tree with one folder per round and, if a document column is named, one below it per document.

    The folder column stays in the files, the document column does not. Rows are not moved: each task
    writes into the folders it has rows for. Only folders that get rows are replaced.
    """
    foldered = df.withColumn("folder", F.col(folder))
    below = [document] if document else []
    with small_scans(df.sparkSession):  # the writer sorts each task's rows by their folder
        _csv_writer(foldered, "overwrite", compression).option("partitionOverwriteMode", "dynamic").partitionBy(
            "folder", *below
        ).csv(path)


PLACE = ("document", "seg", "pos")


def export_ordered_tree(df, path, folder="cap_round", rows_per_file=ROWS_PER_FILE, compression=None):
    """Appends rows with their place (document, seg, pos) to a CSV tree with one folder per round, in the documents' order.

    Rows are dealt out by ranges of round and place, so the files of a round follow each other in the order of their names, a
    document is never a file of its own, and one with very many rows is spread over several. Their number is bounded by the
    number of rows over `rows_per_file`, which a task sorts in memory, and one more per round.
    """
    placed = df.withColumn("folder", F.col(folder))
    files = max(1, -(-df.count() // rows_per_file))
    ranged = placed.repartitionByRange(files, "folder", *PLACE).sortWithinPartitions("folder", *PLACE)
    _csv_writer(ranged, "append", compression).partitionBy("folder").csv(path)


def read_ordered_tree(spark, path):
    """Rows of an ordered tree as text columns, with typed places."""
    rows = spark.read.option("header", True).csv(path).drop("folder")
    return rows.withColumns({"seg": F.col("seg").cast("bigint"), "pos": F.col("pos").cast("bigint")})


def drop_documents(spark, path, documents, compression=None):
    """Takes the rows of documents out of an ordered tree; folders without such rows keep their files."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.withColumn("folder", F.col("folder").cast("string"))
    gone = documents.select("document").distinct()
    touched = [r[0] for r in rows.join(gone, "document", "left_semi").select("folder").distinct().collect()]
    if not touched:
        return 0
    stays = rows.filter(F.col("folder").isin(touched)).join(gone, "document", "left_anti").select(*rows.columns)
    left = {r[0] for r in stays.select("folder").distinct().collect()}
    by_place = [F.col("document"), F.col("seg").cast("bigint"), F.col("pos").cast("bigint")]
    ordered = stays.repartitionByRange("folder", *by_place).sortWithinPartitions("folder", *by_place)
    _csv_writer(ordered, "overwrite", compression).option("partitionOverwriteMode", "dynamic").partitionBy("folder").csv(path)
    for value in touched:
        if value not in left:
            name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("folder", value)
            delete_path(spark, f"{path}/{name}")
    return len(touched)
