"""Table scans and sinks. A path holds files of one format; a name lives in the session catalog.

A table is filled either by batch overwrite or by a stream, never by both: overwriting under a
stream's checkpoint would leave the two out of step, so it is refused.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F

FILL_PROPERTY = "cutline.fill"


def located(spark, path):
    """A path and its file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark, path):
    location, files = located(spark, path)
    return files.exists(location)


def delete_path(spark, path):
    location, files = located(spark, path)
    return files.delete(location, True)


def folders_below(spark, path):
    """Names of the folders directly below a path; none if it does not exist."""
    location, files = located(spark, path)
    if not files.exists(location):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(location) if s.isDirectory())


def note(spark, path, text):
    """Text of a small file, which is created with `text` if it does not exist yet. The first writer wins."""
    location, files = located(spark, path)
    if not files.exists(location):
        out = files.create(location, False)
        out.write(bytearray(text.encode()))
        out.close()
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def mark_fill(spark, path, mode):
    """Says in the folder how it is filled; the other way of filling it is refused."""
    other = {"batch": "stream", "stream": "batch"}[mode]
    if path_exists(spark, f"{path}/_filled_by_{other}"):
        raise ValueError(f"{path} is filled by {other} writes; use another place")
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_filled_by_{mode}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, True).close()


def create_namespace(spark, name, location=None):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def read_path(spark, path, fmt="parquet", merge_schema=False):
    reader = spark.read.format(fmt)
    return (reader.option("mergeSchema", True) if merge_schema else reader).load(path)


def read_table(spark, name):
    return spark.table(name)


def counted(df):
    """The frame with a row counter that is filled while a write runs, and the counter."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _writer(df, mode, fmt, partition_by, rows_per_file):
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    return writer


def write_path(df, path, mode="overwrite", fmt="parquet", partition_by=(), rows_per_file=None):
    """Write files and return the number of rows, counted in the same job."""
    spark = df.sparkSession
    if path_exists(spark, f"{path}/_filled_by_stream"):
        raise ValueError(f"{path} is filled by a stream; write the batch result to another place")
    observed, seen = counted(df)
    _writer(observed, mode, fmt, partition_by, rows_per_file).save(path)
    mark_fill(spark, path, "batch")
    return seen.get["rows"]


def fill_mode(spark, name):
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == FILL_PROPERTY).collect()
    return rows[0]["value"] if rows else None


def save_table(df, name, mode="overwrite", fmt="parquet", partition_by=(), rows_per_file=None):
    """Overwrite (schema may change) or append a catalog table and return the number of rows written."""
    spark = df.sparkSession
    if fill_mode(spark, name) == "stream":
        raise ValueError(f"{name} is filled by a stream; write the batch result to another table")
    observed, seen = counted(df)
    _writer(observed, mode, fmt, partition_by, rows_per_file).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{FILL_PROPERTY}' = 'batch')")
    return seen.get["rows"]


def replace_rows(spark, name, keep):
    """Keep only the rows of `keep(table)`, for a batch table that cannot be overwritten while it is read.

    The kept rows are staged in a second table first; after a failure the staged table still holds them.
    """
    staged = f"{name}__staged"
    if spark.catalog.tableExists(staged):
        raise ValueError(f"{staged} exists: finish or drop the interrupted replacement first")
    save_table(keep(spark.table(name)), staged)
    rows = save_table(spark.table(staged), name)
    spark.sql(f"DROP TABLE {staged}")
    return rows


def delete_touched(spark, path, doomed, partition):
    """Deletes the rows of a partitioned folder for which `doomed` holds, and rewrites only the partitions that have such rows.

    The values of touched partitions pass through the driver, so that the scan opens no other partition. They are replaced
    one by one when all are written; a run that fails before leaves the table as it was, and a repeated run ends the work.
    Returns the number of deleted rows.
    """
    rows = spark.read.parquet(path)
    doomed = F.coalesce(doomed, F.lit(False))
    hit = rows.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"), F.count_if(doomed).alias("gone")).filter("gone > 0").collect()
    left = [r[partition] for r in hit if r["gone"] < r["rows"]]
    if left:
        known = F.col(partition).isin([v for v in left if v is not None])
        touched = known | F.col(partition).isNull() if None in left else known
        rows.filter(touched & ~doomed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            partition).parquet(path)
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for r in hit:
        if r["gone"] == r["rows"]:
            value = r[partition]
            delete_path(spark, f"{path}/{name(partition, value if value is None else str(value))}")
    return sum(r["gone"] for r in hit)
