"""Incremental ingest: only files that no earlier run has seen, run to completion.

The checkpoint's file log makes discovery exactly-once. A micro-batch writes one folder, which it replaces when
it is repeated; that makes the output exactly-once. A target belongs to the checkpoint that filled it first.

Files that cannot be bound to the schema (no header, a repeated or reserved name, no known column) go to a table of
rejects with their text and the reason; the other files of the micro-batch load.
"""

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.operators.cleaning import coerce_types
from cutline.schemas import MALFORMED, RAW_TEXT_SCHEMA
from cutline.session import scratch_dir
from cutline.sources.csv_tree import with_provenance
from cutline.sources.tables import (
    FILL_PROPERTY, delete_path, fill_mode, folders_below, mark_fill, note, path_exists, write_path,
)

SNAPSHOT_SCHEMA = "version int, schema string"
FILES_PER_TRIGGER = 10_000  # bounds what a failed micro-batch repeats on a first run over a large tree


# A type holds the values of those before it.
LATTICE = (T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType())
PROVENANCE = "_source_file string, _ingest_ts timestamp, _batch_id string"
RESERVED = (MALFORMED, "_source_file", "_ingest_ts", "_batch_id", "micro_batch", "version")


def snapshots(spark, location):
    """(version, schema) of all snapshots, oldest first."""
    if not path_exists(spark, location):
        return []
    rows = spark.read.schema(SNAPSHOT_SCHEMA).json(location).orderBy("version").collect()
    return [(r["version"], T.StructType.fromJson(json.loads(r["schema"]))) for r in rows]


def read_snapshot(spark, location):
    """Latest schema snapshot and its version; (None, -1) before the first run."""
    found = snapshots(spark, location)
    return (found[-1][1], found[-1][0]) if found else (None, -1)


def wider(name, a, b):
    """The narrowest type of int < bigint < double < string that holds both; a type outside them cannot change."""
    if a == b:
        return a
    if a not in LATTICE or b not in LATTICE:
        raise ValueError(f"column {name} changed from {a.simpleString()} to {b.simpleString()}")
    return LATTICE[max(LATTICE.index(a), LATTICE.index(b))]


def widened(known, declared):
    """Known fields in their order, as wide as both sides need, then the new ones. Names match without letter case."""
    asked = {field.name.lower(): field.dataType for field in declared}
    if len(asked) < len(declared):
        raise ValueError("a column is declared twice (letter case does not tell names apart)")
    fields = [
        T.StructField(field.name, wider(field.name, field.dataType, asked.get(field.name.lower(), field.dataType)))
        for field in known
    ]
    names = {field.name.lower() for field in known}
    return T.StructType([*fields, *[field for field in declared if field.name.lower() not in names]])


def keep_snapshot(spark, location, version, schema):
    row = [(version, schema.json())]
    spark.createDataFrame(row, SNAPSHOT_SCHEMA).coalesce(1).write.mode("append").json(location)


def resolve_schema(spark, location, declared):
    """Schema of this run: the snapshot widened by the declared columns. A wider one is kept as a new version."""
    wanted = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    known, version = read_snapshot(spark, location)
    schema = widened(known, wanted) if known else wanted
    if schema != known:
        keep_snapshot(spark, location, version + 1, schema)
    return schema


def new_file_stream(spark, source, batch_id, schema=RAW_TEXT_SCHEMA, max_files_per_trigger=FILES_PER_TRIGGER):
    """Stream over the CSV files below a folder, with provenance.

    Rows that are wider or narrower than the schema are kept, with their text in `_malformed`.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = (
        spark.readStream.schema(T.StructType([*declared, T.StructField(MALFORMED, T.StringType())]))
        .option("header", True).option("encoding", "UTF-8").option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files_per_trigger)
    )
    return coerce_types(with_provenance(reader.csv(source), batch_id))


def append_available(stream, target, checkpoint):
    """Write everything that is available now to a catalog table and stop."""
    spark = stream.sparkSession
    if fill_mode(spark, target) == "batch":
        raise ValueError(f"{target} is filled by batch writes; stream to another table")
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).toTable(target)
    )
    query.awaitTermination()
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{FILL_PROPERTY}' = 'stream')")
    return query


def bind_target(spark, target, checkpoint):
    """Ties a target to the stream of one checkpoint: micro-batches are numbered by it, and so are the target's folders."""
    own = note(spark, f"{checkpoint}/_stream", uuid.uuid4().hex)
    held = note(spark, f"{target}/_stream", own)
    if held != own:
        raise ValueError(f"{target} is filled by the stream of another checkpoint; use that one, or another target")


def _blank(line):
    return F.btrim(line, F.lit(" \t")) == ""


def file_headers(lines, known):
    """A row per file: place (block, at) and column names of its first line that is not blank, or the reason why it cannot be loaded."""
    first = lines.groupBy("file").agg(F.min(F.when(~_blank(F.col("value")), F.struct("block", "at", "value"))).alias("head"))
    quoted = F.regexp_extract_all(F.concat(F.lit(","), F.col("head.value")), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), 1)

    def name(field, place):
        bare = F.when(
            field.startswith('"') & field.endswith('"'),
            F.replace(field.substr(F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(field)
        return F.coalesce(F.nullif(F.trim(bare), F.lit("")), F.concat(F.lit("_c"), place.cast("string")))

    named = first.select("file", "head.block", "head.at", F.transform(quoted, name).alias("names")).withColumn(
        "low", F.transform("names", F.lower))

    def literals(names):
        return F.array(*[F.lit(n.lower()) for n in names]).cast("array<string>")

    reason = (
        F.when(F.col("names").isNull(), "no header")
        .when(F.size(F.array_distinct("low")) < F.size("low"), "repeated column name")
        .when(F.arrays_overlap("low", literals(RESERVED)), "reserved column name")
        .when(~F.arrays_overlap("low", literals([f.name for f in known])), "no known column")
    )
    return named.withColumn("reason", reason)


def bound_rows(lines, heads, widths, schema):
    """Typed rows of the lines under the headers of their files, in one pass for any number of headers.

    A line is parsed once, with as many fields as its header has (one parser per number of fields); each column of the
    schema takes the field that the file's header names. Rows wider or narrower than their header, or with a value that its
    column's type does not hold, are kept with their text in `_malformed`.
    """
    names = F.array(*[F.lit(f.name.lower()) for f in schema])
    headed = heads.select(
        "file", F.col("block").alias("_block"), F.col("at").alias("_at"), F.size("names").alias("width"),
        F.transform(names, lambda n: F.array_position("low", n).cast("int")).alias("place"),
    )
    below = lines.join(headed, "file").filter(
        ~((F.col("block") == F.col("_block")) & (F.col("at") == F.col("_at"))) & ~_blank(F.col("value")))
    parsed = {}
    for width in widths:
        kinds = ", ".join([*[f"c{i} string" for i in range(width)], f"{MALFORMED} string"])
        row = F.from_csv("value", kinds, {"columnNameOfCorruptRecord": MALFORMED})
        parsed[f"row_{width}"] = F.when(F.col("width") == width, row)
    split = below.select("file", "value", "place", *[row.alias(name) for name, row in parsed.items()])
    fields = F.coalesce(*[
        F.when(F.col(f"row_{w}").isNotNull(), F.array(*[F.col(f"row_{w}.c{i}") for i in range(w)])) for w in widths])
    listed = split.select(
        F.col("file").alias("_source_file"), "value", "place", fields.alias("fields"),
        F.coalesce(*[F.col(f"row_{w}.{MALFORMED}") for w in widths]).alias("odd"))
    texts = listed.select("_source_file", "value", "odd", *[
        F.get("fields", F.get("place", F.lit(n)) - 1).alias(f"t{n}") for n in range(len(schema))])
    typed = [F.col(f"t{n}").try_cast(field.dataType) for n, field in enumerate(schema)]
    unreadable = [
        F.col(f"t{n}").isNotNull() & typed[n].isNull() for n, f in enumerate(schema) if f.dataType != T.StringType()]
    odd = F.col("odd")
    for test in unreadable:
        odd = F.coalesce(odd, F.when(test, F.col("value")))
    return texts.select(*[t.alias(f.name) for t, f in zip(typed, schema)], odd.alias(MALFORMED), "_source_file")


def ingest_new_files(spark, source, target, checkpoint, batch_id, schema=RAW_TEXT_SCHEMA, schema_location=None,
                     max_files_per_trigger=FILES_PER_TRIGGER, as_table=False):
    """One incremental run from a CSV folder into a Bronze folder.

    A micro-batch replaces the folder of its own number, so one that is repeated after a failure writes nothing
    twice. Columns that the files bring are added to the schema snapshot as text, after the rows are written. The
    text of new files is read once, into a scratch table that is removed at the end. The catalog-table form keeps
    to the declared columns and refuses files whose header is another one.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if as_table:
        declared = resolve_schema(spark, schema_location, declared) if schema_location else declared
        return append_available(new_file_stream(spark, source, batch_id, declared, max_files_per_trigger), target, checkpoint)
    schema_location = schema_location or f"{target.rstrip('/')}_schema"
    mark_fill(spark, target, "stream")
    bind_target(spark, target, checkpoint)

    def load(lines, number):
        scratch = scratch_dir(spark, "incoming")
        lines.withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{scratch}/lines")
        staged = spark.read.parquet(f"{scratch}/lines")
        kept, version = read_snapshot(spark, schema_location)
        known = widened(kept, declared) if kept else declared
        file_headers(staged, known).write.parquet(f"{scratch}/headers")
        heads = spark.read.parquet(f"{scratch}/headers")
        usable, refused = heads.filter("reason IS NULL"), heads.filter("reason IS NOT NULL").select("file", "reason")
        widths = sorted(r[0] for r in usable.select(F.size("names")).distinct().collect())
        if widths:
            found = usable.select(F.explode("names").alias("name")).groupBy(F.lower("name")).agg(F.min("name").alias("name"))
            brought = sorted(r["name"] for r in found.select("name").collect())
            names = {f.name.lower() for f in known}
            wide = T.StructType([*known, *[T.StructField(n, T.StringType()) for n in brought if n.lower() not in names]])
            version += wide != kept
            for other in folders_below(spark, target):
                delete_path(spark, f"{target}/{other}/micro_batch={number}")  # left by a failed attempt
            stamped = coerce_types(bound_rows(staged, usable, widths, wide)).withColumns(
                {"_ingest_ts": F.current_timestamp(), "_batch_id": F.lit(batch_id)})
            stamped.write.mode("overwrite").partitionBy("_batch_id").parquet(f"{target}/version={version}/micro_batch={number}")
            if wide != kept:
                keep_snapshot(spark, schema_location, version, wide)
        if refused.limit(1).count():
            rejected = staged.join(refused, "file").select(
                F.col("file").alias("_source_file"), "reason", "block", "at", F.col("value").alias("text"),
                F.current_timestamp().alias("_ingest_ts"), F.lit(batch_id).alias("_batch_id"))
            rejected.write.mode("overwrite").parquet(f"{rejects_location(target)}/micro_batch={number}")
        delete_path(spark, scratch)

    value = F.regexp_replace("value", "^\ufeff", "").alias("value")
    lines = (
        spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files_per_trigger).text(source)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value)
    )
    query = lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


REJECTS_SCHEMA = (
    "_source_file string, reason string, block bigint, at bigint, text string, _ingest_ts timestamp, _batch_id string"
)


def rejects_location(target):
    return f"{target.rstrip('/')}_rejects"


def read_rejects(spark, target):
    """Lines of the files that could not be loaded, with the reason, in the order (block, at) of their file."""
    if not path_exists(spark, rejects_location(target)):
        return spark.createDataFrame([], REJECTS_SCHEMA)
    return spark.read.schema(REJECTS_SCHEMA).parquet(rejects_location(target)).drop("micro_batch")


def delete_files(spark, target, pattern):
    """Forget the files whose path is like `pattern` in all runs: a list beside the rows, which stay untouched.

    Returns the number of files. Files that arrive later are not affected, unless they have the same path.
    """
    gone = spark.read.schema(PROVENANCE).parquet(target).select("_source_file").filter(F.col("_source_file").like(pattern)).distinct()
    return write_path(gone, deleted_location(target), mode="append")


def deleted_location(target):
    return f"{target.rstrip('/')}_deleted"


def ingested_schema(spark, schema):
    """Schema of the target: the typed columns of the files, the malformed text and the provenance."""
    fields = T.StructType([*schema, T.StructField(MALFORMED, T.StringType())])
    typed = coerce_types(spark.createDataFrame([], fields)).schema
    return T.StructType([*typed, *T.StructType.fromDDL(PROVENANCE)])


def _same_types(older, newer):
    kinds = {f.name: f.dataType for f in newer}
    return all(kinds.get(f.name) == f.dataType for f in older)


def read_ingested(spark, target, schema_location):
    """The rows of all runs under the latest snapshot, without deleted files.

    Columns that came later are NULL in earlier rows, and rows from before a column's type was widened are cast on
    read. There is one scan per change of types, with an explicit schema, which saves a pass over all file footers.
    """
    groups = []  # versions that one schema reads
    for version, schema in snapshots(spark, schema_location):
        if groups and _same_types(groups[-1][1], schema):
            groups[-1] = [*groups[-1][0], version], schema
        else:
            groups.append(([version], schema))
    latest, rows = ingested_schema(spark, groups[-1][1]), None
    for versions, schema in groups:
        paths = [f"{target}/version={v}" for v in versions if path_exists(spark, f"{target}/version={v}")]
        own = ingested_schema(spark, schema)
        part = (
            spark.read.schema(own).option("basePath", target).parquet(*paths) if paths else spark.createDataFrame([], own)
        )
        have = set(own.fieldNames())
        part = part.select(*[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in latest])
        rows = part if rows is None else rows.unionByName(part)
    if path_exists(spark, deleted_location(target)):
        deleted = spark.read.schema("_source_file string").parquet(deleted_location(target)).distinct()
        rows = rows.join(deleted, "_source_file", "left_anti").select(*rows.columns)
    return rows


def run_counts(bronze):
    """Rows and files per run, in one pass."""
    return bronze.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("new_rows"), F.countDistinct("_source_file").alias("new_files")
    )
