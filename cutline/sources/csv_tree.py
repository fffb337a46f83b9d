"""CSV tree scan with provenance columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.operators.cleaning import coerce_types
from cutline.schemas import MALFORMED, RAW_TEXT_SCHEMA


def with_provenance(df, batch_id):
    """Source file, ingest time and batch id; call it on a fresh file scan."""
    return df.withColumns({
        "_source_file": F.col("_metadata.file_path"),
        "_ingest_ts": F.current_timestamp(),
        "_batch_id": F.lit(batch_id),
    })


def read_csv_tree(
    spark, root, batch_id, schema=RAW_TEXT_SCHEMA, infer=False, one_level=False, score_type="double", pattern="*.csv",
):
    """All CSV files below a folder, header line skipped, typed by the documented schema; of a tree written with gzip by `*.csv.gz`.

    Fields are read as text and coerced, so '01002' keeps its zero and '1.0' becomes 1. `one_level`
    reads files exactly one folder down; otherwise any depth. Headers are checked against the schema. Rows that
    are wider or narrower than the schema are kept, with their text in `_malformed`.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    if infer:
        reader = reader.option("inferSchema", True)
    else:
        declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        wide = T.StructType([*declared, T.StructField(MALFORMED, T.StringType())])
        reader = reader.schema(wide).option("enforceSchema", False).option("columnNameOfCorruptRecord", MALFORMED)
    if one_level:
        return coerce_types(with_provenance(reader.csv(f"{root}/*/{pattern}"), batch_id), score_type)
    files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).csv(root)
    return coerce_types(with_provenance(files, batch_id), score_type)
