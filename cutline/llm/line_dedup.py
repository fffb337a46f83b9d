"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of at least `min_chars` code
points that occur in two documents or more lose all their lines, except in the smallest doc_id that
holds them. Other lines stay as they are, joined by line feeds.

`LineRuns` keeps the keys seen so far as sorted runs on shared files. A batch of lines is merge-anti-joined
with the runs; keys not seen before form a new run with the first document that holds them. When a
level has `fanout` runs, they are merged into one run of the next level. Runs hold disjoint keys. Batches
arrive in ascending doc_id, so the first document of a run is the smallest of all.

A line that a third of all documents share is one row per task after the partial aggregate; the join
that marks its lines is an inner join without hints, whose large partitions Spark splits. Keys are 128 hash bits.

Rows: null or empty text is one empty line. Rows that repeat a doc_id count as one document. A row with
null doc_id belongs to no document: it keeps all its lines and owns none. An empty table gives an empty
result. Other columns pass through untouched.
"""

from functools import reduce

from pyspark.sql import functions as F

from cutline.llm.common import BLANKS, ascii_lower, documents, new_folder, stored

KEY = ["__h1", "__h2"]


class LineRuns:
    """Sorted runs of (key, first document) in levels below one shared folder."""

    def __init__(self, spark, root, fanout=2):
        self.spark, self.root, self.fanout, self.levels, self.written = spark, root, fanout, [[]], 0

    def _write(self, run, level):
        while len(self.levels) <= level:
            self.levels.append([])
        path = f"{self.root}/level{level}/run{self.written}"
        self.written += 1
        run.sortWithinPartitions(*KEY).write.parquet(path)
        self.levels[level].append(path)

    def read(self):
        """All runs together, or None before the first batch."""
        paths = [path for level in self.levels for path in level]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, lines):
        """Takes in one batch of (doc_id, key) rows; its ids are larger than those of earlier batches."""
        firsts = lines.groupBy(*KEY).agg(F.min("__doc").alias("__first"))
        seen = self.read()
        if seen is not None:
            firsts = firsts.join(seen.select(*KEY).hint("merge"), KEY, "left_anti")
        self._write(firsts, 0)
        self.compact()

    def compact(self):
        """Merges each full level into one run of the next one."""
        level = 0
        while level < len(self.levels):
            full = self.levels[level]
            if len(full) >= self.fanout:
                self.levels[level] = []
                self._write(self.spark.read.parquet(*full).repartition(*KEY), level + 1)
            level += 1


def line_keys(docs, min_chars, batch):
    """(batch, document, text hash, line number, key) of every line whose key is long enough."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        batch.alias("__batch"),
        F.col("doc_id").alias("__doc"),
        F.xxhash64("text").alias("__row"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("__pos", "__line"),
    )
    key = ascii_lower(F.trim(F.col("__line"), F.lit(BLANKS)))
    return (
        lines.withColumn("__key", key)
        .filter(F.char_length("__key") >= min_chars)
        .select("__batch", "__doc", "__row", "__pos",
                F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(7), "__key").alias("__h2"))
    )


def _batches(docs, number):
    """A batch number per row, ascending with doc_id, from quantiles of doc_id."""
    cuts = docs.agg(F.percentile_approx("doc_id", [i / number for i in range(1, number)], 1000)).first()[0] or []
    return reduce(lambda a, cut: a + (F.col("doc_id") > cut).cast("int"), cuts, F.lit(0))


def line_dedup(docs, min_chars=10, batches=4, fanout=2):
    """The rows of `docs` with n_lines, n_dropped and kept_text added (replacing columns of these names)."""
    spark = docs.sparkSession
    root = new_folder(spark, "line-runs")
    keyed = line_keys(docs, min_chars, _batches(docs, batches))
    keyed.write.partitionBy("__batch").parquet(f"{root}/lines")
    lines = spark.read.schema(keyed.schema).parquet(f"{root}/lines")
    runs = LineRuns(spark, f"{root}/runs", fanout)
    for batch in range(batches):
        runs.add(lines.filter(F.col("__batch") == batch))
    dropped = (
        lines.join(runs.read(), KEY)
        .filter(F.col("__doc") > F.col("__first"))
        .groupBy("__doc", "__row")
        .agg(F.collect_set("__pos").alias("__gone"))
    )
    whole = docs.withColumn("__row", F.xxhash64("text")).withColumn(
        "__lines", F.split(F.coalesce("text", F.lit("")), "\n", -1)
    )
    joined = whole.join(dropped, (whole["doc_id"] == dropped["__doc"]) & (whole["__row"] == dropped["__row"]), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    kept = F.when(F.col("__gone").isNull(), F.array_join("__lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")
    )
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    return joined.select(
        *[whole[c] for c in own],
        F.size("__lines").cast("long").alias("n_lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )


def op6_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
"""
