"""Exact dedup: an extendible-hash index of whole texts on shared files. DataFrame functions only.

Two texts are equal when they are identical after lower-casing A-Z; null counts as empty. Of equal
texts the row with the largest doc_id stays.

1. `entries`: one scan of the texts writes (doc_id, key, digest), the key being 64 hash bits.
2. `directory`: the leading bits of the distinct keys are counted. While a bucket holds more keys than
   its capacity the directory doubles and that bucket splits by one more bit. A bucket is a range of
   keys. Copies count once here, so a text that a third of all rows share does not overfill a bucket.
3. `chains`: a row looks its bucket up in the directory and meets others by bucket, key and text. Equal rows are
   combined in the task that reads them, before the shuffle, and text bytes are compared there and where the
   parts meet. Texts of one key that differ become numbered links of that key's chain. Owner tasks hold buckets,
   which are ranges of keys, and write them sorted.
4. Lookup: each entry asks the directory for its bucket, the bucket's chain of its key for the link of its digest, and
   the link for what stays. A row whose bucket the directory does not know has no answer, and would be missing.

Rows: repeated rows, and rows that repeat a doc_id, are rows like any other; exactly one row per group is
kept, unless several rows of the group carry the kept doc_id, which then are all kept. A null doc_id is
the smallest; a group of null ids alone keeps none of them and has keep_id null. An empty table gives
an empty result. Other columns are ignored.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window

from cutline.llm.common import ascii_lower, documents, new_folder, stored

FINE_BITS = 20


def normalised(text):
    return ascii_lower(F.coalesce(text, F.lit("")))


def hash_key(text):
    return F.xxhash64(text)


def _slot(key, bits):
    """The leading `bits` bits of the key. Two shifts, because one by 64 does nothing; no bits are 0, computed from the key."""
    return F.shiftrightunsigned(F.shiftrightunsigned(key, 1), 63 - bits)


def build_directory(keys, capacity):
    """(slot, bucket, depth) for each slot of the doubled directory, and its global depth.

    A bucket that is overfull at the last depth stays whole: its keys overflow into its chain.
    """
    fine = keys.groupBy(_slot(F.col("key"), FINE_BITS).alias("fine")).agg(F.count(F.lit(1)).alias("keys"))
    fine = stored(fine, new_folder(keys.sparkSession, "key-counts"))
    depth, leaves, parents = 0, [], None
    while True:
        at = F.shiftright("fine", FINE_BITS - depth).alias("bucket")
        counts = fine.groupBy(at).agg(F.sum("keys").alias("keys"))
        if parents is not None:
            counts = counts.join(parents, F.shiftright("bucket", 1) == F.col("parent"), "left_semi")
        overfull = counts.filter(F.col("keys") > capacity)
        if depth == FINE_BITS or overfull.isEmpty():
            leaves.append(counts.withColumn("depth", F.lit(depth)))
            break
        leaves.append(counts.filter(F.col("keys") <= capacity).withColumn("depth", F.lit(depth)))
        parents, depth = overfull.select(F.col("bucket").alias("parent")), depth + 1
    buckets = leaves[0]
    for more in leaves[1:]:
        buckets = buckets.unionByName(more)
    spread = F.lit(depth) - F.col("depth")
    first = F.call_function("shiftleft", F.col("bucket"), spread)
    last = F.call_function("shiftleft", F.col("bucket") + 1, spread) - 1
    return buckets.select(
        F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "depth", "keys"
    ), depth


def build_index(docs, capacity=32_768, key=hash_key):
    """Writes entries, directory and chains to the shared folder and returns them."""
    spark = docs.sparkSession
    root = new_folder(spark, "exact-index")
    texts = docs.select("doc_id", normalised(F.col("text")).alias("body"))
    entries = stored(
        texts.select("doc_id", key(F.col("body")).alias("key"), F.unhex(F.sha2("body", 256)).alias("digest")),
        f"{root}/entries",
    )
    directory, depth = build_directory(entries.select("key").distinct(), capacity)
    directory = stored(directory, f"{root}/directory")
    groups = (
        in_buckets(texts.select("doc_id", "body", key(F.col("body")).alias("key")), directory, depth)
        .groupBy("bucket", "key", "body")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("bucket", "key", F.unhex(F.sha2("body", 256)).alias("digest"), "keep_id", "group_size")
    )
    place = Window.partitionBy("bucket", "key").orderBy("digest")
    chains = (
        groups.repartition("bucket")
        .withColumn("link", F.row_number().over(place))
        .select("bucket", "key", "link", "digest", "keep_id", "group_size")
        .sortWithinPartitions("bucket", "key", "link")
    )
    return in_buckets(entries, directory, depth), directory, stored(chains, f"{root}/chains")


def in_buckets(rows, directory, depth):
    """The rows with the bucket that the directory has for the leading bits of their key.

    The directory is broadcast, so that texts are not moved for it: it has two numbers for each of at most 2 ** FINE_BITS slots.
    """
    slots = F.broadcast(directory.select("slot", "bucket"))
    return rows.withColumn("slot", _slot(F.col("key"), depth)).join(slots, "slot").drop("slot")


def exact_dedup(docs, capacity=32_768, key=hash_key):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and its bucket, key and link in the index."""
    entries, _, chains = build_index(docs, capacity, key)
    return entries.join(chains, ["bucket", "key", "digest"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "bucket", "key", "link",
    )


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir)).drop("bucket", "key", "link")


OP2_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM d WINDOW g AS (PARTITION BY body)
"""
