"""Corpus pipeline: quality, line dedup, near-duplicates, secrets, packing. Each stage rereads the last one's rows.

Every stage but the last takes and returns the columns of `documents` (doc_id, text, lang, source, n_chars; further
columns pass through unchanged, whatever their names). Nulls, empty and very long texts, repeated rows and empty tables are treated as the
operators' docstrings say. n_chars follows the text where a stage changes it.
"""

from pyspark.sql import functions as F

from cutline.llm import jaccard_join, line_dedup, packing, quality, secret_scan
from cutline.llm.common import documents, new_folder, stored


def _narrow(docs):
    """doc_id, text and all other columns in one, so that no name of theirs meets one that an operator uses."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(0).alias("none")]).alias("others"))


def _whole(narrow, docs):
    """The columns of `docs` in their order."""
    return narrow.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"others.`{c}`").alias(c) for c in docs.columns])


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return _whole(quality.classify(_narrow(docs)).filter("accepted"), docs)


def line_stage(spark, docs, sf_dir):
    """Lines that an earlier document holds go; a document keeps its row even if no line is left."""
    kept = line_dedup.line_dedup(_narrow(docs))
    changed = kept.withColumn("text", F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return _counted(_whole(changed, docs))


def near_stage(spark, docs, sf_dir):
    """Of each group of near-duplicates (five words, 0.8 or more) one row stays, of the document with the smallest id.

    A document is an id with a text: rows that repeat an id with another text are judged on their own. Rows without
    an id, or without five words, link with nothing and stay.
    """
    root, narrow = new_folder(spark, "near"), _narrow(docs)
    own = narrow.withColumn("__th", F.xxhash64("text"))
    with_id = own.filter(F.col("doc_id").isNotNull())
    # Numbers that grow with the id stand for the pairs.
    pairs = with_id.select("doc_id", "__th").distinct().orderBy("doc_id", "__th")
    keyed = with_id.join(stored(pairs.withColumn("__key", F.monotonically_increasing_id()), f"{root}/keys"), ["doc_id", "__th"])
    numbered = stored(keyed.select(F.col("__key").alias("doc_id"), "text"), f"{root}/numbered")
    classes = jaccard_join.jaccard_classes(numbered, words=5, share=(80, 100))
    kept = stored(
        classes.filter("component_id = doc_id").groupBy(F.col("doc_id").alias("__key")).agg(
            F.max("n_shingles").alias("__n"), F.count(F.lit(1)).alias("__rows")), f"{root}/kept")
    single = keyed.join(kept.filter("__rows = 1 or __n = 0"), "__key").select(*narrow.columns)
    repeated = keyed.join(kept.filter("__rows > 1 and __n > 0"), "__key").dropDuplicates(["__key"]).select(*narrow.columns)
    return _whole(single.unionByName(repeated).unionByName(narrow.filter(F.col("doc_id").isNull())), docs)


def secret_stage(spark, docs, sf_dir):
    """Secrets are replaced by a mark; no document goes."""
    return _counted(_whole(secret_scan.redact(_narrow(docs)), docs))


def packing_stage(spark, docs, sf_dir):
    """Pieces of sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _counted(changed):
    if "n_chars" in changed.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast("long"))
    return changed


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

# Quality, near-duplicates, secrets and packing have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    root = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"{root}/{name}")
    return docs
