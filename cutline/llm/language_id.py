"""Language ID: a byte convolutional network over fixed windows of the whole text.

The network learns from a bounded sample of labelled documents: for each of at most `most_labels` labels (the
most frequent ones) at most `per_label` documents, chosen by a hash of doc_id, and one piece of at most
`PIECE` characters of each. The sample is drawn in the cluster with a partial minimum per task. Prediction
reads every window of every text; a document's probabilities are the mean over its windows, weighted by
their bytes. lang, source and doc_id are not inputs of a prediction.

Rows: null text, and text without a letter, is `und` with score 0, as is everything when no labelled row is
there to learn from. Repeated rows get the same answer. An empty table gives an empty result. A null doc_id
is predicted like others, is not held out, and is not learnt from. Other columns are ignored.
"""

import pickle

import pyarrow as pa
from pyspark.sql import functions as F

from cutline.llm.common import documents, ship, text_slices

PIECE, WINDOW = 600, 256
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 3


def training_pieces(docs, per_label, most_labels):
    """(lang, piece): at most per_label * most_labels rows."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold() != 1))
    labels = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_labels).select("lang")
    order = F.xxhash64("doc_id", "text")
    start = F.pmod(order, F.greatest(F.char_length("text") - PIECE, F.lit(0)) + 1).cast("int") + 1
    pieces = known.select(
        "lang", F.pmod(F.xxhash64("doc_id"), F.lit(per_label)).alias("place"), order.alias("h"),
        F.substring("text", start, F.lit(PIECE)).alias("piece"))
    return pieces.groupBy("lang", "place").agg(F.min_by("piece", F.struct("h", "piece")).alias("piece")).join(labels, "lang")


def fit(pieces, seed=7):
    """A network and its labels from (label, text) pairs; crops of many lengths make short texts work."""
    import numpy as np

    from cutline.llm.convnet import ConvNet
    from cutline.llm.shingles import _FOLD

    rng = np.random.default_rng(seed)
    labels = sorted({label for label, _ in pieces})
    rows, y = [], []
    for label, text in sorted(pieces):
        raw = _FOLD[np.frombuffer(text.encode(), np.uint8)]
        for _ in range(2):
            size = int(rng.choice([12, 40, 128, WINDOW]))
            at = int(rng.integers(0, max(1, len(raw) - size + 1)))
            row = np.zeros(WINDOW, np.uint8)
            cut = raw[at:at + size]
            row[:len(cut)] = cut
            rows.append(row)
            y.append(labels.index(label))
    return ConvNet(len(labels)).fit(np.array(rows), np.array(y), epochs=4), labels


def predict_languages(docs, model):
    """One row per document: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        import numpy as np

        from cutline.llm.convnet import windows
        from cutline.llm.shingles import _FOLD

        net, labels = pickle.loads(shared.value)
        names = np.array([*labels, "und"], object)
        for batch in batches:
            letters = np.array(batch.column(2))
            best, score = np.full(len(batch), len(labels)), np.zeros(len(batch))
            for first, last, data, offsets in text_slices(batch.column(3)) if net else ():
                x, owner, sizes = windows(_FOLD[data], offsets, WINDOW)
                odds = net.predict(x) * sizes[:, None]
                total = np.stack([np.bincount(owner, odds[:, c], last - first) for c in range(len(labels))], 1)
                total /= np.maximum(total.sum(1, keepdims=True), 1e-12)
                use = letters[first:last]
                best[first:last] = np.where(use, total.argmax(1), len(labels))
                score[first:last] = np.where(use, total.max(1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names[best], pa.string()), pa.array(np.clip(score, 0, 1))],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"), "text",
    ).mapInArrow(run, SCHEMA)


def identify_languages(docs, per_label=1000, most_labels=200):
    pieces = [(r["lang"], r["piece"]) for r in training_pieces(docs, per_label, most_labels).collect()]
    return predict_languages(docs, fit(pieces) if pieces else (None, []))


def op1_language_id(spark, sf_dir):
    return identify_languages(documents(spark, sf_dir))
