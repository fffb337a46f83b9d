"""Best-fit packing by bin completion: whole documents into as few sequences as it can, only long ones are cut.

1. Every document is encoded whole; its ids and the end id are cut into pieces of a window, the first of
   which holds what is over. Each task numbers its pieces of equal length; a narrow table of the pieces goes to the
   shared folder.
2. Pieces of equal length are interchangeable, so the plan needs their numbers by length only: at most
   as many counts as the window has tokens, whatever the size of the table. `bin_completion` enumerates undominated
   fillings around the largest length, prunes by waste bounds and keeps best-fit solutions as incumbents.
3. A piece's place among all pieces of its length is its number in its task plus the pieces of earlier tasks (a
   running sum over tasks, joined by task and length). A filling that is used m times takes a range of those places, so
   the place gives sequence and offset. The plan's ranges are broadcast: at most some ten thousand rows, by the number of
   lengths.

Every sequence can thus take pieces from anywhere in the table; nothing is packed by blocks. No task holds more than
a batch of texts, and a length that very many pieces have is spread like any other.

Rows: null text counts as empty; such a document has the end id alone. A null doc_id is packed too and stays
null. Repeated rows are packed as rows of their own. A very long text is encoded whole and gives as many pieces as it
needs. An empty table gives an empty result. Other columns are ignored.
"""

import zlib

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from cutline.llm import bin_completion
from cutline.llm.common import Recent, documents, new_folder, ship, stored
from cutline.llm.rank_bpe import encoding_of, ranks_of

WINDOW = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class SpacedEncoder:
    """Ids of a text by a byte-level tokenizer: whole through the rank library where ids follow from ranks (see `rank_bpe`).

    If they do not, each word with the space before it is encoded once. The pre-token pattern never joins what is not white
    space to white space behind it, so a text can be cut before each space, unless white space stands on both sides
    of the space or the text ends with it. Such texts then, and in any case texts with a special token's string, and all
    texts if the tokenizer has other steps, go through it whole. `ranks` is what `ranks_of` says about the tokenizer.
    """

    # Fixed value: the pattern of the byte-level step.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, spec, end_id, ranks=ranks_of):
        import json

        import numpy as np
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        parts = json.loads(spec)
        steps = parts["pre_tokenizer"] or {}
        self.spaced = parts["normalizer"] is None and steps.get("type") == "ByteLevel" and (
            steps.get("use_regex", True) and not steps.get("add_prefix_space"))
        ranks = ranks(spec) if callable(ranks) else ranks
        suffix = parts["model"].get("end_of_word_suffix")
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.ranked = encoding_of(ranks, self.PATTERN, self.special) if self.spaced and ranks and not suffix else None
        self.unsafe = regex.compile(r"\s (?:\s|\Z)").search
        self.end = np.array([end_id], self.dtype).tobytes()
        self.words = Recent(self._words, most=2_000_000)

    def _ids(self, texts):
        from array import array

        kind = "H" if self.dtype.itemsize == 2 else "I"
        return [array(kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words):
        return self._ids([" " + w for w in words])

    def _ranked_ids(self, text):
        if any(s in text for s in self.special):
            return self._ids([text])[0]
        return self.ranked(text).astype(self.dtype).tobytes()

    def encode(self, texts):
        """Little-endian ids of each text with the end id."""
        if self.ranked:
            return [self._ranked_ids(text) + self.end for text in texts]
        cut, first, whole = [], [], {}
        for n, text in enumerate(texts):
            if not self.spaced or self.unsafe(text) or any(s in text for s in self.special):
                whole[n] = text
                text = ""
            words = text.split(" ")
            first.append(words.pop(0))
            cut.append(words)
        known = self.words.recall(set().union(*cut))
        out = [b"".join((a, *map(known.__getitem__, words), self.end)) for a, words in zip(self._ids(first), cut)]
        for n, ids in zip(whole, self._ids(list(whole.values()))):
            out[n] = ids + self.end
        return out


_encoders = {}


def encoder_of(spec, end_id, ranks=ranks_of):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (hash(spec), end_id)
    if key not in _encoders:
        _encoders[key] = SpacedEncoder(spec, end_id, ranks)
    return _encoders[key]


def cut_points(size, window):
    """Starts of the pieces of a document of `size` ids; only the first piece may be shorter than a window."""
    return [0, *range(size % window or window, size, window)]


def pieces(docs, spec, ranks, end_id, window):
    """A row per piece with the number it has among its task's pieces of the same length."""
    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        encoder, task = encoder_of(spec.value, end_id, ranks.value), TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                rows = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, raw in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    ids = np.frombuffer(raw, encoder.dtype).astype("<u4").tobytes()
                    starts = cut_points(len(ids) // 4, window)
                    for n, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids) // 4])):
                        length = end - start
                        rows.append((doc_id, n, start, length, zlib.crc32(ids[4 * start:4 * end]), task, seen[length]))
                        seen[length] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def ranges(plan):
    """Rows (length, first place, first sequence, uses in a sequence, first offset) of a plan, by length and place."""
    rows, sequence, taken = [], 0, {}
    for filling, bins in plan:
        offset = 0
        for length, uses in filling:
            first = taken.get(length, 0)
            rows.append((length, first, sequence, uses, offset))
            taken[length] = first + bins * uses
            offset += length * uses
        sequence += bins
    return sorted(rows)


def placed(numbered, plan):
    """Sequence and offset of pieces (with `place` among all pieces of their length)."""
    rows = numbered.sparkSession.sparkContext.broadcast(ranges(plan))

    def run(batches):
        import numpy as np

        length, first, sequence, uses, offset = np.array(rows.value, np.int64).reshape(-1, 5).T
        starts = np.searchsorted(length, np.arange(int(length.max(initial=0)) + 2))
        for batch in batches:
            own, place = (batch.column(n).to_numpy() for n in (3, 5))
            out = np.zeros((2, len(batch)), np.int64)
            for size in np.unique(own):
                a, b = starts[size], starts[size + 1]
                at = np.flatnonzero(own == size)
                found = a + np.searchsorted(first[a:b], place[at], "right") - 1
                nth = place[at] - first[found]
                out[:, at] = sequence[found] + nth // uses[found], offset[found] + nth % uses[found] * size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(out[0]), pa.array(out[1])], [f.split()[0] for f in SCHEMA.split(", ")])

    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "place").mapInArrow(run, SCHEMA)


def pack_whole(docs, tokenizer_path, end_id=2, window=WINDOW, nodes=5_000):
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    `nodes` bounds the branch and bound; beyond it the best incumbent is used.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    ranks = spark.sparkContext.broadcast(ranks_of(spec.value))
    cut = stored(pieces(docs, spec, ranks, end_id, window), new_folder(spark, "bestfit-pieces"))
    by_task = stored(
        cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), new_folder(spark, "bestfit-counts"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = bin_completion.complete(counts, window, nodes=nodes)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = cut.join(before, ["task", "length"]).withColumn("place", F.col("place") + F.col("before"))
    return placed(numbered, plan)


def op12_bestfit_packing(spark, sf_dir):
    import public_tokenizers

    return pack_whole(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
