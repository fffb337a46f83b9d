"""Packing: lexical retrieval fills sequences with related documents, without padding inside a shard.

1. Every document is encoded whole; its ids, with the end id behind them, go to a shared table.
2. BM25 statistics over all documents: document frequency of each token id (as many rows as the
   vocabulary has), number of documents, mean length. They are broadcast.
3. Documents are dealt out to shards by ranges of their strongest term and their id, so that related ones
   meet, and a term that a third of all documents share still spreads over many shards. The limits between shards
   are quantiles over a sample of the documents.
4. A shard works through blocks of a bounded number of tokens. It builds the block's inverted index. A seed
   document opens a sequence; the index returns its unused neighbours by BM25 score, and they fill the
   window one after the other. The document that no longer fits is cut; its rest seeds the next sequence.
5. A sequence left open goes on in the next block. At the end of a shard it is cut into sequences whose
   lengths are powers of two, which need no padding.

Rows: null text counts as empty; such a document has the end id alone. A document longer than a window is cut
freely. Repeated rows are packed as rows of their own. A null doc_id is packed too and stays null. An
empty table gives an empty result. Other columns are ignored.
"""

import math
import zlib
from string import punctuation

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from cutline.llm.common import documents, new_folder, ship
from cutline.llm.rank_bpe import encoding_of, ranks_of

WINDOW = 4096
K1, B = 1.2, 0.75
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class WordEncoder:
    """Ids of a text by a tokenizer whose pre-tokens hold no white space.

    The tokenizer's own steps before the merges (canonical composition, lower case, its pattern) are applied here;
    the pre-tokens, a space behind each, go through the rank library (see `rank_bpe`), a text in one call. Texts that
    hold a special token's string, or control characters that Python counts as white space and the pattern does not, go
    through the tokenizer whole; so do all texts if its steps are others or its ids do not follow from ranks.
    `ranks` is what `ranks_of` says about the tokenizer.
    """

    # The steps that are applied here.
    STEPS = ["NFC", "Replace", "Lowercase"]
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, spec, end_id, ranks=ranks_of):
        import json

        import numpy as np
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        parts = json.loads(spec)
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", ())]
        split = next(iter((parts["pre_tokenizer"] or {}).get("pretokenizers", ())), {})
        own = kinds == self.STEPS and split.get("invert") and split["pattern"].get("Regex") == self.PATTERN
        ranks = ranks(spec) if callable(ranks) else ranks
        own = own and parts["model"].get("end_of_word_suffix") and ranks
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.ranked = encoding_of(ranks, "[^ ]+ ", special) if own else None
        self.find = regex.compile(self.PATTERN).findall
        self.odd = [*special, "\x1c", "\x1d", "\x1e", "\x1f"]
        self.end = np.array([end_id], self.dtype).tobytes()

    def _part(self, word):
        """A word with spaces between its pre-tokens."""
        letters = word.rstrip(punctuation)
        if letters.isalpha():
            return f"{letters} {word[len(letters):]}"
        return " ".join(self.find(word)) if letters else word

    def _ids(self, text):
        import unicodedata

        import numpy as np

        if not self.ranked or any(o in text for o in self.odd):
            return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        part = self._part
        return self.ranked(" ".join([w if w.isalpha() else part(w) for w in text.lower().split()]) + " ")

    def encode(self, texts):
        """Little-endian ids of each text with the end id."""
        return [self._ids(text).astype(self.dtype).tobytes() + self.end for text in texts]


_encoders = {}


def encoder_of(spec, end_id, ranks=ranks_of):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (hash(spec), end_id)
    if key not in _encoders:
        _encoders[key] = WordEncoder(spec, end_id, ranks)
    return _encoders[key]


def encode(docs, spec, ranks, end_id):
    """(doc_id, ids): the ids as little-endian bytes."""
    def run(batches):
        encoder = encoder_of(spec.value, end_id, ranks.value)
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def _terms(ids):
    """Distinct ids and their counts."""
    import numpy as np

    ordered = np.sort(ids, kind="stable")
    last = np.flatnonzero(ordered[1:] != ordered[:-1])
    edges = np.empty(len(last) + 2, np.int64)
    edges[0], edges[1:-1], edges[-1] = 0, last + 1, len(ordered)
    return ordered[edges[:-1]].astype(np.int64), edges[1:] - edges[:-1]


def statistics(encoded, size, dtype):
    """Document frequency of each id, number of documents, and number of ids: at most size + 2 rows."""
    def run(batches):
        import numpy as np

        counts = np.zeros(size + 2, np.int64)
        for batch in batches:
            for row in batch.column(0):
                ids = np.frombuffer(row.as_py(), dtype)
                counts[_terms(ids)[0]] += 1
                counts[size] += 1
                counts[size + 1] += len(ids)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])

    parts = encoded.select("ids").mapInArrow(run, "term long, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


class Block:
    """The inverted index of a bounded number of documents: postings by term with BM25 weights."""

    def __init__(self, docs, idf, mean):
        import numpy as np

        found = [_terms(ids) for _, ids in docs]
        self.queries = [terms for terms, _ in found]
        terms = np.concatenate(self.queries)
        owner = np.repeat(np.arange(len(docs)), [len(t) for t in self.queries])
        tf = np.concatenate([n for _, n in found]).astype(np.float64)
        size = np.array([len(ids) for _, ids in docs], np.float64)[owner]
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
        order = np.argsort(terms, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.n = len(docs)

    def neighbours(self, seed):
        """All documents of the block by falling score for the seed's terms, equals in their order."""
        import numpy as np

        terms = self.queries[seed]
        a, b = self.starts[terms], self.starts[terms + 1]
        size = b - a
        at = np.arange(size.sum()) + np.repeat(a - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        scores = np.bincount(self.owner[at], self.weight[at], self.n)
        return np.argsort(-scores, kind="stable")

    def keep(self, docs):
        """Leaves the postings of other documents out (a mask); these score nothing from then on."""
        import numpy as np

        kept = docs[self.owner]
        before = np.concatenate(([0], np.cumsum(kept)))
        self.owner, self.weight, self.starts = self.owner[kept], self.weight[kept], before[self.starts]


class Packer:
    """Fills sequences with pieces; `rows` holds finished pieces."""

    def __init__(self, shard, window):
        self.base, self.window, self.count = shard << 40, window, 0
        self.rows, self.open, self.used = [], [], 0

    def _close(self):
        offset = 0
        for doc_id, ids, start, length in self.open:
            crc = zlib.crc32(ids[start:start + length].astype("<u4").tobytes())
            self.rows.append((doc_id, start, length, crc, len(ids), self.base + self.count, offset))
            offset += length
        self.open, self.used, self.count = [], 0, self.count + 1

    def put(self, doc_id, ids, start=0):
        """Adds as much of the document as the window takes; returns where the rest starts."""
        take = min(len(ids) - start, self.window - self.used)
        self.open.append((doc_id, ids, start, take))
        self.used += take
        if self.used == self.window:
            self._close()
        return start + take

    def place(self, doc):
        doc_id, ids = doc
        at = self.put(doc_id, ids)
        while at < len(ids):
            at = self.put(doc_id, ids, at)

    def fill(self, docs, block):
        """Packs every document of the block, each seed with its nearest unused neighbours.

        Used documents leave the index whenever half of those in it are used.
        """
        import numpy as np

        unused, indexed = np.ones(len(docs), bool), len(docs)
        for first in range(len(docs)):
            if not unused[first]:
                continue
            unused[first] = False
            self.place(docs[first])
            seed = first
            while self.used and seed is not None:
                left = np.count_nonzero(unused)
                if 2 * left <= indexed:
                    block.keep(unused)
                    indexed = left
                sequence, ranked = self.count, block.neighbours(seed)
                seed = None
                for near in ranked[unused[ranked]]:
                    unused[near] = False
                    self.place(docs[near])
                    if self.count > sequence:
                        seed = near
                        break

    def finish(self):
        """Cuts what is open into sequences whose lengths are powers of two."""
        rest, self.open, used, whole = self.open, [], self.used, self.window
        self.used = 0
        for doc_id, ids, start, length in rest:
            while length:
                if not self.used:
                    self.window = 1 << (used.bit_length() - 1)
                take = min(length, self.window - self.used)
                used -= take
                self.open.append((doc_id, ids, start, take))
                self.used += take
                start, length = start + take, length - take
                if self.used == self.window:
                    self._close()
        self.window = whole

    def batch(self):
        rows, self.rows = self.rows, []
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 7
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])


def pack(docs, tokenizer_path, end_id=2, window=WINDOW, shard_tokens=4_000_000, block_tokens=1_000_000):
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    ranks = spark.sparkContext.broadcast(ranks_of(spec.value))
    encoder = encoder_of(spec.value, end_id, ranks.value)
    dtype, size = encoder.dtype, max(encoder.tokenizer.get_vocab_size(), end_id + 1)
    path = new_folder(spark, "packing-ids")
    encode(docs, spec, ranks, end_id).write.option("compression", "zstd").parquet(path)
    encoded = spark.read.schema("doc_id long, ids binary").parquet(path)
    counts = {r["term"]: r["n"] for r in statistics(encoded, size, dtype).collect()}
    number, total = counts.get(size, 0), counts.get(size + 1, 0)
    import numpy as np

    df = np.array([counts.get(t, 0) for t in range(size)], np.float64)
    idf = spark.sparkContext.broadcast(np.log1p((number - df + 0.5) / (df + 0.5)))
    mean = total / max(number, 1)

    def with_key(batches):
        """The document's place in the order of shards: its strongest term, then its id (the last 40 bits)."""
        for batch in batches:
            terms = []
            for row in batch.column(1):
                ids, tf = _terms(np.frombuffer(row.as_py(), dtype))
                terms.append(int(ids[np.argmax(idf.value[ids] * tf / (tf + K1))]))
            low = pc.fill_null(batch.column(0), 0).to_numpy() & ((1 << 40) - 1)
            key = np.array(terms, np.int64) << 40 | low
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], ["doc_id", "ids", "key"])

    def with_shard(batches):
        for batch in with_key(batches):
            shard = np.searchsorted(limits.value, batch.column(2).to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], ["doc_id", "ids", "key", "shard"])

    def fill(batches):
        from pyspark import TaskContext

        packer, docs, tokens = Packer(TaskContext.get().partitionId(), window), [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs.append((doc_id, np.frombuffer(raw.as_py(), dtype)))
                tokens += len(docs[-1][1])
                if tokens >= block_tokens:
                    packer.fill(docs, Block(docs, idf.value, mean))
                    docs, tokens = [], 0
                    yield packer.batch()
        if docs:
            packer.fill(docs, Block(docs, idf.value, mean))
        packer.finish()
        yield packer.batch()

    # Limits between shards come from about 200 documents a shard; they decide the balance only. Ranges of whole documents by
    # Spark's own sampling would decode every document once more.
    number_of_shards = max(1, math.ceil(total / shard_tokens))
    sampled = encoded.sample(min(1.0, 200 * number_of_shards / max(number, 1)), seed=7).mapInArrow(
        with_key, "doc_id long, ids binary, key long")
    shares = [n / number_of_shards for n in range(1, number_of_shards)]
    found = sampled.agg(F.percentile_approx("key", shares, max(10_000, 10 * number_of_shards))).first()[0] if shares else None
    limits = spark.sparkContext.broadcast(np.array(found or [], np.int64))
    shards = (
        encoded.mapInArrow(with_shard, "doc_id long, ids binary, key long, shard int")
        .repartitionById(number_of_shards, "shard")
        .sortWithinPartitions("key", "doc_id", F.crc32("ids"))
        .select("doc_id", "ids")
    )
    return shards.mapInArrow(fill, SCHEMA)


def op10_packing(spark, sf_dir):
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
