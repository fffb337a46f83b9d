"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

The model is serialised directly from the vocabulary: each byte has a printable character, a piece is
its token's bytes in those characters, its score is the negative rank, normalisation is the identity. The
best-scored merge is then the merge of the lowest rank, and the leftmost of equals, as rank-based BPE
has it. Each match of the pre-token pattern is encoded by itself; ids map back to pieces and bytes.

A text is cut before each space where the pattern cannot look across (see `Codec.cut`), and a worker keeps
the codes of the pieces it has met, a bounded number of them. The vocabulary (a fixed file, under 1 MB) is
read by the driver and broadcast, so executors need no file.

Rows: null text counts as empty and has no ids (the digests are those of nothing). Texts of any length are
encoded whole. Repeated rows and an empty table give as many rows as came in. Other columns are ignored.
"""

import base64
import hashlib
import struct

import pyarrow as pa

from cutline.llm.common import Recent, documents, ship

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters():
    """A printable character for each byte: Latin-1 printables stand for themselves, others move above 255."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(own))}
    return [moved.get(b, chr(b)) for b in range(256)]


def read_ranks(path):
    """Rank -> token bytes from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {int(rank): base64.b64decode(token) for token, rank in pairs}


def _varint(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _bytes_field(number, value):
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _int_field(number, value):
    return _varint(number << 3) + _varint(value)


def serialise_model(ranks):
    """A sentencepiece BPE model whose ids are the ranks; the unknown piece comes last."""
    chars = byte_characters()
    size = max(ranks) + 1
    pieces = []
    for rank in range(size):
        piece = "".join(chars[b] for b in ranks[rank]) if rank in ranks else f"ༀ{rank}"
        kind = 1 if rank in ranks else 5  # normal, unused
        pieces.append(_bytes_field(1, piece.encode()) + struct.pack("<Bf", 2 << 3 | 5, -rank) + _int_field(3, kind))
    pieces.append(_bytes_field(1, b"<unk>") + struct.pack("<Bf", 2 << 3 | 5, 0) + _int_field(3, 2))
    trainer = _int_field(3, 2) + _int_field(4, size + 1) + _int_field(40, size)
    normalizer = _bytes_field(1, b"identity") + _int_field(3, 0) + _int_field(4, 0) + _int_field(5, 0)
    return b"".join(_bytes_field(1, p) for p in pieces) + _bytes_field(2, trainer) + _bytes_field(3, normalizer)


class Codec:
    """Encodes texts to ids and ids to bytes with a model made by `serialise_model`."""

    def __init__(self, model, pattern):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        self.unsafe = regex.compile(r"\s (?:\s|\Z)").search
        self.chars = byte_characters()
        inverse = {ord(c): b for b, c in enumerate(self.chars)}
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size() - 1))
        self.pieces = [bytes(inverse.get(ord(c), 63) for c in piece) for piece in pieces]
        self.words, self.tokens = Recent(self._words), Recent(self._tokens)

    def decode(self, ids):
        return b"".join(map(self.pieces.__getitem__, ids))

    def _tokens(self, tokens):
        """(ids text, decoded bytes) of pre-tokens."""
        mapped = [t.encode().decode("latin-1").translate(self.chars) for t in tokens]
        return [(" ".join(map(str, ids)), self.decode(ids)) for ids in self.model.encode(mapped, num_threads=1)]

    def _words(self, words):
        """The same of words with a space before them, each of which may hold several pre-tokens."""
        found = [self.find(" " + w) for w in words]
        known = self.tokens.learn([t for tokens in found for t in tokens])
        return [(" ".join(known[t][0] for t in tokens), b"".join(known[t][1] for t in tokens)) for tokens in found]

    def cut(self, text):
        """(pre-tokens, words behind a space) that together have the text's pre-tokens in order.

        White space is split by what follows it, so a cut before a space is safe unless white space stands on
        both sides of it (or the text ends behind it): such texts go through the pattern as a whole.
        """
        if self.unsafe(text):
            return self.find(text), ()
        first, *words = text.split(" ")
        return self.find(first), words

    def codes(self, text):
        """(ids text, decoded bytes) per pre-token or word."""
        tokens, words = self.cut(text)
        known = self.tokens.learn(tokens)
        codes = [known[t] for t in tokens]
        if words:
            codes += map(self.words.learn(words).__getitem__, words)
        return codes

    def encode(self, text):
        return [int(i) for ids, _ in self.codes(text) for i in ids.split()]

    def digest(self, text):
        """(number of ids, digest of the ids, digest of the bytes decoded from them)."""
        codes = self.codes(text)
        ids = " ".join([c[0] for c in codes]).encode()
        decoded = b"".join([c[1] for c in codes])
        return ids.count(b" ") + 1 if ids else 0, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


_codecs = {}


def codec_of(model, pattern):
    """One codec per Python worker."""
    key = (hash(model), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(model, pattern)
    return _codecs[key]


def _run(docs, ranks_path, pattern, schema, row):
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(serialise_model(read_ranks(ranks_path)))

    def run(batches):
        codec = codec_of(model.value, pattern)
        for batch in batches:
            rows = [row(codec, text or "") for text in batch.column(1).to_pylist()]
            columns = [pa.array(c) for c in zip(*rows)] if rows else None
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [f.split()[0] for f in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs, ranks_path, pattern):
    """(doc_id, ids array) per document."""
    return _run(docs, ranks_path, pattern, "doc_id long, ids array<int>", lambda c, t: (_int32(c.encode(t)),))


def _int32(ids):
    import numpy as np

    return np.array(ids, np.int32)


def codec_digests(docs, ranks_path, pattern):
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _run(docs, ranks_path, pattern, SCHEMA, lambda c, t: c.digest(t))


def op9_byte_bpe(spark, sf_dir):
    import public_tokenizers

    docs = documents(spark, sf_dir)
    return codec_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
