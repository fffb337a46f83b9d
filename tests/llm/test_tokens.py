"""Byte-level BPE, token counts and packing against the tokenizer libraries."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from cutline.llm import byte_bpe, catalog, packing, token_counts
from tests.llm import plain

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.serialise_model(byte_bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)


def odd_texts(number=3000):
    rng = random.Random(5)
    signs = ["a", " ", " ", "\n", "b'S", "\t", "é", "1", ".", "\x1d", " ", "　", "Σ", "it's", "😀", "\x00", "<|endoftext|>", "▁"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 25))) for _ in range(number)] + ["a" * 4000, ""]


def test_codec_like_the_rank_library(codec, reference):
    for text in odd_texts():
        ids = reference.encode_ordinary(text)
        assert codec.encode(text) == ids
        assert codec.decode(ids) == text.encode()


def test_codec_with_full_memory(codec, reference):
    small = byte_bpe.Codec(byte_bpe.serialise_model(byte_bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    small.words.most = small.tokens.most = 20
    for text in odd_texts(200):
        assert small.encode(text) == reference.encode_ordinary(text)


def digests(rows, reference):
    out = []
    for i, text in rows:
        ids = reference.encode_ordinary(text or "")
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), plain.sha(text or "")))
    return sorted(out)


def test_codec_query(spark, reference):
    rows = [(r["doc_id"], r["text"]) for r in plain.table()]
    assert sorted(map(tuple, catalog.all_queries()["op9_byte_bpe"](spark, plain.SF).collect())) == digests(rows, reference)


def test_codec_odd_rows(spark, reference):
    df = byte_bpe.codec_digests(plain.frame(spark), RANKS, public_tokenizers.PATTERN)
    assert sorted(map(tuple, df.collect())) == digests([r[:2] for r in plain.ROWS], reference)
    assert byte_bpe.codec_digests(plain.frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0
    ids = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(plain.frame(spark), RANKS, public_tokenizers.PATTERN).collect()}
    assert ids[17] == reference.encode_ordinary(plain.ROWS[16][1])


def counted(rows, reference):
    """Token by token, character by character."""
    out = []
    for i, text in rows:
        text = text or ""
        places = np.cumsum([0] + [len(c.encode()) for c in text])
        ids = reference.encode_ordinary(text)
        ends = np.cumsum([0] + [len(reference.decode_single_token_bytes(t)) for t in ids])
        for n, (a, b) in enumerate(token_counts.line_sections(text)):
            low, high = places[a], places[b]
            whole = sum(low <= s < high for s in ends[:-1])
            share = sum(max(0, min(high, e) - max(low, s)) / (e - s) for s, e in zip(ends, ends[1:]))
            out.append((i, n, a, b, whole, round(float(share), 6)))
    return sorted(out)


def rounded(df):
    return sorted((*r[:5], round(r[5], 6)) for r in map(tuple, df.collect()))


def test_counts_query(spark, reference):
    rows = [(r["doc_id"], r["text"]) for r in plain.table()][:60]
    ids = [i for i, _ in rows]
    df = catalog.all_queries()["op5_token_counts"](spark, plain.SF)
    assert rounded(df.filter(df.doc_id.isin(ids))) == counted(rows, reference)
    total = df.groupBy().sum("n_tokens", "token_share").first()
    whole = sum(len(reference.encode_ordinary(r["text"] or "")) for r in plain.table())
    assert total[0] == whole and abs(total[1] - whole) < 1e-3


def test_counts_odd_rows_and_crossing_tokens(spark, reference):
    rows = [r for r in plain.ROWS if r[0] not in (7, 8, 9)]
    df = token_counts.token_counts(plain.frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    assert rounded(df) == counted([r[:2] for r in rows], reference)
    assert token_counts.token_counts(plain.frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0
    counter = token_counts.Counter(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    first, share = counter.count("hello", [(0, 2), (2, 5)])
    assert list(first) == [1, 0] and np.allclose(share, [0.4, 0.6])


def check_packing(rows, pieces, tokenizer, window=4096):
    want, per, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for i, text in rows:
        want[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    for p in pieces:
        per[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    assert set(per) == set(want)
    for i, copies in want.items():
        assert sum(p["length"] for p in per[i]) == sum(map(len, copies))
        if len(copies) == 1:
            at = 0
            for p in sorted(per[i], key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(copies[0])
                cut = np.array(copies[0][at:at + p["length"]], "<u4")
                assert p["ids_crc32"] == zlib.crc32(cut.tobytes())
                at += p["length"]
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at == window or at & (at - 1) == 0 and at < window


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def test_word_encoder(tokenizer):
    with open(WORDS, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read(), 2)
    texts = odd_texts() + ["İstanbul ΣΑΣ ΑΣ", "WE'LL don't'S 12345", "a <|startoftext|> b"]
    for text, raw in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(raw, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_packing_query(spark, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in plain.table()]
    check_packing(rows, catalog.all_queries()["op10_packing"](spark, plain.SF).collect(), tokenizer)


def test_packing_odd_rows_small_shards(spark, tokenizer):
    rows = [*plain.ROWS, (None, "no id", "x")]
    df = packing.pack(plain.frame(spark, rows), WORDS, window=64, shard_tokens=20_000, block_tokens=500)
    check_packing([r[:2] for r in rows], df.collect(), tokenizer, 64)
    assert packing.pack(plain.frame(spark, []), WORDS).count() == 0


def test_neighbours_are_the_related_documents():
    docs = [(n, np.array([10 * (n % 3) + k for k in range(8)] + [99, n + 100], "<u2")) for n in range(12)]
    idf = np.log1p((12 - 4 + 0.5) / 4.5) * np.ones(200)
    idf[99] = 0.01
    block = packing.Block(docs, idf, 10)
    assert {int(n) % 3 for n in block.neighbours(4)[:4]} == {1}


def test_used_documents_leave_the_index():
    rng = np.random.default_rng(4)
    docs = [(n, rng.integers(0, 60, rng.integers(1, 40)).astype("<u2")) for n in range(50)]
    idf = np.log1p(rng.random(60))
    whole, block, unused = packing.Block(docs, idf, 20), packing.Block(docs, idf, 20), np.ones(50, bool)
    for used in ([3, 7, 8], range(20, 45), range(50)):
        unused[list(used)] = False
        block.keep(unused)
        assert len(block.owner) == len(block.weight) == block.starts[-1] == sum(len(block.queries[n]) for n in np.flatnonzero(unused))
        for seed in range(50):
            ranked, own = whole.neighbours(seed), block.neighbours(seed)
            assert ranked[unused[ranked]].tolist() == own[unused[own]].tolist()
