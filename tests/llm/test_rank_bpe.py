"""Ids by rank against the tokenizer library, and when they are not used."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cutline.llm import bestfit_packing, packing
from cutline.llm.rank_bpe import ranks_of
from tests.llm import plain
from tests.llm.test_tokens import odd_texts

WORDS, BYTES = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "byte_bpe_50k.json"))
KINDS = [(packing.WordEncoder, WORDS), (bestfit_packing.SpacedEncoder, BYTES)]


def read(path):
    with open(path, encoding="utf-8") as file:
        return file.read()


def nonsense(number=400):
    """Words that no vocabulary holds, of letters of one and more bytes, with signs around them."""
    rng = random.Random(11)
    letters = ["e", "t", "th", "in", "tion", "é", "ß", "Я", "漢", "İ", "Σ", "é", "Q", "7", "'", "’"]
    ends = ["", "", " ", " ", ".", "!!", ",!!", "%%%", "'s", "\n", "  ", " |", "...", "'"]
    return ["".join("".join(rng.choices(letters, k=rng.randrange(1, 12))) + rng.choice(ends) + " " for _ in range(40))
            for _ in range(number)]


class Uncalled:
    """A tokenizer that no text goes through."""

    def encode_batch_fast(self, *args, **names):
        raise AssertionError("the tokenizer encodes the words")


@pytest.mark.parametrize("kind, path", KINDS)
def test_new_words_do_not_go_through_the_tokenizer(kind, path):
    spec = read(path)
    tokenizer, encoder = Tokenizer.from_str(spec), kind(spec, 2)
    encoder.tokenizer = encoder.merges = Uncalled()
    texts = [r["text"] or "" for r in plain.table()] + nonsense() + ["", " ", "a" * 50_000, "\n" * 5000, "^" * 5000 + " b"]
    for text, raw in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(raw, encoder.dtype).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)


@pytest.mark.parametrize("kind, path", KINDS)
def test_without_ranks_the_ids_are_the_same(kind, path):
    spec = read(path)
    texts = odd_texts() + nonsense(100)
    own, other = kind(spec, 2), kind(spec, 2, None)
    assert own.ranked and not other.ranked
    if kind is bestfit_packing.SpacedEncoder:
        other.words.most = 500  # a memory that turns over
    for at in range(0, len(texts), 200):
        assert own.encode(texts[at:at + 200]) == other.encode(texts[at:at + 200])


def changed(path, change):
    parts = json.loads(read(path))
    change(parts["model"])
    return json.dumps(parts)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ranks_are_refused_where_they_differ(path):
    def other_pair(model):  # a token comes from a pair that its bytes do not lead to
        place, pair = next(
            (place, [(a + b)[:n], (a + b)[n:]]) for place, (a, b) in enumerate(model["merges"]) for n in range(1, len(a + b))
            if n != len(a) and (a + b)[:n] in model["vocab"] and (a + b)[n:] in model["vocab"])
        model["merges"][place] = pair

    def unlisted(model):
        model["merges"].pop()

    def disordered(model):
        model["merges"][100:102] = model["merges"][101:99:-1]

    def without_byte(model):
        del model["vocab"]["!"]

    assert ranks_of(read(path))
    for change in (other_pair, unlisted, disordered, without_byte, lambda m: m.update(dropout=0.1)):
        assert ranks_of(changed(path, change)) is None


def test_pairs_off_the_ranks_are_seen():
    """`tokenizers` leaves c, ab apart here, where the bytes of the token cab would be joined by rank."""
    from cutline.llm.byte_bpe import byte_characters

    vocab = {c: n for n, c in enumerate(byte_characters())}
    merges = [["a", "b"], ["c", "a"], ["ca", "b"]]
    vocab.update(("".join(m), 256 + n) for n, m in enumerate(merges))
    spec = json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                       "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
                       "post_processor": None, "decoder": None, "model": {"type": "BPE", "vocab": vocab, "merges": merges}})
    encoder = bestfit_packing.SpacedEncoder(spec, 2)
    assert ranks_of(spec) is None and not encoder.ranked
    assert np.frombuffer(encoder.encode(["cab"])[0], "<u2").tolist() == [vocab["c"], vocab["ab"], 2]
