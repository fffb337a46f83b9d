"""Best-fit packing: ids against the tokenizer, the bins against exhaustive search and bounds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cutline.llm import bestfit_packing as packing
from cutline.llm import bin_completion, catalog
from tests.llm import plain
from tests.llm.test_tokens import odd_texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def fewest(items, capacity):
    """The least number of bins, by trying every bin for every item."""
    items, best, bins = sorted(items, reverse=True), len(items), []

    def go(n):
        nonlocal best
        if len(bins) >= best:
            return
        if n == len(items):
            best = len(bins)
            return
        tried = set()
        for b, used in enumerate(bins):
            if used + items[n] <= capacity and used not in tried:
                tried.add(used)
                bins[b] += items[n]
                go(n + 1)
                bins[b] -= items[n]
        bins.append(items[n])
        go(n + 1)
        bins.pop()

    go(0)
    return best


def holds(plan, items, capacity):
    used = Counter()
    for filling, bins in plan:
        assert bins > 0 and sum(s * u for s, u in filling) <= capacity
        for size, uses in filling:
            used[size] += uses * bins
    return used == Counter(items)


def test_completion_is_optimal_on_small_cases():
    rng, better = random.Random(3), 0
    for _ in range(400):
        capacity = rng.choice([10, 20, 50, 100])
        items = [
            rng.randrange(1, capacity + 1) if rng.random() < 0.3 else rng.randrange(capacity // 5, capacity // 2 + 2)
            for _ in range(rng.randrange(0, 12))]
        plan, bound = bin_completion.complete(Counter(items), capacity)
        least = fewest(items, capacity)
        assert holds(plan, items, capacity) and bound <= least == sum(n for _, n in plan), items
        better += sum(n for _, n in bin_completion.best_fit(Counter(items), capacity)) > least
    assert better  # the search was needed


@pytest.mark.parametrize("number, low, high", [(300, 1, 1023), (5000, 1, 1023), (5000, 100, 1023), (3000, 200, 700), (100_000, 1, 1024)])
def test_completion_of_many_sizes(number, low, high):
    rng = random.Random(number)
    items = Counter(rng.randrange(low, high + 1) for _ in range(number))
    plan, bound = bin_completion.complete(items, 1024)
    own, quick = sum(n for _, n in plan), sum(n for _, n in bin_completion.best_fit(items, 1024))
    assert holds(plan, items, 1024) and holds(bin_completion.best_fit(items, 1024), items, 1024)
    assert bound <= own <= quick
    assert len(plan) <= 4096
    if low == 1:
        assert own <= bound + max(1, bound // 200)


def test_fillings_leave_dominated_ones_out():
    assert bin_completion.fillings({5: 1, 3: 2, 2: 2}, 5) == [(5,)]
    assert bin_completion.fillings({4: 1, 3: 1, 1: 1}, 5) == [(4, 1)]
    assert bin_completion.fillings({3: 2, 2: 1}, 5) == [(3, 2)]
    assert set(bin_completion.fillings({6: 1, 3: 3}, 8)) == {(6,)}
    with pytest.raises(ValueError):
        bin_completion.complete({11: 1}, 10)
    assert bin_completion.complete({}, 10) == ([], 0)
    assert np.isnan(bin_completion.gap([], 10)) and bin_completion.gap([(((5, 1),), 2)], 10) == 0.5


def test_ids_like_the_tokenizer():
    with open(BYTES, encoding="utf-8") as file:
        spec = file.read()
    tokenizer, encoder = Tokenizer.from_str(spec), packing.SpacedEncoder(spec, 2)
    assert encoder.spaced
    texts = odd_texts() + [r["text"] or "" for r in plain.table()] + ["a\n b", "a \n b", " a  b ", "a   b", "it 's we 'll 12 34"]
    encoder.words.most = 500  # a memory that turns over
    for at in range(0, len(texts), 50):
        part = texts[at:at + 50]
        for text, raw in zip(part, encoder.encode(part)):
            assert np.frombuffer(raw, encoder.dtype).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)


def check(rows, found, window, tokenizer):
    """Pieces are those of the tokenizer, sequences have no gap and no more than a window."""
    want, sequences, lengths = Counter(), defaultdict(list), []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        end = len(ids) % window or window
        start = 0
        for n in range(-(-len(ids) // window)):
            want[doc_id, n, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
            lengths.append(end - start)
            start, end = end, end + window
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    bound = bin_completion.lower_bound(Counter(lengths), window) if lengths else 0
    assert bound <= len(sequences) <= sum(n for _, n in bin_completion.best_fit(Counter(lengths), window))
    return len(sequences), bound


def test_bestfit_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in plain.table()]
    found = catalog.all_queries()["op12_bestfit_packing"](spark, plain.SF)
    assert found.dtypes == [("doc_id", "bigint"), ("piece", "int"), *[
        (c, "bigint") for c in ("start", "length", "ids_crc32", "sequence_id", "offset")]]
    own, bound = check(rows, found.collect(), 1024, Tokenizer.from_file(BYTES))
    assert own <= bound + 2


@pytest.mark.parametrize("window", [1, 7, 64, 1024])
def test_bestfit_odd_rows(spark, window):
    rows = [r[:2] for r in plain.ROWS if window > 7 or len(r[1] or "") < 5000] + [(None, "no id"), (None, None)]
    df = plain.frame(spark, [(*r, "x") for r in rows]).repartition(5)
    found = packing.pack_whole(df, BYTES, window=window).collect()
    check(rows, found, window, Tokenizer.from_file(BYTES))
    assert packing.pack_whole(plain.frame(spark, []), BYTES, window=window).count() == 0


def test_equal_lengths_from_many_tasks(spark):
    """One length that nearly all pieces have gets places over all tasks."""
    rows = [(n, "same words here") for n in range(3000)] + [(9000 + n, "other " * n) for n in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    own, bound = check(rows, packing.pack_whole(df, BYTES).collect(), 1024, Tokenizer.from_file(BYTES))
    assert own <= bound + 1
