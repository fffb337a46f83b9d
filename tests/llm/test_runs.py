"""Periodic runs against plain search period by period."""

import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cutline.llm import catalog, periodic_runs
from tests.llm import plain

SPLIT = re.compile(r"[^\x20\x09-\x0d]+")


def plain_runs(words, least=24, power=3):
    """(start, length, period) of every maximal run, each period tried at every place."""
    found = {}
    for period in range(1, len(words) // power + 1):
        first = 0
        while first + period < len(words):
            last = first
            while last + period < len(words) and words[last] == words[last + period]:
                last += 1
            if last + period - first >= max(least, power * period):
                found.setdefault((first, last + period - first), period)
            first = last + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def repetitive(rng, most=400):
    """Words with blocks that repeat, nested and cut."""
    def word():
        return b"w%d" % rng.randrange(few)

    out, few = [], rng.choice([1, 2, 3, 60])
    while len(out) < most * rng.random():
        block = [word() for _ in range(rng.randrange(1, rng.choice([3, 12, 60])))]
        if rng.random() < 0.3:
            block = [block[0]] * rng.randrange(1, 30) + block
        out += (block * rng.randrange(1, 10))[:rng.randrange(1, 300)]
    return b" ".join(out)


@pytest.mark.parametrize("least, power", [(24, 3), (3, 3), (10, 4), (100, 3)])
def test_runs_like_plain_search(least, power):
    rng = random.Random(least)
    for _ in range(60):
        texts = [repetitive(rng) for _ in range(rng.randrange(1, 6))] + [b""] * rng.randrange(2)
        rng.shuffle(texts)
        words, found = periodic_runs.runs_of_texts(texts, least, power)
        for own, runs in zip(words, found):
            assert runs == plain_runs(own, least, power)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 30)), max_size=30), st.integers(1, 12))
def test_runs_of_powers(parts, times):
    words = [b"abc"[k:k + 1] for k, n in parts for _ in range(n)] * times
    assert periodic_runs.runs_of_texts([b" ".join(words)])[1][0] == plain_runs(words)


def test_long_periods_and_many_repeats():
    rng = random.Random(1)
    block = [b"%d" % rng.randrange(10**9) for _ in range(5000)]
    assert periodic_runs.runs_of_texts([b" ".join([b"x", *block * 4, b"y"])])[1][0] == [(1, 20_000, 5000)]
    for period in (1, 2, 7, 9, 17, 100):
        text = b" ".join([b"x", *block[:period] * (60_000 // period), b"y"])
        assert periodic_runs.runs_of_texts([text])[1][0] == [(1, 60_000 // period * period, period)]
    unrelated = [b"%d" % n for n in range(30_000)]
    assert periodic_runs.runs_of_texts([b" ".join(unrelated), b" ".join(unrelated)])[1] == [[], []]


def test_proposals_are_few():
    """Places of a set thin out with the scale, and texts without repeats propose nothing."""
    import numpy as np

    words = np.random.default_rng(3).integers(0, 1 << 60, 50_000).astype(np.uint64)
    for scale in (4, 16, 64, 256):
        places = periodic_runs._synchronising(words, np.zeros(len(words), bool), scale)
        assert len(places) < 3 * len(words) / scale


def expected(rows):
    out = []
    for doc_id, text in rows:
        words = SPLIT.findall(text or "")
        if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words) if len(words) < 3000 else periodic_runs.runs_of_texts([" ".join(words).encode()])[1][0]
        gone = {i for start, length, period in runs for i in range(start + period, start + length)}
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
        out.append((
            doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            plain.sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            plain.sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=str)


def test_runs_query(spark):
    found = catalog.all_queries()["op13_periodic_runs"](spark, plain.SF)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = expected([(r["doc_id"], r["text"]) for r in plain.table()])
    assert sorted(map(tuple, found.collect()), key=str) == rows
    assert sum(r[1] for r in rows) > 5


def test_runs_odd_rows(spark, folder):
    repeats = ["a b c " * 9, "\v".join(["x"] * 24), "x " * 23, "x " * 30, " lead\x1c" * 30, ("é ü " * 12 + "z ") * 4]
    rows = [(i, t) for i, t, _ in plain.ROWS] + list(enumerate(repeats, 100)) + [(None, "q r " * 20), (None, None), (16, "one")]
    # Ids of the changed tenth, over empty, short and repeated texts.
    chosen = [i for i in range(200, 900) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, t) for i, t in zip(chosen, [None, "", " ", "one", "  two words\n", *[r[1] for r in plain.ROWS], *repeats])]
    df = spark.createDataFrame(
        [(*r, 1, 2, "w", 3) for r in rows], "doc_id long, text string, h int, n int, words string, period int")
    df.write.parquet(f"{folder}/documents.parquet")
    found = periodic_runs.op13_periodic_runs(spark, folder)
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)
    df.limit(0).write.parquet(f"{folder}/empty/documents.parquet")
    assert periodic_runs.op13_periodic_runs(spark, f"{folder}/empty").count() == 0


def test_outputs_of_the_operator(spark):
    row = periodic_runs.periodic_runs(spark.createDataFrame([(1, "go " + "a b " * 20 + "end")], "doc_id int, text string")).first()
    assert row["n_words"] == 42 and row["collapsed"] == "go a b end"
    assert [tuple(r) for r in row["runs"]] == [(1, 40, 2)] and tuple(row["strongest"]) == (1, 40, 2)
