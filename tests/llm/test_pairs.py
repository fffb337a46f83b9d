"""Jaccard join, lattice dedup and components against plain versions."""

import random

import numpy as np
import pytest

from cutline.llm import catalog, components, jaccard_join, lattice_dedup
from tests.llm import plain


def classes(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def edited(words, share, rng):
    return " ".join(rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words)


def test_jaccard_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in plain.table()]
    assert classes(catalog.all_queries()["op8_jaccard_join"](spark, plain.SF)) == plain.jaccard(rows, 4, (85, 100))


@pytest.mark.parametrize("words,share", [(4, (85, 100)), (5, (80, 100)), (1, (50, 100))])
def test_jaccard_near_copies(spark, words, share):
    """Groups around the threshold, a passage that all documents share, sizes from one word up."""
    rng = random.Random(words)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for group in range(8):
        base = [f"g{group}w{i}" for i in range(rng.choice([4, 6, 30, 200]))]
        texts += [edited(base, rng.choice([0, 0.005, 0.02, 0.05]), rng) + (f" {passage}" if rng.random() < 0.5 else "") for _ in range(12)]
    rows = [(r[0], r[1], r[2]) for r in plain.ROWS] + [(100 + i, t, "en") for i, t in enumerate(texts)]
    for common in (2, 32):
        got = classes(jaccard_join.jaccard_classes(plain.frame(spark, rows), words, share, common))
        assert got == plain.jaccard([r[:2] for r in rows], words, share)


def test_jaccard_odd_tables(spark):
    assert jaccard_join.jaccard_classes(plain.frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "q r s t u v w", "x"), (2, "q r s t u v w", "x"), (3, None, "x")]
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1)
                 for r in jaccard_join.jaccard_classes(plain.frame(spark, rows)).collect())
    assert [x for x in got if x[0] in (-1, 3)] == [(-1, 2, -1), (3, 0, 3)]


def vectors():
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for spread in (0.0, 0.02, 0.03, 0.036):
        for _ in range(6):
            base = rng.normal(size=48)
            base /= np.linalg.norm(base)
            for _ in range(10):
                rows.append((n, [float(x) for x in (base + rng.normal(size=48) * spread).astype(np.float32)]))
                n += 1
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 48), (n + 3, [float("nan")] + [1.0] * 47), (n + 4, [None] + [1.0] * 47),
             (n + 5, [float("inf")] + [1.0] * 47), (n + 6, [1.0, 0.0]), (n + 7, [3.0, 0.0]), (n + 8, [1e30, 0.0]), (n + 9, [1e-30, 0.0])]
    return rows


def test_lattice_against_plain(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 7, 1) for r in rows], "vec_id long, embedding array<float>, id long, cell int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice_dedup.vector_links(df).collect()}
    want = plain.cosine_links(rows)
    found, all_ = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in got)
    assert all_ > 1000 and found >= 0.97 * all_
    assert lattice_dedup.vector_links(df.limit(0)).count() == 0


def test_lattice_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in plain.table("embeddings")]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in catalog.all_queries()["op3_lattice_dedup"](spark, plain.SF).collect()}
    assert got == plain.cosine_links(rows)


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(1)
    x, near = rng.normal(size=(200, 8)) * 2, None
    near = lattice_dedup.decode(x)
    others = (near[:, None] + lattice_dedup.roots()[None]) - x[:, None]
    assert len(lattice_dedup.roots()) == 240
    assert (((x - near) ** 2).sum(1)[:, None] <= (others ** 2).sum(2) + 1e-9).all()


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)],
    [(random.Random(n).randrange(90), random.Random(n + 999).randrange(90)) for n in range(70)],
])
def test_components(spark, edges):
    sets = plain.Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    df = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, df.collect())) == sorted((x, sets.find(x)) for x in linked)


def test_sizes_of_very_long_texts_do_not_overflow(spark):
    from pyspark.sql import functions as F

    member = "struct<at:int,doc:long,n:int,met:int,all:int>"
    rows = spark.createDataFrame([
        ((0, 1, 30_000_000, 0, 9_000_000), (0, 2, 30_000_000, 0, 9_000_000)),
        ((0, 1, 30_000_000, 0, 9_000_000), (0, 2, 20_000_000, 0, 9_000_000)),
        ((0, 1, 2_000_000_000, 5, 9_000_000), (3, 2, 2_000_000_000, 5, 9_000_000)),
    ], f"x {member}, y {member}")
    found = rows.select(
        jaccard_join._may_link(F.col("x"), F.col("y"), (85, 100)).alias("may"),
        jaccard_join._least_shared(F.col("x.n"), F.col("y.n"), (85, 100)).alias("least")).collect()
    assert [r["may"] for r in found][:2] == [True, False] and all(r["least"] > 0 for r in found)
