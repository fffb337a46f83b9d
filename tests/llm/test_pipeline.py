"""The corpus pipeline: each stage on its own input, and the whole."""

import hashlib

import corpus_pipeline as cp
from cutline.llm import quality, secret_scan
from tests.llm import plain


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_on_their_own_input(spark, folder):
    docs, seen = spark.read.parquet(f"{plain.SF}/documents.parquet"), []
    for n, (name, stage) in enumerate(cp.STAGES):
        before = rows(docs)
        out = stage(spark, docs, plain.SF)
        out.write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        if n < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            after = rows(docs)
            seen.append((name, before, after))
            assert set(after) <= set(before) and all(r["n_chars"] == len(r["text"]) for r in after.values())
    (_, a, b), (_, c, d), (_, e, f), (_, g, h) = seen
    assert 0.7 * len(a) < len(b) < len(a) and all(b[i] == a[i] for i in b)
    want = {i: s for i, _, _, s in plain.lines([(i, r["text"]) for i, r in c.items()])}
    assert {i: hashlib.sha256(r["text"].encode()).hexdigest() for i, r in d.items()} == want
    parts = plain.jaccard([(i, r["text"]) for i, r in e.items()], 5, (80, 100))
    assert set(f) == {i for i, (_, part) in parts.items() if part == i}
    found = {i for i, r in g.items() if secret_scan.base_spans(r["text"])}
    assert set(g) == set(h) and all("[secret]" in h[i]["text"] and not secret_scan.base_spans(h[i]["text"]) for i in found)
    assert all(h[i]["text"] == g[i]["text"] or "[secret]" in h[i]["text"] for i in h)
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == set(h)


def test_run_and_odd_rows(spark, folder):
    import pyspark.sql.functions as F

    df = plain.frame(spark).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    df.write.parquet(f"{folder}/documents.parquet")
    out = cp.run(spark, folder)
    assert out.count() > 0 and {r["doc_id"] for r in out.collect()} <= {r[0] for r in plain.ROWS}
    df.limit(0).write.parquet(f"{folder}/none/documents.parquet")
    assert cp.run(spark, f"{folder}/none").count() == 0


def test_the_query_is_registered():
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and cp.ORACLE_SQL is None
    assert len([q for q in entry.queries() if q.startswith("op")]) == 13
    assert callable(quality.classify)


def test_near_duplicates_with_repeated_ids(spark):
    text = lambda word: " ".join(f"{word}{n}" for n in range(40))
    data = [(1, text("a"), "x"), (1, text("a"), "x"), (2, text("a") + " end", "x"), (2, text("b"), "x"), (3, text("c"), "x"),
            (4, text("b") + " end", "x"), (5, "", "x"), (5, "", "x"), (None, text("a"), "x"), (6, text("c"), "y"), (6, text("d"), "y")]
    out = cp.near_stage(spark, plain.frame(spark, data), plain.SF).select("doc_id", "text").collect()
    want = [(1, text("a")), (2, text("b")), (3, text("c")), (5, ""), (5, ""), (None, text("a")), (6, text("d"))]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_columns_of_any_name_pass_through(spark, folder):
    """Names that operators use themselves stay as they came, in every stage that returns documents."""
    import pyspark.sql.functions as F

    names = ["n_lines", "n_dropped", "kept_text", "quality_score", "accepted", "spans", "__key", "__own", "__doc", "__row",
             "others", "th", "__th", "a.b"]
    docs = plain.frame(spark).select("doc_id", "text", *[
        F.concat(F.lit(f"{name}:"), F.coalesce("lang", F.lit("-"))).alias(name) for name in names], "lang")
    for n, (name, stage) in enumerate(cp.STAGES[:4]):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/{n}")
        kept = spark.read.parquet(f"{folder}/{n}")
        assert kept.count() > 0
        for row in kept.collect():
            assert all(row[c] == f"{c}:{row['lang'] or '-'}" for c in names), (name, row)


def test_only_the_two_needed_columns(spark, folder):
    docs = plain.frame(spark).select("doc_id", "text")
    for _, stage in cp.STAGES[:4]:
        assert stage(spark, docs, folder).columns == ["doc_id", "text"]
