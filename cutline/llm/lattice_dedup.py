"""Embedding near-dedup by lattice hashing.

Each of several tables projects a vector, scaled to length one, by random matrices to blocks of eight
dimensions and decodes each block to the nearest point of the E8 lattice; the points together are the
vector's cell. The index holds one cell per vector and table. Every vector probes its own cell and those
made with the second-nearest point in one or more blocks. Vectors that meet are candidates, and the
cosine, in double precision, decides. Every vector is indexed and every one is a query.

With the default parameters a pair at cosine 0.95 is met by a table with probability 0.42, so by eight
tables with 0.98; at 0.98 with more than 0.999. Unrelated vectors of 64 dimensions meet with probability 2e-6 per
table. Larger corpora take more blocks: each multiplies that figure by about 0.01.

Equal vectors form one class with one representative, so thousands of copies are one row in the index, and
their links are counted by class sizes. The join of cells has no cap; Spark splits large cells.

Rows: vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Vectors of
different length never link. Repeated rows are vectors of their own and link with each other. A row with
null vec_id is not compared; its component is null. An empty table gives an empty result. Other columns are ignored.
"""

import itertools

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from cutline.llm.common import new_folder, ship, stored
from cutline.llm.components import components

CLASS = ["k1", "k2"]


def roots():
    """The 240 shortest vectors of E8."""
    import numpy as np

    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            found.append([a if n == i else b if n == j else 0 for n in range(8)])
    found += [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


def _even(x):
    """Nearest integer points with an even sum."""
    import numpy as np

    near = np.rint(x)
    rest = x - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    at = np.abs(rest[odd]).argmax(1)
    near[odd, at] += np.where(rest[odd, at] >= 0, 1, -1)
    return near


def decode(x):
    """Nearest E8 points: integers with an even sum, or those shifted by a half."""
    import numpy as np

    one, two = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - one) ** 2).sum(1) <= ((x - two) ** 2).sum(1)
    return np.where(nearer[:, None], one, two)


def cells(vectors, table, blocks, scale, seed):
    """Cell numbers per vector, its own one first: every choice of nearest or second-nearest point per block."""
    import numpy as np

    from cutline.llm.shingles import mix

    directions, size = roots(), vectors.shape[1]
    parts = []
    for block in range(blocks):
        rng = np.random.default_rng([seed, table, block, size])
        y = vectors @ (rng.normal(size=(size, 8)) / np.sqrt(8)) / scale
        own = decode(y)
        other = own + directions[((y - own) @ directions.T).argmax(1)]
        codes = []
        for point in (own, other):
            code = np.full(len(point), 1 + block, np.uint64)
            for column in (2 * point).astype(np.int64).T:
                code = mix(code * np.uint64(0x9E3779B97F4A7C15) + column.view(np.uint64))
            codes.append(code)
        parts.append(codes)
    out = []
    for choice in itertools.product((0, 1), repeat=blocks):
        code = np.full(len(vectors), table * 1000003 + size, np.uint64)
        for codes, which in zip(parts, choice):
            code = mix(code + codes[which])
        out.append(code.view(np.int64))
    return out


def _cell_rows(classes, tables, blocks, scale, seed):
    """(cell, id, own) of all cells that a vector is in or probes."""
    def run(batches):
        import numpy as np

        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                ids, lists = part.column(0).to_numpy(), part.column(1).to_pylist()
                sizes = np.array([len(x) for x in lists])
                for size in set(sizes.tolist()):
                    rows = np.flatnonzero(sizes == size)
                    vectors = np.array([lists[r] for r in rows], np.float64)
                    vectors /= np.abs(vectors).max(1)[:, None]
                    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
                    for table in range(tables):
                        found = cells(vectors, table, blocks, scale, seed)
                        own = np.zeros(len(found) * len(rows), bool)
                        own[:len(rows)] = True
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.concatenate(found)), pa.array(np.tile(ids[rows], len(found))), pa.array(own)],
                            ["cell", "id", "own"])

    return classes.select("id", "embedding").mapInArrow(run, "cell long, id long, own boolean")


def _cosines(pairs, classes):
    """(a, b, cosine) of candidate pairs."""
    def run(batches):
        import numpy as np

        for batch in batches:
            for at in range(0, len(batch), 5000):
                part = batch.slice(at, 5000)
                va, vb = part.column(2), part.column(3)
                same = np.array(pc.equal(pc.list_value_length(va), pc.list_value_length(vb)))
                part = part.filter(pa.array(same))
                if not len(part):
                    continue
                cosine = np.empty(len(part))
                sizes = np.array(pc.list_value_length(part.column(2)))
                for size in set(sizes.tolist()):
                    rows = np.flatnonzero(sizes == size)
                    x, y = (part.column(c).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                            .astype(np.float64).reshape(-1, size) for c in (2, 3))
                    x /= np.abs(x).max(1)[:, None]
                    y /= np.abs(y).max(1)[:, None]
                    cosine[rows] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cosine)], ["a", "b", "cosine"])

    one = classes.select(F.col("id").alias("a"), F.col("embedding").alias("va"))
    two = classes.select(F.col("id").alias("b"), F.col("embedding").alias("vb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long, cosine double")


def vector_links(vectors, least=0.95, tables=8, blocks=3, scale=0.8, seed=17):
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    ship(spark)
    root = new_folder(spark, "lattice")
    usable = (
        F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0)
    )
    usable = F.coalesce(usable, F.lit(False))
    keyed = vectors.select(
        "vec_id", F.when(usable, F.xxhash64("embedding")).alias("k1"),
        F.when(usable, F.xxhash64(F.lit(7), "embedding")).alias("k2"), "embedding")
    classes = stored(
        keyed.filter("k1 is not null").groupBy(*CLASS)
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("embedding").alias("embedding")),
        f"{root}/classes")
    rows = stored(_cell_rows(classes, tables, blocks, scale, seed), f"{root}/cells")
    index = rows.filter("own").select("cell", F.col("id").alias("other"))
    pairs = (
        rows.join(index, "cell").filter("id != other")
        .select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()
    )
    links = stored(_cosines(pairs, classes).filter(F.col("cosine") >= least), f"{root}/links")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("id").alias("b"), "size")
    counts = both.join(sizes, "b").groupBy(F.col("a").alias("id")).agg(F.sum("size").alias("linked"))
    parts = components(links).select(F.col("node").alias("id"), "component")
    known = classes.select(*CLASS, "id", "size").join(counts, "id", "left").join(parts, "id", "left")
    component = F.coalesce("component", "id", "vec_id")
    return keyed.select("vec_id", *CLASS).join(known, CLASS, "left").select(
        "vec_id",
        (F.coalesce("size", F.lit(1)) - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op3_lattice_dedup(spark, sf_dir):
    return vector_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


# All pairs of vectors of finite components that are not all zero; reachable vectors by recursion.
OP3_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
         coalesce(len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
                  AND list_bool_or(list_transform(embedding, lambda x: x <> 0)), false) AS usable FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id, vec_id AS other FROM vectors UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
parts AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM parts
"""
