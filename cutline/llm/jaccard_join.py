"""N-gram Jaccard join in the metric space of shingle sets: pivots, regions, windows, recursion. Exact.

The distance is 1 - |x and y| / |x or y|; documents link when it is at most eps = 1 - threshold.
Unrelated texts all have distance 1 from each other, so whole documents as first pivots would leave nearly
the whole corpus in one region. The pivots therefore come in two kinds:

1. First pivots are single shingles in one global order, common ones last. A document lies nearest to its
   first pivot; the window of documents that may be within eps of it reaches as far as its first
   n - ceil(threshold * n) + l pivots, and it is replicated to their regions. Two documents within eps meet
   in at least l regions (l the smaller of both documents' values), and at places in their orders that leave room
   for the overlap they need. That holds for any global order, so the order may be approximate: every task
   counts the shingles of its documents, those that repeat there are summed up, and those in more than
   `common` documents are set in a bitmap of fixed size, which is broadcast.
2. Within a region a document is the pivot. Distances to it are computed exactly; documents within eps of it
   form its cell and are linked. The rest recurses with a new pivot, as long as a tenth of the comparisons
   link and they are a fiftieth of all links. What then remains apart is compared pair by pair, if the triangle inequality over the last common pivot and
   the sizes allow a link. Documents that are already connected need no comparison, so a group of
   thousands of near copies costs one comparison per member and pivot, not one per pair.

Equal shingle sets (a 128-bit digest of the set) are one class, represented by its smallest doc_id.
Intersection and union are counted on 64-bit shingle hashes of the whole texts.

Rows: null or empty texts, and texts of blanks, have no shingles and link with nothing. Rows that repeat a
doc_id are one document; if their texts differ, the one with the smallest hash stands for it. A null doc_id
links with nothing and has no component. An empty table gives an empty result. Other columns are ignored.
"""

from functools import reduce

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from cutline.llm.common import documents, new_folder, ship, stored
from cutline.llm.components import components

BITS = 1 << 24
PROFILE = "doc_id long, th long, n long, s1 long, s2 long, key long, docs long"
LEADING = "doc_id long, th long, n long, keys binary"
COUNTED = 2_000_000  # shingles that a task counts together


def _ceil_share(n, share):
    """ceil(n * share) for a share given as (numerator, denominator)."""
    return -(-n * share[0] // share[1])


def _shared(n):
    """How many regions two linked documents share at least, by size."""
    return 1 + n // 16


def _leading(n, share):
    return min(n, n - _ceil_share(n, share) + _shared(n))


def _bitmap(frame, value):
    """A broadcast bitmap of BITS bits with the values of a column, modulo BITS: at most 512 rows reach the driver."""
    slot = F.pmod(value, F.lit(BITS)) + 1
    rows = frame.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    whole = bytearray(BITS // 8)
    for row in rows:
        at = (row["bucket"] - 1) * 4096
        whole[at:at + len(row["bits"])] = row["bits"]
    return frame.sparkSession.sparkContext.broadcast(bytes(whole))


def _bits(bitmap):
    import numpy as np

    return np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").astype(bool)


def profiles(docs, words):
    """Per row: set size and digest of the set (docs is null). Between them rows (key, docs): shingles that repeat."""
    def run(batches):
        import numpy as np

        from cutline.llm.shingles import mix, shingle_sets

        def repeated(parts):
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            keys, counts = keys[counts > 1], counts[counts > 1]
            return pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(keys), pa.int64()) for _ in range(5)), pa.array(keys.view(np.int64)), pa.array(counts)], names)

        names, parts, held = [f.split()[0] for f in PROFILE.split(", ")], [], 0
        for batch in batches:
            n, s1, s2 = [], [], []
            for _, found in shingle_sets(batch.column(1), words):
                n.append(len(found))
                s1.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                parts.append(found)
                held += len(found)
                if held >= COUNTED:
                    yield repeated(parts)
                    parts, held = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), *(pa.nulls(len(batch), pa.int64()) for _ in range(2))], names)
        if held:
            yield repeated(parts)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, PROFILE)


def leading_shingles(docs, words, share, common):
    """Per row: set size and the leading shingles in the global order, as bytes."""
    def run(batches):
        import numpy as np

        from cutline.llm.shingles import shingle_sets

        bits = _bits(common)
        for batch in batches:
            n, keys = [], []
            for _, found in shingle_sets(batch.column(1), words):
                take = _leading(len(found), share)
                late = bits[found & np.uint64(BITS - 1)]
                if late[:take].any():
                    found = np.concatenate((found[~late], found[late]))
                n.append(len(found))
                keys.append(found[:take].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary())],
                [f.split()[0] for f in LEADING.split(", ")])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, LEADING)


def _exploded(rows):
    """(key, doc, n, at) per leading shingle, `at` being its place in the document's order."""
    def run(batches):
        import numpy as np

        for batch in batches:
            for first in range(0, len(batch), 2000):
                part = batch.slice(first, 2000)
                raw = [k.as_py() for k in part.column(2)]
                sizes = np.array([len(k) // 8 for k in raw])
                at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(b"".join(raw), np.int64)),
                    pa.array(np.repeat(part.column(0).to_numpy(), sizes)),
                    pa.array(np.repeat(part.column(1).to_numpy(), sizes).astype(np.int32)),
                    pa.array(at.astype(np.int32)),
                ], ["key", "doc", "n", "at"])

    return rows.select("doc_id", "n", "keys").mapInArrow(run, "key long, doc long, n int, at int")


def _only_marked(docs, marks):
    """(doc_id, th, text) of documents whose hashed id is marked; a few more may pass."""
    def run(batches):
        bits = _bits(marks)
        for batch in batches:
            yield batch.select([0, 1, 2]).filter(pa.array(bits[batch.column(3).to_numpy()]))

    slot = F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).alias("slot")
    return docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("th"), "text", slot).mapInArrow(run, "doc_id long, th long, text string")


def _measured(pairs, texts, words):
    """(a, b, both, either) for pairs (a, b): sizes of intersection and union."""
    def run(batches):
        import numpy as np

        from cutline.llm.shingles import shingle_sets

        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                distinct = part.column(3).dictionary_encode()
                right = [s for _, s in shingle_sets(distinct.dictionary, words)]
                both, either = [], []
                for (_, x), code in zip(shingle_sets(part.column(2), words), distinct.indices.to_pylist()):
                    y = right[code]
                    merged = np.sort(np.concatenate((x, y)))
                    same = int((merged[1:] == merged[:-1]).sum())
                    both.append(same)
                    either.append(len(x) + len(y) - same)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())],
                    ["a", "b", "both", "either"])

    joined = (
        pairs.select("a", "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
    )
    return joined.mapInArrow(run, "a long, b long, both long, either long")


def _sizes_allow(x, y, share):
    """The smaller set is at least the threshold's share of the larger one."""
    x, y = x.cast("long"), y.cast("long")
    return F.least(x, y) * share[1] >= F.greatest(x, y) * share[0]


def _least_shared(x, y, share):
    """How many leading shingles two linked documents of these sizes share at least.

    All shared shingles up to the end of the prefix that ends first lead both documents; behind it at most the
    rest of that document can be shared.
    """
    x, y = x.cast("long"), y.cast("long")

    def rest(n):
        return F.greatest(F.lit(0).cast("long"), F.ceil(n * share[0] / share[1] - 1e-9) - 1 - F.floor(n / 16))

    need = F.ceil((x + y) * share[0] / (share[0] + share[1]) - 1e-9)
    return F.greatest(need - F.greatest(rest(x), rest(y)), F.lit(1))


def _may_link(x, y, share):
    """Whether two members (structs of a region) may link with the region's shingle as the first that they share.

    Two linked documents meet in the region of their first shared shingle, so other regions need not name the
    pair. Of a document's leading shingles `all` lead another document too, `met` of them before this one. The
    first shared one has enough of them left in both documents. Shared shingles before any other are among the
    `met` ones of both; behind it at most the lesser rest can be shared.
    """
    least, sizes = _least_shared(x["n"], y["n"], share), x["n"].cast("long") + y["n"]
    left = (x["met"] + least <= x["all"]) & (y["met"] + least <= y["all"])
    meet = F.least(x["met"], y["met"]) + F.least(x["all"] - x["met"], y["all"] - y["met"])
    most = F.least(x["met"], y["met"]) + F.least(x["n"] - x["at"], y["n"] - y["at"])
    room = most.cast("long") * (share[0] + share[1]) >= sizes * share[0]
    return _sizes_allow(x["n"], y["n"], share) & left & (meet >= least) & room


def _union(frames):
    return reduce(lambda one, other: one.unionByName(other), frames)


def _linked(measured, share):
    return measured.filter(F.col("both") * share[1] >= F.col("either") * share[0]).select("a", "b")


def _stars(members, share):
    """Pairs of a region's pivot (b) and a member (a) that are not connected yet and may be within eps."""
    x, p = F.col("x"), F.col("p")
    return (
        members.filter((F.col("part") != F.col("pp")) & _may_link(x, p, share))
        .select(x["doc"].alias("a"), p["doc"].alias("b")).distinct()
    )


def _with_pivots(members):
    """(key, x, part) with the region's pivot p and its part pp.

    The pivot is the member that has the region's shingle first in its order: it has the fewest rare ones
    before it, so of a group of near copies it is the one that most others are near to. Of regions with a
    pivot before (its part is `was`) the new one is from outside of its component; others are done.
    """
    pivots = members.filter("was is null or part != was").groupBy("key").agg(F.min(F.struct("x", "part")).alias("next"))
    return members.drop("was").join(pivots, "key").select(
        "key", "x", "part", F.col("next.x").alias("p"), F.col("next.part").alias("pp"))


def _recurse(members, parts):
    """Regions that still hold several components, with new pivots."""
    doc = parts.select(F.col("node").alias("doc"), "component")
    last = parts.select(F.col("node").alias("pivot"), F.col("component").alias("was"))
    members = members.select("key", "x", F.col("x.doc").alias("doc"), F.col("p.doc").alias("pivot"))
    return _with_pivots(members.join(doc, "doc", "left").join(last, "pivot", "left").select(
        "key", "x", F.coalesce("component", "doc").alias("part"), F.coalesce("was", "pivot").alias("was")))


def _apart(members, measured, share):
    """Pairs of region members that are not connected, unless places, sizes or the triangle inequality rule a link out."""
    distance = _union([
        known.select(F.col("a").alias("doc"), F.col("b").alias("pivot"), (1 - F.col("both") / F.col("either")).alias("d"))
        for known in measured
    ])
    sides = members.withColumns({"doc": F.col("x.doc"), "pivot": F.col("p.doc")}).join(distance, ["doc", "pivot"], "left")
    x = sides.select("key", "x", F.col("part").alias("px"), F.col("d").alias("dx"))
    y = sides.select("key", F.col("x").alias("y"), F.col("part").alias("py"), F.col("d").alias("dy"))
    eps = 1 - share[0] / share[1]
    window = F.coalesce(F.abs(F.col("dx") - F.col("dy")) <= eps + 1e-9, F.lit(True))
    return (
        x.join(y, "key")
        .filter((F.col("x.doc") > F.col("y.doc")) & (F.col("px") != F.col("py")) & window)
        .filter(_may_link(F.col("x"), F.col("y"), share))
        .select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()
    )


def _new(pairs, measured):
    """Pairs that were not measured before, in either order."""
    both = [m.select("a", "b") for m in measured] + [m.select(F.col("b").alias("a"), F.col("a").alias("b")) for m in measured]
    return pairs.join(_union(both), ["a", "b"], "left_anti") if both else pairs


def jaccard_classes(docs, words=5, share=(80, 100), common=32):
    """(doc_id, n_shingles, component_id) per row, `share` being the threshold as a fraction."""
    spark = docs.sparkSession
    ship(spark)
    root = new_folder(spark, "jaccard")
    both = stored(profiles(docs, words), f"{root}/profiles")
    counts = both.filter("docs is not null").groupBy("key").agg(F.sum("docs").alias("docs"))
    late = _bitmap(counts.filter(F.col("docs") > common), F.col("key"))
    first = both.filter("docs is null")
    ids = first.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(F.struct("th", "n", "s1", "s2")).alias("x")).select("doc_id", "x.*")
    classes = stored(
        ids.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min(F.struct("doc_id", "th")).alias("rep"))
        .select("n", "s1", "s2", F.col("rep.doc_id").alias("rep"), F.col("rep.th").alias("th")),
        f"{root}/classes")
    reps = classes.select(F.col("rep").alias("doc_id"), "th")
    leading = leading_shingles(docs, words, share, late).join(reps, ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
    rows = stored(_exploded(leading), f"{root}/leading")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    own = Window.partitionBy("doc")
    met = rows.join(shared, "key").withColumns({
        "met": F.row_number().over(own.orderBy("at")) - 1, "all": F.count(F.lit(1)).over(own).cast("int")})
    # A linked document shares at least as many leading shingles as `_shared` asks of the smaller one.
    able = met.filter(F.col("all") >= F.floor(F.col("n").cast("long") * share[0] / share[1] / 16))
    members = stored(able.select("key", F.struct("at", "doc", "n", "met", "all").alias("x")), f"{root}/able")
    members = stored(
        _with_pivots(members.withColumns({"part": F.col("x.doc"), "was": F.lit(None).cast("long")})), f"{root}/members0")
    marked = _only_marked(docs, _bitmap(members.filter("p.doc != x.doc").select(F.explode(F.array("p.doc", "x.doc")).alias("doc")), F.xxhash64("doc")))
    texts = marked.join(reps, ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"]).drop("th")
    texts.write.option("compression", "zstd").parquet(f"{root}/texts")
    texts = spark.read.parquet(f"{root}/texts")

    measured, links, parts, total = [], [], None, 0
    while True:
        turn = len(measured)
        found = stored(_measured(_new(_stars(members, share), measured), texts, words), f"{root}/stars{turn}")
        measured.append(found)
        links.append(_linked(found, share))
        compared, near = found.count(), links[-1].count()
        if near:
            parts = components(_union(links))
            members = stored(_recurse(members, parts), f"{root}/members{turn + 1}")
        total += near
        if near * 10 <= compared or near * 50 <= total:
            break
    rest = stored(_measured(_new(_apart(members, measured, share), measured), texts, words), f"{root}/pairs")
    links.append(_linked(rest, share))
    if parts is None or not links[-1].isEmpty():
        parts = components(_union(links))
    own = ids.join(classes.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"]).select("doc_id", "rep")
    return (
        first.select("doc_id", F.col("n").alias("n_shingles"))
        .join(own, "doc_id", "left")
        .join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    )


def op8_jaccard_join(spark, sf_dir):
    return jaccard_classes(documents(spark, sf_dir), words=4, share=(85, 100))


# Every pair of documents that share a shingle, compared by whole sets; reachable documents by recursion.
OP8_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM texts),
sizes AS (SELECT doc_id, count(s) AS n FROM texts LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM texts UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
"""
