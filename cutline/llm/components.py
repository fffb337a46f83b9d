"""Connected components by alternating star operations, on shared files between the rounds.

Every round links the larger neighbours of a node to its smallest neighbour (large star) and then the smaller
ones (small star). The edges shrink to one star per component, whose centre is its smallest node. A
node with very many neighbours is one row per task after the partial minimum, and its join is a plain
inner join whose large partitions Spark splits.
"""

from pyspark.sql import functions as F

from cutline.llm.common import new_folder, stored


def _large_star(edges):
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges):
    """Edges come with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(edges):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges, a="a", b="b"):
    """(node, component) for every node that has an edge to another one; the component is its smallest node.

    Self-loops and repeated edges do no harm. No edges give an empty result.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    root = new_folder(edges.sparkSession, "components")
    edges, turn = stored(edges, f"{root}/0"), 0
    mark = _mark(edges)
    while mark[0]:
        turn += 1
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), f"{root}/{turn}")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)
