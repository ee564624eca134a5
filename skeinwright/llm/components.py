"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a minimum per node (pre-aggregated) and a join with it, so no neighbourhood is ever
gathered in one place; each half-step is written to the shared folder, which lets Spark split a hub's
rows over tasks in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written


def _star(edges: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Links the ``a`` of each edge (a, b) to the least of a and all its b; edges (node, least), and the path
    of the table of minima that they are made from."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    least, path = written(least, tag)
    moved = edges.filter("b > a" if tag == "large" else "true").join(
        least.withColumnRenamed("a", "n"), F.col("a") == F.col("n")
    )
    moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if tag == "small":
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter("a <> b").distinct(), path


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, 7, a))")).head()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b) with a <> b; root is the least node in reach.

    Edges may repeat, in either direction; loops and an empty table give no rows. Nodes are longs. Each round
    lowers a node's links or ends, so it goes on until nothing changes; a round's tables are deleted when the
    next one's are written.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, path = written(edges, "edges")
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large, least1 = _star(both, "large")
        large, middle = written(large, "edges")
        small, least2 = _star(large, "small")
        edges, after = written(small, "edges")
        for old in (path, least1, middle, least2):
            release(spark, old)
        path, now = after, _signature(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
