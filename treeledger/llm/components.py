"""Connected components by alternating stars, as joins and aggregates.

Each round points every node at the smallest node it knows of: first the larger neighbours of each
node, then the smaller ones. The edges shrink to stars around the smallest node of each component, in
a number of rounds that grows with the logarithm of the component's size. Every round is a table in
the shared folder, so that a lost executor costs tasks and not rounds. Minima combine before the
shuffle, and in the joins one side has a row per node, so a large star is split by the skew join.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.sources.store import stored


def _larger(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored, so that the skew join can split the rows of a large star's centre.
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of an edge ``(a, b)`` with ``a <> b``; ``component`` is the
    smallest node that can be reached. Ids are integers; repeated edges and both directions are fine,
    and no edges give no rows."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = stored(now, "edges"), None
    while True:
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        now = stored(_smaller(_larger(now).distinct()).distinct(), "edges")
