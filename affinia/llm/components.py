"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.sources.workspace import written


def _starred(edges: DataFrame, centre: str, other: str) -> DataFrame:
    """Each row with the least neighbour of its centre, the centre included, as ``m``."""
    least = edges.groupBy(centre).agg(F.min(other).alias("m"))
    least = written(least.select(centre, F.least(centre, "m").alias("m")), "star")
    return edges.join(least, centre)


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _starred(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    starred = _starred(written(down, "large"), "a", "b")
    small = starred.select(F.col("b").alias("a"), F.col("m").alias("b"))
    small = small.unionByName(starred.select("a", F.col("m").alias("b")))
    return small.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (``node``, ``component``) for all nodes with an edge; the component is its least node.

    ``edges`` has integer columns ``a`` and ``b`` in any order; loops, repeated
    edges and edges with a null are ignored. Every step is an aggregate and a
    join on all edges; what a step makes is written to the shared folder. The
    number of rounds grows with the logarithm of the longest chain.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    edges, before = written(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        edges, before = written(_round(edges), "edges"), now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
