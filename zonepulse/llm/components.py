"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import salted_join
from zonepulse.sources.scratch import materialize


def _least_of(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v; a node with very many neighbours is dealt over salts."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return salted_join(pairs, least, lambda a, b: a["u"] == b["node"], F.col("v"), "inner").drop("node")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are tied to its least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least_of(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = _least_of(down)
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(tied.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the least node that it can reach.

    The number of rounds grows with the logarithm of the longest path; each writes its edges, so a lost
    executor costs one round. Loops and repeated edges do no harm; no edges give no rows.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.filter("u != v").distinct()

    current, mark = materialize(tidy(edges.select("u", "v")), "edges"), None
    while True:
        current = materialize(tidy(_small_star(tidy(_large_star(current)))), "edges")
        found = current.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(found) == mark or found[0] == 0:
            break
        mark = tuple(found)
    # at the end every edge leads from a node to its root
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(current.select("v", "v")).distinct()
