"""Connected components of a link table by alternating star contraction, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policymill.runtime import materialize


def connected(links: DataFrame, scope: str, a: str, b: str) -> DataFrame:
    """(scope, node, component) of all nodes that have links; the component is the least node in it.

    Rounds repeat until no link changes; their number grows with the logarithm of the longest path. A node with many
    links only ever meets them in a grouped minimum and an equi-join, never in one row.
    """
    s = F.col(scope).alias("s")
    edges = links.select(s, F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    before = None
    while True:
        # Large star: link every greater neighbour of a node to the least of the node and its neighbours.
        both = edges.select("s", "u", "v").unionByName(edges.select("s", F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("s", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, ["s", "u"]).where("v > u").select("s", F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: link every smaller neighbour of a node, and the node, to the least of them.
        least = large.groupBy("s", "u").agg(F.min("v").alias("m"))
        small = large.join(least, ["s", "u"]).select("s", F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("s", "u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialize(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("s", "u", "v")), F.bit_xor(F.xxhash64("u", "v", "s"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("s", F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(edges.select("s", F.col("v").alias("node"), F.col("v").alias("component")).distinct()).withColumnRenamed("s", scope)
