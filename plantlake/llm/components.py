"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (bigint). Returns node, root: each node that is not the smallest of its component, with the smallest.

    Each round joins every node with the smallest neighbour it knows and hands it on; the number of rounds grows with the
    logarithm of the nodes. Rounds are written to the shared folder; only a count and a checksum reach the driver.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "components-start")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "components-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(least, "a")
        small = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = stored(small.distinct(), "components-small")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
