"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.base import stored


def _hung(pairs: DataFrame) -> DataFrame:
    """u, v of both directions with the least of u and all its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that each node of the links (a, b) can reach.

    Large and small stars in turns: each node's larger neighbours, then its smaller ones and itself, are hung on the least
    of them, until nothing changes.  The rounds grow with the logarithm of the nodes; each is written to the
    shared folder, and only its size and a checksum come to the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = _hung(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = stored(small, "components")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
