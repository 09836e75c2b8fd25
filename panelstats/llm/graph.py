"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop, mark, save, since


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is the smallest node reachable.

    Large-star and small-star steps alternate until the edges no longer change; every round is written to
    the shared folder, and only a count and a checksum come to the driver.
    """
    spark = links.sparkSession
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, path = save(edges, "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, large_path = save(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges, new_path = save(small, "edges")
        drop(spark, path, large_path)
        path = new_path
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def saved_components(links: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``components`` as a written table, without the edges of its last round."""
    at = mark()
    found, path = save(components(links), name)
    drop(links.sparkSession, *[p for p in since(at) if p != path])
    return found, path
