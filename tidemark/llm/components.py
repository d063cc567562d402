"""Connected components of a graph whose edges may be too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stage


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, of every node in links (a, b).

    Alternates two steps until nothing changes: each node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows.  Minima are taken before every shuffle, and the
    joins have one row for each node on a side, so that Spark can split a hub.  Every round is
    staged.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    state = _checksum(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(
            small.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct(), "edges"
        )
        before, state = state, _checksum(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
