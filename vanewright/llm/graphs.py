"""Connected components of a graph held in DataFrames.

Large-star and small-star steps (Kiveris et al., 2014) alternate until nothing changes. The smallest neighbours are combined
before they are shuffled, and written before they are joined with the edges again: then both sides of the join are plain
exchanges, and Spark's adaptive skew join splits the hub of a large component over many tasks. No node's neighbours are
gathered, and only a count and a hash reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import discard, materialise, shuffled


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest neighbour of each node."""
    return materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "lowest")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both)
    moved = both.join(shuffled(low), "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    out = materialise(moved.where("u <> v").distinct(), "edges")
    discard(low)
    return out


def _small(edges: DataFrame) -> DataFrame:
    low = _lowest(edges)
    moved = edges.join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = materialise(moved.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
    discard(low)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges between long ids -> (node, label): every node with an edge, and the smallest id it reaches.

    Rows with a null id and self-loops are ignored; repeated edges count once; no edges give an empty table.
    """
    now = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct()
    now = materialise(now, "edges")
    seen = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
        large = _large(now)
        small = _small(large)
        discard(now, large)
        now = small
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
