"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations and a join over the edges, and ends in a
checkpoint in the shared folder.  The minimum per node is combined on the map
side; it is written before the join, so that both sides of the join are plain
shuffles and a hub's links can be split over tasks (AQE's skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import drop_table, written


def _kept(df: DataFrame, temporary: list[DataFrame]) -> DataFrame:
    temporary.append(written(df, "components-least"))
    return temporary[-1]


def _large_star(edges: DataFrame, temporary: list[DataFrame]) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), temporary)
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, temporary: list[DataFrame]) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _kept(down.groupBy("u").agg(F.min("v").alias("m")), temporary)
    inner = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) for every node with a link; the component is its
    smallest node.  Nodes without links, self links and null ends do not appear.

    The loop ends with the first round that changes nothing; alternating stars
    are known to take in the order of log(n) squared rounds.
    """
    edges = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v").distinct().checkpoint()
    before = _signature(edges)
    while True:
        temporary: list[DataFrame] = []
        edges = _small_star(_large_star(edges, temporary).checkpoint(), temporary).checkpoint()
        for t in temporary:
            drop_table(t)
        after = _signature(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = after
