"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two aggregations (map-side combined) and two joins; no component is ever
gathered in a task or on the driver, and the lineage is cut by ``checkpoint()`` in the
shared checkpoint folder.  Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeeper.session import ensure_checkpoint_dir


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` (smallest node reachable) for every node that has a link to
    another node.  Links are undirected long pairs; NULL ends and self links are ignored;
    an empty table gives an empty result."""
    ensure_checkpoint_dir(links.sparkSession)
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct().checkpoint()
    state = _state(edges)
    while state[0]:
        edges = _stars(edges).checkpoint()
        if (after := _state(edges)) == state:
            break
        state = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
