"""Connected components of a large edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.session import materialise


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; every node's least neighbour is a pre-aggregated
    minimum, so a node with very many edges costs one row per task before the join."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()  # u > v from here on
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node with an edge; root is the least node of its component.

    ``edges`` has two columns of one comparable type; null ends and loops are left out. Each
    round is written to the shared folder, and the rounds stop when the edges no longer change;
    their number grows with the logarithm of the longest path.
    """
    u, v = edges.columns
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")) \
        .where("u is not null and v is not null and u <> v").distinct()
    now = materialise(now, f"{name}-{uuid.uuid4().hex[:8]}")
    state = None
    while True:
        # order-free fingerprint of the edge set: rows, and two sums of hashes
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 2147483647),
                      F.sum(F.xxhash64("v", "u") % 2147483647)).first()
        if new == state or new[0] == 0:
            break
        state = new
        now = materialise(_stars(now), f"{name}-{uuid.uuid4().hex[:8]}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
