"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link (long ids).

    Each round points every node's larger neighbours at its smallest neighbour (large star),
    then every node and its smaller neighbours at the smallest (small star); after O(log n)
    rounds every node points straight at its component's smallest node.  Minima are partial
    aggregates and the joins are on node ids, so a node with very many links is a skewed join
    key, which adaptive execution splits, and no neighbour list is ever gathered.  Each round
    is written to the shared checkpoint folder, which cuts the lineage.  No links: no rows;
    links with a null end or from a node to itself are ignored."""
    edges = cut_lineage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
                        .distinct())
    before = _signature(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = cut_lineage(small)
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
                         .distinct()))
