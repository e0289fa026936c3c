"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every id in `links` (a long, b long); component is its smallest reachable id.

    Large-star ties the larger neighbours of every node to its smallest neighbour, small-star the
    smaller ones; in the end all links are stars around the smallest ids. Every round settles its
    links, and the smallest neighbours before they are joined, so that Spark can split the links of
    a node with very many.
    Null ids and self-links are no links; repeated links count once. No links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = settle(edges)
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select("v", "u"))
        least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        edges = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        edges = settle(
            joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
