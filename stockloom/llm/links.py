"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import stored
from stockloom.sources.durable import drop_tables


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root``: every node that has a link to another one, with the smallest node of its component.

    Large-star and small-star steps in turn: each node's larger neighbours, then its smaller ones, are tied to the smallest
    node nearby, until all edges of a component meet in its smallest node. Every step is a grouped minimum and a join on
    nodes; each round is written to the shared folder, where it takes the place of the one before. Nodes must be comparable and not null; links of a node to itself,
    repeated links and an empty table are fine.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        before = state
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))).where("u <> v").distinct()
        old, edges = edges, stored(small, "links")
        drop_tables(old, large)
