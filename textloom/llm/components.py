"""Connected components of a table of links.

Large-star and small-star steps alternate until no link changes: every node ends linked to the smallest node of its
component. A step joins the links with one row per node, so a node with many links is a skewed key of a join that AQE
splits, and never one row or group. Each step's links are staged, so lineage stays short and a lost executor costs one
step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.staging import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node in ``links`` (a, b), both bigint.

    Nodes without a link to another node are left out, as are links with a null; order, direction and repeats of links don't
    matter; no links give no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        edges = stage(edges, "links")
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        down = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(down.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(own)
