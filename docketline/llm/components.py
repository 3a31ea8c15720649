"""Connected components as joins: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialise


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star round. Each node's smallest neighbour comes from a grouped (map-side
    reduced) pass; the join back on a hot node can be split as a skewed join."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    out = both.join(least, "a")
    if small:
        out = out.select(F.col("b"), F.col("m")).unionByName(least.select(F.col("a").alias("b"), "m"))
    else:
        out = out.where("b > a").select("b", "m")
    return out.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b long): comp is its component's smallest node.

    Loops and repeated or reversed edges do no harm; no edges give no rows. Each
    round is written to the shared folder; only its row count and checksum reach the driver.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), f"{name}-edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        now = materialise(_stars(_stars(now, small=False), small=True), f"{name}-round")
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
