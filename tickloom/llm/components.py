"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import settle


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges a < b. Every node learns the smallest node around
    it and hands that on: to its larger neighbours (large star), or to its smaller
    neighbours and itself (small star)."""
    if small:
        around = edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
    else:
        around = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
    least = around.groupBy("node").agg(F.min("near").alias("least"))
    least = least.withColumn("least", F.least("least", "node"))
    met = around.join(least, "node")
    if small:
        out = met.select(F.col("near").alias("x"), "least").union(least.select(F.col("node").alias("x"), "least"))
    else:
        out = met.filter(F.col("near") > F.col("node")).select(F.col("near").alias("x"), "least")
    return (
        out.filter(F.col("x") != F.col("least"))
        .select(F.col("least").alias("a"), F.col("x").alias("b"))
        .distinct()
    )


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``links`` has a and b of one orderable type; returns node, label (smallest
    node that can be reached) for every node of a link. Self-links and nulls are
    ignored. The rounds grow with the logarithm of the longest chain; each is
    written to the shared folder. A large star is never gathered: its minimum is
    pre-aggregated, and its edges are rows.
    """
    edges = settle(
        links.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = None
    for _ in range(most_rounds):
        edges = settle(_stars(_stars(edges, small=False), small=True), "stars")
        row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    )
