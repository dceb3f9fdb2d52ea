"""Connected components of a graph of links, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctweave.operators.handoff import hand_off


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of ``links`` (a, b).

    Rounds of large stars (each node's larger neighbours move to its least neighbour) and small
    stars (the same for the smaller ones) until nothing changes; both keep the components and
    shorten paths, so the rounds grow with the logarithm of the longest path. Every round is
    written to the shared folder, and a node's links are aggregated, never gathered in a task.
    """
    edges = hand_off(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        # large star: u's neighbours above u link to the least of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # small star: u and its smaller neighbours link to the least of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = hand_off(
            large.join(small, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct(),
            "links",
        )
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now
