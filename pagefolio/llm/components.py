"""Connected components of a table of links, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefolio.sources.scratch import written


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links (a, b)``; the component is its smallest id.

    Rounds of the large-star and small-star steps: every node points all its larger neighbours,
    then all its smaller ones, to the smallest node it knows. The links become stars around
    the smallest ids in a number of rounds that grows with the logarithm of the longest path. A
    round is written to the shared folder, which cuts the lineage. Nothing but one
    row of counts per round comes to the driver. Null ids and loops are ignored.
    """
    oriented = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(oriented.filter("a > b").distinct(), "links")
    seen = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m"))
        larger = both.filter("b > a").join(
            smallest.select("a", F.least("a", "m").alias("m")), "a"
        ).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        larger = written(larger, "links")
        smallest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(smallest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(
            smaller.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), "links"
        )
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
