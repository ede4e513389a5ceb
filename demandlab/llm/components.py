"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.session import materialize


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones) are linked to its smallest neighbour."""
    both = links.union(links.select("b", "a")) if larger else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if larger:
        stars = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        stars = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return stars.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (columns a and b) lead to, for every node of a link.

    A step writes its links to the shared folder. The steps end when every node is
    linked to its smallest one and nothing changes, after about log(nodes) steps.
    """
    links = materialize(links.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    state = None
    while True:
        links = materialize(_stars(_stars(links, True), False), "stars")
        row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (new := tuple(row)) == state:
            break
        state = new
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())
