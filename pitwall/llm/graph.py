"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, component): the smallest node reachable, for every node that has a link to another.

    Large and small star steps (each node's larger, then smaller neighbours move to the smallest one) until the links
    no longer change; the number of rounds grows with the logarithm of the longest chain. Every step is a partial
    aggregate and a join on the node, which AQE splits for a node with very many links. Null ends are no links.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links, mark = checkpointed(links), None
    rows = links.count()  # steps move links and make no more of them
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        links = checkpointed(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct(), rows)
        new = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = new
