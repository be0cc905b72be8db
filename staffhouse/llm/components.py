"""Connected components of a link table by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffhouse.llm.common import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(least, "a").filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Links here point from the larger to the smaller id."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): the smallest node reachable, for every node with a link.

    Each round turns paths into stars and is written to the shared folder; the number of rounds
    grows with the logarithm of the longest path. Null ends are dropped, loops ignored."""
    links = (links.select("a", "b").dropna().filter("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state, seen = stage(links, "links"), None
    while True:
        total = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if total == seen or not total[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = total
        state = stage(_small_star(_large_star(state)), "stars")
