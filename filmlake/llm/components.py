"""Connected components of links between ids, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.steps import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node``, ``root``: for each linked id the smallest id it reaches.

    ``links`` has columns ``a`` and ``b``. In a round every node hands the
    smallest id near it to its larger neighbours, then every node does so for its
    smaller ones, until nothing changes; the number of rounds grows with the
    logarithm of the longest path. Minima are combined before they travel, and
    the joins may split a node of many links, so a large star is no hot spot.
    """
    now = scratch.keep(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct(),
        f"{name}_0",
    )
    step = 0
    while True:
        step += 1
        # large star: neighbours above a node move to the smallest of its neighbourhood
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = scratch.keep(
            both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m")),
            f"{name}_l{step}",
        )
        large = scratch.keep(
            both.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct(),
            f"{name}_g{step}",
        )
        # small star: neighbours below a node, and the node, move to the smallest of them
        low = scratch.keep(large.groupBy("v").agg(F.min("u").alias("m")), f"{name}_s{step}")
        moved = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u")
        following = scratch.keep(
            moved.union(low.select("v", F.col("m").alias("u"))).distinct(), f"{name}_{step}"
        )
        scratch.drop(f"{name}_l{step}", f"{name}_g{step}", f"{name}_s{step}", f"{name}_{step - 1}")
        now = following
        # done when every node has one link, to a node that has none of its own
        many = now.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
        middle = now.select("v").join(now.select(F.col("u").alias("v")), "v", "left_semi")
        if many.union(middle).isEmpty():
            return now.select(F.col("v").alias("node"), F.col("u").alias("root"))
