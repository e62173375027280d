"""Connected components of a link table by alternating large-star and small-star steps, all in Spark."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import stored


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """One step. Every node's links are replaced by links of its neighbours to the smallest of them and itself.

    ``larger_only``: only larger neighbours are moved (large-star), else only smaller ones and the node (small-star).
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger_only:
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        down = both.where("b < a")
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", "low"))
    return moved.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that can be reached.

    The links shrink to stars in a number of rounds that grows with the logarithm of the longest chain; they end when a
    round changes nothing. Every round's links are a written table.
    """
    now = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    before = None
    while True:
        sums = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if sums["n"] == 0 or sums == before:
            break
        before = sums
        now = stored(_star(stored(_star(now, True), "links"), False), "links")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
