"""Connected components of a table of links, by rounds of joins.

Each round applies the large-star and small-star steps (Kiveris et al., 2014): every node's
neighbours are hung below the least of them. Rounds grow with the logarithm of a component's
width. A round is written to the shared folder, so a lost executor costs no earlier round, and
only two counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assayframe.session import settle

#: Far beyond what the logarithm of any table asks for; more rounds mean a fault.
MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    if large:
        ways = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("m"))
        hung = ways.join(least, ways["a"] == least["node"]).where("b > a")
        return hung.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
    joined = links.join(least, links["a"] == least["node"])
    hung = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): the least node that links reach.

    Links to itself and repeated links are allowed; nodes without any other link don't appear.
    Null nodes are dropped. An empty table gives an empty result.
    """
    now = settle(links.where("a != b").select(F.greatest("a", "b").alias("a"),
                                              F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    for _ in range(MAX_ROUNDS):
        n, low = now.agg(F.count("*"), F.sum(F.expr("xxhash64(a, b) % 1000003"))).first()
        if (n, low) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = (n, low)
        now = settle(_star(_star(now, True), False), name)
    raise RuntimeError("components did not settle")
