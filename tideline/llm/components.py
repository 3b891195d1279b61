"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import BROADCAST_ROWS, written


def _sent(least: DataFrame, links: int) -> DataFrame:
    """The least neighbours, a row per node; broadcast where the counted links bound them, so that no node with many
    links has them gathered in one task. Larger ones are joined, and adaptive execution splits such a node's rows."""
    return F.broadcast(least) if 2 * links <= BROADCAST_ROWS else least


def _large_star(links: DataFrame, count: int) -> DataFrame:
    """Each larger neighbour of a node is linked with the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(_sent(least, count), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, count: int) -> DataFrame:
    """Links point from the larger node `a`; its smaller neighbours and itself go to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(_sent(least, count), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link: the root is the smallest node that can be reached.

    Large-star and small-star steps until nothing changes; the work of a round is in proportion to the links and the
    rounds to the logarithm of the longest path. Each round is written to the shared folder. Nodes are compared by
    value; null ends and links of a node with itself are left out.
    """
    now = written(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct(), "links"
    )
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).alias("mark")
    before = now.agg(mark).first()["mark"]
    while before[0]:
        now = written(_small_star(_large_star(now, before[0]), before[0]), "links")
        after = now.agg(mark).first()["mark"]
        if after == before:
            break
        before = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
