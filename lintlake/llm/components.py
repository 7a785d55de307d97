"""Connected components of a link table, by alternating large-star and small-star steps.

Links, labels and components stay distributed. Every step is a grouping with partial
aggregation and one join; its result is written to the shared folder, so lineage stays
short and a lost executor costs a re-read. What reaches the driver is one checksum row a
round, which tells when nothing moves any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import handed_over


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to its smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, are linked to the smallest of them."""
    down = links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").selectExpr("b AS a", "m AS b")
    return moved.unionByName(least.selectExpr("a", "m AS b")).where("a <> b").distinct()


def roots(links: DataFrame) -> DataFrame:
    """(a, b) links of long nodes → (node, root), one row per node that is not a root.

    `root` is the smallest node reachable. Links may be repeated, in either direction, and
    may lead from a node to itself.
    """
    now = handed_over(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        now = handed_over(_small_star(_large_star(now)), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            return now.selectExpr("a AS node", "b AS root")
        before = tuple(mark)
