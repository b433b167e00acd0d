"""Connected components of links by alternating large and small stars, for links of any size.

In a large star every node sends its larger neighbours to its least one, in a small star its
smaller ones; both keep what is connected and lower the ids, until only stars are left. Least
neighbours are minima that combine on the map side, and the links of a hot node meet its minimum in a
join that adaptive execution can split. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import cut


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _large_star(links: DataFrame) -> DataFrame:
    around = _both(links)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def _is_forest(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller node or is the end of links, never both."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("up")), F.struct(F.col("b").alias("id"), F.lit(0).alias("up")))).alias("e"))
    node = ends.groupBy("e.id").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("least"))
    return node.filter("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def stars(links: DataFrame) -> DataFrame:
    """``id`` and ``root`` (smallest id it is connected with) of every node that is not its own root.

    ``links`` has columns ``a`` and ``b`` of one orderable type. Loops and nulls are ignored.
    """
    links = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_forest(links):
        links = cut(_small_star(_large_star(links)))
    return links.select(F.col("a").alias("id"), F.col("b").alias("root"))
