"""Connected components of a graph of 64-bit nodes, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import staged


#: A node's neighbours are dealt to so many parts, so that one with very many is the work of several tasks.
PARTS = 64


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (``u, v``) with ``m``, the least ``v`` of each ``u``.

    The least of each part is found before the shuffle, and then that of up to ``PARTS`` rows a node.
    """
    parted = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    least = parted.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.min("m").over(Window.partitionBy("u")))
    return parted.join(least, ["u", "part"]).drop("part")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    # a node's least neighbour links to it; the others move to that one
    found = _with_least(down)
    return found.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``) that isn't its root.

    The root is the component's smallest node. Every round writes its edges to the shared
    folder; rounds grow with the logarithm of the component sizes. No edges give no rows.
    """
    now = staged(_small(edges), "edges")
    mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
    while mark[0]:
        new = staged(_small(_large(now)), "edges")
        new_mark = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if new_mark == mark:
            break
        now, mark = new, new_mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
