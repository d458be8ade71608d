"""The order of pages that name only the page after them, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.plans.session import staged


def page_order(pages: DataFrame, url: str = "url", following: str = "next", starts: DataFrame | None = None) -> DataFrame:
    """``url, source, page_no, status`` for each distinct url of ``pages``, whose column ``following`` names the next page (null: none).

    Every page points to the page before it; in each round its pointer jumps to where that page's pointer goes, and the steps add
    up, so the number of rounds is the logarithm of the longest chain, and a round is one join of rows without their contents.

    ``source`` is the url that the chain starts with and ``page_no`` the number of pages before. ``status`` is ``ok`` or says why a page has
    no place in its source's order: ``broken`` (the chain doesn't begin at one of ``starts``, so pages before it are lost; without ``starts``
    any page that none names may begin one), ``merged`` (it or a page before it is named by several pages; the chain is counted from
    there) or ``cyclic`` (the way back never ends: no source, no number). Null urls have no order. Of pages with one url the least ``following`` counts.
    """
    links = pages.filter(F.col(url).isNotNull()).groupBy(F.col(url).alias("url")).agg(F.min(following).alias("next"))
    links = staged(links, "chain-links")
    before = links.filter("next is not null").groupBy(F.col("next").alias("url")).agg(F.min("url").alias("before"), F.count(F.lit(1)).alias("named"))
    first = links.select("url").join(before, "url", "left").withColumn("merged", F.coalesce(F.col("named") > 1, F.lit(False)))
    # a page that several name starts a chain of its own; so no page is pointed to twice
    at = F.when(~F.col("merged"), F.col("before"))
    now = staged(first.select("url", "merged", at.alias("to"), F.when(at.isNotNull(), 1).otherwise(0).cast("long").alias("steps"), F.when(at.isNull(), F.col("url")).alias("source")), "chain")
    open_ = now.filter("source is null").count()
    done = now.filter("source is not null")
    while open_:
        target = now.select(F.col("url").alias("to"), F.col("to").alias("then"), F.col("steps").alias("more"), F.col("source").alias("end"))
        moved = now.filter("source is null").join(target, "to")
        moved = moved.select("url", "merged", F.col("then").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), F.col("end").alias("source"))
        now = staged(moved.unionByName(done), "chain")
        done = now.filter("source is not null")
        left = now.filter("source is null").count()
        if left == open_:  # of a chain that ends, a round places one page at least
            break
        open_ = left
    heads = first.select(F.col("url").alias("source"), F.col("merged").alias("_merged"))
    if starts is not None:
        known = starts.select(F.col(starts.columns[0]).alias("source")).distinct().withColumn("_known", F.lit(True))
        heads = heads.join(known, "source", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    else:
        heads = heads.withColumn("_known", F.lit(True))
    placed = now.join(heads, "source", "left")
    status = F.when(F.col("source").isNull(), "cyclic").when(F.col("_merged"), "merged").when(F.col("_known"), "ok").otherwise("broken")
    return placed.select("url", "source", F.when(F.col("source").isNotNull(), F.col("steps")).alias("page_no"), status.alias("status"))


def placed(pages: DataFrame, order: DataFrame, number: Column) -> DataFrame:
    """``pages`` (``url`` and more) with ``source``, ``number`` or else the place in the chain as ``page_no``, and ``status``, which is ``ok`` where a number is given."""
    given = F.col("page_no").isNotNull()
    own = order.select("url", "source", F.col("page_no").alias("_place"), F.col("status").alias("_status"))
    rows = pages.withColumn("page_no", number).join(own, "url", "left")
    status = F.when(given, "ok").otherwise(F.coalesce("_status", F.lit("unnamed")))
    return rows.withColumn("status", status).withColumn("page_no", F.coalesce(F.col("page_no").cast("long"), F.when(status == "ok", F.col("_place")))).drop("_place", "_status")
