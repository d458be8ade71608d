"""A trie of conversation prefixes: a z-fast trie whose nodes Spark finds by joins.

A conversation is a sequence of turns. Each of its prefixes has a signature of 128 bits: the exclusive or of hashes of (place, role, text), so
a prefix without its last turn has the signature less that turn's. Two prefixes are one trie node if they have the same depth and signature.

The trie is kept compacted, a table with a row a node: where conversations part or end, the node's depth and signature, its edge
(parent's depth, depth] and the conversation that spells it. A node's handle is its prefix at the two-fattest depth of its edge, the
number in that range with the most factors of two. Conversations are inserted in batches of growing size. For each distinct one

1. fat binary search finds where it leaves the trie: the two-fattest depth of the open range is looked up among the handles,
   by a join; a hit moves the lower end to that node's depth, a miss the upper end below the handle. So it takes a number of joins that is the logarithm of
   the longest conversation, each with one row a conversation. The last hit is the exit node, or the exit node's parent.
2. Turns below the exit node's parent, and those of the edges that a batch leaves through, are grouped by signature. Groups where several turns
   follow, or a conversation ends, are the nodes that replace those edges. Turns above are not looked at again.

At last each conversation is joined to its nodes, which gives counts, and every edge is expanded to its turns.

A conversation of any length is split: turns are numbered by ranges of the order, signatures are summed in runs of ``RUN`` turns.
Only the search for conversations of up to ``RUN`` turns carries their signatures along; longer ones join theirs. The ids that end at a node are joined
in ranges, and the ranges hashed one after the other as a stream, so no task holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import staged
from framewright.operators.grouping import numbered

#: Turns of a run whose signatures one task adds up.
RUN = 512
#: Shares of the distinct conversations, in 64ths, by which batches end; each is about four times what came before.
BATCHES = (4, 16, 64)
#: Ids that are joined to one text.
IDS = 4096
NODE = ("e", "s1", "s2")


def turns_of(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``c, d, role, text``: the turns of each conversation, numbered from 1 by turn (null first), role and text; null role and text are empty.

    Rows with a null conversation are left out.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = df.select(F.col(conv).cast("long").alias("c"), F.col(turn).alias("k"), blank(role).alias("role"), blank(text).alias("text")).filter("c is not null")
    rows = numbered(rows, "c", "k", "role", "text")
    first = rows.groupBy("c").agg(F.min("rn").alias("first"))
    return rows.join(first, "c").select("c", (F.col("rn") - F.col("first") + 1).alias("d"), "role", "text")


def share_openings(turns: DataFrame, step: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations, and ``c, n``, all of them with their lengths.

    Conversation c gets the first h turns of c - c % ``step`` (h = CRC-32 of c, modulo ``most``), then its own after its first h.
    """
    sizes = turns.groupBy("c").agg(F.max("d").alias("own"))
    heads = F.pmod(F.crc32(F.col("c").cast("string")), F.lit(most))
    sizes = sizes.withColumn("h", heads).withColumn("base", F.col("c") - F.col("c") % step)
    base = sizes.select(F.col("c").alias("base"), F.col("own").alias("of_base"))
    sizes = staged(sizes.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("of_base", F.lit(0)))), "conversation-sizes")
    opening = turns.filter(F.col("d") < most).withColumnRenamed("c", "base").join(sizes.select("base", "c", "h"), "base").filter("d <= h")
    rest = turns.join(sizes.select("c", "h", "taken"), "c").filter("d > h").withColumn("d", F.col("taken") + F.col("d") - F.col("h"))
    lengths = sizes.select("c", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return opening.select("c", "d", "role", "text").unionByName(rest.select("c", "d", "role", "text")), lengths


def prefixes(turns: DataFrame) -> DataFrame:
    """``c, d, s1, s2, t1, t2, size, upto``: each prefix's signature and that without its last turn, the last text's UTF-8 bytes, and all texts' up to it."""
    own = [F.xxhash64(F.lit(seed), "d", "role", "text").alias(f"h{k}") for k, seed in ((1, "one"), (2, "another seed"))]
    rows = turns.select("c", "d", *own, F.octet_length("text").cast("long").alias("size")).withColumn("run", F.floor((F.col("d") - 1) / RUN))
    before = Window.partitionBy("c").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("c", "run").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"), F.sum("size").alias("b"))
    runs = runs.select("c", "run", *(F.coalesce(f(x).over(before), F.lit(0)).alias(x) for f, x in ((F.bit_xor, "b1"), (F.bit_xor, "b2"), (F.sum, "b"))))
    until = Window.partitionBy("c", "run").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    upto = rows.join(runs, ["c", "run"]).select(
        "c", "d", "h1", "h2", "size", *(F.bit_xor(f"h{k}").over(until).bitwiseXOR(F.col(f"b{k}")).alias(f"s{k}") for k in (1, 2)), (F.sum("size").over(until) + F.col("b")).alias("upto")
    )
    return upto.select("c", "d", "s1", "s2", *(F.col(f"s{k}").bitwiseXOR(F.col(f"h{k}")).alias(f"t{k}") for k in (1, 2)), "size", "upto")


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with the most factors of two."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits).cast("long")


def _search(paths: DataFrame, turns: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """``c, at``: for each of ``paths`` (``c, n, sigs``) the depth of the deepest node of the trie that it passes.

    ``sigs`` has the signatures of paths of up to ``RUN`` turns; those of longer ones are joined from ``turns``.
    """
    handles = nodes.select(F.col("f").alias("at"), F.col("f1").alias("x1"), F.col("f2").alias("x2"), F.col("e").alias("hit"), "p", F.col("s1").alias("e1"), F.col("s2").alias("e2"))
    far = turns.select("c", F.col("d").alias("at"), F.col("s1").alias("y1"), F.col("s2").alias("y2"))
    sig = lambda k: F.coalesce(F.col(f"y{k}"), F.get(F.col("sigs"), (F.col("at") - 1).cast("int"))[f"s{k}"]).alias(f"x{k}")
    # last: the deepest node whose handle matched, with its parent's depth
    state = paths.select("c", "n", "sigs", F.lit(0).cast("long").alias("low"), F.col("n").alias("high"), *(F.lit(0).cast("long").alias(x) for x in ("e", "p", "e1", "e2")))
    for step in range(longest.bit_length() + 1):
        open_ = F.col("low") < F.col("high")
        asked = state.withColumn("at", F.when(open_, two_fattest(F.col("low"), F.col("high"))))
        asked = asked.join(far, ["c", "at"], "left").select(*state.columns, "at", sig(1), sig(2))
        found = asked.join(handles.toDF("at", "x1", "x2", "hit", "hp", "h1", "h2"), ["at", "x1", "x2"], "left")
        hit = F.col("hit").isNotNull()
        state = found.select(
            "c",
            "n",
            "sigs",
            F.when(hit, F.col("hit")).otherwise(F.col("low")).alias("low"),
            F.when(open_ & ~hit, F.col("at") - 1).otherwise(F.col("high")).alias("high"),
            *(F.when(hit, F.col(new)).otherwise(F.col(old)).alias(old) for old, new in (("e", "hit"), ("p", "hp"), ("e1", "h1"), ("e2", "h2"))),
        )
        if step % 3 == 2:
            state = staged(state, "exits")
    at_end = state.withColumn("at", F.col("e")).join(far, ["c", "at"], "left").select("c", "n", "e", "p", "e1", "e2", sig(1), sig(2))
    passes = (F.col("e") == 0) | ((F.col("e") <= F.col("n")) & (F.col("x1") == F.col("e1")) & (F.col("x2") == F.col("e2")))
    return staged(at_end.select("c", F.when(passes, F.col("e")).otherwise(F.col("p")).alias("low")), "exits")


def _insert(nodes: DataFrame | None, paths: DataFrame, turns: DataFrame, longest: int) -> DataFrame:
    """The trie with ``paths`` in it. ``turns`` are the prefixes of all distinct conversations."""
    stop = F.col("d") == F.col("n")
    if nodes is None:
        fresh = turns.join(paths.select("c", "n", F.lit(0).cast("long").alias("low")), "c").select(*turns.columns, "low", stop.alias("stop"))
        kept = None
    else:
        brief = turns.join(paths.filter(F.col("n") <= RUN).select("c"), "c", "left_semi").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("d", "s1", "s2"))).alias("sigs"))
        far = turns.join(paths.filter(F.col("n") > RUN).select("c"), "c", "left_semi")
        exits = _search(paths.join(brief, "c", "left"), far, nodes, longest)
        fresh = turns.join(paths.select("c", "n").join(exits, "c"), "c").filter("d > low").select(*turns.columns, "low", stop.alias("stop"))
        fresh = staged(fresh, "fresh-turns")
        # the edges through which the batch leaves the trie, by their first turns
        left = fresh.filter("d = low + 1").select((F.col("d") - 1).alias("p"), F.col("s1").alias("c1"), F.col("s2").alias("c2")).distinct()
        marked = staged(nodes.join(left.withColumn("left", F.lit(True)), ["p", "c1", "c2"], "left"), "edges")
        kept = marked.filter("left is null").drop("left")
        edges = marked.filter("left").select(F.col("r").alias("c"), F.col("p").alias("low"), "e")
        fresh = fresh.unionByName(_spelled(edges, turns).select(*turns.columns, "low", (F.col("d") == F.col("e")).alias("stop")))
    groups = fresh.groupBy("d", "s1", "s2", "t1", "t2").agg(F.bool_or("stop").alias("stop"), F.min("c").alias("r"))
    groups = staged(groups, "prefix-groups")
    several = groups.groupBy((F.col("d") - 1).alias("d"), F.col("t1").alias("s1"), F.col("t2").alias("s2")).agg(F.count(F.lit(1)).alias("follow")).filter("follow > 1")
    new = groups.join(several, ["d", "s1", "s2"], "left").filter("stop or follow > 1").select("d", "s1", "s2", "r")
    # a node's parent is the node before it on the way of the conversation that spells it; that may spell several edges, with others between, so none above its own edge
    way = fresh.select("c", "d", "s1", "s2", "low", "upto").join(new, ["d", "s1", "s2"])
    way = way.withColumn("p", F.greatest(F.lag("d").over(Window.partitionBy("c").orderBy("d")), F.col("low"))).filter("c = r")
    way = way.withColumn("f", two_fattest(F.col("p"), F.col("d")))
    first = turns.select(F.col("c").alias("r"), (F.col("d") - 1).alias("p"), F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("t1").alias("p1"), F.col("t2").alias("p2"), (F.col("upto") - F.col("size")).alias("above"))
    handle = turns.select(F.col("c").alias("r"), F.col("d").alias("f"), F.col("s1").alias("f1"), F.col("s2").alias("f2"))
    new = way.withColumnRenamed("d", "e").join(first, ["r", "p"]).join(handle, ["r", "f"])
    new = new.select(*NODE, "r", "p", "p1", "p2", "c1", "c2", "f", "f1", "f2", "upto", "above")
    return staged(new if kept is None else kept.select(*new.columns).unionByName(new), "trie")


def _spelled(edges: DataFrame, turns: DataFrame) -> DataFrame:
    """The turns of edges (``c, low, e`` and more): those of conversation c at depths over ``low`` and up to ``e``. Both are matched by runs."""
    runs = F.explode(F.sequence(F.floor(F.col("low") / RUN), F.floor((F.col("e") - 1) / RUN)))
    return turns.withColumn("run", F.floor((F.col("d") - 1) / RUN)).join(edges.withColumn("run", runs), ["c", "run"]).filter("d > low and d <= e").drop("run")


def _digests(ends: DataFrame) -> DataFrame:
    """``e, s1, s2, ends_sha256`` from ``e, s1, s2, c``: the hash of a node's ids, ascending and comma-joined."""
    names = [*NODE, "part", "seq", "ids"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, seq = None, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in now[:3]), pa.array([now[3]], pa.int32()), pa.array([seq], pa.int64()), pa.array([",".join(map(str, ids))])], names=names)

        for batch in batches:
            for *own, c in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4, 3)), strict=True):
                if own != now or len(ids) == IDS:
                    if ids:
                        yield row()
                    now, ids, seq = own, [], seq + 1
                ids.append(c)
        if ids:
            yield row()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in now), pa.array([digest.hexdigest()])], names=[*NODE, "ends_sha256"])

        for batch in batches:
            for *own, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 5)), strict=True):
                if own != now:
                    if digest:
                        yield row()
                    now, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if digest:
            yield row()

    order = [*NODE, "c"]
    ranged = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    parts = ranged.mapInArrow(joined, "e bigint, s1 bigint, s2 bigint, part int, seq bigint, ids string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "part", "seq").mapInArrow(hashed, "e bigint, s1 bigint, s2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, batches: tuple[int, ...] = BATCHES) -> DataFrame:
    """The nodes of the trie of conversations ``turns`` (``c, d, role, text``; d from 1 without gaps) and ``lengths`` (``c, n``; also those of no turns).

    Columns: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. The root has depth 0.
    No conversations give no rows.
    """
    spark = turns.sparkSession
    zero = F.lit(0).cast("long")
    every = staged(prefixes(turns), "prefixes")
    at_end = every.select("c", F.col("d").alias("n"), "s1", "s2")
    ends = lengths.join(at_end, ["c", "n"], "left").select("c", F.col("n").alias("e"), *(F.coalesce(x, zero).alias(x) for x in ("s1", "s2")))
    ends = staged(ends, "conversation-ends")
    # one of equal conversations is inserted
    paths = ends.groupBy(*NODE).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("m"))
    paths = staged(paths.withColumn("share", F.pmod(F.xxhash64(*NODE), F.lit(64))), "paths")
    inserted = paths.filter("e > 0")
    own = staged(every.join(inserted.select("c"), "c", "left_semi"), "path-prefixes")
    longest = inserted.agg(F.max("e")).first()[0] or 0
    nodes, low = None, 0
    for high in batches:
        batch = inserted.filter((F.col("share") >= low) & (F.col("share") < high)).select("c", F.col("e").alias("n"))
        nodes, low = _insert(nodes, batch, own, longest), high
    root = spark.range(1).select(*(zero.alias(x) for x in NODE))
    # each conversation's nodes, the root among them
    members = own.select("c", F.col("d").alias("e"), "s1", "s2", "size").join(nodes.select(*NODE), [*NODE]).unionByName(paths.select("c", *(zero.alias(x) for x in (*NODE, "size"))))
    members = staged(members.join(paths.select("c", "m", F.col("e").alias("n")), "c"), "members")
    children = nodes.groupBy(F.col("p").alias("e"), F.col("p1").alias("s1"), F.col("p2").alias("s2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = members.groupBy(*NODE).agg(F.sum("m").alias("n_convs"), F.min("c").alias("owner"), F.max("size").alias("size"))
    whole = nodes.unionByName(root.withColumns({x: zero for x in nodes.columns if x not in NODE}).withColumn("p", F.lit(-1).cast("long")))
    whole = whole.join(counted, [*NODE]).join(children, [*NODE], "left").withColumn("n_children", F.coalesce("n_children", zero))
    whole = staged(whole.withColumn("edge", (F.col("n_convs") - 1) * (F.col("upto") - F.col("above"))), "trie-nodes")
    # a node's edge counts with its owner, once, for all nodes above it
    given = whole.select(F.col("owner").alias("c"), "e", "edge", "n_children")
    below = Window.partitionBy("c").orderBy(F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    sums = members.join(given.select("c", "e", "edge"), ["c", "e"], "left").withColumn("below", F.coalesce(F.sum("edge").over(below), zero))
    leaf = whole.filter("n_children = 0").select(F.col("owner").alias("c"), F.lit(1).alias("leaf"))
    sums = sums.join(leaf, "c", "left").groupBy(*NODE).agg(F.sum("below").alias("below"), F.coalesce(F.sum("leaf"), zero).alias("n_leaves"))
    whole = staged(whole.join(sums, [*NODE]).join(_digests(ends), [*NODE], "left"), "trie-sums")
    above = whole.select(F.col("e").alias("p"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("owner").alias("parent"))
    edges = whole.filter("e > 0").join(above, ["p", "p1", "p2"])
    edges = edges.select(F.col("owner").alias("c"), F.col("p").alias("low"), "e", "parent", "n_convs", "n_children", "n_leaves", "below", F.col("upto").alias("until"), "ends_sha256")
    rows = _spelled(edges, own)
    top, empty = F.col("d") == F.col("e"), hashlib.sha256(b"").hexdigest()
    rest = F.col("below") + (F.col("n_convs") - 1) * (F.col("until") - F.col("upto") + F.col("size"))
    rows = rows.select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("low") + 1, F.col("parent")).otherwise(F.col("c")).alias("parent_conv_id"),
        "n_convs",
        F.when(top, F.col("n_children")).otherwise(1).alias("n_children"),
        "n_leaves",
        rest.alias("saved_tokens"),
        F.when(top, F.coalesce("ends_sha256", F.lit(empty))).otherwise(empty).alias("ends_sha256"),
    )
    textless = whole.filter("e = 0").select(
        F.col("owner").alias("conv_id"), F.col("e").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("below").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )
    return rows.unionByName(textless)


def shared_openings_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``prefix_trie`` of the conversations of ``df``, rebuilt by ``share_openings``."""
    turns = staged(turns_of(df, conv, turn, role, text), "turns")
    return prefix_trie(*share_openings(turns))
