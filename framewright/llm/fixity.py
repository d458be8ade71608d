"""Merkle fixity audit of WARC replicas.

Each file's records, in their order, are cut into ranges. A range begins at a record whose key's hash is divisible by ``FAN``, so both replicas
cut at the same records, and a record that is lost or added changes no range but its own. Ranges of over ``SPAN`` records are cut again.
A range's digest is of its records in order, each with its offset in the range, length and SHA-256, and of the range before it; so
order counts, within ranges and among them. Ranges are the leaves of a tree, up to one root a file: the parent of ``FAN`` places of a level has the digest
of its children. The audit compares the roots of two replicas and goes down only into nodes that differ, so sound files cost one row
each. Both replicas share one table with a ``side``.

Only the records of ranges that differ are aligned, by key and digest: a key with another digest is ``corrupt``, a record that only one
replica has ``missing`` or ``extra``, wherever it is in the file. A record that both have is ``moved`` if neither neighbour is the one
that it has in the primary, or if it follows another record than there and comes after one that should follow it; neighbours are those among the aligned
records. So a file in reverse is all moved, and of a run that goes to another place the first record is.

Null bodies count as empty. Repeated rows are records of their own, in the order of offset, then digest; of equal copies the last are missing or extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import staged

FAN = 16
#: Records of a range at most; and of a run of a file that is one task's.
SPAN, RUN = 64, 65_536


def warc_record(url: Column, body: Column) -> Column:
    """A WARC 1.0 response record as text."""
    body = F.coalesce(body, F.lit(""))
    head = (F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"))
    return F.concat(*head, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``seq`` and ``offset``: the records, and their bytes, that come before in the file; ``leaf``, which names the record's range, ``within``, its
    offset there, and for the first of a range ``before``, which names the range before.

    Ranges of the whole order are dealt to tasks, so a file of any size is numbered by many; what earlier ranges hold of a file
    is added from a small table.
    """
    ranges = staged(rows.repartitionByRange("file", *order).withColumn("_range", F.spark_partition_id()), "fixity-order")
    own = Window.partitionBy("file", "_range").orderBy(*order)
    earlier = Window.partitionBy("file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("file", "_range").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("s"))
    before = sums.select(F.col("file").alias("_of"), F.col("_range").alias("_at"), *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in ("n", "s")))
    ranked = ranges.withColumn("_k", F.row_number().over(own) - 1).withColumn("_b", F.coalesce(F.sum("length").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = ranked.join(before, F.col("file").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at")))
    out = out.withColumn("seq", (F.col("_n") + F.col("_k")).cast("long")).withColumn("offset", (F.col("_s") + F.col("_b")).cast("long")).drop("_k", "_b", "_of", "_at", "_n", "_s")
    # the first of records with one key may begin a range; what begins before a task's rows comes from the tasks before
    key = F.xxhash64("key")
    first = F.coalesce(F.lag(key).over(own) != key, F.lit(True)) & (F.pmod(key, F.lit(FAN)) == 0)
    mark = F.when(first, F.struct(F.col("seq"), F.col("offset"), key.alias("id")))
    marked = staged(out.withColumn("_mark", mark), "fixity-marks")
    last = marked.groupBy("file", "_range").agg(F.max("_mark").alias("m")).select(F.col("file").alias("_of"), F.col("_range").alias("_at"), F.last("m", ignorenulls=True).over(earlier).alias("_m"))
    rows = marked.join(last, F.col("file").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at")))
    none = F.struct(F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("id"))
    until, past = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)
    here, ahead = (F.coalesce(F.last("_mark", ignorenulls=True).over(w), F.col("_m"), none) for w in (until, past))
    rows = rows.withColumn("_here", here).withColumn("_ahead", ahead).withColumn("_span", F.floor((F.col("seq") - F.col("_here.seq")) / SPAN))
    # a name that comes again and again in a file is told apart by runs of the file
    leaf = F.xxhash64("_here.id", "_span", F.floor(F.col("_here.seq") / RUN))
    return rows.withColumns({"leaf": leaf, "before": F.when(F.col("_mark").isNotNull(), F.col("_ahead.id")), "within": F.col("offset") - F.col("_here.offset")}).drop("_range", "_mark", "_of", "_at", "_m", "_here", "_ahead", "_span")


def manifest(df: DataFrame, file: Column, order: list[Column], record: Column, keep: list[str] = (), key: list[Column] | None = None) -> DataFrame:
    """``file, key, seq, offset, length, digest, leaf, within, before`` of each record, laid out in each file by ``order``; also the columns ``keep``.

    ``key`` has the values of ``key``, or else of ``order``, as JSON. Where a replica has its records in another order than their keys', ``order`` is that order and ``key`` names the records.
    """
    rows = df.select(file.alias("file"), *keep, *(c.alias(f"_{i}") for i, c in enumerate(order)), *(c.alias(f"_key{i}") for i, c in enumerate(key or order)), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))
    names = [f"_key{i}" for i in range(len(key or order))]
    rows = rows.withColumn("key", F.to_json(F.array(*(F.col(c).cast("string") for c in names)))).drop(*names)
    return _in_order(rows, *(f"_{i}" for i in range(len(order))), "digest").select("file", "key", "seq", "offset", "length", "digest", "leaf", "within", "before", *keep)


def _running(rows: DataFrame, at: str, value: Column, how, name: str) -> DataFrame:
    """Adds ``name``: ``how`` (a sum or maximum) of ``value`` over the file's rows before, in the order of ``at``; by runs, so that a file is many tasks."""
    own = rows.withColumn("_run", F.floor(F.col(at) / RUN)).withColumn("_v", value)
    before = Window.partitionBy("file").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy("file", "_run").agg(how("_v").alias("_s")).select(F.col("file").alias("_of"), F.col("_run").alias("_at"), how("_s").over(before).alias("_s"))
    until = Window.partitionBy("file", "_run").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    out = own.withColumn("_v", how("_v").over(until)).join(sums, F.col("file").eqNullSafe(F.col("_of")) & (F.col("_run") == F.col("_at")))
    both = F.greatest("_v", "_s") if how is F.max else F.coalesce("_v", F.lit(0)) + F.coalesce("_s", F.lit(0))
    return out.withColumn(name, both).drop("_run", "_v", "_s", "_of", "_at")


def _moved(pairs: DataFrame) -> DataFrame:
    """Of records that both replicas have (``file, seq, other``, places in the primary and the replica), those that moved."""
    ranked = _running(_running(pairs, "seq", F.lit(1), F.sum, "p"), "other", F.lit(1), F.sum, "r")
    ranked = staged(_running(ranked, "other", F.col("seq"), F.max, "most"), "fixity-order")
    near = [ranked.select(F.col("file").alias("_of"), (F.col("r") + k).alias("_r"), F.col("p").alias(name)) for k, name in ((1, "_last_p"), (-1, "_next_p"))]
    rows = ranked
    for x in near:
        rows = rows.join(x, F.col("file").eqNullSafe(F.col("_of")) & (F.col("r") == F.col("_r")), "left").drop("_of", "_r")
    ends = ranked.groupBy(F.col("file").alias("_of")).agg(F.max("p").alias("_last"))
    rows = rows.join(ends, F.col("file").eqNullSafe(F.col("_of"))).drop("_of")
    after = ~F.coalesce(F.col("_last_p") == F.col("p") - 1, F.col("p") == 0)
    follows = ~F.coalesce(F.col("_next_p") == F.col("p") + 1, F.col("p") == F.col("_last"))
    return rows.filter((after & follows) | (after & F.coalesce(F.col("seq") < F.col("most"), F.lit(False))))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Returns ``file, seq, kind, offset, length, expected, actual`` for each record that differs.

    Both inputs are manifests; ``seq`` counts a file's records from 0, in the replica for an ``extra`` one.
    ``kind`` is ``corrupt``, ``missing``, ``extra`` or ``moved``.
    """
    columns = ["file", "key", "seq", "offset", "length", "digest", "leaf", "within", "before"]
    both = primary.select(F.lit("primary").alias("side"), *columns).unionByName(replica.select(F.lit("replica").alias("side"), *columns))
    leaves = staged(both, "fixity-leaves")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", "within", "length", "digest", "before"))), lambda x: F.concat_ws(" ", x.within, x.length, x.digest, x.before))
    ranges = staged(leaves.groupBy("side", "file", "leaf").agg(F.sha2(F.array_join(listed, "\n"), 256).alias("digest")), "fixity-ranges")
    most, depth = (leaves.agg(F.max("seq")).first()[0] or 0) // FAN + 1, 0
    while FAN**depth < most:
        depth += 1
    node = F.pmod("leaf", F.lit(FAN**depth)).alias("node")
    own = F.transform(F.array_sort(F.collect_list(F.struct("leaf", "digest"))), lambda c: F.concat(c.leaf.cast("string"), F.lit(" "), c.digest))
    levels = [staged(ranges.groupBy("side", "file", node).agg(F.sha2(F.array_join(own, "\n"), 256).alias("digest")), "fixity-level")]
    for _ in range(depth):
        children = F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: F.concat(c.node.cast("string"), F.lit(" "), c.digest))
        parent = F.sha2(F.array_join(children, "\n"), 256).alias("digest")
        up = levels[-1].groupBy("side", "file", F.floor(F.col("node") / FAN).alias("up")).agg(parent)
        levels.append(staged(up.withColumnRenamed("up", "node"), "fixity-level"))

    def joined(rows: DataFrame, on: list[str]) -> DataFrame:
        one, two = (rows.filter(F.col("side") == s).drop("side").alias(s[0]) for s in ("primary", "replica"))
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on]
        return one.join(two, same, "full_outer")

    def differing(level: DataFrame) -> DataFrame:
        bad = joined(level, ["file", "node"]).filter(~F.col("p.digest").eqNullSafe(F.col("r.digest")))
        return bad.select(F.coalesce("p.file", "r.file").alias("of"), F.coalesce("p.node", "r.node").alias("at"))

    within = lambda place: F.col("file").eqNullSafe(F.col("of")) & (place == F.col("at"))
    bad = differing(levels[-1])
    for level in levels[-2::-1]:
        bad = differing(level.join(bad, within(F.floor(F.col("node") / FAN)), "left_semi"))
    open_ = ranges.withColumn("node", node).join(bad, within(F.col("node")), "left_semi").select("side", "file", F.col("leaf").alias("node"), "digest")
    found = staged(leaves.join(differing(open_), within(F.col("leaf")), "left_semi").select("side", *columns[:6]), "fixity-found")
    # records that both have go away, copy by copy; what is left of a key is paired in its order
    left, right = (F.count(F.when(F.col("side") == s, 1)).over(Window.partitionBy("file", "key", "digest")) for s in ("primary", "replica"))
    copy = F.row_number().over(Window.partitionBy("side", "file", "key", "digest").orderBy("seq"))
    copies = staged(found.withColumn("shared", F.least(left, right)).withColumn("copy", copy), "fixity-copies")
    alone, both = copies.filter("copy > shared"), joined(copies.filter("copy <= shared"), ["file", "key", "digest", "copy"])
    moved = _moved(both.select("p.file", "p.key", "p.seq", F.col("r.seq").alias("other"), "p.offset", "p.length", "p.digest"))
    moved = moved.select("file", "seq", F.lit("moved").alias("kind"), "offset", "length", F.col("digest").alias("expected"), F.col("digest").alias("actual"))
    place = F.row_number().over(Window.partitionBy("side", "file", "key").orderBy("seq"))
    pairs = joined(alone.withColumn("place", place), ["file", "key", "place"])
    kind = F.when(F.col("r.digest").isNull(), "missing").when(F.col("p.digest").isNull(), "extra").otherwise("corrupt")
    changed = pairs.select(
        F.coalesce("p.file", "r.file").alias("file"),
        F.coalesce("p.seq", "r.seq").alias("seq"),
        kind.alias("kind"),
        F.coalesce("p.offset", "r.offset").alias("offset"),
        F.coalesce("p.length", "r.length").alias("length"),
        F.col("p.digest").alias("expected"),
        F.col("r.digest").alias("actual"),
    )
    return changed.unionByName(moved)
