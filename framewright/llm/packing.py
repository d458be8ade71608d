"""Packing into optimal length buckets.

Texts over ``max_length`` tokens are cut into sequences of that length, so lengths lie in
1 to ``max_length`` and the global histogram has at most that many rows. Dynamic programming
over it picks the ``n_buckets`` upper bounds that minimise the padding over all sequences.
Within a bucket, sequences fill batches of ``token_budget`` padded tokens.

Null and empty texts have one sequence of length 0, with null ``bucket``, ``bound`` and
``batch_id``: there is nothing to pack. Other columns are not returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import staged, word_count

#: Sequences of a bucket that are numbered together, about; bounds the work of a task.
RUN = 20_000


def best_bounds(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> tuple[list[int], int]:
    """Upper bounds of at most ``n_buckets`` buckets with the least padding, and that padding.

    ``lengths`` ascend. A bucket ends at a length that occurs; the last one at the largest.
    """
    d = len(lengths)
    if d == 0:
        return [], 0
    n = np.r_[0, np.cumsum(counts)].astype(np.int64)
    tokens = np.r_[0, np.cumsum(counts * lengths)].astype(np.int64)
    best = lengths * n[1:] - tokens[1:]  # lengths 0 to j in one bucket
    back = []
    for _ in range(min(n_buckets, d) - 1):
        new, cut = best.copy(), np.full(d, -1)
        for j in range(1, d):
            # the last bucket holds lengths i + 1 to j
            cost = best[:j] + lengths[j] * (n[j + 1] - n[1 : j + 1]) - (tokens[j + 1] - tokens[1 : j + 1])
            i = int(np.argmin(cost))
            if cost[i] < new[j]:
                new[j], cut[j] = cost[i], i
        back.append(cut)
        best = new
    bounds, j = [int(lengths[-1])], d - 1
    for cut in reversed(back):
        if cut[j] >= 0:
            j = int(cut[j])
            bounds.append(int(lengths[j]))
    return bounds[::-1], int(best[-1])


def pack_buckets(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    n_buckets: int = 8,
    max_length: int = 2048,
    token_budget: int = 16384,
) -> DataFrame:
    """Returns ``id_col, piece, start, length, bucket, bound, padding, batch_id, place``: a row a sequence.

    Tokens are words. ``start`` is the sequence's first token; ``place`` its place in the batch,
    which holds ``token_budget // bound`` sequences. Only a bucket's last batch may have fewer.
    """
    if token_budget < max_length:
        raise ValueError("token_budget must be max_length or more")
    spark = df.sparkSession
    key = F.xxhash64(F.col(text), F.col(id_col))
    tokens = staged(df.select(F.col(id_col), word_count(F.col(text).cast("string")).alias("tokens"), key.alias("key")), "pack-tokens")
    last = F.greatest(F.ceil(F.col("tokens") / max_length) - 1, F.lit(0)).cast("long")
    pieces = tokens.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("start", F.col("piece") * max_length)
    pieces = pieces.withColumn("length", F.least(F.col("tokens") - F.col("start"), F.lit(max_length)).cast("long"))

    histogram = pieces.filter("length > 0").groupBy("length").count().toPandas().sort_values("length")
    counts = histogram["count"].to_numpy(dtype=np.int64)
    lengths = histogram["length"].to_numpy(dtype=np.int64)
    bounds, _ = best_bounds(lengths, counts, n_buckets)
    total = np.diff(np.r_[0, np.cumsum(counts)[np.searchsorted(lengths, bounds)]]) if bounds else []
    table = [(k, b, token_budget // b, max(1, int(n) // RUN)) for k, (b, n) in enumerate(zip(bounds, total, strict=True))]
    buckets = F.broadcast(spark.createDataFrame(table, "bucket int, bound long, room long, runs long"))
    in_bucket = F.array_position(F.transform(F.array(*map(F.lit, bounds)), lambda b: b >= F.col("length")), True) - 1 if bounds else F.lit(None)
    pieces = pieces.withColumn("bucket", F.when(F.col("length") > 0, in_bucket).cast("int")).join(buckets, "bucket", "left")
    empty, pieces = pieces.filter("length = 0"), pieces.filter("length > 0")
    pieces = pieces.withColumn("run", F.pmod(F.xxhash64("key", "piece"), F.col("runs")))

    # ranks over a bucket without sorting it in one task: rank in its run plus what runs before it hold
    before = Window.partitionBy("bucket").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = pieces.groupBy("bucket", "run").agg(F.count(F.lit(1)).alias("n"))
    runs = runs.select("bucket", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("bucket", "run").orderBy("key", id_col, "piece")
    ranked = pieces.withColumn("rank", F.row_number().over(order) - 1).join(runs, ["bucket", "run"], "left")
    rank = F.col("before") + F.col("rank")
    batch = F.concat_ws("-", "bucket", F.floor(rank / F.col("room")))
    packed = ranked.select(
        id_col,
        "piece",
        "start",
        "length",
        "bucket",
        "bound",
        (F.col("bound") - F.col("length")).alias("padding"),
        batch.alias("batch_id"),
        F.pmod(rank, F.col("room")).alias("place"),
    )
    # nothing to rank here, however many rows there are
    kinds = dict(packed.dtypes)
    nothing = (F.lit(None).cast(kinds[c]).alias(c) for c in ("bound", "padding", "batch_id", "place"))
    return packed.unionByName(empty.select(id_col, "piece", "start", "length", "bucket", *nothing))
