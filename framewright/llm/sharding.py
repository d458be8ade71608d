"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Rows with equal texts form a group and go to one shard. Only a group that alone exceeds a shard's capacity of bytes, tokens or
rows is split, in pieces by a hash of its rows. Groups are placed largest first, each in the shard where the dot product of its
vector with the residual capacity is highest.

The groups with at least one in ``LIMIT`` of all bytes, tokens or rows (so at most 3 * ``LIMIT``) and the pieces of split ones are placed
by the driver. All smaller groups are placed by tasks: they are dealt to cells of about ``CELL`` groups by their hash, and each cell places its
groups, by the same rule, in its part of the capacity that is left. So every group is placed by its own vector, whatever their number, and
what the driver holds is bounded. Tables of up to ``LIMIT`` rows are placed by the driver alone.

Null texts count as empty. Ties, repeated rows and null ids are placed like all others. Rows of a split group that are equal in
all columns stay in one piece. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import staged, word_count

#: Pieces of a group as large as a shard.
SHARE = 32
LIMIT = 20_000
#: Groups of a cell, about.
CELL = 20_000
#: Rows of a shard that get their slots in one task, about.
RUN = 1_000_000
SUMS = ("size", "tokens", "n")


def place(vectors: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """The shard of each unit. Columns of ``vectors`` are dimensions; ``residual`` has each shard's capacity left, and is lessened."""
    shard = np.zeros(len(vectors), dtype=np.int64)
    for i in np.argsort(-vectors.max(axis=1), kind="stable"):
        shard[i] = np.argmax(residual @ vectors[i])
        residual[shard[i]] -= vectors[i]
    return shard


def _described(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns of the plan: ``size, tokens, text_crc32``, the group and the row's hash."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    size = (F.octet_length(body) + 1).cast("long")
    others = [F.col(f"`{c}`").cast("string") for c in df.columns if c != text]
    added = {"_size": size, "_tokens": word_count(body), "_crc": F.crc32(body), "_grp": F.xxhash64(body), "_row": F.xxhash64(F.to_json(F.array(*others)) if others else F.lit(0), size)}
    return df.withColumns(added)


def _placed(rows: DataFrame, n_shards: int) -> DataFrame:
    """``rows`` with ``_shard``."""
    spark = rows.sparkSession
    sums = [F.sum("_size").alias("size"), F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")]
    total = rows.agg(*sums).first()
    whole = np.maximum(np.array([total[c] or 0 for c in SUMS], dtype=np.float64), 1)
    share = F.greatest(*(F.col(c) / F.lit(float(w)) for c, w in zip(SUMS, whole, strict=True)))
    groups = staged(rows.groupBy("_grp").agg(*sums).withColumn("share", share), "shard-groups")
    large = sorted(groups.filter(F.col("share") >= 1 / LIMIT).collect(), key=lambda r: r["_grp"])
    cut = [(r["_grp"], int(np.ceil(r["share"] * n_shards * SHARE)) if r["share"] * n_shards > 1 and r["n"] > 1 else 1) for r in large]
    split = F.broadcast(spark.createDataFrame(cut, "_grp long, _pieces int"))
    piece = F.when(F.col("_pieces") > 1, F.pmod("_row", F.col("_pieces").cast("long"))).otherwise(0).cast("int")
    own = rows.join(split, "_grp", "left").withColumn("_piece", piece)
    pieces = own.filter("_pieces > 1").groupBy("_grp", "_piece").agg(*sums).collect()
    units = [(r["_grp"], 0, *(r[c] for c in SUMS)) for r, (_, n) in zip(large, cut, strict=True) if n == 1]
    units = sorted(units + [(r["_grp"], r["_piece"], *(r[c] for c in SUMS)) for r in pieces])
    residual = np.full((n_shards, len(SUMS)), 1.0 / n_shards)
    shard = place(np.array([u[2:] for u in units], dtype=np.float64).reshape(-1, len(SUMS)) / whole, residual)
    table = [(g, k, int(x)) for (g, k, *_), x in zip(units, shard, strict=True)]
    placed = own.join(F.broadcast(spark.createDataFrame(table, "_grp long, _piece int, _shard int")), ["_grp", "_piece"], "left")
    small = groups.filter(F.col("share") < 1 / LIMIT)
    rest = small.agg(F.count(F.lit(1)).alias("groups"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS)).first()
    if not rest["groups"]:
        return placed
    left = np.maximum(np.array([rest[c] for c in SUMS], dtype=np.float64), 1)

    def placed_cell(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_grp", ignore_index=True)
        vectors = frame[list(SUMS)].to_numpy(dtype=np.float64)
        shard = place(vectors / whole, residual * vectors.sum(axis=0) / left)
        return pd.DataFrame({"_grp": frame["_grp"], "_own": shard.astype(np.int32)})

    cells = max(1, -(-rest["groups"] // CELL))
    by_cell = small.select("_grp", *SUMS, F.pmod("_grp", F.lit(cells)).alias("_cell")).groupBy("_cell").applyInPandas(placed_cell, "_grp long, _own int")
    # no group of these has over one in LIMIT of the rows
    others = placed.filter("_shard is null").drop("_shard").join(staged(by_cell, "shard-cells"), "_grp").withColumnRenamed("_own", "_shard")
    return placed.filter("_shard is not null").unionByName(others)


def _slotted(rows: DataFrame, n_shards: int) -> DataFrame:
    """Adds ``_shard`` and ``_slot``: a shard's rows are numbered in runs by a hash, so that it is several tasks."""
    n = rows.count()
    runs = max(1, -(-n // (n_shards * RUN)))
    placed = _placed(rows, n_shards).withColumn("_run", F.pmod(F.xxhash64("_row"), F.lit(runs)))
    before = Window.partitionBy("_shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_shard", "_run").agg(F.count(F.lit(1)).alias("_n"))
    # a row for each run
    counts = counts.select("_shard", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_shard", "_run").orderBy("_row", "_grp")) - 1
    return placed.withColumn("_rank", rank).join(F.broadcast(counts), ["_shard", "_run"]).withColumn("_slot", (F.col("_before") + F.col("_rank")).cast("long"))


def pack_shards(df: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns ``id_col, size, tokens, text_crc32, shard, slot`` for every row of ``df``.

    ``size`` is the UTF-8 length of the text plus 1. Slots count from 0 in each shard without gaps.
    """
    rows = _described(df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), "_text").drop("_text")
    rows = _slotted(staged(rows, "shard-rows"), n_shards)
    names = {"_id": id_col, "_size": "size", "_tokens": "tokens", "_crc": "text_crc32", "_shard": "shard", "_slot": "slot"}
    return rows.select(*(F.col(c).alias(name) for c, name in names.items()))


def write_shards(df: DataFrame, path: str, n_shards: int = 8, text: str = "text") -> None:
    """Writes all rows of ``df`` as Parquet, one folder ``shard=k`` a shard, each file in the order of ``slot``, which is added.

    Null and repeated ids, and rows equal in all columns, are written as often as they come.
    """
    if {"shard", "slot"} & {c.lower() for c in df.columns}:
        raise ValueError("columns named shard and slot are added, so rename those of the input")
    planned = _slotted(staged(_described(df, text), "shard-rows"), n_shards)
    out = planned.select(*(F.col(f"`{c}`") for c in df.columns), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
