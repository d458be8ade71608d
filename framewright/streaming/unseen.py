"""Structured Streaming: emit each key once, process each new row once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framewright.functions.text import py_strip
from framewright.operators.grouping import top_k

#: Parts of a log, by hash of the key.
PARTS = 256


def stream_unseen(stream: DataFrame, key: str) -> DataFrame:
    """The first row of each key, ever; so the state holds every key. ``stream_unseen_logged`` keeps a log instead."""
    return stream.dropDuplicates([key])


def stream_pending(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new since the checkpoint to ``out`` and stops."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _path(spark: SparkSession, path: str):
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """``h, key, batch, part``: the keys that were emitted, with a 64-bit hash, the batch and the part of the log; none before the first batch."""
    schema = "h long, key string, batch long, part int"
    files, path = _path(spark, log)
    return spark.read.schema(schema).parquet(log) if files.exists(path) else spark.createDataFrame([], schema)


def take_unseen(batch: DataFrame, number: int, key: str, order: Sequence[str], log: str, out: str) -> None:
    """Writes the first row, in ``order``, of each key of the batch that the log doesn't have to ``out`` and its key to the log.

    Keys count without white space at their ends; rows with a null key are left out. Both writes are by batch number and replace what an earlier
    attempt of the same batch wrote, and the log's rows of that batch don't count, so a batch that is repeated after a failure gives
    the same rows again, once. The log is kept in parts by hash and read only in the parts that the batch has; hashes are compared first, then
    keys. As the log's rows are matched to the batch's keys and not the other way, it isn't shuffled while those are few enough to broadcast.
    """
    spark = batch.sparkSession
    own = batch.withColumn(key, py_strip(F.col(key).cast("string"))).filter(F.col(key).isNotNull()).withColumn("_h", F.xxhash64(key))
    first = top_k(own, ["_h", key], order, 1, "_k").drop("_k")
    keys = first.select(F.col("_h").alias("h"), F.col(key).alias("key"), F.pmod("_h", F.lit(PARTS)).cast("int").alias("part"))
    parts = [r["part"] for r in keys.select("part").distinct().collect()]
    past = read_log(spark, log).filter(F.col("part").isin(parts) & (F.col("batch") != number))
    logged = past.join(keys, ["part", "h", "key"], "left_semi").select(F.col("h").alias("_h"), F.col("key").alias(key)).distinct()
    first.join(logged, ["_h", key], "left_anti").write.mode("overwrite").parquet(f"{out}/batch={number}")
    new = spark.read.schema(first.schema).parquet(f"{out}/batch={number}")
    new.select(F.col("_h").alias("h"), F.col(key).alias("key"), F.pmod("_h", F.lit(PARTS)).cast("int").alias("part")).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{log}/batch={number}")


def stream_unseen_logged(stream: DataFrame, key: str, order: Sequence[str], log: str, out: str, checkpoint: str) -> StreamingQuery:
    """Each key once, ever, by a log of keys in place of state; takes what is there and stops. See ``take_unseen``."""
    writer = stream.writeStream.foreachBatch(lambda batch, number: take_unseen(batch, number, key, order, log, out))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def compact_log(spark: SparkSession, log: str, before: int) -> None:
    """Joins the log's batches under ``before``, which must be complete, into one, so that a part is few files.

    The joined batch stands beside the old ones before they go; a key that is in both is the same key.
    """
    old = read_log(spark, log).filter(F.col("batch") < before)
    numbers = [r["batch"] for r in old.select("batch").distinct().collect()]
    if len(numbers) > 1:
        joined = min([0, *numbers]) - 1
        old.groupBy("part", "h", "key").agg(F.count(F.lit(1)).alias("n")).drop("n").repartition("part").write.partitionBy("part").parquet(f"{log}/batch={joined}")
        for number in numbers:
            files, path = _path(spark, f"{log}/batch={number}")
            files.delete(path, True)
