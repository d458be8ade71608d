"""Models on batches of rows: set up once a worker, resumable."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators.grouping import score_batches

#: The model that this Python worker holds, by the token of its job.
_HELD: dict[str, Callable] = {}


def _held(token: str, setup: Callable[[], Callable]) -> Callable:
    if token not in _HELD:
        _HELD.clear()  # one model at a time
        _HELD[token] = setup()
    return _HELD[token]


def score_with(df: DataFrame, setup: Callable[[], Callable], schema: str, batch: int = 250, done: DataFrame | None = None, key: str = "id", report: bool = False) -> DataFrame:
    """``score_batches`` with the function that ``setup`` makes: a model is loaded where it runs, once for each Python worker, and is never shipped.

    A worker keeps it for all tasks that Spark gives it, until another model is asked for.
    """
    token = uuid.uuid4().hex
    return score_batches(df, lambda frame: _held(token, setup)(frame), schema, batch, done, key, report)


def score_resumable(df: DataFrame, setup: Callable[[], Callable], schema: str, out: str, batch: int = 250, key: str = "id", report: bool = False, chunks: int = 16) -> DataFrame:
    """Scores the rows of ``df`` whose keys ``out`` lacks, adds them there, and returns all of ``out``.

    Rows are dealt to ``chunks`` by a hash of the key, each a write of its own: after a failure the chunks that were written stay,
    and the next call scores only the rest. The same goes for rows that came later. Keys aren't null; of repeated keys every row is scored.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[key]
    token = uuid.uuid4().hex
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for chunk in range(chunks):
        own = df.filter(F.pmod(F.xxhash64(key), F.lit(chunks)) == chunk)
        folder = path(f"{out}/chunk={chunk}")
        if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            own = own.join(spark.read.schema(f"`{key}` {kind}").parquet(f"{out}/chunk={chunk}").distinct(), key, "left_anti")
        scored = score_batches(own, lambda frame: _held(token, setup)(frame), schema, batch, None, key, report)
        scored.write.mode("append").parquet(f"{out}/chunk={chunk}")
    schema = f"{schema}, error string" if report else schema
    return spark.read.schema(schema).parquet(out).select(*(x.split()[0] for x in schema.split(",")))
