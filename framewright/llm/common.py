"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white spaces.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A to Z in lower case; every other character stays."""
    return F.translate(c, _UPPER, _LOWER)


def lower_ascii(text: str) -> str:
    """As ``ascii_lower``, for a Python string. The length in code points stays."""
    return text.encode("utf-8").lower().decode("utf-8")


def word_count(c: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD_SQL)), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where it is unset and all runs on one machine, as in local tests, a temporary folder is set once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    That cuts the lineage: a lost executor costs a new read, not a new computation. The files stay
    until ``drop_staged``, as a result may be read again at any time.
    """
    spark = df.sparkSession
    path = f"{_staging(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _staging(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Removes all that this application has staged; for the end of a job, when its results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def chunks(sizes: list[int], limit: int):
    """Ranges of neighbours whose sizes sum to ``limit`` or less (or that have one member)."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)
