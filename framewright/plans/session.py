"""Settings that the jobs need of a session, and the files they leave in its shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def with_checkpoints(spark: SparkSession) -> None:
    """Sets a checkpoint folder only where the session names none and all runs on one machine, as in local tests."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))


def _scratches(spark: SparkSession) -> str:
    with_checkpoints(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{shared.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path among this application's in the session's shared folder; ``drop_scratch`` removes them all."""
    return f"{_scratches(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to a scratch path and reads it again, so that its lineage ends there and a lost executor costs a new read."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Removes what this application has written to scratch paths and its ``checkpoint()`` files; for the end of a job, when its results are written."""
    context = spark.sparkContext
    for folder in (_scratches(spark), context.getCheckpointDir()):
        if folder:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
