"""Cutting lineage with tables that outlive any single executor.

Iterative operators write each round to the shared folder that the cluster names
in ``spark.checkpoint.dir`` and read it back.  A parquet table is preferred over
``DataFrame.checkpoint``: it is columnar, so later reads prune columns, and it
carries real sizes, so the planner picks join strategies from facts.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get(_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {_KEY} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to, grouped by application for later clean-up."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/textloom/{app}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads it back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove tables that ``durable`` wrote and nothing will read again."""
    for df in stored:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
