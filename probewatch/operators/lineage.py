"""Reliable checkpoints for results that several later plans read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; below the warehouse only where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints").rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    The folder is the session's ``spark.checkpoint.dir``.  Only where none is named, it lies
    below the warehouse, which executors share as well.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
