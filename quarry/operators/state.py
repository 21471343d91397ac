"""Cutting lineage on storage that every executor shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where that is unset a local session, as in a test, takes a temporary folder; on a cluster that is an error, as
    executors could not read each other's files.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="quarry-"))
    return found or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
