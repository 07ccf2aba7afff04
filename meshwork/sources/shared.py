"""Intermediate results in the folder that the whole cluster shares."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where none is set and all
    runs in one process. On a cluster a missing setting is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="meshwork-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where it lies; on a
    cluster it is installed or shipped."""
    own, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [x for x in own.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        own["PYTHONPATH"] = os.pathsep.join([*paths, root])


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once into a reliable checkpoint, for results that several later
    steps read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
