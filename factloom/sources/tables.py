"""Parquet tables of one data directory."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``data_dir``; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints that every executor can read.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset and the session runs in one
    process (tests) a temporary folder is made. On a cluster without it this raises RuntimeError, since a
    folder of one machine would be unreadable to the others. With ``spark.cleaner.referenceTracking.cleanCheckpoints``
    a checkpoint is removed when nothing refers to it any more.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not conf and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(conf or os.path.join(tempfile.gettempdir(), "factloom-checkpoints"))
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle parallelism."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
