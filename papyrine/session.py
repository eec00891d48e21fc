"""Tables, checkpoints and size-checked broadcasts shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; a private one only where none is named (tests, local runs)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="papyrine-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which survives lost executors."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting; beyond ``max_rows`` the planner keeps a shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows over all cores, where the files have fewer parts than the cluster has cores; otherwise as they lie.

    Only tables that are small for the cluster are shuffled. ``key`` should be nearly unique.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
