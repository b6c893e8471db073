"""Folders that all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import pickle
import tempfile
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where the setting is absent and the master is local, as in tests, a temporary folder is made
    and set; on a cluster the absence is an error, since a machine's own folder is not shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, value) -> Broadcast:
    """``value`` for all executors, as bytes that bring its class along: they need no copy of this library."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast: Broadcast):
    """What ``shipped`` sent."""
    return pickle.loads(broadcast.value)
