"""Paths for tables that a plan writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses, in the folder of ``spark.checkpoint.dir``, which all executors share.

    A local master without that setting, as in tests, gets a temporary folder; a cluster without it is an error.
    The table stays there for the folder's owner to delete.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
