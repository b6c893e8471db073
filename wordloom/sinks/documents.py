"""Documents as text files, one each.

Spark's text writer opens, renames and commits each file by itself, the last of these on the driver. Here a task
writes its files into a hidden folder of its own and moves that into place at its end, so that a file costs
its bytes and a folder one rename.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What runs inside tasks travels with its job, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _write_files(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """One row with the number of files written. A task that runs twice leaves the files of one run."""
    files, root = fs.FileSystem.from_uri(path)
    task = TaskContext.get()
    own = f"{root}/_attempt-{task.partitionId()}-{task.taskAttemptId()}"
    files.create_dir(own, recursive=True)
    n = 0
    for batch in batches:
        for text in batch.column(0):
            with files.open_output_stream(f"{own}/part-{task.partitionId():05d}-{n:07d}.txt", buffer_size=0) as out:
                out.write(text.as_buffer())
                out.write(b"\n")
            n += 1
    place = f"{root}/folder={task.partitionId()}"
    if files.get_file_info(place).type == fs.FileType.NotFound:
        files.move(own, place)
    else:
        files.delete_dir(own)
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme; Spark takes one without for a path of the default file system."""
    if ":" in path.split("/", 1)[0]:
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return f"file://{path}" if default.startswith("file:") else default.rstrip("/") + path


def write_documents(docs: DataFrame, path: str, text: str = "text") -> None:
    """A file ``path/folder=<i>/<name>.txt`` for each row, with the row's text and a line break; NULL is no text.

    No two files have one name. Paths that Arrow cannot open go through Spark's text writer, without folders.
    """
    values = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("value"))
    place = _qualified(docs.sparkSession, path)
    try:
        files, root = fs.FileSystem.from_uri(place)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError):
        values.write.option("maxRecordsPerFile", 1).text(path)
        return
    files.create_dir(root, recursive=True)
    values.mapInArrow(partial(_write_files, path=place), "files long").agg(F.sum("files")).collect()
