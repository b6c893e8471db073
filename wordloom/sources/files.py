"""Text files as documents: whole where they fit in a row, line by line where not.

Spark's readers hold an entry for each file in the driver, once for each reader, and put few small files in a task. Here
the driver learns of folders only: tasks list the files in them, and tasks read what is listed. Paths that Arrow
cannot open, compressed files and nested folders without names of partitions go through Spark's readers.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import clean_document_id, line_array
from wordloom.sources.lines import drop_long_lines, read_document_lines

# What runs inside tasks travels with its job, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files up to this size are read as one row; lines of larger ones are read in ranges of so many bytes.
WHOLE_BYTES = 32 << 20
#: Files and bytes of a task, and bytes and files of a batch of rows.
TASK_FILES, TASK_BYTES = 4_000, 64 << 20
BATCH_BYTES, BATCH_FILES = 4 << 20, 2_000
#: Bytes read at once beyond the end of a range, for its last line.
STEP_BYTES = 1 << 20
#: Endings of files that Spark's readers decompress.
PACKED = r"(?i)\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd|lzo|xz)$"
#: Paths above which a pattern's matches are left to Spark's readers.
MOST_ROOTS = 1_000

FOUND = "file string, name string, bytes long, folder boolean"


def _opened(base: str) -> fs.FileSystem:
    return fs.LocalFileSystem() if base == "file:///" else fs.FileSystem.from_uri(base)[0]


def _find(batches: Iterator[pa.RecordBatch], base: str) -> Iterator[pa.RecordBatch]:
    """What stands in each folder, but for what Spark's readers hide."""
    files = _opened(base)
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            found = files.get_file_info(fs.FileSelector(folder))
            for at in range(0, len(found), BATCH_FILES):
                rows = [
                    (x.path, x.base_name, x.size or 0, x.type == fs.FileType.Directory)
                    for x in found[at : at + BATCH_FILES]
                    if not (x.base_name.startswith("_") and "=" not in x.base_name)
                    and not x.base_name.startswith(".")
                    and not x.base_name.endswith("._COPYING_")
                ]
                columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
                types = (pa.string(), pa.string(), pa.int64(), pa.bool_())
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "name", "bytes", "folder"])


def _batches(rows: Iterator[tuple[str, bytes]], name: str) -> Iterator[pa.RecordBatch]:
    ids, texts, held = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary())], names=["doc_id", name])

    for doc_id, text in rows:
        if texts and held + len(text) > BATCH_BYTES:
            yield batch()
            ids, texts, held = [], [], 0
        ids.append(doc_id)
        texts.append(text)
        held += len(text) + 64
    yield batch()


def _read_whole(batches: Iterator[pa.RecordBatch], base: str) -> Iterator[pa.RecordBatch]:
    files = _opened(base)

    def rows() -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            for doc_id, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with files.open_input_file(file) as opened:
                    yield doc_id, opened.read()

    return _batches(rows(), "text")


def _range_lines(opened, first: int, last: int) -> list[bytes]:
    """The lines that begin in a range of a file; LF, CR and CRLF each end a line."""
    ends = re.compile(rb"\r\n|\n|\r")
    size = opened.size()
    low = max(first - 1, 0)
    opened.seek(low)
    data = bytearray(opened.read(last - low))

    def line_start(at: int, seen: int) -> int:
        """The first beginning of a line from ``at`` on, or the end of the file."""
        while True:
            for end in ends.finditer(data, seen):
                if end.group() == b"\r" and end.end() == len(data) and low + len(data) < size:
                    break  # a line feed may follow
                if low + end.end() >= at:
                    return low + end.end()
            if low + len(data) >= size:
                return size
            seen = max(len(data) - 1, 0)
            data.extend(opened.read(STEP_BYTES))

    start = 0 if first == 0 else line_start(first, 0)
    if start >= min(last, size):
        return []
    stop = line_start(last, max(last - low - 2, 0))
    text = bytes(data[start - low : stop - low])
    if start == 0:
        text = text.removeprefix(b"\xef\xbb\xbf")
    lines = ends.split(text)
    return lines[:-1] if not lines[-1] else lines


def _read_lines(batches: Iterator[pa.RecordBatch], base: str) -> Iterator[pa.RecordBatch]:
    files = _opened(base)

    def rows() -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            for doc_id, file, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_input_file(file) as opened:
                    for line in _range_lines(opened, first, last):
                        yield doc_id, line

    return _batches(rows(), "line")


@dataclass(frozen=True)
class _Listed:
    """Files as ``(file, name, bytes)``, listed by tasks; ``tasks`` to read them, and Arrow's file system."""

    files: DataFrame
    tasks: int
    base: str


def _roots(spark: SparkSession, path) -> tuple[str, list[str]] | None:
    """Arrow's file system and the folders that a path, a pattern or a list of them names."""
    found, bases = [], set()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for one in [path] if isinstance(path, str) else path:
        place = spark._jvm.org.apache.hadoop.fs.Path(one)
        store = place.getFileSystem(conf)
        for status in store.globStatus(store.makeQualified(place)) or []:
            uri = status.getPath().toUri()
            if not status.isDirectory() or len(found) == MOST_ROOTS:
                return None
            base = f"{uri.getScheme()}://{uri.getAuthority() or ''}/"
            bases.add(base)
            if base == "file:///":
                found.append(uri.getPath())
                continue
            try:
                found.append(fs.FileSystem.from_uri(uri.toString())[1])
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError):
                return None
    return (bases.pop(), found) if found and len(bases) == 1 else None


def _listed(spark: SparkSession, path) -> _Listed | None:
    """The files that Spark's readers take, where tasks can list them; else None. Counts them in a job or two."""
    roots = _roots(spark, path)
    if roots is None:
        return None
    base, folders = roots

    def entries(folders: list[str]) -> DataFrame:
        places = spark.createDataFrame([(x,) for x in folders], "place string")
        return places.mapInArrow(partial(_find, base=base), FOUND)

    def summary(found: DataFrame):
        return found.agg(
            F.collect_list(F.when(F.col("folder"), F.struct("file", "name"))).alias("folders"),
            F.count_if(~F.col("folder")).alias("n"),
            F.count_if(F.col("name").rlike(PACKED)).alias("packed"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        ).head()

    found = entries(folders)
    top = seen = summary(found)
    if top.folders:
        keys = {x.name.split("=")[0] if "=" in x.name else None for x in top.folders}
        if top.n or len(folders) > 1 or len(keys) > 1 or None in keys:
            return None
        found = entries([x.file for x in top.folders])
        seen = summary(found)
        if seen.folders:
            return None
    if seen.packed:
        return None
    tasks = max(2 * spark.sparkContext.defaultParallelism, seen.n // TASK_FILES, seen.bytes // TASK_BYTES)
    return _Listed(found.select("file", "name", "bytes"), tasks, base)


def _clean(name: Column, clean_ids: bool) -> Column:
    return clean_document_id(name) if clean_ids else name


def _document_id(clean_ids: bool) -> Column:
    # The name is percent-encoded as in a URI, where a plus sign stands for itself.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return _clean(name, clean_ids)


def list_documents(spark: SparkSession, path, clean_ids: bool = False) -> DataFrame:
    """``(file, doc_id, bytes)`` of every file, without reading it."""
    listed = _listed(spark, path)
    if listed is not None:
        return _documents(listed, clean_ids)
    found = spark.read.format("binaryFile").load(path)
    size = F.col("_metadata.file_size")
    return found.select(F.col("_metadata.file_path").alias("file"), _document_id(clean_ids).alias("doc_id"), size.alias("bytes"))


def _documents(listed: _Listed, clean_ids: bool) -> DataFrame:
    return listed.files.select("file", _clean(F.col("name"), clean_ids).alias("doc_id"), "bytes")


def split_documents(listed: DataFrame, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``(doc_id)`` of listed documents that are not one row: larger files, and names of several files."""
    files = listed.where(F.col("bytes") > 0).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"))
    return files.where((F.col("n") > 1) | (F.col("bytes") > whole_bytes)).select("doc_id")


def _read_listed(listed: _Listed, others: DataFrame, clean_ids: bool) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, value)`` of the files of no document in ``others``, and ``(doc_id, line)`` of the files of these."""
    files = _documents(listed, clean_ids).where(F.col("bytes") > 0)
    other = F.col("doc_id") == F.col("_other")
    whole = files.join(others, other, "left_anti").select("doc_id", "file").repartition(listed.tasks, "file")
    whole = whole.mapInArrow(partial(_read_whole, base=listed.base), "doc_id string, text binary")
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(WHOLE_BYTES).cast("long"))
    ranges = files.join(others, other, "left_semi").select("doc_id", "file", F.explode_outer(starts).alias("first"))
    ranges = ranges.withColumn("last", F.col("first") + WHOLE_BYTES).repartition(listed.tasks, "file", "first")
    lines = ranges.mapInArrow(partial(_read_lines, base=listed.base), "doc_id string, line binary")
    value = whole.select("doc_id", F.col("text").cast("string").alias("value"))
    return value, lines.select("doc_id", F.col("line").cast("string").alias("line"))


def read_documents(
    spark: SparkSession,
    path,
    max_line_bytes: int | None = None,
    clean_ids: bool = False,
    whole_bytes: int = WHOLE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text)`` of documents that are one row each, and ``(doc_id, line)`` of the others.

    A document is one row if it is a single file of at most ``whole_bytes``: what is distinct in it can be
    found inside the row. Larger files, and files whose name stands in several folders, are read line by
    line. Both together hold what ``read_document_lines`` reads; lines of ``max_line_bytes`` are dropped in both.
    Files without a byte give no row.
    """
    listed = _listed(spark, path)
    found = list_documents(spark, path, clean_ids) if listed is None else _documents(listed, clean_ids)
    others = split_documents(found, whole_bytes).select(F.col("doc_id").alias("_other"))
    text = F.col("value")
    if max_line_bytes is not None:
        short = F.filter(line_array("value"), lambda line: F.octet_length(line) + 1 < max_line_bytes)
        text = F.array_join(short, "\n")
    if listed is not None:
        whole, lines = _read_listed(listed, others, clean_ids)
        return whole.select("doc_id", text.alias("text")), drop_long_lines(lines, max_line_bytes)
    files = spark.read.text(path, wholetext=True).where(F.col("_metadata.file_size") <= whole_bytes)
    whole = files.select(_document_id(clean_ids).alias("doc_id"), text.alias("text"))
    lines = read_document_lines(spark, path, max_line_bytes, clean_ids)
    other = F.col("doc_id") == F.col("_other")
    return whole.join(others, other, "left_anti"), lines.join(others, other, "left_semi")
