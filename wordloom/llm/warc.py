"""WARC archives with one gzip member per record: a writer and a splittable reader (operator 4).

Writing: tasks write files of their own to a shared folder and return a manifest, which is settled
before anything reads it; files of attempts that did not count are never listed. Of records with equal
payloads of at least ``REVISIT_BYTES``, those with the largest id carry the payload and the
others are revisit records that refer to it.

Reading: files are cut into byte ranges, one task each. A task looks for gzip magic from its start
on, validates a candidate member by decoding its headers, and follows the chain of members from there
for more bytes than a stored deflate block can hold; a candidate whose chain breaks before lies inside
another member's data and is passed over. The task owns the records that start inside its range and reads the last one beyond the end.

Both sides use ``pyarrow.fs``, which opens local and object stores by their address.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.shared import fresh_path, settled

#: Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000
#: Compressed bytes after which a task starts another file, and those of one range.
FILE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
LEVEL = 6
READ_BYTES = 1 << 20
DATE = "2000-01-01T00:00:00Z"

#: The start of a deflate gzip member, and the profile of revisits by digest.
MAGIC = b"\x1f\x8b\x08"
#: Fixed value: the bytes of a stored deflate block; no run of foreign members is longer in another.
STORED_BYTES = 65535
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
RECORD_COLUMNS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string,"
    " refers_to long, payload binary"
)


def _record_id(page_id: int | None) -> str:
    own = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f"page {page_id}")
    return f"<urn:uuid:{own}>"


def _member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. Control characters and spaces of the url are percent-encoded."""
    stored = payload if refers_to is None else b""
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    ) + stored
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {_record_id(refers_to)}",
            f"WARC-Refers-To-Page-ID: {refers_to}",
        ]
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, name, size, count = None, "", 0, 0
        done: dict[str, list] = {"path": [], "size": [], "records": []}

        def close() -> None:
            out.close()
            done["path"].append(f"{folder}/{name}")
            done["size"].append(size)
            done["records"].append(count)

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in range(batch.num_rows):
                member = _member(*(c[row].as_py() for c in columns))
                if out is None or size + len(member) > FILE_BYTES and size:
                    if out is not None:
                        close()
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                out.write(member)
                size += len(member)
                count += 1
        if out is not None:
            close()
            yield pa.RecordBatch.from_pydict(
                done, schema=pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())])
            )

    return write


def write_warc(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record for each row of (page_id, url, html); returns the manifest (path, size, records).

    ``folder`` must be shared by all executors; by default it is a new one under
    ``spark.checkpoint.dir``. Null html is an empty payload. Rows without id are always responses.
    Rows that share the largest id of a payload are all responses. Further columns are ignored. An empty
    table gives an empty manifest. A very long page is a member of its own, held once in its task.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html"))
    tops = (
        own.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy(F.sha1(F.col("html").cast("string").cast("binary")).alias("digest"))
        .agg(F.max("page_id").alias("top"), F.min("page_id").alias("low"))
        .where("low < top")
        .select("digest", "top")
    )
    records = rows.join(tops, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") < F.col("top"), F.col("top")).alias("refers_to")
    )
    return settled(records.mapInArrow(_writer(folder), "path string, size long, records long"), "manifest")


class _Members:
    """The gzip members of a file, decoded from any offset with bounded reads."""

    def __init__(self, path: str, size: int):
        store, name = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(name)
        self.size = size

    def inflate(self, at: int, least: int | None = None) -> tuple[bytes, int] | None:
        """(data, next offset) of the member at ``at``; None if there is none.

        With ``least`` only so many bytes are decoded, and the offset says nothing. A member cut
        off by the end of the file is an error unless only its start is asked for.
        """
        unpack = zlib.decompressobj(31)
        parts, got, start = [], 0, at
        while not unpack.eof:
            data = self.file.read_at(min(READ_BYTES if least is None else 4096, self.size - at), at)
            if not data:
                if least is None:
                    raise EOFError(f"the member at {start} is cut off")
                break
            try:
                part = unpack.decompress(data)
            except zlib.error:
                return None
            at += len(data)
            parts.append(part)
            got += len(part)
            if least is not None and got >= least:
                break
        return b"".join(parts), at - len(unpack.unused_data)

    def opens(self, at: int) -> bool:
        """Whether a WARC record starts in a member at ``at``, by the first lines of its headers."""
        found = self.inflate(at, 16)
        return found is not None and re.match(rb"WARC/\d\.\d\r\n", found[0]) is not None

    def chain(self, at: int) -> bool:
        """Whether members follow each other for over STORED_BYTES or to the end of the file."""
        end = at + STORED_BYTES + 1
        while at < min(end, self.size):
            if not self.opens(at):
                return False
            try:
                found = self.inflate(at)
            except EOFError:
                return False
            if found is None:
                return False
            at = found[1]
        return True

    def first(self, start: int, end: int) -> int | None:
        """Offset of the first record that starts in ``[start, end)``."""
        if start == 0:
            return 0 if self.size else None
        at = start
        while at < end:
            data = self.file.read_at(min(READ_BYTES, end - at) + len(MAGIC) - 1, at)
            place = data.find(MAGIC)
            while place >= 0 and at + place < end:
                if self.opens(at + place) and self.chain(at + place):
                    return at + place
                place = data.find(MAGIC, place + 1)
            at += READ_BYTES
        return None


def _parse(record: bytes) -> dict | None:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    digest = fields.get("warc-payload-digest", "")
    digest = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None
    if kind == "response":
        found = hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError(f"record {fields.get('warc-record-id')} does not match its digest")
        digest = found

    def number(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    return {
        "page_id": number("warc-page-id"),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": len(payload) if kind == "response" else int(length[1]) if length else None,
        "payload_digest": digest,
        "refers_to": number("warc-refers-to-page-id"),
        "payload": payload if kind == "response" else None,
    }


def _reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                members = _Members(split["path"], split["size"])
                at = members.first(split["start"], split["end"])
                rows, held = [], 0
                while at is not None and at < split["end"]:
                    found = members.inflate(at)
                    if found is None:
                        raise ValueError(f"no gzip member at {at} of {split['path']}")
                    record, at = found
                    row = _parse(record)
                    if row is None:
                        continue
                    held += len(record) if with_payload else 200
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    if held > READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    return read


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of (path, size): see ``RECORD_COLUMNS``.

    Each byte range is a row dealt to the tasks by a hash of its place. Other record types are
    passed over. Payloads are checked against their digests; of a revisit, length and digest are
    those of the payload it refers to. A damaged file raises an error; no files give no rows.
    """
    spark = files.sparkSession
    splits = files.where("size > 0").select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    )
    splits = splits.withColumn("end", F.least(F.col("start") + split_bytes, F.col("size")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = splits.repartition(tasks, "path", "start")
    return dealt.mapInArrow(_reader(with_payload), RECORD_COLUMNS)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_warc(write_warc(pages), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
    FROM pages
), q AS (
    SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
           CASE WHEN octet_length(encode(h)) >= {REVISIT_BYTES} AND page_id < top THEN top END AS refers_to
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM q
"""
