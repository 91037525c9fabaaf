"""WARC archives: write records with an index, read selected records back by byte ranges.

``write_archives`` writes one gzip member per record into archives under a
shared folder and returns the index (archive, offset, length, URL, digest,
...).  ``read_records`` starts from index rows: it sorts them by place,
merges neighbouring ranges into few reads, and parses the records.

Files are opened with ``pyarrow.fs`` from the folder's URI (local or any
store pyarrow knows).  The index holds only archives of tasks that Spark
committed; an archive left by a lost attempt has a name of its own and is
never read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import staged
from orrery.session import scratch_path

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20  # an archive is closed when it has grown past this
TASK_BYTES = 128 << 20  # records that a task reads, if there are many
READ_GAP, READ_BYTES = 64 << 10, 8 << 20  # ranges closer than the gap are read at once, up to so many bytes

INDEX_SCHEMA = ("record_id string, page_id bigint, archive string, offset bigint, length bigint, url string, "
                "digest string, record_type string, refers_to string")
RECORD_SCHEMA = ("record_id string, page_id bigint, url string, record_type string, refers_to string, "
                 "payload binary, payload_bytes bigint, payload_digest string")


def open_fs(uri: str):
    """(file system, path) of a URI or of a plain local path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def plan_records(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Each page with its record id, payload digest, and the record it revisits, if any.

    Of rows with equal payloads of at least 100 bytes the one with the
    smallest key (null last; repeated keys: the first in scan order) is the
    response.  Only (digest, row) pairs are aggregated, with map-side minima,
    so a payload shared by very many rows meets in one small row; the join
    back is on the digest, large sides of which adaptive execution splits.
    """
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
                        F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn(
        "record_id", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
                              F.lit(":"), F.col("row").cast("string")))
    place = F.struct(F.col("page_id").isNull().alias("no_key"), "page_id", "row", "record_id")
    first = (rows.filter(F.octet_length("html") >= MIN_REVISIT_BYTES)
             .groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("digest", F.col("first.record_id").alias("first_id")))
    joined = rows.join(first, "digest", "left")
    revisit = F.col("first_id").isNotNull() & (F.col("first_id") != F.col("record_id"))
    return joined.select(
        "record_id", "page_id", "url", "digest", F.octet_length("html").cast("bigint").alias("payload_bytes"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        F.when(~revisit, F.col("html").cast("binary")).alias("payload"))


def _record(row: dict) -> bytes:
    body = row["payload"] or b""
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "text/html; charset=utf-8"),
            ("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("X-Payload-Length", str(row["payload_bytes"])),
            ("Content-Length", str(len(body)))]
    if row["url"] is not None:  # header lines end at a line break: the text is escaped and read back
        head.append(("WARC-Target-URI", row["url"].encode("unicode_escape").decode("ascii")))
    if row["refers_to"] is not None:
        head += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", "identical-payload-digest")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode("ascii") + b"\r\n" + body + b"\r\n\r\n"


def _parse(data: bytes) -> dict:
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("ascii").split("\r\n")[1:])
    payload = rest[:int(fields["Content-Length"])]
    record_id, refers = fields["WARC-Record-ID"][1:-1], fields.get("WARC-Refers-To")
    page, uri = record_id.split(":")[2], fields.get("WARC-Target-URI")
    digest = fields["WARC-Payload-Digest"].split(":", 1)[1]
    whole = fields["WARC-Type"] == "response"
    if whole and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {record_id} does not have its digest")
    return {"record_id": record_id, "page_id": None if page == "none" else int(page),
            "url": None if uri is None else uri.encode("ascii").decode("unicode_escape"),
            "record_type": fields["WARC-Type"], "refers_to": refers[1:-1] if refers else None,
            "payload": payload if whole else None,
            "payload_bytes": len(payload) if whole else int(fields["X-Payload-Length"]),
            "payload_digest": hashlib.sha256(payload).hexdigest() if whole else digest}


def write_archives(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the rows of ``plan_records`` to archives below ``folder``; return the committed index.

    Each task writes archives of about 64 MiB one after the other, with
    constant memory.  The index is staged as Parquet in the shared folder.
    """
    spark = records.sparkSession
    folder = folder or scratch_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        sink, name, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if sink is None or at >= ARCHIVE_BYTES:
                        if sink is not None:
                            sink.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = fs.open_output_stream(f"{path}/{name}", compression=None)
                    data = gzip.compress(_record(row), 6, mtime=0)
                    sink.write(data)
                    index.append({"record_id": row["record_id"], "page_id": row["page_id"], "archive": f"{folder}/{name}",
                                  "offset": at, "length": len(data), "url": row["url"], "digest": row["digest"],
                                  "record_type": row["record_type"], "refers_to": row["refers_to"]})
                    at += len(data)
                yield pa.RecordBatch.from_pylist(index, _INDEX)
        finally:
            if sink is not None:
                sink.close()

    return staged(records.mapInArrow(run, INDEX_SCHEMA), "warc-index")


_INDEX = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()),
                    ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.string())])
_RECORD = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def coalesce_ranges(places: list[tuple[int, int]], gap: int = READ_GAP, most: int = READ_BYTES) -> list[list[int]]:
    """Groups of indices of (offset, length) places in ascending order; each group is one read."""
    groups: list[list[int]] = []
    begin = end = 0
    for i, (offset, length) in enumerate(places):
        if groups and offset - end <= gap and offset + length - begin <= most:
            groups[-1].append(i)
            end = max(end, offset + length)
        else:
            groups.append([i])
            begin, end = offset, offset + length
    return groups


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of ``index`` name, payloads included.

    Index rows are dealt by ranges of (archive, offset): a task for each 8 MiB
    of records up to the session's shuffle partitions, beyond them one for
    each ``TASK_BYTES``.  A task opens an archive once per batch and reads
    merged ranges of at most 8 MiB (one record, if that is larger).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            archives, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
            i = 0
            while i < len(archives):
                j = i
                while j < len(archives) and archives[j] == archives[i]:
                    j += 1
                fs, path = open_fs(archives[i])
                with fs.open_input_file(path) as source:
                    for group in coalesce_ranges(list(zip(offsets[i:j], lengths[i:j], strict=True))):
                        own = [i + g for g in group]
                        base = offsets[own[0]]
                        data = source.read_at(max(offsets[g] + lengths[g] for g in own) - base, base)
                        rows = [_parse(data[offsets[g] - base:offsets[g] - base + lengths[g]]) for g in own]
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                i = j

    places = index.select("archive", "offset", "length")
    # the index is small beside the records that it names, so the tasks are counted from the records' bytes
    total = places.agg(F.sum("length")).first()[0] or 0
    blocks, least = -(-total // READ_BYTES), int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(blocks, least), -(-total // TASK_BYTES))
    dealt = places.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame, *, folder: str | None = None, key: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """Write a record for every row of ``pages``, then read all of them back (columns of RECORD_SCHEMA).

    A null html has an empty payload; null URLs have no target header; null
    keys come back as null.  Repeated rows are records of their own, revisits
    of the first when large enough.  Empty table: no archive, empty result.
    Other columns are ignored.
    """
    return read_records(write_archives(plan_records(pages, key=key, url=url, html=html), folder))
